"""The pipeline's stages in a row against plain Python on a small corpus."""

import hashlib
import random

import pytest

import corpus_pipeline as C
from test_jaccard import brute
from test_native import brute_lines, brute_mix
from tidemark.llm import quality as Q
from tidemark.llm.bpe import Codec
from tidemark.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, vocabulary


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    r = random.Random(8)
    folder = tmp_path_factory.mktemp("corpus")
    rows, labels = [], []
    passage = "\n".join(" ".join(r.choice(["red", "blue", "sun", "moon", "sea"]) + str(r.randint(0, 99)) for _ in range(9)) for _ in range(4))
    for i in range(160):
        good = i % 4 != 3
        lines = [" ".join(("" if good else "%%") + "".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(8)) for _ in range(r.randint(1, 9))]
        text = "\n".join(lines) + ("\n" + passage if i % 10 == 0 else "")
        if i % 9 == 4:
            text = rows[i - 1][1].replace("a", "a", 1) + " more"
        rows.append((i, text, r.choice(["en", "de"]), r.choice(["src0", "src1", "src2"]), len(text)))
        labels.append((i, int(good if i % 9 != 4 else (i - 1) % 4 != 3), 0))
    rows += [(200, None, None, None, None), (201, "", "en", "src0", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def test_stages_contract():
    assert [n for n, _ in C.STAGES] == ["quality", "line_dedup", "jaccard", "mixing", "bpe"] and C.ORACLE_SQL is None


def test_run_against_brute_force(spark, corpus):
    from tokenizers import Tokenizer

    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = Q.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.doc_id: r.predicted for r in Q.classify(docs, model).collect()}
    kept = [r for r in rows if scores[r[0]]]
    assert 0 < len(kept) < len(rows)
    text = {d: t for (d, _), (t, _, _) in brute_lines([(r[0], r[1]) for r in kept]).items()}
    group = {d: c for d, (_, c) in brute(list(text.items()), C.SHINGLE_WORDS, C.PERCENT).items()}
    rest = [r for r in kept if group[r[0]] == r[0]]
    taken = brute_mix([(r[0], text[r[0]], r[2], r[3]) for r in rest], MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    t = Tokenizer.from_file(vocabulary())
    want = []
    for d, _ in taken:
        ids = t.encode(text[d] or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256((text[d] or "").encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.decoded_sha256) for r in C.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)
    assert len({d for d, _ in taken}) < len(taken) or len(taken) <= len(rest)


def test_encoder_sends_no_texts_back_and_holds_no_second_vocabulary(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = C.tokenise(spark, docs, folder)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == len(rows)
    line = next(x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "MapInArrow" in x)
    assert "text" not in line.rsplit("[", 1)[1]
    with open(vocabulary(), encoding="utf-8") as f:
        assert type(Codec(f.read()).pre).__name__ == "ByteLevel"


def test_tasks_give_memory_back(monkeypatch):
    from tidemark.llm import common
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.lean(lambda batches: (2 * b for b in batches))(iter([1, 2]))) == [2, 4] and len(calls) == 2
    with pytest.raises(ZeroDivisionError):
        list(common.lean(lambda batches: (1 // b for b in batches))(iter([0])))
    assert len(calls) == 4
