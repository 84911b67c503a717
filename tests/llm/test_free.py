"""Encoding, classifier, HTML, fingerprints, WARC and top-k: brute force, library and edge rows."""

import gzip
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import fingerprint as P
from tidemark.llm import html_text as H
from tidemark.llm import quality as Q
from tidemark.llm import topk as K
from tidemark.llm import warc as W
from tidemark.llm.bpe import Codec, encode
from tidemark.llm.queries import vocabulary
from tidemark.llm.tokens import slices, words


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    with open(vocabulary(), encoding="utf-8") as f:
        return Codec(f.read()), Tokenizer.from_file(vocabulary())


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab'sdtlm !?\n\t\r\x0b\xa0  \x1c09.,<|>éà漢👍"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_bpe_as_the_library(both, text):
    codec, library = both
    ids = codec.encode(text.encode())
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == text


def test_bpe_long_and_special(both):
    codec, library = both
    r = random.Random(1)
    for text in ("a" * 4000, " " * 999 + "x", "\n" * 999 + "x", "x<|endoftext|>y<|endoftext|><|endo", "".join(r.choice("theanr ") for _ in range(20000)), "à la à\n\nà  b", ""):
        assert codec.encode(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_bpe_edges(spark):
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (2, None, 6), (None, "", 7)], "doc_id bigint, text string, n_tokens int")
    got = encode(df, vocabulary())
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    rows = sorted(((r.doc_id or 0, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()))
    assert rows == [(0, 0, b"", ""), (1, 2, b"\x40\0\0\0\x13\x01\0\0", "a b"), (1, 2, b"\x40\0\0\0\x13\x01\0\0", "a b"), (2, 0, b"", "")]
    assert encode(df.where("false"), vocabulary()).count() == 0


def test_words_are_whitespace_runs():
    texts = ["a  b\tc", "", None, "\n x", "é\x0by", "end "]
    got = [[] for _ in texts]
    for first, raw, at in slices(pa.array(texts)):
        for s, e, d in zip(*words(raw, at)):
            got[first + d].append(raw[s:e].tobytes())
    assert got == [(t or "").encode().split() for t in texts]


def test_features_of_plain_cases():
    texts = pa.array(["AA bb!! bb!!", "", "x | y | z\nx | y | z", None])
    x = np.concatenate([Q.features(raw, at) for _, raw, at in slices(texts)])
    f = {n: x[:, k] for k, n in enumerate(Q.FEATURES)}
    assert np.allclose(f["words"], np.log1p([3, 0, 10, 0])) and np.allclose(f["chars"], np.log1p([12, 0, 19, 0]))
    assert f["repeat_words"][0] == pytest.approx(1 / 3) and f["distinct_words"][0] == pytest.approx(2 / 3)
    assert f["repeat_lines"][2] == 0.5 and f["bars"][2] == pytest.approx(0.4) and np.isfinite(x).all()


def test_additive_model_learns_pairs():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0.3) | ((x[:, 1] > 0) ^ (x[:, 2] > 0))).astype(float)
    m = Q.fit(x[:2000], y[:2000])
    assert m["pairs"] and {tuple(sorted(p[:2])) for p in m["pairs"]} >= {(1, 2)}
    assert ((Q.predict(m, x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    one = Q.fit(x[:100], np.ones(100))
    assert (Q.predict(one, x[:5]) > 0.9).all()


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7), "en") for i in range(40)] + [(None, None, None)], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, None)], "doc_id bigint, quality int")
    got = Q.classify(docs, Q.train(docs, labels))
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == 41
    none = Q.train(docs, labels.where("false"))
    assert {r.score for r in Q.classify(docs, none).collect()} == {0.5}
    assert Q.classify(docs.where("false"), none).count() == 0


PAGE = ('<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
        '<!-- x <p>no</p> --><article><h1>Head &amp; line</h1><p><b>One  two&nbsp;three.<br><p>Next &#233; para &lt;b&gt;.</article><div class="comments"><p>I liked it</p></div>'
        "<footer>&copy; x</footer></body></html>")


def test_html_blocks_and_text():
    field = H.learn([])
    assert [b.text for b in H.blocks_of(PAGE)] == ["Home", "Head & line", "One two three.", "Next é para <b>.", "I liked it", "© x"]
    assert H.main_text(PAGE, field) == "Head & line\nOne two three.\nNext é para <b>."
    assert H.main_text(None, field) == "" and H.main_text("", field) == "" and H.main_text("<!-- open", field) == ""
    H.main_text("<div>" * 20000 + "x" + "<a<" * 5000, field)  # no recursion, no long scan


def test_html_head_without_end():
    def texts(page):
        return [b.text for b in H.blocks_of(page)]

    assert texts("<html><head><title>T</title><body><article><p>Hi</article>") == ["Hi"]
    assert texts("<head><meta charset=x><link href=y>\n<style>p{}</style><script>1</script><p>Hi<div>you") == ["Hi", "you"]
    assert texts("<head><title>T</title> plain <b>text</b>") == ["plain text"]
    assert texts("<head><template><p>no</p></template><title>T</title></head><body>yes<head>too") == ["yestoo"]
    assert texts("<html><head> <title>T</title> </head> <body><p>Hi") == ["Hi"]
    assert texts("<html><head><title>T</title><noscript><p>no</p></noscript><header>top</header>") == ["top"]


def test_html_names_of_long_tags():
    for n in (0, 9_000, 20_000, 300_000):
        for page in (f'<div data-x="{"y" * n}" class="comments">one</div>', f'<div class="comments" style="{"y;" * n}">one</div>'):
            assert [(e.tag, e.names) for e in H.blocks_of(page)[0].node.path()] == [("div", ("comments",))]
    H.blocks_of("<div " + "class= " * 100_000 + "id=\"" * 100_001 + ">one")  # no long scan


def test_html_field_on_other_layouts():
    texts = [[f"line {k} of text number {i} goes on and on here." for k in range(6)] for i in range(60)]
    field = H.learn([])
    right = total = 0
    for i, lines in enumerate(texts):
        blocks = H.blocks_of(H.layouts(lines[0], lines, ["some other prose that is here for filling."], ["home", "about"], 900 + i))
        y = field.decode(blocks)
        right += sum(int(b.label == "1") == v for b, v in zip(blocks, y))
        total += len(y)
    assert right > 0.95 * total


def test_viterbi_is_the_best_path():
    field = H.learn([PAGE])
    blocks = H.blocks_of(PAGE)
    e = [sum(field.weights.get(x, 0.0) for x in f) for f in H.features_of(blocks)]
    same = H.same_parent(blocks)

    def score(y):
        return sum(v * w for v, w in zip(y, e)) + sum(field.change[same[k]][y[k - 1]][y[k]] for k in range(1, len(y)))

    paths = [[(m >> k) & 1 for k in range(len(blocks))] for m in range(1 << len(blocks))]
    assert math.isclose(score(field.decode(blocks)), max(map(score, paths)))


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None)], "page_id bigint, url string, html string, text string")
    got = H.extract(df, H.train(df))
    assert sorted(got.columns) == ["html", "n_chars", "page_id", "text", "url"]
    assert sorted(r.n_chars for r in got.collect())[0] == 0 and got.where("n_chars > 20").count() == 2
    assert H.extract(df.where("false"), H.train(df.where("false"))).count() == 0


def test_entropies_against_counting():
    r = np.random.default_rng(2)
    raw = np.concatenate([r.integers(0, 4, 300), np.zeros(200), r.integers(0, 256, 300)]).astype(np.uint8)
    e = P.entropies(raw)
    assert len(e) == len(raw) - 63
    for i in range(len(e)):
        total = sum(int(P._G[c]) for c in Counter(raw[i:i + 64].tolist()).values())
        assert e[i] == (P._FULL - total) * P.BINS // P._FULL


def test_fingerprints_do_not_depend_on_neighbours():
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefgh ijklm.\n") for _ in range(n)).encode() for n in (0, 1, 63, 64, 65, 100, 127, 128, 900, 20000, 700000)]
    rank = P.ranks(np.arange(P.BINS + 1)[::-1])
    together = P.fingerprints(texts + texts, rank)
    assert together[:11] == together[11:] == [P.fingerprints([t], rank)[0] for t in texts]
    assert together[0] == [] and all(together[1:11])
    assert all(P.likeness(f, P.filters_of(P.text_of(f))) == 1 for f in together)
    assert P.likeness(together[8], together[9]) < 0.2 and P.likeness(together[0], together[8]) == 0


def test_next_document_order_and_edges(spark):
    rows = [(5, "e" * 100), (1, None), (3, "abc" * 50), (3, "abc" * 50), (9, ""), (None, "tail text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = P.compare_edited(df).collect()
    assert len(got) == 6
    by = Counter((r.doc_id, r.n_chars) for r in got)
    assert by == Counter({(5, 100): 1, (1, 0): 1, (3, 150): 2, (9, 0): 1, (None, 9): 1})
    import hashlib

    sha = {(r.doc_id, r.edited_sha256) for r in got}
    assert (5, hashlib.sha256(b"e" * 75).hexdigest()) in sha  # next is document 9, empty
    assert (None, hashlib.sha256(b"tail te").hexdigest()) in sha  # next is the first, empty
    assert any(r.doc_id == 3 and r.near_next == 1 for r in got)
    assert P.compare_edited(df.where("false")).count() == 0
    assert P.compare_edited(df.where("doc_id = 5")).collect()[0].near_next == 1


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>é {i}\r\n\r\nWARC/1.0</p>") for i in range(25)] + [(7, "http://x/7", "<p>é 7\r\n\r\nWARC/1.0</p>"), (None, None, None)]
    packed = W.pack(spark.createDataFrame(rows, "page_id bigint, url string, html string"), per_file=10)
    W.write_warc(packed, str(tmp_path / "w"))
    back = W.read_warc(spark, str(tmp_path / "w")).collect()
    assert Counter((r.uri, bytes(r.payload).decode()) for r in back) == Counter((u or "", h or "") for _, u, h in rows)
    assert sorted((r.offset, r.length) for r in back) == sorted((r.offset, r.length) for r in packed.collect())
    one = b"WARC/1.0\r\nWARC-Type: x\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    assert [(h["warc-type"], p) for _, _, h, p in W.parse_warc(gzip.compress(one) + gzip.compress(one))] == [("x", b"hi")] * 2


def test_warc_audit(spark):
    a = [(f, o * 1000, 1000, f"d{f}-{o}") for f in range(300) for o in range(20)]
    b = [x for x in a if x not in (a[5], a[777])]
    b = [(f, o, n, "bad") if (f, o) == (40, 3000) else (f, o, n, d) for f, o, n, d in b] + [(299, 90000, 1000, "new"), (10, 50000, 1000, a[200][3])]
    b = [x for x in b if x != a[200]]
    schema = "file bigint, offset bigint, length bigint, digest string"
    got = {(r.file, r.offset, r.fault) for r in W.audit(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    assert got == {(0, 5000, "missing"), (38, 17000, "missing"), (40, 3000, "changed"), (299, 90000, "extra"), (10, 0, "moved")}
    same = spark.createDataFrame(a, schema)
    assert W.audit(same, same).count() == 0
    none = same.where("false")
    assert W.audit(none, none).count() == 0 and W.audit(same.where("file < 2"), none).count() == 40


@pytest.mark.parametrize("packed_files", [False, True])
def test_audit_of_stored_files(spark, tmp_path, packed_files):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>é {i} WARC/1.0</p>" * (1 + i % 3)) for i in range(12)], "page_id bigint, url string, html string")
    packed = W.pack(pages, per_file=6)
    W.write_warc(packed, str(tmp_path / "w"))
    index, keys = W.stored_index(spark, str(tmp_path / "w")), ("file", "offset", "length", "digest")
    assert sorted(map(tuple, index.select(*keys).collect())) == sorted(map(tuple, packed.select(*keys).collect()))
    roots = [tmp_path / "a", tmp_path / "b"]
    for root in roots:  # copies without Hadoop's own checksums
        for f in (tmp_path / "w").rglob("part-*"):
            raw, out = f.read_bytes(), root / f.parent.name / "records"
            out.parent.mkdir(parents=True)
            out.write_bytes(b"".join(gzip.compress(raw[at: at + n], mtime=0) for at, n, _, _ in W.parse_warc(raw)) if packed_files else raw)
    first = W.stored_index(spark, str(roots[0]))
    victim = sorted(roots[1].rglob("records"))[0]
    raw = victim.read_bytes()
    record = first.where(f"file = {victim.parent.name[5:]} and offset = 0").first()
    whole = set(first.select(*keys).collect())
    assert set(W.stored_index(spark, str(roots[1])).select(*keys).collect()) == whole
    # a byte of the magic, of the payload, of the closing line end, and one behind the last record
    for at in (2, record.length - 6, record.length - 1, None):
        victim.write_bytes(raw + b"x" if at is None else raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1:])
        now = set(W.stored_index(spark, str(roots[1])).select(*keys).collect())
        assert {r.file for r in now ^ whole} == {record.file}, at
    found = W.audit(first, W.stored_index(spark, str(roots[1]))).collect()
    assert [(r.file, r.offset, r.length, r.fault) for r in found] == [(record.file, len(raw), 1, "extra")]


def brute_top(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % every == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block", [8192, 37])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "BATCH", 5)
    monkeypatch.setattr(K, "FEW", 6)
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(12)]) for i in range(220)]
    rows += [(300 + i, rows[3][1]) for i in range(9)] + [(400, [float("nan")] * 12), (401, None), (402, [None] * 12), (403, []), (None, rows[1][1]), (410, [0.0] * 12), (420, [float("inf")] * 12)]
    got = K.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), is_query=lambda i: i % 10 == 0)
    f32 = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v else v) for i, v in rows]
    assert {tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_top(f32, 5, 10)


def test_top_k_edges(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in K.top_k(df, is_query=lambda i: i == 0).collect()] == [(0, 1, 1, 256 * 256 * 11)]
    assert K.top_k(df.where("false"), is_query=lambda i: i == 0).count() == 0
    assert K.top_k(df, is_query=lambda i: i == 5).count() == 0


def test_top_k_repeated_query_ids(spark):
    """Equal query rows are one query; other vectors under the same id are queries of their own."""
    r = random.Random(9)
    vector = lambda: [float(r.randrange(-40, 40)) / 16 for _ in range(4)]
    v = [vector() for _ in range(12)]
    rows = [(i, v[i]) for i in range(1, 9)] + [(0, v[9]), (0, v[9]), (0, v[10]), (20, v[11]), (20, v[11]), (3, v[4])]
    got = K.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), is_query=lambda i: i % 20 == 0)
    whole = lambda x: [math.floor(256 * c) for c in x]
    want = []
    for q, x in ((0, v[9]), (0, v[10]), (20, v[11])):
        best = sorted((-sum(a * b for a, b in zip(whole(x), whole(y))), i) for i, y in rows if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_bpe_windows_of_long_texts(both, monkeypatch):
    """Texts far beyond a window, odd ones among usual ones, and pieces beyond the rounds' length."""
    from tidemark.llm import bpe

    monkeypatch.setattr(bpe, "SLICE_BYTES", 300)
    codec, library = both
    r = random.Random(4)
    words_ = ["don't", "I'll", "  x", "\n\n'ss", "naïve", "×÷", "日本", "a" * 200, "0123", "<|endoftext|>", "--'re", "\t", "ÿÀ", "he'd've"]
    texts = [" ".join(r.choices(words_, k=r.randrange(200))) for _ in range(40)] + ["", "a\xa0b " * 300, "x" * 3000, " " * 900, "b c " * 900]
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    ids, counts = codec.encode_slice(np.frombuffer(raw, np.uint8), offsets)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert codec.decode_slice(ids).tobytes() == raw


def test_bpe_refuses_other_vocabularies(both):
    import json

    with open(vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}, {"model": {**spec["model"], "byte_fallback": True}}):
        with pytest.raises(ValueError):
            Codec(json.dumps({**spec, **change}))


def plain_score(model, x):
    """The score of one feature row, look-up by look-up."""
    def place(edges, v):
        return sum(1 for e in edges if e <= v)

    logit = model["base"]
    if model["edges"]:
        logit += sum(t[place(e, v)] for e, t, v in zip(model["edges"], model["tables"], x))
        logit += sum(t[place(model["pair_edges"][i], x[i]), place(model["pair_edges"][j], x[j])] for i, j, t in model["pairs"])
    return 1 / (1 + math.exp(-logit))


def test_quality_scores_are_sums_of_table_entries(spark):
    """Scores of a whole table against plain look-ups and additions of the trained tables."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = Q.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert model["edges"]
    rows = Q.classify(docs, model).collect()
    texts = pa.array([r.text for r in rows], pa.large_string())
    x = np.concatenate([Q.features(raw, at) for _, raw, at in slices(texts)])
    for r, f in zip(rows, x.tolist()):
        want = plain_score(model, f)
        assert abs(r.score - want) < 1e-9 and (r.predicted == (r.score >= 0.7))


def test_pairwise_tables_are_looked_up_and_added():
    r = np.random.default_rng(8)
    x = r.normal(size=(1500, len(Q.FEATURES)))
    model = Q.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float))
    assert any({i, j} == {0, 1} for i, j, _ in model["pairs"])
    got = Q.predict(model, x[:200])
    assert np.allclose(got, [plain_score(model, f) for f in x[:200].tolist()], atol=1e-12)
