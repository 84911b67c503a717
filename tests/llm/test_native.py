"""Line dedup, mixing and personal data: brute force, edge rows and DuckDB SQL."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import mixing, pii
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix


def brute_lines(rows, window=3):
    """rows: (id, text), distinct; in the order (id, hash of the text)."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42) & ((1 << 60) - 1))):
        if t is None:
            out[i, t] = (None, 0, 0)
            continue
        lines, gone = t.split("\n"), set()
        for k in range(len(lines) - window + 1):
            run = tuple(lines[k:k + window])
            if run in seen:
                gone.update(range(k, k + window))
            seen.add(run)
        out[i, t] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_line_dedup_against_brute_force(spark):
    r = random.Random(1)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "", "long line"]) for _ in range(r.randint(0, 9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n".join(str(k) for k in range(5000))), (63, "\n".join(str(k) for k in range(4000, 9000))), (None, "a\nb\nc\nd")]
    assert lines_of(spark, rows) == brute_lines(rows)


def lines_of(spark, rows):
    df = spark.createDataFrame([(*r, r[1]) for r in rows], "doc_id bigint, text string, was string")
    return {(x.doc_id, x.was): (x.text, x.n_lines, x.n_removed) for x in line_dedup(df).collect()}


def test_line_dedup_without_ids(spark):
    """Repeats among rows without an id, and among rows that share one, lose their later occurrences too."""
    r = random.Random(2)
    rows = {(r.choice([None, None, 5, 9223372036854775807, -9223372036854775808, k]), "\n".join(r.choice("abcd") for _ in range(r.randint(2, 12)))) for k in range(80)}
    got = lines_of(spark, sorted(rows, key=repr))
    assert got == brute_lines(rows)
    assert sum(n for (i, _), (_, _, n) in got.items() if i is None) > 0


def test_line_dedup_edges(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 9, "x", 5), (1, "a\nb\nc", 9, "x", 5), (2, "a\nb\nc", None, None, 5)],
                               "doc_id bigint, text string, n_removed int, covered string, n_chars bigint")
    got = line_dedup(df)
    assert sorted(got.columns) == sorted(["doc_id", "text", "covered", "n_chars", "n_lines", "n_removed"])
    # wholly equal rows stand together; the copy under a later id loses all lines
    assert sorted((r.doc_id, r.text, r.n_removed, r.n_chars) for r in got.collect()) == [(1, "a\nb\nc", 0, 5), (1, "a\nb\nc", 0, 5), (2, "", 3, 0)]
    assert line_dedup(df.where("false")).count() == 0


def brute_share(budget, caps, weights):
    """Water filling among siblings in whole tokens."""
    open_ = sorted(caps, key=lambda c: (caps[c] / weights[c], (c is not None, c)))
    out = {}
    while open_:
        c = open_[0]
        total = sum(weights[x] for x in open_)
        if caps[c] * total <= budget * weights[c]:
            out[c] = caps[c]
            budget -= caps[c]
            open_.pop(0)
        else:
            out.update({x: budget * weights[x] // total for x in open_})
            break
    return out


def brute_mix(rows, weights, share, epochs, seed):
    leaf = {}
    for d, t, lang, src in rows:
        dom = None if src is None else (f"d{int(re.search(r'[0-9]+$', src)[0]) % 4}" if re.search(r"[0-9]+$", src) else "none")
        leaf.setdefault((dom, lang, src), []).append((d, len((t or "").split())))
    supply = {k: sum(n for _, n in v) for k, v in leaf.items()}
    budgets = {(): min(sum(supply.values()) * share[0] // share[1], sum(supply.values()) * epochs)}
    for depth, level in enumerate(("domain", "lang", "source")):
        nxt = {}
        for p, b in budgets.items():
            kids = {k[depth] for k in leaf if k[:depth] == p}
            caps = {c: epochs * sum(s for k, s in supply.items() if k[:depth + 1] == (*p, c)) for c in kids}
            w = {c: weights.get(level, {}).get(c, 1) for c in kids}
            nxt.update({(*p, c): v for c, v in brute_share(b, caps, w).items()})
        budgets = nxt
    out = []
    for k, docs in leaf.items():
        full, rest = divmod(budgets[k], supply[k]) if supply[k] else (0, 0)
        out += [(d, e) for d, _ in docs for e in range(full)]
        if full < epochs:
            order = sorted(docs, key=lambda x: hashlib.md5(f"{seed}:{full}:{x[0]}".encode()).hexdigest())
            for d, n in order:
                rest -= n
                if rest < 0:
                    break
                out.append((d, full))
    return sorted(out)


@pytest.mark.parametrize("rows_per_bucket", [4096, 3])
def test_mixing_against_brute_force(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", rows_per_bucket)
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.randint(0, 30)), r.choice(["en", "en", "de", None]), r.choice(["src0", "src0", "src0", "src1", "src5", "blog", None])) for i in range(300)]
    rows += [(300, None, "en", "src9"), (301, "", "fr", "src2")]
    weights = {"domain": {"d0": 4, "d1": 3, "none": 5}, "lang": {"en": 5, "de": 2}, "source": {}}
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = mix(df, weights, budget_share=(4, 5), max_epochs=2, seed=7)
    assert sorted((x.doc_id, x.epoch) for x in got.collect()) == brute_mix(rows, weights, (4, 5), 2, 7)


def test_mixing_edges(spark):
    schema = "doc_id bigint, text string, lang string, source string, epoch string, key int"
    df = spark.createDataFrame([(1, "a b", "en", "s1", "q", 1), (1, "a b", "en", "s1", "q", 1), (None, "c", None, None, None, None)], schema)
    got = mix(df, {}, budget_share=(10, 1), max_epochs=3)
    assert sorted(got.columns) == sorted(["doc_id", "text", "lang", "source", "key", "domain", "epoch"])
    assert got.count() == 9  # more budget than supply: everything, three times
    assert mix(df.where("false"), {}).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and (not 12 <= len(d) <= 19 or sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate(d[::-1])) % 10):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def test_pii_against_plain_patterns(spark):
    r = random.Random(3)
    bits = ["a.b@c.de", "x@y.z_q@w.v", "@", "_", "é👍", " ", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.255.9", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (555) 010-9999", "+49.", "12", "-", "7", "DE89 3704 0044 0532 0130 00", "card ", "call ", "+", "..", "a@b", "%x@a-b.c"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 14)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "9" * 30000 + " a" * 5 + "x" * 30000 + "@b.cd"), (403, "1 " * 20000), (404, "mail me: +" * 3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = F.filter(F.col("spans"), lambda s: s["kind"].isin(*pii.BASE))
    got = {x.doc_id: x.s for x in pii.find_pii(df).select("doc_id", pii.listed(spans).alias("s")).collect()}
    assert got == {i: brute_base(t) for i, t in rows}


def test_pii_iban_score_redaction(spark):
    df = spark.createDataFrame([(1, "my bank: DE89 3704 0044 0532 0130 00, not DE89 3704 0044 0532 0130 01", "s"), (2, "mail a@b.cd or +1 555 010 9999", None), (3, None, None)],
                               "doc_id int, text string, spans string")
    rows = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert [(s.kind, s.start, s.end, s.score) for s in rows[1].spans if s.kind == "iban"] == [("iban", 9, 36, 0.9)]
    assert [(s.kind, s.value) for s in rows[2].spans] == [("email", "a@b.cd"), ("phone", "+1 555 010 9999")]
    assert rows[3].spans == []
    text = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert text[2] == "mail [email] or [phone]" and text[3] is None
    assert pii.find_pii(df.where("false")).count() == 0


def _ibans(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [[(s.value, s.score) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(df).orderBy("doc_id").collect()]


def test_pii_iban_has_its_country_length(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "NO9386011117947"
    got = _ibans(spark, f"{de} BIC COBADEFFXXX", "DE89370400440532013000 NOW", f"x {gb}, {no}.", f"{gb}X", f"é{no}é", "ZZ89370400440532013000", f"A{no}")
    assert got == [[(de, 0.8)], [("DE89370400440532013000", 0.8)], [(gb, 0.8), (no, 0.8)], [], [(no, 0.8)], [], []]


def test_pii_score_decides_on_odd_grouping(spark):
    odd = "DE 89 37040044 0532013000".replace("DE 89", "DE89")
    got = _ibans(spark, f"see {odd} here", f"account {odd} here", f"bankers {odd}", "bank " + "y" * 30 + f" {odd}", "a bank" + "y" * 38 + f" {odd}", f"{odd} " + "z" * 35 + " banks now")
    assert got == [[], [(odd, 0.55)], [], [(odd, 0.55)], [], []]


def test_pii_context_is_whole_words(spark):
    df = spark.createDataFrame([(0, "hotel +1 555 010 9999"), (1, "tel +1 555 010 9999"), (2, "+1 555 010 9999 recall"), (3, "ho" + "tel " + "-" * 36 + " +1 555 010 9999")],
                               "doc_id int, text string")
    assert [r.spans[0].score for r in pii.find_pii(df).orderBy("doc_id").collect()] == [0.6, 0.7, 0.6, 0.6]


def test_pii_many_matches(spark):
    text = "".join(f"é a{k}@b.cd" for k in range(5000))
    got = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first().spans
    want = [(m.start(), m.end(), m[0]) for m in re.finditer(PLAIN["email"], text)]
    assert [(s.start, s.end, s.value) for s in got] == want and len(want) == 5000
