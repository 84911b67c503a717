"""Operators 11 to 13 against brute force: edge rows, blocks, shards, runs and tiles made small on purpose."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import collocations as col
from tidemark.llm import divergence as div
from tidemark.llm import lattice


def brute_vectors(rows, cosine=0.93):
    """(id, links, component, kept) of (id, vector, label) rows by all pairs."""
    def able(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if able(a, la) and able(b, lb) and la == lb and len(a) == len(b):
            a, b = np.array(a, float), np.array(b, float)
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    out = [(r[0], links[i], least.get(find(i))) for i, r in enumerate(rows)]
    return sorted(((a, b, c, c is None or a == c) for a, b, c in out), key=repr)


def near(spark, rows, **how):
    df = spark.createDataFrame([(i, v, k, "x") for i, v, k in rows], "vec_id bigint, embedding array<float>, label int, cells string")
    got = lattice.near_vectors(df, **how).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr)


def planted(dim, clusters, size, cosines, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(clusters):
        a = rng.normal(size=dim)
        a /= np.linalg.norm(a)
        for s in range(size):
            b = rng.normal(size=dim)
            b -= (a @ b) * a
            b /= np.linalg.norm(b)
            c = cosines[(k + s) % len(cosines)]
            out.append(((a if not s else c * a + np.sqrt(1 - c * c) * b) * rng.uniform(0.5, 3)).astype(np.float32).tolist())
    return out


def test_e8_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    at = lattice.e8_nearest(x)
    doubled = 2 * at
    assert ((doubled % 2).max(1) == (doubled % 2).min(1)).all() and (at.sum(1) % 2 == 0).all()
    steps = lattice.e8_shortest()
    assert steps.shape == (240, 8) and ((steps**2).sum(1) == 2).all()
    # no neighbour is nearer, and nothing lies farther off than the covering radius 1
    assert (((x - at) ** 2).sum(1)[:, None] <= ((x[:, None] - at[:, None] - steps) ** 2).sum(2) + 1e-9).all()
    assert ((x - at) ** 2).sum(1).max() <= 1 + 1e-9


def test_near_vectors_edge_rows(spark):
    one = planted(16, 12, 4, [0.99, 0.97])
    rows = [(i, v, i // 24) for i, v in enumerate(one)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [1.0, None], 1), (104, [float("nan")] * 16, 1), (105, one[0], None),
             (106, [float("inf")] * 16, 1), (0, one[0], 0), (None, one[0], 0), (None, [5.0] * 16, 9), (107, [1.0, 2.0], 0), (107, [1.0, 2.0], 0),
             (108, [2.0, 4.0], 0), (109, [3e38, 6e38 / 2], 0), (110, [-1.0, -2.0], 0)]
    assert near(spark, rows) == brute_vectors(rows)
    assert near(spark, []) == []


@pytest.mark.parametrize("block", [7, 8192])
def test_near_vectors_hot_cell(spark, monkeypatch, block):
    """One cell with most rows, in blocks; copies and near copies of one vector."""
    monkeypatch.setattr(lattice, "SMALL", 4)
    rows = [(i, v, 1) for i, v in enumerate(planted(32, 1, 90, [0.999, 0.99]) + planted(32, 20, 2, [0.985], seed=8))]
    rows += [(200 + i, rows[0][1], 1) for i in range(40)]
    assert near(spark, rows, block=block) == brute_vectors(rows)


def test_near_vectors_recall(spark):
    for cosine, least in ((0.932, 0.9), (0.95, 0.96), (0.98, 0.999)):
        rows = [(i, v, 0) for i, v in enumerate(planted(64, 1500, 2, [cosine]))]
        got = sum(n for _, n, _, _ in near(spark, rows)) / 2
        assert least * 1500 <= got <= 1500


# operator 12

PIECE, WORD = re.compile(r"[.,;:!?\x0a-\x0d]"), re.compile(r"[^\x20\x09]+")


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_phrases(rows, support, covered=80, top=2000):
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(small(text or "")):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i: i + k])] += 1
    cand = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= support}
    out = []
    for (lang, p), a in cand.items():
        score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        longer = [c for (other, q), c in cand.items() if other == lang and len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
        if not any(100 * c >= covered * a for c in longer):
            out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    out.sort()
    rank = collections.Counter()
    got = []
    for lang, score, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(got)


def phrases(spark, rows, **how):
    df = spark.createDataFrame([(t, k, 1, "x") for t, k in rows], "text string, lang string, f int, phrase string")
    return sorted(tuple(r) for r in col.collocations(df, **how).collect())


def corpus(seed, texts=120, longest=60):
    rng = random.Random(seed)
    words = ["a", "B", "cd", "Éa", "ä", "x1", "日本", "the", "of"]
    gaps = [" ", "  ", "\t", ", ", "\n", ". ", " \x0b", "; "]
    return ["".join(rng.choice(words) + rng.choices(gaps, [20, 2, 2, 1, 1, 1, 1, 1])[0] for _ in range(rng.randrange(longest))) for _ in range(texts)]


@pytest.mark.parametrize("support,block", [(3, 4_000_000), (30, 500)])
def test_collocations_brute_force(spark, monkeypatch, support, block):
    monkeypatch.setattr(col, "BLOCK", block)
    rows = [(t, k) for t, k in zip(corpus(1), itertools.cycle(["en", "en", "de", None]))]
    rows += [(None, "en"), ("", "fr"), ("  \t. ", "en"), ("w" * 70_000 + " " + "y " * 300, "en"), ("only once", "es"), ("x y " * 40, "")] + rows[:20]
    got = phrases(spark, rows, support=support)
    assert got and got == brute_phrases(rows, support)
    assert phrases(spark, rows, support=support, top=7) == brute_phrases(rows, support, top=7)
    assert phrases(spark, []) == []


def test_collocations_keep_what_the_map_adds(spark, monkeypatch):
    """A bit map that is full of clashes costs time, never rows."""
    monkeypatch.setattr(col, "FILTER_BITS", 64)
    rows = [(t, "en") for t in corpus(2, texts=60)]
    assert phrases(spark, rows, support=5) == brute_phrases(rows, 5)


# operator 13

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, min_docs, top=10):
    docs, count, groups = collections.Counter(), collections.defaultdict(collections.Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [small(t) for t in TERM.findall(text or "")]
        docs.update({(lang, t) for t in terms})
        count[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for (k, t), n in docs.items() if k == lang and n >= min_docs}
        sources = [s for k, s in groups if k == lang]
        total = collections.Counter()
        for s in sources:
            total.update({t: n for t, n in count[lang, s].items() if t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def divergence(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "text string, lang string, source string, term string, rank int")
    return sorted(tuple(r) for r in div.source_divergence(df, **how).collect())


@pytest.mark.parametrize("block,chunk,tile,tiles", [(2_000_000, 256, 256, 128), (40, 3, 2, 2)])
def test_divergence_brute_force(spark, monkeypatch, block, chunk, tile, tiles):
    """Also with runs of 40 postings, chunks of three terms and two tiles of two sources."""
    for name, value in (("BLOCK_TERMS", block), ("CHUNK", chunk), ("TILE", tile), ("TILES", tiles)):
        monkeypatch.setattr(div, name, value)
    rng = random.Random(5)
    words = ["a", "B", "b", "Éa", "éa", "日本", "the", "of", "ﬀ", "z9z", "x_y", "I'm"]
    rows = [(" ".join(rng.choices(words, [rng.random() + 0.01 for _ in words], k=rng.randrange(40))), rng.choice(["en", "de", None]),
             rng.choice(["s1", "s2", "s3", "", None, "s4", "ü"])) for _ in range(200)]
    rows += [(None, "en", "empty"), ("", "xx", "lone"), ("", "yy", "a"), ("1 2 3", "yy", "b"), ("rare", "de", "s9"), ("a " * 50_000, "en", "s1")] + rows[:9]
    assert divergence(spark, rows, min_docs=10) == brute_divergence(rows, 10)
    assert divergence(spark, rows, min_docs=1, shards=3) == brute_divergence(rows, 1)
    assert divergence(spark, []) == []


def test_share_is_exact_beyond_64_bits(spark):
    big = [(9 * 10**15 // 3, 9 * 10**15), (7, 9 * 10**15), (9 * 10**15, 9 * 10**15), (0, 1), (123456789012345, 987654321098765)]
    df = spark.createDataFrame(big, "n bigint, whole bigint")
    got = [r[0] for r in df.select(div.share(df["n"], df["whole"])).collect()]
    assert got == [1 + 1000000000 * n // w for n, w in big]


def test_merge_opens_chunks_in_order():
    opened = []

    def chunks():
        for t in (["a", "m", "z"], ["b", "c"], ["b", "z"], ["d"], ["z"]):
            opened.append(t[0])
            yield div.Chunk("en", t, [1] * len(t), [1] * len(t), ["s"], [0] * len(t), [2] * len(t))

    got = []
    for term, counts in div.merge_runs(chunks(), 1):
        got.append((term, counts["s"], len(opened)))
    # one chunk beyond the term at most
    assert got == [("a", 2, 2), ("b", 4, 4), ("c", 2, 4), ("d", 2, 5), ("m", 2, 5), ("z", 6, 5)]
    assert [t for t, _ in div.merge_runs(chunks(), 2)] == ["b", "z"]
