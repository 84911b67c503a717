"""The Jaccard join against brute force, and its parts."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard as J
from tidemark.llm.components import components
from tidemark.llm.tokens import shingle_sets, slices


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for d in sorted(sets):
        shared = collections.Counter(e for s in sets[d] for e in holders[s])
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def corpus(seed, n=160):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    common = [word() for _ in range(60)]
    texts = []
    for _ in range(n // 8):
        base = [word() for _ in range(r.choice([1, 2, 3, 5, 8, 14, 30, 80, 200]))]
        if r.random() < 0.5:
            base += common
        for _ in range(8):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                t[r.randrange(len(t))] = word()
            texts.append(r.choice([" ", "  ", "\n", "\t"]).join(t).replace("a", r.choice("aA")))
    texts += ["", "  \n", None, "one", "ONE", "a b", "word " * 3000, "word " * 3001]
    return list(enumerate(texts))


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1), (5, 80, 2)])
def test_against_brute_force(spark, k, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(df, k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "LEAF", 2)
    monkeypatch.setattr(J, "HUB_ROWS", 2)
    rows = corpus(5, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), k=4, percent=85).collect()}
    assert got == brute(rows, 4, 85)


def test_edges(spark):
    df = spark.createDataFrame([(7, "a b c d e", 1), (7, "a b c d e", 1), (3, "A B C D E", None), (None, "a b c d e", 2), (9, None, 3), (9, None, 3)],
                               "doc_id bigint, text string, node int")
    got = sorted(map(tuple, J.near_groups(df).collect()), key=str)
    assert got == sorted([(7, 2, 3), (7, 2, 3), (3, 2, 3), (None, 2, 3), (9, 0, 9), (9, 0, 9)], key=str)
    kept = J.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 9, 9]
    assert J.near_groups(df.where("false")).count() == 0
    long = [f"w{k}" for k in range(60)]
    near = spark.createDataFrame([(None, " ".join(long)), (8, " ".join(long[:-1] + ["x"])), (8, "other text of that id entirely"), (5, " ".join(["x"] + long[1:-1] + ["x"]))],
                                 "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.component_id) for r in J.near_groups(near).collect()) == [("5", 5), ("8", 5), ("8", 8), ("None", 5)]


def test_keep_one_by_row(spark):
    long = [f"w{k}" for k in range(60)]
    base, near, other = " ".join(long), " ".join(long[:-1] + ["x"]), "other text of that id entirely"
    rows = [(None, base, "a"), (None, base, "a"), (8, near, "a"), (8, other, "a"), (5, base, "a"), (5, base, "a"), (5, base, "b"), (5, near, "c"),
            (None, "only rows without an id", "a"), (None, "only rows without an id", "a"), (None, None, "a"), (9, "", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = [(r.doc_id, r.text) for r in J.keep_one(df, k=4, percent=80, nameless=True).collect()]
    assert sum(t in (base, near) for _, t in got) == 1 and {d for d, t in got if t in (base, near)} == {5}
    assert sorted(((d, t) for d, t in got if t not in (base, near)), key=str) == sorted([(8, other), (None, "only rows without an id"), (None, None), (9, "")], key=str)
    named = [(r.doc_id, r.text) for r in J.keep_one(df, k=4, percent=80).collect()]
    assert sorted((str(d), t) for d, t in named if t == other or d == 5)[1:] == [("8", other)] and sum(d is None for d, _ in named) == 5


def test_linked_pairs_share_a_cell():
    r = np.random.default_rng(4)
    for n in (6, 7, 12, 40, 135, 400, 3000):
        a = r.choice(1 << 54, n, replace=False).astype(np.uint64)
        for _ in range(20):
            d = J.difference(n, 85)
            out = int(r.integers(0, d + 1))
            gone = min(out, d // 2)
            b = np.concatenate([a[gone:], r.choice(1 << 54, out - gone).astype(np.uint64)])
            a_, b_ = np.sort(a), np.unique(b)
            i = len(np.intersect1d(a_, b_))
            if 100 * i < 85 * (len(a_) + len(b_) - i) or np.array_equal(a_, b_):
                continue
            cell, doc = J.cells(np.concatenate([a_, b_]), np.array([0, len(a_), len(a_) + len(b_)]), 85)
            assert set(cell[doc == 0].tolist()) & set(cell[doc == 1].tolist())


def test_bound_never_below_overlap():
    texts = pa.array([t or "" for _, t in corpus(9)])
    for _, raw, at in slices(texts):
        sets, off = shingle_sets(raw, at, 4)
        v = J.count_vectors(sets, off)
        for i in range(0, len(off) - 2, 7):
            both = len(np.intersect1d(sets[off[i]:off[i + 1]], sets[off[i + 1]:off[i + 2]]))
            assert np.minimum(v[i], v[i + 1]).sum() >= both


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000 + k) for k in range(1, 200)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}


def test_counts_beyond_two_bytes():
    """A set with more than 65,535 elements in one group keeps exact counts, beside narrow ones."""
    import pyarrow as pa

    x = np.random.default_rng(2).integers(0, 1 << 54, 18_500_000, dtype=np.uint64)
    x = np.unique(x[(J.mix64(x) >> np.uint64(56)) == 3])
    assert len(x) > 66_000
    wide = J.count_vectors(x, np.array([0, len(x)]))
    narrow = J.count_vectors(x[:9], np.array([0, 9]))
    assert wide[0, 3] == len(x) == wide.sum() and narrow.dtype == np.uint16
    both = J.vectors_of(pa.array([wide[0].tobytes(), narrow[0].tobytes()], pa.binary()))
    assert both[0, 3] == len(x) and both[1, 3] == 9 and np.minimum(both[0], both[1]).sum() == 9
    assert J.vectors_of(pa.array([narrow[0].tobytes()], pa.binary())).dtype == np.uint16
