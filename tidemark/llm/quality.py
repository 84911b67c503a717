"""Operator 10, quality classifier: a generalised additive model with pairwise interactions.

Features are shares and lengths of the whole text (letters, symbols, repeats, lines). Each feature
is cut into bins; boosting goes round the features in a cycle, every step fits a shallow tree
of up to four leaves on one feature's histogram and adds it to that feature's lookup table.
Then the pairs with the largest gain get two-dimensional tables in the same way. A score is
the logistic function of a sum of table entries, looked up by bin for a whole batch at once.

The model is fitted on the driver on at most ``max_rows`` labelled rows (a documented bound);
scoring is a map over whole texts without a shuffle.

Defined results: a null text counts as empty and is scored as such; rows with a null id are never
trained on; labels that disagree for an id count by their mean, a tie as 1; with no labelled
rows or one class only every score is the smoothed share of label 1; extra columns pass through,
clashing ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lean, with_replaced
from tidemark.llm.tokens import HASH_BITS, mix64, range_hashes, slices, words

FEATURES = ("chars", "words", "word_length", "longest_word", "upper", "digits", "shout", "bars", "symbols", "stops",
            "distinct_words", "repeat_words", "distinct_pairs", "lines", "line_length", "repeat_lines", "foreign", "capitals", "top_word")
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, RATE = 250, 80, 0.08
MAX_ROWS = 20_000


def _is(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_UPPER, _DIGIT = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _is("0123456789")
_LETTER = _UPPER | _is("abcdefghijklmnopqrstuvwxyz")
_SHOUT, _BAR, _STOP = _is("!?"), _is("|"), _is(".,;:")
_SYMBOL = _is("#$%&*@^~=<>+/\\{}[]_")


def _distinct(group: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, in each of ``n`` groups."""
    key = (group.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS))
    key.sort()
    if not len(key):
        return np.zeros(n), np.zeros(n)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    g = (key[at] >> np.uint64(HASH_BITS)).astype(np.int64)
    runs = np.diff(np.append(at, len(key)))
    top = np.zeros(n)
    np.maximum.at(top, g, runs)
    return np.bincount(g, minlength=n).astype(float), top


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per document of a slice."""
    n = len(offsets) - 1
    doc_of = np.repeat(np.arange(n), np.diff(offsets))

    def count(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc_of[mask], minlength=n).astype(float)

    starts, ends, doc = words(raw, offsets)
    n_words = np.bincount(doc, minlength=n).astype(float)
    h = range_hashes(raw, starts, ends)
    length = (ends - starts).astype(float)
    per_word = np.maximum(n_words, 1)
    latin_upper = np.zeros(len(raw), bool)
    latin_upper[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    high = raw >= 0xC0
    chars = count((raw & 0xC0) != 0x80)
    letters = np.maximum(count(_LETTER[raw]) + count(high), 1)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    pair = np.zeros(len(h), np.uint64)
    pair[1:] = mix64(h[1:] + h[:-1] * np.uint64(0x9E3779B97F4A7C15))
    inner = np.zeros(len(h), bool)
    inner[1:] = doc[1:] == doc[:-1]
    words_seen, top = _distinct(doc, h, n)
    pairs_seen, _ = _distinct(doc[inner], pair[inner], n)
    # lines: a line ends at each line feed and at the end of its document
    breaks = np.flatnonzero(raw == 10)
    full = np.flatnonzero(np.diff(offsets) > 0)
    line_from = np.sort(np.concatenate([offsets[full], breaks + 1]))
    line_to = np.sort(np.concatenate([breaks, offsets[full + 1]]))
    line_doc = np.searchsorted(offsets[1:], line_to, "left")
    # rows whose text ends with a line feed have an empty last line
    filled = line_to > line_from
    line_hash = range_hashes(raw, line_from[filled], line_to[filled])
    line_doc = line_doc[filled]
    n_lines = np.bincount(line_doc, minlength=n).astype(float)
    lines_seen, _ = _distinct(line_doc, line_hash, n)
    first = raw[starts] if len(starts) else np.zeros(0, np.uint8)
    capital = np.bincount(doc[_UPPER[first]], minlength=n) if len(starts) else np.zeros(n)
    columns = (
        np.log1p(chars), np.log1p(n_words), np.bincount(doc, length, minlength=n) / per_word, np.log1p(longest),
        (count(_UPPER[raw]) + count(latin_upper)) / letters, count(_DIGIT[raw]) / np.maximum(chars, 1),
        count(_SHOUT[raw]) / per_word, count(_BAR[raw]) / per_word, count(_SYMBOL[raw]) / per_word, count(_STOP[raw]) / per_word,
        words_seen / per_word, np.bincount(doc[same], minlength=n) / per_word, pairs_seen / np.maximum(n_words - 1, 1),
        np.log1p(n_lines), np.log1p(chars / np.maximum(n_lines, 1)), 1 - lines_seen / np.maximum(n_lines, 1),
        count(high) / letters, capital / per_word, top / per_word,
    )
    return np.column_stack(columns)


def _tree(g: np.ndarray, w: np.ndarray, least: float) -> np.ndarray:
    """Newton step per bin of the best tree of two levels over ordered bins."""
    cg, cw = np.cumsum(g), np.cumsum(w)

    def cut(lo: int, hi: int) -> int | None:
        """Last bin of the left part of the best cut of bins lo..hi-1."""
        if hi - lo < 2:
            return None
        a = slice(lo, hi - 1)
        base_g, base_w = (cg[lo - 1], cw[lo - 1]) if lo else (0.0, 0.0)
        lg, lw = cg[a] - base_g, cw[a] - base_w
        rg, rw = cg[hi - 1] - base_g - lg, cw[hi - 1] - base_w - lw
        gain = np.where((lw >= least) & (rw >= least), lg * lg / (lw + 1) + rg * rg / (rw + 1), -1.0)
        best = int(np.argmax(gain))
        return lo + best if gain[best] >= 0 else None

    edges = [0, len(g)]
    if (mid := cut(0, len(g))) is not None:
        parts = [c for c in (cut(0, mid + 1), cut(mid + 1, len(g))) if c is not None]
        edges = sorted({0, mid + 1, len(g), *(c + 1 for c in parts)})
    out = np.zeros(len(g))
    for lo, hi in zip(edges[:-1], edges[1:]):
        out[lo:hi] = g[lo:hi].sum() / (w[lo:hi].sum() + 1)
    return out


def _quadrants(g: np.ndarray, w: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best cut of a two-dimensional table into four."""
    cg, cw = g.cumsum(0).cumsum(1), w.cumsum(0).cumsum(1)
    a, b = cg[:-1, :-1], cw[:-1, :-1]
    top, top_w, left, left_w = cg[:-1, -1:], cw[:-1, -1:], cg[-1:, :-1], cw[-1:, :-1]
    parts = [(a, b), (top - a, top_w - b), (left - a, left_w - b), (cg[-1, -1] - top - left + a, cw[-1, -1] - top_w - left_w + b)]
    gain = sum(np.where(pw >= least, pg * pg / (pw + 1), 0) for pg, pw in parts)
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            if w[rows, cols].sum() >= least:
                out[rows, cols] = g[rows, cols].sum() / (w[rows, cols].sum() + 1)
    return float(gain[i, j]), out


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)])


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The model of features ``x`` and labels ``y`` (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = {"base": float(np.log(share / (1 - share))), "edges": [], "tables": [], "pairs": [], "pair_edges": []}
    if len(y) < 20 or y.min() == y.max():
        return model
    k = x.shape[1]
    edges = [_edges(x[:, f], BINS) for f in range(k)]
    b = _bins(x, edges)
    tables = [np.zeros(len(e) + 1) for e in edges]
    least = max(2.0, 0.0005 * len(y))
    logit = np.full(len(y), model["base"])

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(k):
            g, w = slopes()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(b[:, f], g, size), np.bincount(b[:, f], w, size), least / 4)
            tables[f] += step
            logit += step[b[:, f]]
    pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(k)]
    pb = _bins(x, pair_edges)
    sizes = [len(e) + 1 for e in pair_edges]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(pb[:, i] * sizes[j] + pb[:, j], v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, w = slopes()
    gains = sorted(((_quadrants(grid(i, j, g), grid(i, j, w), least)[0], i, j) for i in range(k) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((sizes[i], sizes[j]))) for gain, i, j in gains[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in chosen:
            g, w = slopes()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, w), least)[1]
            t += step
            logit += step[pb[:, i], pb[:, j]]
    return model | {"edges": edges, "tables": tables, "pairs": chosen, "pair_edges": pair_edges}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores by bin additions."""
    logit = np.full(len(x), model["base"])
    if model["edges"]:
        b, pb = _bins(x, model["edges"]), _bins(x, model["pair_edges"])
        for f, t in enumerate(model["tables"]):
            logit += t[b[:, f]]
        for i, j, t in model["pairs"]:
            logit += t[pb[:, i], pb[:, j]]
    return 1 / (1 + np.exp(-logit))


def _scored(docs: DataFrame, model: dict | None, text: str) -> DataFrame:
    """``docs`` with ``__x`` (features; no model) or ``__score``; the work of a map task."""
    name = "__x" if model is None else "__score"
    kind = T.ArrayType(T.DoubleType()) if model is None else T.DoubleType()
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def run(batches):
        for batch in batches:
            rows = [features(raw, offsets) for _, raw, offsets in slices(batch.column(text))]
            x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            if model is None:
                new = pa.array(list(x), pa.list_(pa.float64()))
            else:
                new = pa.array(predict(model, x), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, name])

    return docs.mapInArrow(lean(run), schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          max_rows: int = MAX_ROWS) -> dict:
    """Fit on at most ``max_rows`` labelled documents, chosen by a hash of their id."""
    usable = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    # a few times the bound go on, so that no task gets more; the rest is cut off by the order of the hash
    every = max(1, usable.count() // (4 * max_rows))
    sample = (
        usable.where(F.pmod(F.xxhash64(F.col(doc_id), F.lit(1)), F.lit(every)) == 0).groupBy(F.col(doc_id).alias("__id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    )
    # the bound on the rows bounds the broadcast
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text)).join(F.broadcast(sample), "__id")
    got = _scored(rows, None, text).select("__id", "__y", "__x").orderBy("__id").limit(max_rows).toPandas()
    x = np.array(got["__x"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit(x, got["__y"].to_numpy(float))


def classify(docs: DataFrame, model: dict, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (double) and ``predicted`` (int)."""
    return with_replaced(_scored(docs, model, text), {
        "score": F.col("__score"), "predicted": (F.col("__score") >= threshold).cast("int")}).drop("__score")
