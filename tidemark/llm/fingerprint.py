"""Operator 3, document fingerprints of improbable features.

Every window of ``WINDOW`` bytes has an entropy, kept in ``BINS`` steps. The rarer an entropy is among
all windows of the corpus, the better a window of that entropy; windows almost without entropy are left out.
In each run of ``RUN`` neighbouring windows the best one (leftmost among equals) gets a vote, and a window with
``VOTES`` is a feature. Features are hashed into Bloom filters of ``BITS`` bits, a new one after every
``FILL`` features. The likeness of two filters is the share of common bits above chance
(and above a noise margin) in what the emptier one could have in common; that of two documents is the mean,
over the filters of the one with fewer filters, of the best likeness with a filter of the other.

Entropies are sums of integers, so equal texts have equal fingerprints wherever they stand.

Defined results: null text counts as empty; an empty text has the empty fingerprint, alike (1) only to another
empty one; a text shorter than a window is one feature; the next document is the one with the
next larger id (null ids last, rows of one id by a hash of their text, wholly equal rows in any order),
after the last the first; one document alone is its own next; extra columns are not returned.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions
from tidemark.llm.tokens import U, mix64, slices

WINDOW, RUN, VOTES = 64, 64, 16
BINS, LOWEST = 1000, 100
BITS, FILL, HASHES = 2048, 160, 5
MARGIN = 0.3
_SCALE = 1 << 20
_G = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 2)], np.int64)
_GAIN = np.diff(_G)  # _GAIN[c]: g(c + 1) - g(c)
_FULL = round(WINDOW * np.log2(WINDOW) * _SCALE)
_PART = 1 << 19
#: parts of the order of ids; a part is sorted and read as a stream, so its size costs no memory
MAX_PARTS = 8192


def entropies(raw: np.ndarray) -> np.ndarray:
    """Entropy step (0 to ``BINS``) of the window that starts at each byte but the last ones.

    A window's sum of c log c changes by one byte in and one byte out, so all it takes is, for every
    byte, how often it occurs in the window it ends and in the one it starts. Both are
    counted on the positions sorted by byte value, by comparing ever more distant neighbours.
    """
    n = len(raw)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    if n >= _PART + WINDOW:  # bounded memory for long texts; windows do not depend on the cut
        return np.concatenate([entropies(raw[k: k + _PART + WINDOW - 1]) for k in range(0, n - WINDOW + 1, _PART)])
    order = np.argsort(raw, kind="stable").astype(np.uint32)
    key = (raw[order].astype(np.uint32) << np.uint32(24)) | order
    back, ahead = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for lag in range(1, WINDOW):
        near = (key[lag:] - key[:-lag]) < WINDOW
        if not near.any():
            break
        back[lag:] += near
        ahead[:-lag] += near
    ends, starts = np.empty(n, np.uint8), np.empty(n, np.uint8)
    ends[order], starts[order] = back, ahead
    step = _GAIN[ends - 1]
    step[WINDOW:] -= _GAIN[starts[: n - WINDOW] - 1]
    total = np.cumsum(step)[WINDOW - 1:]
    return (_FULL - total) * BINS // _FULL


def ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each entropy step, 0 the rarest; steps too low for a feature come last."""
    order = np.lexsort((np.arange(BINS + 1), histogram))
    order = np.concatenate([order[order >= LOWEST], order[order < LOWEST]])
    out = np.empty(BINS + 1, np.uint64)
    out[order] = np.arange(BINS + 1)
    return out


def _features(raw: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of the features of a slice, in text order, each once in a document."""
    docs = len(offsets) - 1
    size = np.diff(offsets)
    e = entropies(raw)
    m = len(e)
    hashes, owner = [], []
    if m:
        place = np.arange(m, dtype=np.uint64)
        key = (rank[e] << U(32)) | place
        last = np.repeat(np.maximum(offsets[1:] - WINDOW, -1), size)[:m]  # last window of the document
        key[place.astype(np.int64) > last] = np.iinfo(np.uint64).max  # windows that reach into the next document
        best, span = key, 1
        while span < RUN:
            best = np.minimum(best[: len(best) - span], best[span:]) if len(best) > span else best[:0]
            span *= 2
        chosen = []
        if len(best):
            inside = np.arange(len(best)) + (RUN - 1) <= last[: len(best)]
            winner = (best[inside] & U(0xFFFFFFFF)).astype(np.int64)
            if len(winner):
                at = np.flatnonzero(np.concatenate([[True], winner[1:] != winner[:-1]]))
                votes = np.diff(np.append(at, len(winner)))
                good = (votes >= VOTES) & (e[winner[at]] >= LOWEST)
                chosen.append(winner[at][good])
        found = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        doc = np.searchsorted(offsets, found, "right") - 1
        # a document with windows but no feature gives its best window
        for d in np.setdiff1d(np.flatnonzero(size >= WINDOW), doc):
            lo = int(offsets[d])
            found = np.append(found, lo + int(np.argmin(key[lo: int(offsets[d + 1]) - WINDOW + 1])))
            doc = np.append(doc, d)
        if len(found):
            bytes_of = raw[found[:, None] + np.arange(WINDOW)]
            parts = np.ascontiguousarray(bytes_of).view("<u8").astype(U)
            h = np.zeros(len(found), U)
            for k in range(parts.shape[1]):
                h = mix64(h ^ parts[:, k])
            hashes.append(h)
            owner.append(doc)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    for d in short:
        digest = hashlib.sha256(raw[offsets[d]: offsets[d + 1]].tobytes()).digest()
        hashes.append(np.frombuffer(digest[:8], "<u8").astype(U))
        owner.append(np.array([d]))
    if not hashes:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h, d = np.concatenate(hashes), np.concatenate(owner)
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    _, first = np.unique(np.stack([d.astype(U), h]), axis=1, return_index=True) if docs > 1 else np.unique(h, return_index=True)
    first.sort()
    return h[first], d[first]


#: a fingerprint in memory: its filters as integers of ``BITS`` bits
Filters = list[int]


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[Filters]:
    """Chained filters of each text."""
    out: list[Filters] = []
    for _, raw, offsets in slices(pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())):
        docs = len(offsets) - 1
        h, d = _features(raw, offsets, rank)
        count = np.bincount(d, minlength=docs)
        nth = np.arange(len(d)) - np.repeat(np.cumsum(count) - count, count)
        chain = -(-count // FILL)
        base = np.cumsum(chain) - chain
        row = base[d] + nth // FILL if len(d) else d
        bits = np.zeros((int(chain.sum()), BITS), bool)
        for k in range(HASHES):
            bits[row, ((h >> U(11 * k)) & U(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        ints = [int.from_bytes(p.tobytes(), "big") for p in packed]
        out += [ints[base[i]: base[i] + chain[i]] for i in range(docs)]
    return out


def text_of(filters: Filters) -> str:
    """Printed form: the filters in base64, joined by dots."""
    return ".".join(base64.b64encode(f.to_bytes(BITS // 8, "big")).decode() for f in filters)


def filters_of(text: str) -> Filters:
    return [int.from_bytes(base64.b64decode(p), "big") for p in text.split(".")] if text else []


def likeness(a: Filters, b: Filters) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if not a or not b:
        return float(a == b)
    if len(a) > len(b):
        a, b = b, a

    def one(x: int, y: int) -> float:
        nx, ny = x.bit_count(), y.bit_count()
        most, chance = min(nx, ny), nx * ny / BITS
        floor = chance + MARGIN * (most - chance)
        return max(0.0, ((x & y).bit_count() - floor) / (most - floor)) if most > floor else float(x == y)

    return sum(max(one(x, y) for y in b) for x in a) / len(a)


def entropy_histogram(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of all texts have each entropy step; ``BINS`` + 1 sums come to the driver."""
    def run(batches):
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            for _, raw, offsets in slices(batch.column(0)):
                e = entropies(raw)
                size = np.diff(offsets)
                last = np.repeat(np.maximum(offsets[1:] - WINDOW, -1), size)[: len(e)]
                total += np.bincount(e[np.arange(len(e)) <= last], minlength=BINS + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["step", "n"])

    out = np.zeros(BINS + 1, np.int64)
    for r in docs.select(text).mapInArrow(run, "step bigint, n bigint").groupBy("step").agg(F.sum("n").alias("n")).collect():
        out[r["step"]] = r["n"]
    return out


def with_next(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (part, tail, id, hash, text), to be read in this order inside a part: every row is followed by
    its next document. The last row of a part is followed by a copy of the next part's first (``tail``)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    parts = min(4 * partitions(docs.sparkSession), MAX_PARTS)
    cuts = rows.where("id is not null").approxQuantile("id", [k / parts for k in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = np.unique(np.array(cuts, np.int64)) if cuts else np.zeros(0, np.int64)

    @F.arrow_udf("int")
    def part_of(x: pa.Array) -> pa.Array:
        part = np.searchsorted(bounds, x.fill_null(0).to_numpy(), "right")
        return pa.array(np.where(x.is_null().to_numpy(zero_copy_only=False), len(bounds), part), pa.int32())

    placed = rows.withColumn("part", part_of("id"))
    # one row per part reaches the driver
    heads = placed.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("head")).orderBy("part").collect()
    if not heads:
        return placed.select("part", F.lit(0).alias("tail"), "id", "hash", "text")
    follows = [(heads[k - 1]["part"], h["head"]["none"], h["head"]["id"], h["head"]["hash"]) for k, h in enumerate(heads)]
    tails = docs.sparkSession.createDataFrame(follows, "to int, none boolean, head_id bigint, head_hash bigint")
    copies = rows.join(F.broadcast(tails), F.col("id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash"))) \
        .dropDuplicates(["to"]).select(F.col("to").alias("part"), F.lit(1).alias("tail"), "id", "hash", "text")
    both = placed.select("part", F.lit(0).alias("tail"), "id", "hash", "text").union(copies)
    return both.repartition(partitions(docs.sparkSession), "part").sortWithinPartitions(
        "part", "tail", F.col("id").asc_nulls_last(), "hash")


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_edited(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of all documents and of their edited texts (last quarter replaced by the start of the next
    document), and the likeness of each to its edited text and to the next document."""
    rank = ranks(entropy_histogram(docs, text))

    def run(batches):
        held = None  # the last row so far: (id, text, fingerprint, part, tail)
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            part, tail = batch.column("part").to_pylist(), batch.column("tail").to_pylist()
            prints = fingerprints([t.encode() for t in texts], rank)
            rows = ([held] if held else []) + list(zip(ids, texts, prints, part, tail))
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[4]]
            if any(a[3] != b[3] for a, b in pairs):
                raise ValueError("a part came without the copy of its next document")
            edited = []
            for a, b in pairs:
                q = len(a[1]) // 4
                edited.append(a[1][: len(a[1]) - q] + b[1][:q])
            changed = fingerprints([t.encode() for t in edited], rank)
            held = rows[-1] if rows else None
            yield pa.RecordBatch.from_arrays([
                pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([text_of(a[2]) for a, _ in pairs], pa.string()), pa.array([text_of(c) for c in changed], pa.string()),
                pa.array([likeness(a[2], c) for (a, _), c in zip(pairs, changed)], pa.float64()),
                pa.array([likeness(a[2], b[2]) for a, b in pairs], pa.float64()),
            ], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return with_next(docs, text=text, doc_id=doc_id).mapInArrow(run, SCHEMA)


def fingerprint(docs: DataFrame, rank: np.ndarray, *, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with the printed fingerprint of every text (a map; ``rank`` from :func:`ranks`)."""
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() != column.lower()])

    def run(batches):
        for batch in batches:
            prints = fingerprints([(t or "").encode() for t in batch.column(text).to_pylist()], rank)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([text_of(p) for p in prints], pa.string())],
                                             names=[*batch.schema.names, column])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(column, T.StringType())]))
