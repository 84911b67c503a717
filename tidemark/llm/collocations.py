"""Operator 12, collocations of two to four words by SON partitioning.

1. *Shards.* Texts are dealt to ``SHARDS`` shards by a hash, alike in every pass. A phrase that occurs ``support`` times in all occurs at least
   ``ceil(support / SHARDS)`` times in some shard, so a shard is mined completely at that local support.
   First words and pairs are counted, then runs of three and four words whose pairs are all locally frequent. A shard is no task: its counts are
   an aggregate like any other, whatever its size.
2. *Candidates.* The locally frequent phrases of all shards are united, as a bit map of fixed size (``FILTER_BITS``): it holds every one of
   them, and some others, which cost time only.
3. *Count.* One more pass counts all candidates in all texts, as strings, exactly; those below ``support`` go.

Mining works on 61-bit hashes: phrases that clash are counted together, which can only raise a local count. The final counts are of
strings. Scores and the cuts into parts are joins over the frequent phrases; every part of a frequent phrase is frequent and thus counted.

Defined results: null text counts as empty, a null language as ``und``; languages without any candidate give no rows; rows that repeat
count each time; a word may be of any length; a table without rows gives none; extra columns do not pass. Order is by code points' bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.runs import LOWER, runs, strings
from tidemark.llm.tokens import U, mix64, range_hashes, slices

SHARDS = 6  # at most 8: three bits of a key
FILTER_BITS = 1 << 26
BLOCK = 4_000_000  # occurrences that a task gathers before it adds them up
LONGEST = 4
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS  # of hashes, dealt to the shuffle's partitions; a bucket's keys may spill

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_CONTENT = ~_BREAK
_CONTENT[[32, 9]] = False


class Pieces:
    """Words of a slice of texts, and where phrases may start."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = LOWER[raw]
        self.content = _CONTENT[self.raw]
        self.starts, self.ends, self.doc = runs(self.raw, offsets, self.content)
        # breaks and text ends before a word: equal for words of one piece only
        self.piece = np.cumsum(_BREAK[self.raw])[self.starts] + self.doc if len(self.starts) else self.starts

    def phrases(self, k: int) -> np.ndarray:
        """First words of all phrases of ``k`` words."""
        n = len(self.piece) - k + 1
        return np.flatnonzero(self.piece[:n] == self.piece[k - 1:]) if n > 0 else np.zeros(0, np.int64)

    def hashes(self, lang: np.ndarray) -> list[np.ndarray]:
        """61-bit hashes of the phrases of 1 to ``LONGEST`` words that start at each word (if there is one); ``lang`` is a hash of each text's."""
        word = range_hashes(self.raw, self.starts, self.ends)
        x = lang[self.doc]
        out = []
        for k in range(LONGEST):
            n = max(len(word) - k, 0)
            x = mix64(x[:n] + word[k: k + n])
            out.append(x >> U(3))
        return out


def _positions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the bit map."""
    a = mix64(gram)
    return (a % U(FILTER_BITS)).astype(np.int64), (mix64(a) % U(FILTER_BITS)).astype(np.int64)


def in_filter(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    out = np.ones(len(gram), bool)
    for at in _positions(gram):
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


def bit_map(keys: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits as bytes with the places of all ``key`` set. The rows that come to the driver are bounded by the map's size."""

    def place(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_positions(batch.column("key").to_numpy().view(U))))
            words, first = np.unique(at >> 6, return_index=True)
            bit = (U(1) << (at & 63).astype(U)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.bitwise_or.reduceat(bit, first) if len(first) else bit)], ["word", "bits"])

    words = keys.mapInArrow(place, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def _lang_hashes(column: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    import xxhash

    words = column.dictionary_encode()
    each = np.array([xxhash.xxh64_intdigest(x.encode()) for x in words.dictionary.to_pylist()] or [0], U)
    return each[words.indices.to_numpy()]


def _local(base: DataFrame, levels: tuple[int, ...], need: int, bits=None) -> DataFrame:
    """key (61-bit hash, 3 bits of the shard) of phrases of ``levels`` words that are frequent in a shard. With ``bits``, only
    phrases whose pairs are all in the map."""

    def count(batches):
        held, size = [], 0

        def out():
            key = np.concatenate(held)
            held.clear()
            key.sort()
            # rows of one bucket each: the upper bits of the keys
            cuts = np.searchsorted(key, np.arange(1, BUCKETS, dtype=U) << U(64 - BUCKET_BITS))
            for bucket, (a, b) in enumerate(zip(np.append(0, cuts), np.append(cuts, len(key)))):
                if b > a:
                    part = key[a:b]
                    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                    times = np.diff(np.append(first, b - a)).astype(np.int32)
                    keys = part[first].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int32()), *[pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), pa.array(x)) for x in (keys, times)]],
                        ["bucket", "keys", "times"])

        for batch in batches:
            lang, shard = _lang_hashes(batch.column("lang")), batch.column("shard").to_numpy().astype(U)
            for first, raw, offsets in slices(batch.column("text")):
                pieces = Pieces(raw, offsets)
                rows = slice(first, first + len(offsets) - 1)
                grams, own = pieces.hashes(lang[rows]), shard[rows][pieces.doc]
                if bits is not None:
                    pair = np.zeros(len(own), bool)
                    starts = pieces.phrases(2)
                    pair[starts] = in_filter(bits.value, (grams[1][starts] << U(3)) | own[starts])
                for k in levels:
                    starts = pieces.phrases(k)
                    if bits is not None:
                        for t in range(k - 1):
                            starts = starts[pair[starts + t]]
                    held.append((grams[k - 1][starts] << U(3)) | own[starts])
                    size += len(starts)
                if size >= BLOCK:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    # a bucket holds all rows of its keys, so the aggregate of (bucket, key) needs no shuffle of single keys
    dealt = base.mapInArrow(count, "bucket int, keys array<bigint>, times array<int>").repartition("bucket")
    each = dealt.select("bucket", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("bucket", F.col("x.keys").alias("key"), F.col("x.times").alias("n"))
    return each.groupBy("bucket", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= need).select("key")


def frequent_phrases(base: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of 1 to 4 words with f >= ``support``, and (lang, n) words of each language."""
    sc = base.sparkSession.sparkContext
    need = -(-support // SHARDS)
    short = materialise(_local(base, (1, 2), need), "phrases_short")
    pairs = sc.broadcast(bit_map(short))
    long = materialise(_local(base, (3, 4), need, pairs), "phrases_long")
    candidates = short.union(long).select(F.shiftrightunsigned("key", 3).alias("key"))
    bits = sc.broadcast(bit_map(candidates))

    def count(batches):
        held, size = [], 0

        def out():
            table = pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
            for b in table.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).combine_chunks().to_batches(max_chunksize=100_000):
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.string()), b.column(2)], ["lang", "phrase", "n"])

        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            number, hashed = names.indices.to_numpy(), _lang_hashes(batch.column("lang"))
            for first, raw, offsets in slices(batch.column("text")):
                pieces = Pieces(raw, offsets)
                if not len(pieces.starts):
                    continue
                rows = slice(first, first + len(offsets) - 1)
                lang = number[rows][pieces.doc]
                words = strings(pieces.raw, pieces.content, pieces.starts, pieces.ends).dictionary_encode()
                word, n = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
                grams = pieces.hashes(hashed[rows])
                per_lang = np.bincount(lang, minlength=len(names.dictionary))
                held.append(_counts(names.dictionary, np.arange(len(per_lang)), pa.nulls(len(per_lang), pa.large_string()), per_lang))
                for k in range(1, LONGEST + 1):
                    starts = pieces.phrases(k)
                    starts = starts[in_filter(bits.value, grams[k - 1][starts])]
                    if not len(starts):
                        continue
                    key = lang[starts].astype(np.int64)
                    for t in range(k):  # exact numbers of (language, words so far)
                        key = np.unique(key, return_inverse=True)[1] * n + word[starts + t]
                    _, at, times = np.unique(key, return_index=True, return_counts=True)
                    at = starts[at]
                    parts = [words.dictionary.take(pa.array(word[at + t])) for t in range(k)]
                    held.append(_counts(names.dictionary, lang[at], pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0], times))
                    size += len(at)
                if size >= BLOCK // 4:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    counted = base.select("text", "lang").mapInArrow(count, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    kept = materialise(counted.where((F.col("f") >= support) | F.col("phrase").isNull()), "phrases")
    phrases = kept.where("phrase is not null").select("lang", "phrase", (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1).alias("k"), "f")
    return phrases, kept.where("phrase is null").select("lang", F.col("f").alias("n"))


def _counts(langs: pa.Array, number: np.ndarray, phrase, n: np.ndarray) -> pa.Table:
    return pa.table({"lang": langs.take(pa.array(number)), "phrase": phrase, "n": pa.array(n.astype(np.int64))})


def _exact(c) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", support: int = 30, covered: int = 80, top: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: collocations of each language by score, without those that longer candidates cover by
    ``covered`` percent; with ``top``, the first of each language only."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(body.alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(body), F.lit(SHARDS)).cast("int").alias("shard"))
    phrases, words = frequent_phrases(base, support)
    many = phrases.where("k > 1").withColumn("words", F.split("phrase", " "))

    def span(start, length) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    cuts = many.select("lang", "phrase", F.col("f").alias("a"), "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole = F.call_function("div", F.lit(2_000_000).cast("decimal(8,0)") * _exact("a"), (F.col("l").cast("decimal(20,0)") + F.col("r")).cast("decimal(21,0)"))
    scored = (
        cuts.select("lang", "phrase", "a", "cut", span(F.lit(1), F.col("cut")).alias("first"), span(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
        .join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(whole.alias("score"), "cut", "l", "r")).alias("best")))
    inside = (
        many.where("k > 2").select("lang", F.col("f").alias("longer"), "words", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
        .select("lang", "longer", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
        .select("lang", span(F.col("start"), F.col("size")).alias("phrase"), "longer")
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * covered))
    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # a language's phrases are first cut to the top of 64 parts each, so no task sees them all
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        rows = rows.withColumn("near", F.row_number().over(part)).where(F.col("near") <= top).drop("near")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
