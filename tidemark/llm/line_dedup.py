"""Operator 1, line dedup by overlapping three-line windows (DataFrame functions only).

Every run of ``window`` consecutive lines is hashed (two 64-bit hashes); windows that occur more
than once in the whole corpus are found by one aggregate; every occurrence after the first, in
the order (document id, hash of the text, line number), covers its lines, and the union of the covered lines
is removed. A line never loses its earliest copy, for that copy has no earlier window.

Defined results: null text stays null; a text of fewer lines than the window has no window and stays as it
is; a document whose lines are all covered becomes the empty text; blank lines are lines;
documents with a null id come last; rows that share an id, or have none, stand in the order of their texts' 60-bit
hashes, and only rows equal in both share a place and get equal results; extra columns pass
through, and input columns called like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, with_replaced

LAST = "9223372036854775808"  # of documents with a null id: behind every bigint
CONTENT = 1 << 60  # values of a text's hash


def _place(doc_id: Column, content: Column) -> Column:
    """One number for the order (document id, hash of the text); a decimal is of fixed width, which an aggregate's buffer needs."""
    id_ = F.coalesce(doc_id.cast("long").cast("decimal(19,0)"), F.lit(LAST).cast("decimal(19,0)"))
    return (id_ * F.lit(CONTENT).cast("decimal(19,0)") + content.bitwiseAND(F.lit(CONTENT - 1)).cast("decimal(19,0)")).cast("decimal(38,0)")


def _windows(lines: Column, window: int) -> Column:
    """array<struct<i, a, b>>: the 128-bit hash of each run of ``window`` lines."""
    def one(i: Column) -> Column:
        run = [F.get(lines, i + k) for k in range(window)]
        return F.struct(i.alias("i"), F.xxhash64(*run).alias("a"), F.xxhash64(F.lit(window), *run[::-1]).alias("b"))

    return F.transform(F.sequence(F.lit(0), F.size(lines) - window), one)


def line_dedup(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", window: int = 3,
               length: str | None = "n_chars") -> DataFrame:
    """``docs`` with later occurrences of repeated windows removed from ``text``, and
    ``n_lines`` and ``n_removed`` (bigint) added; ``length``, if present, is the new text's."""
    others = [c for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("kept"),
        _place(F.col(doc_id), F.xxhash64(text)).alias("place"),
        F.split(F.col(text), "\n", -1).alias("lines"),
    )
    runs = (
        base.where(F.size("lines") >= window)
        .select("place", F.explode(_windows(F.col("lines"), window)).alias("w"))
        .select("place", "w.i", "w.a", "w.b")
    )
    # both columns of the aggregate have fixed width, so it is a hash aggregate, combined on the map side
    repeated = materialise(
        runs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("place").alias("first_place"))
        .where("n > 1").drop("n"), "line_windows")
    # both sides come straight from a shuffle: a hot window is split by the adaptive skew join
    hits = runs.join(repeated, ["a", "b"])
    # a set: equal rows add nothing, so a group is bounded by a document's lines
    per_doc = (
        hits.groupBy("place")
        .agg(F.array_sort(F.collect_set(F.struct("a", "b", "i", (F.col("place") > F.col("first_place")).alias("later")))).alias("hits"))
    )
    hit = F.col("hits")

    def is_later(x: Column, k: Column) -> Column:
        before = F.get(hit, k - 1)
        return x["later"] | F.coalesce((before["a"] == x["a"]) & (before["b"] == x["b"]) & (before["i"] < x["i"]), F.lit(False))

    covered = per_doc.select(
        "place",
        F.array_distinct(F.flatten(F.transform(
            F.filter(hit, is_later), lambda x: F.sequence(x["i"], x["i"] + (window - 1))))).alias("covered"),
    ).where(F.size("covered") > 0)
    joined = base.join(covered, "place", "left")
    lines = F.col("lines")
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    cleaned = F.when(F.col("covered").isNull(), F.array_join(lines, "\n")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n"))
    done = joined.select(
        "kept.*", cleaned.alias(text),
        F.when(lines.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("__n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("__n_removed"),
    )
    new = {"n_lines": F.col("__n_lines"), "n_removed": F.col("__n_removed")}
    if length and length in docs.columns:
        new[length] = F.char_length(F.col(text)).cast("long")
    return with_replaced(done, new).drop("__n_lines", "__n_removed")
