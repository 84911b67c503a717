"""Previous-row lookups per entity that do not put a whole entity into one task.

``LAG(x) OVER (PARTITION BY entity ORDER BY d)`` sorts every row of an entity in one task.
Here the window runs per (entity, block) -- block = the year (or month) of the order
column -- and the first row of each block takes the last row of the previous non-empty
block from a per-block summary. The summary has one row per (entity, block), so its
window by entity holds at most one row per block of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
                  block: str = "year", prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + v`` = value of v at the previous row of the same key (ordered by ``order``).

    ``block`` in {"year", "month", "none"}. Order values must be unique within a key
    (true for the raw key (code, date, type)); ties would make LAG itself non-deterministic.
    """
    keys = list(keys)
    values = list(values)
    if block == "none":
        w = Window.partitionBy(*keys).orderBy(order)
        return df.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in values])

    # The block is one struct: structs compare NULL fields as equal, so rows with a NULL key are
    # linked like any others, and window, summary and join share one partitioning.
    blk = "_blk"
    framed = df.withColumn(blk, F.struct(*keys, F.trunc(F.col(order), block).alias("_at")))
    w = Window.partitionBy(blk).orderBy(order)
    inner = framed.select("*", F.lag(F.struct(*values)).over(w).alias("_in"))

    # last row of every (key, block), then the previous block's last row per key
    # one max_by per value keeps the summary in a hash aggregate (a struct buffer would
    # force a sort-based one); orders are unique within a key, so the picks agree.
    last = (inner.groupBy(blk)
            .agg(*[F.max_by(v, F.col(order)).alias(v) for v in values])
            .select(blk, F.struct(*values).alias("_last")))
    wb = Window.partitionBy(*[F.col(blk)[k] for k in keys]).orderBy(F.col(blk)["_at"])
    carry = last.select(blk, F.lag("_last").over(wb).alias("_carry"))

    out = inner.join(carry, blk, "left")
    prev = F.coalesce(F.col("_in"), F.col("_carry"))
    return out.select(*df.columns, *[prev[v].alias(prefix + v) for v in values])


def with_previous_period(df: DataFrame, keys: Sequence[str], period: str, values: Sequence[str], block: str | None = None, prefix: str = "prev_") -> DataFrame:
    """:func:`with_previous` of rows that are one a key and period (a week, month or quarter): a key has as few as the calendar has periods, so
    one window by key takes them, and what made them is neither run twice nor joined with itself. A row without a period comes before
    no other. ``block`` asks for the blocks all the same."""
    if block is not None:
        return with_previous(df, keys, period, values, block=block, prefix=prefix)
    w = Window.partitionBy(*keys).orderBy(period)
    return df.select("*", *[F.lag(F.when(F.col(period).isNotNull(), F.col(v))).over(w).alias(prefix + v) for v in values])


def with_previous_in_ranges(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """:func:`with_previous` over rows that lie by ``keys`` already, of which a key has few (one a day of the calendar): one window by key.
    As there, rows without an order value come before each other only."""
    inner = df.select("*", F.lag(F.struct(F.col(order).alias("_at"), *values)).over(Window.partitionBy(*keys).orderBy(order)).alias("_in"))
    prev = F.when(F.col("_in")["_at"].isNotNull() | F.col(order).isNull(), F.col("_in"))
    return inner.select(*df.columns, *[prev[v].alias(prefix + v) for v in values])


def with_previous_in_blocks(df: DataFrame, keys: Sequence[str], block: str, order: str, values: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """:func:`with_previous` over rows that lie by (``keys``, ``block``) already, ``block`` being a column that rises with ``order``
    (a year): the window and the summary work where the rows lie, and only the summary, one row a block, is shuffled. Keys and
    block must not be null."""
    at = [*keys, block]
    inner = df.select("*", F.lag(F.struct(*values)).over(Window.partitionBy(*at).orderBy(order)).alias("_in"))
    last = df.groupBy(*at).agg(*[F.max_by(v, F.col(order)).alias(v) for v in values]).select(*at, F.struct(*values).alias("_last"))
    carry = last.select(*at, F.lag("_last").over(Window.partitionBy(*keys).orderBy(block)).alias("_carry"))
    out = inner.join(carry, at, "left")
    prev = F.coalesce(F.col("_in"), F.col("_carry"))
    return out.select(*df.columns, *[prev[v].alias(prefix + v) for v in values])
