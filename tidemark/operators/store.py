"""Keyed writes without MERGE: upsert (last write wins), insert-ignore (first write wins)
and the entity dimension sync. All are grouped aggregates on the key, so a key with many
versions is combined map-side rather than sorted in one task."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit, ts_lit
from tidemark.schema import FACT_COLUMNS, KEY, RAW_COLUMNS


_ts = ts_lit


def _latest(df: DataFrame, cols, order: Column, key=KEY) -> DataFrame:
    """One row per key: the one with the greatest ``order``."""
    payload = [c for c in cols if c not in key]
    return (df.groupBy(*key)
            .agg(F.max_by(F.struct(*payload), order).alias("_w"))
            .select(*key, *[F.col("_w")[c].alias(c) for c in payload])
            .select(*cols))


def _order(seq) -> Column | None:
    """The order of arrival: one column or several, the earlier ones first."""
    if seq is None:
        return None
    return F.col(seq).cast("long") if isinstance(seq, str) else F.struct(*seq)


def _one_per_key(batch: DataFrame, cols, order: Column | None, key=KEY) -> DataFrame:
    """The last row of each key. Without an order the keys must be unique: a repeated one is an error, for
    which of its rows came last is not known."""
    if order is not None:
        return _latest(batch, cols, order, key)
    payload = [c for c in cols if c not in key]
    first = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in payload])
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("a key comes twice in a batch without an order (seq)"))).otherwise(F.lit(True))
    return first.filter(checked).select(*cols)


def upsert(target: DataFrame, batch: DataFrame, as_of, seq=None) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same (code, date, type): rate,
    name and nominal are taken from the batch and load_timestamp is set to ``as_of``.
    Within the batch the last row by ``seq`` (a column, or several) wins. Keys of the target are
    unique, so only the batch is aggregated; the target is filtered by an anti join against the
    batch's keys as they come, for which the rows need not be aggregated a second time.
    """
    return upsert_staged(target, one_per_key(batch, as_of, seq), batch.select(*KEY))


def one_per_key(batch: DataFrame, as_of, seq=None) -> DataFrame:
    """The rows that an upsert of ``batch`` puts in: the last one of each key, with the load time ``as_of``."""
    return _one_per_key(batch.withColumn("load_timestamp", _ts(as_of)), list(RAW_COLUMNS), _order(seq))


def upsert_staged(target: DataFrame, new: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``target`` with the rows ``new``, one a key, in the place of those with the same key. ``keys`` are the keys of ``new``, repeated or not."""
    new = new.select(*RAW_COLUMNS)
    kept = target.select(*RAW_COLUMNS).join(new.select(*KEY) if keys is None else keys, list(KEY), "left_anti")
    return kept.select(*RAW_COLUMNS).unionByName(new)


def upsert_counts(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Inserted vs. updated keys of an upsert (true counts, not the driver's rowcount)."""
    keys = batch.select(*KEY).distinct()
    marked = keys.join(target.select(*KEY, F.lit(1).alias("_hit")), list(KEY), "left")
    return marked.agg(F.count_if(F.col("_hit").isNull()).alias("inserted"),
                      F.count_if(F.col("_hit").isNotNull()).alias("updated"))


def insert_ignore(target: DataFrame, batch: DataFrame, cols=FACT_COLUMNS, seq: str | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (first in-batch row per key wins).
    Returns the rows to append; existing rows are never changed."""
    if "load_timestamp" in cols and "load_timestamp" not in batch.columns:
        batch = batch.withColumn("load_timestamp", F.lit(None).cast("timestamp_ntz"))
    first = _one_per_key(batch, list(cols), -F.col(seq).cast("long") if seq else None)
    return first.join(target.select(*KEY), list(KEY), "left_anti")


def insert_ignore_table(target: DataFrame, batch: DataFrame, cols=FACT_COLUMNS, seq: str | None = None) -> DataFrame:
    """The target after insert-ignore: target rows plus the new keys of the batch."""
    return target.select(*cols).unionByName(insert_ignore(target, batch, cols, seq))


def load_facts(target: DataFrame, batch: DataFrame, mode: str = "ignore", cols=FACT_COLUMNS, seq=None) -> DataFrame:
    """The fact table after a load: known keys keep their row (``ignore``, as in the original) or take the
    batch's last one (``upsert``)."""
    if mode == "ignore":
        return insert_ignore_table(target, batch, cols, seq)
    if mode != "upsert":
        raise ValueError("mode must be ignore or upsert")
    if "load_timestamp" in cols and "load_timestamp" not in batch.columns:
        batch = batch.withColumn("load_timestamp", F.lit(None).cast("timestamp_ntz"))
    new = _one_per_key(batch, list(cols), _order(seq))
    return target.select(*cols).join(new.select(*KEY), list(KEY), "left_anti").select(*cols).unionByName(new)


def dimension_names(raw: DataFrame) -> DataFrame:
    """One name per code: daily rows before monthly ones, then the latest load, then the
    greatest name; also the first and last rate date of the code.

    The rows are first aggregated to one a code, kind and name, in a hash aggregate of fixed width; the text as an aggregate's
    value, for which Spark sorts, is left to those few."""
    names = (raw.groupBy("currency_code", (F.col("rate_type") == F.lit("daily")).alias("d"), "currency_name")
             .agg(F.max("load_timestamp").alias("load_timestamp"), F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date")))
    pref = F.struct("d", "load_timestamp", "currency_name")
    return (names.groupBy("currency_code")
            .agg(F.max_by("currency_name", pref).alias("currency_name"),
                 F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")))


def init_dimension(raw: DataFrame, as_of) -> DataFrame:
    """Initial dimension: distinct codes of ``raw``, first_seen = last_seen = as_of."""
    d = date_lit(as_of)
    return dimension_names(raw).select("currency_code", "currency_name", d.alias("first_seen"),
                                       d.alias("last_seen"), F.lit(True).alias("is_active"))


def sync_dimension(dim: DataFrame, raw: DataFrame, as_of, dates_from_data: bool = False) -> DataFrame:
    """Upsert the dimension from ``raw``: new codes are inserted, known codes get the
    current name and last_seen = as_of. With ``dates_from_data`` first_seen / last_seen
    come from the rate dates instead of the sync day."""
    d = date_lit(as_of)
    src = dimension_names(raw).alias("s")
    cur = dim.alias("t")
    j = cur.join(src, "currency_code", "full_outer")
    seen = F.col("s.currency_name").isNotNull()
    if dates_from_data:
        first = F.least(F.col("t.first_seen"), F.col("s.min_date"))
        last = F.greatest(F.col("t.last_seen"), F.col("s.max_date"))
    else:
        first = F.coalesce(F.col("t.first_seen"), d)
        last = F.when(seen, d).otherwise(F.col("t.last_seen"))
    return j.select(
        "currency_code",
        F.coalesce(F.col("s.currency_name"), F.col("t.currency_name")).alias("currency_name"),
        first.alias("first_seen"), last.alias("last_seen"),
        F.coalesce(F.col("t.is_active"), F.lit(True)).alias("is_active"))


def union_sources(daily: DataFrame | None, monthly: DataFrame | None, load_type: str = "both") -> DataFrame:
    """Concatenate the daily and monthly batches by load type (UNION ALL)."""
    if load_type not in ("daily_only", "monthly_only", "both"):
        raise ValueError("load_type must be daily_only, monthly_only or both")
    parts = []
    if load_type in ("daily_only", "both") and daily is not None:
        parts.append(daily.withColumn("rate_type", F.lit("daily")))
    if load_type in ("monthly_only", "both") and monthly is not None:
        parts.append(monthly)
    if not parts:
        raise ValueError("no data for this load type")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
