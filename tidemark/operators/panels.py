"""Dashboard and ad-hoc queries over the raw rates: counters, trailing series of one
entity, labelled majors (long and wide), loads per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit, ts_lit
from tidemark.operators.marts import daily_changes
from tidemark.sources.tables import after


_date_lit = date_lit
_ts_lit = ts_lit


def total_records(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("value"))


def distinct_entities(raw: DataFrame) -> DataFrame:
    return raw.agg(F.countDistinct("currency_code").alias("value"))


def loads_last_days(raw: DataFrame, as_of_ts, days: int = 7) -> DataFrame:
    """Rows per load day with load_timestamp > as_of_ts - days, by day."""
    since = _ts_lit(as_of_ts) - F.make_dt_interval(F.lit(days))
    return (raw.filter(F.col("load_timestamp") > since)
            .groupBy(F.to_date("load_timestamp").alias("day"))
            .agg(F.count(F.lit(1)).alias("records"))
            .orderBy("day"))


def entity_trailing(raw: DataFrame, entity: str, as_of, days: int = 30,
                    rate_type: str | None = None) -> DataFrame:
    """(time, value) of one entity over the trailing window (all rate types by default)."""
    rows = after(raw.filter(F.col("currency_code") == F.lit(entity)), as_of, days)
    if rate_type is not None:
        rows = rows.filter(F.col("rate_type") == F.lit(rate_type))
    return rows.select(F.col("rate_date").alias("time"), F.col("exchange_rate").alias("value")).orderBy("time")


def entity_last_week_changes(raw: DataFrame, entity: str, as_of, days: int = 7) -> DataFrame:
    """Daily changes of one entity in the trailing window. The LAG runs over the whole
    series first (the first day in range needs its predecessor), then the filter applies.
    The blocked LAG keeps even a very large entity spread over per-year tasks."""
    ch = daily_changes(raw.filter(F.col("currency_code") == F.lit(entity)))
    return (ch.filter(F.col("rate_date") > F.date_sub(_date_lit(as_of), days))
            .select("rate_date", "exchange_rate", "pct_change").orderBy("rate_date"))


def _label(labels: Mapping[str, str]):
    expr = None
    for code, text in labels.items():
        cond = F.col("currency_code") == F.lit(code)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def majors_labelled(raw: DataFrame, labels: Mapping[str, str], as_of, days: int = 30,
                    rate_type: str | None = None) -> DataFrame:
    """Long (time, metric, value) rows for the major entities; metric is the label."""
    codes = list(labels)
    rows = after(raw.filter(F.col("currency_code").isin(codes)), as_of, days)
    if rate_type is not None:
        rows = rows.filter(F.col("rate_type") == F.lit(rate_type))
    return rows.select(F.col("rate_date").alias("time"), _label(labels).alias("metric"),
                       F.col("exchange_rate").alias("value")).orderBy("time")


def majors_wide(raw: DataFrame, labels: Mapping[str, str], as_of, days: int = 30) -> DataFrame:
    """Wide form: one row per time, one column per label (max over rate types)."""
    long = majors_labelled(raw, labels, as_of, days)
    values: Sequence[str] = list(labels.values())
    return long.groupBy("time").pivot("metric", values).agg(F.max("value")).orderBy("time")
