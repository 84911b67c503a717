"""Data-quality checks and load / batch reports. Each is one grouped aggregate; results
are small DataFrames, never Python loops over collected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit


_d = date_lit


def dq_counts(check_date, majors: Sequence[str], upper: float = 1000.0, rate_type_on_date: str = "daily", where: Column | None = None) -> list[Column]:
    """The counts of the report as aggregates, of the rows that meet ``where``; also for an observation."""
    here = F.lit(True) if where is None else where
    on_date = here & (F.col("rate_date") == _d(check_date))
    rate = F.col("exchange_rate")
    return [F.count_if(on_date & (F.col("rate_type") == F.lit(rate_type_on_date))).alias("rows_on_date"),
            F.count_if(here & ((rate <= F.lit(0)) | (rate > F.lit(upper)))).alias("anomalies"),
            F.count_if(on_date & F.col("currency_code").isin(*majors)).alias("major_values"),
            F.count_if(here).alias("total_records")]


def dq_report(raw: DataFrame, check_date, majors: Sequence[str], upper: float = 1000.0,
              rate_type_on_date: str = "daily") -> DataFrame:
    """Long table (check, value, status). Checks: rows of the type on the date (warn if 0),
    anomalies rate <= 0 or > upper (warn if > 0), major-entity rows on the date, any type
    (warn if none), total rows (info). Never fails."""
    counts = raw.agg(*dq_counts(check_date, majors, upper, rate_type_on_date))
    long = counts.select(F.expr(
        "stack(4, 'rows_on_date', rows_on_date, 'anomalies', anomalies, "
        "'major_values', major_values, 'total_records', total_records) AS (check, value)"))
    status = (F.when(F.col("check") == "rows_on_date", F.when(F.col("value") == 0, "warn").otherwise("ok"))
              .when(F.col("check") == "anomalies", F.when(F.col("value") > 0, "warn").otherwise("ok"))
              .when(F.col("check") == "major_values", F.when(F.col("value") == 0, "warn").otherwise("ok"))
              .otherwise("info"))
    return long.select("check", "value", status.alias("status"))


def dq_major_values(raw: DataFrame, check_date, majors: Sequence[str], rate_type: str | None = None) -> DataFrame:
    rows = raw if rate_type is None else raw.filter(F.col("rate_type") == F.lit(rate_type))
    return (rows.filter((F.col("rate_date") == _d(check_date)) & F.col("currency_code").isin(*majors))
            .select("currency_code", "rate_type", "exchange_rate").orderBy("currency_code", "rate_type"))


def record_stats(raw: DataFrame) -> DataFrame:
    """Per rate type: rows, date range (and as text "min - max"), distinct entities."""
    return (raw.groupBy("rate_type")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
                 F.countDistinct("currency_code").alias("currencies"))
            .select("rate_type", "count", "min_date", "max_date",
                    F.concat_ws(" - ", F.col("min_date").cast("string"), F.col("max_date").cast("string")).alias("date_range"),
                    "currencies"))


def batch_stats(batch: DataFrame, sample: int = 3) -> DataFrame:
    """Distinct codes, dates and types of a batch, the types as text, the first ``sample``
    codes in code order, and the date range. The sample is a bounded top-k, not a collect."""
    stats = batch.agg(F.countDistinct("currency_code").alias("currencies"),
                      F.countDistinct("rate_date").alias("dates"),
                      F.countDistinct("rate_type").alias("rate_types"),
                      F.concat_ws(", ", F.array_sort(F.collect_set("rate_type"))).alias("types"),
                      F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
                      F.lit(1).alias("_k"))
    first = (batch.select("currency_code").distinct().orderBy("currency_code").limit(sample)
             .agg(F.concat_ws(", ", F.array_sort(F.collect_list("currency_code"))).alias("sample_codes"),
                  F.lit(1).alias("_k")))
    return stats.join(first, "_k").drop("_k")


def run_totals(batch: DataFrame) -> DataFrame:
    return batch.agg(F.count_if(F.col("rate_type") == "daily").alias("daily"),
                     F.count_if(F.col("rate_type") == "monthly").alias("monthly"),
                     F.count(F.lit(1)).alias("total"))


def period_analysis(batch: DataFrame) -> DataFrame:
    """Date range, distinct dates and entities, average entities per day (1 place)."""
    return batch.agg(F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
                     F.countDistinct("rate_date").alias("dates"),
                     F.countDistinct("currency_code").alias("currencies"),
                     F.count(F.lit(1)).alias("records")).select(
        "*", F.round(F.col("records") / F.col("dates"), 1).alias("avg_per_day"))


def rows_per_date(batch: DataFrame) -> DataFrame:
    return batch.groupBy("rate_date").agg(F.count(F.lit(1)).alias("rows")).orderBy("rate_date")


def existing_dates(raw: DataFrame, rate_type: str | None = None) -> DataFrame:
    rows = raw if rate_type is None else raw.filter(F.col("rate_type") == F.lit(rate_type))
    return rows.select("rate_date").distinct().orderBy("rate_date")


def load_report(raw: DataFrame, start, end) -> DataFrame:
    """Period report: period bounds, calendar days, rows in the period, and the table's
    total rows, distinct entities and date range -- one aggregate."""
    s, e = _d(start), _d(end)
    in_period = F.col("rate_date").between(s, e)
    return raw.agg(
        s.alias("period_start"), e.alias("period_end"),
        (F.datediff(e, s) + 1).alias("days"),
        F.count_if(in_period).alias("records_loaded"),
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("currency_code").alias("currencies"),
        F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"))
