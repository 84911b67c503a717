"""Calendar of days between two dates, built distributed with ``spark.range``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def calendar(spark: SparkSession, start, end, skip_weekends: bool = False, keep_skipped: bool = False) -> DataFrame:
    """Days start..end (closed). With skip_weekends, Saturday and Sunday are dropped, or
    kept with ``skipped = true`` when keep_skipped is set."""
    start, end = as_date(start), as_date(end)
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    n = (end - start).days + 1
    days = spark.range(0, n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("rate_date"))
    weekend = F.dayofweek("rate_date").isin(1, 7)
    if not skip_weekends:
        return days.withColumn("skipped", F.lit(False)) if keep_skipped else days
    if keep_skipped:
        return days.withColumn("skipped", weekend)
    return days.filter(~weekend)


def calendar_of(rows: DataFrame, skip_weekends: bool = False, keep_skipped: bool = False) -> DataFrame:
    """Days from the first to the last ``rate_date`` of ``rows``, as part of the plan (one row of bounds, unfolded)."""
    days = rows.agg(F.min("rate_date").alias("a"), F.max("rate_date").alias("b")).where("a is not null") \
        .select(F.explode(F.sequence("a", "b")).alias("rate_date"))
    weekend = F.dayofweek("rate_date").isin(1, 7)
    if keep_skipped:
        return days.withColumn("skipped", weekend & F.lit(skip_weekends))
    return days.filter(~weekend) if skip_weekends else days


def check_period(start, end, today=None, warn_days: int = 365) -> dict:
    """Driver-side argument checks of a period load: start <= end, end not in the future."""
    start, end = as_date(start), as_date(end)
    today = as_date(today) if today else dt.date.today()
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    if end > today:
        raise ValueError(f"end {end} is in the future")
    days = (end - start).days + 1
    return {"start_date": start.isoformat(), "end_date": end.isoformat(), "days_count": days,
            "long_period": days > warn_days}


def day_status(spark: SparkSession, rows: DataFrame, start=None, end=None, skip_weekends: bool = False) -> DataFrame:
    """Per calendar day: rows landed and status loaded / missing / skipped. Without bounds: the days of ``rows``."""
    if start is None:
        cal = calendar_of(rows, skip_weekends, keep_skipped=True)
    else:
        cal = calendar(spark, start, end, skip_weekends, keep_skipped=True)
        rows = rows.filter(F.col("rate_date").between(F.lit(as_date(start)), F.lit(as_date(end))))
    per_day = rows.groupBy("rate_date").agg(F.count(F.lit(1)).alias("rows"))
    j = cal.join(per_day, "rate_date", "left")
    status = (F.when(F.col("skipped"), F.lit("skipped"))
              .when(F.col("rows").isNull(), F.lit("missing"))
              .otherwise(F.lit("loaded")))
    return j.select("rate_date",
                    F.when(F.col("skipped"), F.lit(0)).otherwise(F.coalesce(F.col("rows"), F.lit(0))).cast("long").alias("rows"),
                    status.alias("status"))


def day_status_summary(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(F.col("status") == "loaded").alias("successful_days"),
                      F.count_if(F.col("status") == "missing").alias("failed_days"),
                      F.count_if(F.col("status") == "skipped").alias("skipped_days"),
                      F.sum("rows").alias("total_rows"))
