"""Numeric helpers that give the same numbers in Spark, DuckDB and PostgreSQL.

* averages: exact decimal sum divided by the count in double;
* percent change: double division, rounded half-up to 4 places;
* correlation: covariance over the product of standard deviations, NULL when either side is
  constant (bare ``corr`` divides by zero under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double") / F.count(c)


def pct_change(cur: Column, prev: Column, digits: int = 4) -> Column:
    ratio = F.try_divide(cur.cast("double"), prev.cast("double"))
    return F.round((ratio - F.lit(1.0)) * F.lit(100.0), digits)


def pct_range(mx: Column, mn: Column, avg: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide((mx - mn).cast("double"), avg) * F.lit(100.0), digits)


def guarded_corr(x: str, y: str) -> Column:
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    varying = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    return F.when(varying, F.covar_samp(xs, ys) / (F.stddev_samp(xs) * F.stddev_samp(ys)))


def decimals_to_double(df):
    """Cast every decimal column to double (query outputs compare across engines)."""
    from pyspark.sql.types import DecimalType
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])
