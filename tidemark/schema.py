"""Table schemas of the raw store, the dimension, the fact table and the marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ("currency_code", "rate_date", "rate_type")
RATE_TYPES = ("daily", "monthly")

RAW_SCHEMA = T.StructType([
    T.StructField("currency_code", T.StringType(), False, {"comment": "entity code, 3 upper-case letters"}),
    T.StructField("currency_name", T.StringType(), False, {"comment": "entity name, at most 100 characters"}),
    T.StructField("exchange_rate", T.DecimalType(12, 6), False, {"comment": "price of `nominal` units"}),
    T.StructField("rate_date", T.DateType(), False, {"comment": "observation date"}),
    T.StructField("rate_type", T.StringType(), False, {"comment": "daily or monthly"}),
    T.StructField("nominal", T.IntegerType(), True, {"comment": "units the price refers to, default 1"}),
    T.StructField("load_timestamp", T.TimestampNTZType(), True, {"comment": "time of the last write"}),
])
RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

# Records before validation: every field as text, nullable.
RECORD_SCHEMA = T.StructType([
    T.StructField(c, T.StringType(), True)
    for c in ("currency_code", "currency_name", "exchange_rate", "rate_date", "rate_type", "nominal")
])

DIM_SCHEMA = T.StructType([
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("currency_name", T.StringType(), False),
    T.StructField("first_seen", T.DateType(), True),
    T.StructField("last_seen", T.DateType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])

FACT_COLUMNS = ("currency_code", "exchange_rate", "rate_date", "rate_type", "nominal", "load_timestamp")

LOG_SCHEMA = T.StructType([
    T.StructField("log_message", T.StringType(), True),
    T.StructField("log_time", T.TimestampNTZType(), True),
    T.StructField("run", T.StringType(), True),
    T.StructField("mart", T.StringType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), True),
])


@dataclass(frozen=True)
class SeriesSpec:
    """Column names of an arbitrary (entity, date, value) series."""

    entity: str = "currency_code"
    date: str = "rate_date"
    value: str = "exchange_rate"
    rate_type: str | None = "rate_type"
    load_ts: str | None = "load_timestamp"
    name: str | None = "currency_name"
    nominal: str | None = "nominal"


def _or_lit(df: DataFrame, name: str | None, default: Column) -> Column:
    return F.col(name) if name and name in df.columns else default


def to_raw(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Project any series onto the raw schema (missing parts take the table defaults)."""
    return df.select(
        F.col(spec.entity).cast("string").alias("currency_code"),
        _or_lit(df, spec.name, F.col(spec.entity)).cast("string").alias("currency_name"),
        F.col(spec.value).cast(T.DecimalType(12, 6)).alias("exchange_rate"),
        F.to_date(F.col(spec.date)).alias("rate_date"),
        _or_lit(df, spec.rate_type, F.lit("daily")).cast("string").alias("rate_type"),
        _or_lit(df, spec.nominal, F.lit(1)).cast("int").alias("nominal"),
        _or_lit(df, spec.load_ts, F.lit(None)).cast(T.TimestampNTZType()).alias("load_timestamp"),
    )
