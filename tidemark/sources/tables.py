"""Reads of the given parquet tables and of the raw rates store.

``rates_from_lines`` derives a raw-rates relation from the order lines: the supplier is the
entity, the ship day the date, the extended price the rate; of several lines of a supplier on a day the last wins
(:func:`superseded_lines` counts the others). Monthly rows hold the month's largest daily
price. Entities and rows grow with the table, about nine rates for ten lines.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import date_lit
from tidemark.session import input_tasks, shares_and_tasks
from tidemark.schema import RAW_SCHEMA

RAW_STORE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("rate_month", T.StringType())])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Names of the monthly series, chosen by supplier key modulo their number; they reach every rule of ``codes``.
MONTHLY_NAMES = ("Доллара США к рублю", "Евро к рублю", "Юаня к рублю", "Фунта стерлингов к рублю", "Йены к рублю", "Франка к рублю",
                 "Казахстанского тенге", "Белорусского рубля", "Гривны", "Лари", "Доллар", "ЕВР", "Юань", "Фунт", "Йена", "Франк",
                 "Рупия", "XYZ coin")
CENTS = 1 << 24  # more than any price in cents


def _letter(n):
    return F.char(F.lit(65) + F.pmod(n, F.lit(26)))


#: The longest code of the relation that is valid: three letters and the number behind them, up to 1.7 billion suppliers.
MAX_CODE = 8


def entity_code(k) -> Column:
    """Three capital letters from a supplier key, with a number behind from 17,576 on; every tenth key gets a
    code that breaks the rules: ``S-`` and ten digits, longer than any valid one."""
    k = F.col(k)
    letters = F.concat(_letter(F.floor(k / 676)), _letter(F.floor(k / 26)), _letter(k))
    return F.when(k % 10 == 7, F.concat(F.lit("S-"), F.lpad(k.cast("string"), 10, "0"))).otherwise(
        F.concat(letters, F.when(k >= 17576, F.floor(k / 17576).cast("string")).otherwise(F.lit(""))))


#: Lines of a month that one task takes where a table by months is written from them.
MONTH_TASK_LINES = 250_000


def whole_cents(price) -> Column:
    """The price in cents, halves away from zero. ``round`` goes through the double's decimal digits; in the usual range one addition does
    the same, as halves are exact there."""
    cents = price * 100
    return F.when((cents >= 1.0) & (cents < float(1 << 51)), (cents + 0.5).cast("long")).otherwise(F.round(cents).cast("long"))


def lines_by_day(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Per (supplier, ship day): the number of lines and ``seq`` of the last one, by order key, line number
    and price. ``seq`` holds the price in its last digits, so one hash aggregate of fixed width does it.

    The lines are dealt once, by supplier and month, to a number of tasks that follows the table's size: a task's memory does not grow
    with the table (left to itself, Spark joins small partitions until there is one a core), and sums by supplier and month, week or day
    behind it are combined where the rows lie. With ``by_month`` they are dealt by month and a share of the suppliers (column ``_share``), so
    that a table by months is written from them without another shuffle; the months' sizes take a look at the ship days alone."""
    cents = whole_cents(F.col("l_extendedprice"))
    seq = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * F.lit(CENTS) + cents
    lines = (table(spark, sf_dir, "lineitem")
             .select(F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("rate_date"), seq.alias("seq"))
             .withColumn("month", F.trunc("rate_date", "month")))
    at = ["k", "month"]
    if by_month:
        days = lines.groupBy("rate_date").count().withColumn("month", F.trunc("rate_date", "month"))  # few days, so few months to work out
        shares, tasks = shares_and_tasks(spark, [r["n"] for r in days.groupBy("month").agg(F.sum("count").alias("n")).collect()], MONTH_TASK_LINES)
        at.append("_share")
        lines = lines.withColumn("_share", F.pmod(F.hash("k"), F.lit(shares))).repartition(tasks, "month", "_share")
    else:
        lines = lines.repartition(input_tasks(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet"), *at)
    return lines.groupBy(*at, "rate_date").agg(F.max("seq").alias("seq"), F.count(F.lit(1)).alias("lines"))


def daily_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows, with the supplier ``k``."""
    return _daily_rows(lines_by_day(spark, sf_dir), "k")


def _price(cents) -> Column:
    """The rate of a price in cents."""
    return (cents.cast(T.DecimalType(12, 0)) * F.lit(Decimal("0.01"))).cast(T.DecimalType(12, 6))


def _loaded(day) -> Column:
    return F.col(day).cast(T.TimestampNTZType()) + F.expr("INTERVAL 18 HOURS")


def _daily_rows(days: DataFrame, *at: str) -> DataFrame:
    """Daily rows of :func:`lines_by_day`, with its columns ``at``."""
    name = F.concat(F.lit("Series "), F.col("currency_code"))
    return (days.select("k", "rate_date", _price(F.col("seq") % F.lit(CENTS)).alias("exchange_rate"), entity_code("k").alias("currency_code"))
            .select(
                "currency_code",
                F.when(F.col("k") % 10 == 9, F.concat(name, F.repeat(F.lit(" of a long name"), 7))).otherwise(name).alias("currency_name"),
                "exchange_rate", "rate_date", F.lit("daily").alias("rate_type"),
                F.when(F.col("k") % 3 == 0, 1).when(F.col("k") % 3 == 1, 10).otherwise(100).alias("nominal"),
                _loaded("rate_date").alias("load_timestamp"), *at))


def _monthly_rows(days: DataFrame) -> DataFrame:
    """Monthly rows of :func:`lines_by_day`, aggregated where a supplier's month lies: the largest price in cents and the last day."""
    names = F.array(*[F.lit(n) for n in MONTHLY_NAMES])
    return (days.groupBy("k", "month", *(["_share"] if "_share" in days.columns else []))
            .agg(F.max(F.col("seq") % F.lit(CENTS)).alias("cents"), F.max("rate_date").alias("last"))
            .select(entity_code("k").alias("currency_code"), F.get(names, F.pmod("k", F.lit(len(MONTHLY_NAMES))).cast("int")).alias("currency_name"),
                    _price(F.col("cents")).alias("exchange_rate"), F.col("month").alias("rate_date"),
                    F.lit("monthly").alias("rate_type"), F.lit(1).alias("nominal"), _loaded("last").alias("load_timestamp")))


def rates_from_lines(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Raw rates (daily and monthly) derived from the order lines. With ``by_month`` they lie as a table by months is written."""
    days = lines_by_day(spark, sf_dir, by_month)
    return _daily_rows(days).unionByName(_monthly_rows(days))


def superseded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines the last-wins rule of :func:`lines_by_day` left out, per month: nothing goes unseen."""
    return (lines_by_day(spark, sf_dir).groupBy(F.trunc("rate_date", "month").alias("month"))
            .agg(F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("rates"), (F.sum("lines") - F.count(F.lit(1))).alias("superseded")))


def rates_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events seen as loads: entity = event_type, load_timestamp = ts."""
    ev = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    return ev.select(
        F.col("event_type").alias("currency_code"),
        F.col("event_type").alias("currency_name"),
        F.col("value").cast(T.DecimalType(12, 6)).alias("exchange_rate"),
        F.to_date("ts").alias("rate_date"),
        F.lit("daily").alias("rate_type"),
        F.lit(1).alias("nominal"),
        F.col("ts").cast(T.TimestampNTZType()).alias("load_timestamp"),
    )


def read_raw(spark: SparkSession, path: str, start=None, end=None, with_month: bool = False) -> DataFrame:
    """The raw store: the catalogue table ``database.name``, or a folder, partitioned by rate_type and rate_month (see
    ``operators.tables``).

    ``start`` and ``end`` (closed) prune the month folders and filter the rows. ``with_month`` keeps the
    partition column, which the trailing windows of the marts and panels use for their own bounds.
    """
    from tidemark.schema import RAW_COLUMNS
    rows = spark.read.schema(RAW_STORE_SCHEMA).parquet(path) if "/" in path else spark.table(path)
    for bound, side in ((start, "ge"), (end, "le")):
        if bound is not None:
            day = date_lit(bound)
            month = F.date_format(day, "yyyy-MM")
            rows = rows.filter((F.col("rate_date") >= day) & (F.col("rate_month") >= month)) if side == "ge" else \
                rows.filter((F.col("rate_date") <= day) & (F.col("rate_month") <= month))
    return rows.select(*RAW_COLUMNS, *(["rate_month"] if with_month else []))


def after(rows: DataFrame, as_of, days: int) -> DataFrame:
    """Rows with rate_date > as_of - days (that day excluded); prunes the month folders of a raw store."""
    bound = F.date_sub(date_lit(as_of), days)
    rows = rows.filter(F.col("rate_date") > bound)
    return rows.filter(F.col("rate_month") >= F.date_format(bound, "yyyy-MM")) if "rate_month" in rows.columns else rows
