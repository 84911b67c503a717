"""Marts kept up to date after a load, from stored summaries of months instead of the months' rows.

* **Moments** (:func:`moments`): for each entity and piece of a week inside a month its count, exact sum, mean, sum of squared
  deviations, extremes, first and last row, and the co-moments with the anchor series. Weeks, months, quarters, the whole
  series and trailing windows are merged from pieces (:func:`period_stats`, :func:`anchor_correlation`, :func:`top_volatile`); a load
  recomputes the pieces of its months only (:func:`refresh_moments`).
* **Daily changes** (:func:`refresh_daily_changes`): a late row changes its own change and that of the *next* existing row of its entity. The
  months to do again are the touched ones and, for their entities, the next month with rows; the row before a month's first comes from the pieces.
* **Load statistics** (:func:`load_bitmaps`, :func:`load_stats`): distinct entities and dates of a load day as bitmaps, merged by OR: exact,
  and without another look at earlier loads.

The tables are partitioned by month and their partitions switched (``operators.tables.replace_months``), so readers see whole months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.literals import date_lit
from tidemark.functions.numeric import pct_change, pct_range
from tidemark.functions.series import with_previous_period
from tidemark.operators import marts
from tidemark.operators.tables import MONTH, deal, month_sizes, replace_months

PIECE = ("currency_code", "month", "week")


def _millionths(rate: Column) -> Column:
    """A rate of six decimal places, as a double, in millionths: a whole number, so sums are exact, in half the time of wide decimals."""
    return F.floor(rate * 1e6 + 0.5)


def _mean_rate() -> Column:
    """The mean of pieces: their exact sum, divided once as a decimal's double is, by their rows."""
    return F.sum("total").cast("double") / 1e6 / F.sum("n")


def moments(raw: DataFrame, anchor: str, rate_type: str = "daily", sizes: list[int] | None = None) -> DataFrame:
    """One row for each entity and piece of a week inside a month. All aggregates are of fixed width. With ``sizes``, the numbers of rows of
    the months, the rows (not their pieces, which are five times as wide) are dealt by ``rate_month`` as the table of moments lies, and this
    is the only shuffle; else they are combined on the map side. The anchor has one row a day of the calendar, so it is broadcast."""
    rows = raw.filter(F.col("rate_type") == F.lit(rate_type))
    other = rows.filter(F.col("currency_code") == F.lit(anchor)).groupBy("rate_date").agg(F.max("exchange_rate").alias("anchor_rate"))
    at = [] if sizes is None else ["rate_month", "_share"]
    rows = rows.select("currency_code", "rate_date", "exchange_rate", *at[:1])
    if at:
        rows = deal(rows, sizes, MONTH)
    x, y = F.col("exchange_rate"), F.when(F.col("currency_code") != F.lit(anchor), F.col("anchor_rate"))
    xd, yd = x.cast("double"), y.cast("double")
    both = F.when(yd.isNotNull(), xd)
    count, pairs = F.count(F.lit(1)), F.count(both)
    pieces = (rows.join(F.broadcast(other), "rate_date", "left")
              .groupBy(*at, "currency_code", F.trunc("rate_date", "month").alias("month"), F.trunc("rate_date", "week").alias("week"))
              .agg(count.alias("n"), F.sum(_millionths(xd)).alias("total"), F.avg(xd).alias("mean"), (F.var_pop(xd) * count).alias("m2"),
                   F.min(x).alias("lo"), F.max(x).alias("hi"),
                   F.min("rate_date").alias("first_date"), F.max("rate_date").alias("last_date"), F.max_by(x, F.col("rate_date")).alias("last_rate"),
                   pairs.alias("pairs"), F.avg(both).alias("mean_x"), F.avg(yd).alias("mean_y"), (F.var_pop(both) * pairs).alias("m2_x"),
                   (F.var_pop(yd) * pairs).alias("m2_y"), (F.covar_pop(both, yd) * pairs).alias("c_xy"),
                   F.min(both).alias("lo_x"), F.max(both).alias("hi_x"), F.min(yd).alias("lo_y"), F.max(yd).alias("hi_y")))
    rate_month = F.col("rate_month") if at else F.date_format("month", "yyyy-MM")
    return pieces.select(*[c for c in pieces.columns if c not in at], rate_month.alias("rate_month"))


def _merged(n: str, x: str, y: str, xx: str, yy: str, xy: str) -> Column:
    """Merged moments of the pieces of a group, in the order of their weeks: struct<n, x, y, xx, yy, xy>. A group has few pieces (up to six a
    month of the calendar), however many rows they stand for."""
    zero = F.lit(0.0)
    piece = F.struct(F.col("month").alias("month"), F.col("week").alias("week"), F.col(n).cast("double").alias("n"),
                     *[F.coalesce(F.col(c), zero).alias(a) if c else zero.alias(a) for c, a in ((x, "x"), (y, "y"), (xx, "xx"), (yy, "yy"), (xy, "xy"))])

    def merge(a: Column, b: Column) -> Column:
        whole = a["n"] + b["n"]
        part = F.when(whole > 0, b["n"] / whole).otherwise(zero)
        dx, dy, weight = b["x"] - a["x"], b["y"] - a["y"], a["n"] * part
        return F.struct(whole.alias("n"), (a["x"] + dx * part).alias("x"), (a["y"] + dy * part).alias("y"), (a["xx"] + b["xx"] + dx * dx * weight).alias("xx"),
                        (a["yy"] + b["yy"] + dy * dy * weight).alias("yy"), (a["xy"] + b["xy"] + dx * dy * weight).alias("xy"))

    start = F.struct(*[zero.alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    return F.aggregate(F.array_sort(F.collect_list(piece)), start, merge)


def _spread() -> Column:
    """Merged moments of the pieces' own values."""
    return _merged("n", "mean", None, "m2", None, None)


def _week_spread() -> Column:
    """:func:`_spread` of the pieces of a week, which are two at most as it lies in two months at most: the same merge by aggregates of fixed
    width, which need no lists."""
    zero, order = F.lit(0.0), F.coalesce("month", F.lit("1970-01-01").cast("date"))
    mean, whole = F.coalesce("mean", zero), F.sum("n").cast("double")
    n = F.min_by("n", order).cast("double")
    between = F.max_by(mean, order) - F.min_by(mean, order)
    return F.struct(whole.alias("n"), (F.sum(F.coalesce("m2", zero)) + between * between * (n * ((whole - n) / whole))).alias("xx"))


def _stddev(m: Column) -> Column:
    return F.when(m["n"] > 1, F.sqrt(m["xx"] / (m["n"] - 1)))


def period_stats(pieces: DataFrame, unit: str, volatility_digits: int | None = None, block: str | None = None) -> DataFrame:
    """``marts.period_stats`` from the moments. The pieces are dealt once, by entity, for the periods and the look at the period before."""
    period = marts.PERIOD_COLUMN[unit]
    pieces = pieces.select(*PIECE, "n", "total", "mean", "m2", "lo", "hi")
    if block is None:
        pieces = pieces.repartition("currency_code")
    at = F.col("week") if unit == "week" else F.trunc("month", unit)
    stats = pieces.groupBy("currency_code", at.alias(period)).agg(
        _mean_rate().alias("avg_rate"), F.min("lo").alias("min_rate"), F.max("hi").alias("max_rate"),
        (_week_spread() if unit == "week" else _spread()).alias("m"), F.sum("n").alias("days_count"))
    vol = _stddev(F.col("m"))
    stats = stats.select("currency_code", period, "avg_rate", "min_rate", "max_rate",
                         (F.round(vol, volatility_digits) if volatility_digits is not None else vol).alias("volatility"), "days_count")
    before = with_previous_period(stats, ["currency_code"], period, ["avg_rate"], block)
    return before.select(*stats.columns, (F.col("avg_rate") - F.col("prev_avg_rate")).alias("abs_change"),
                         pct_change(F.col("avg_rate"), F.col("prev_avg_rate")).alias("pct_change"))


def anchor_correlation(pieces: DataFrame, anchor: str, min_days: int = 10) -> DataFrame:
    """``marts.anchor_correlation`` from the moments (made for the same anchor)."""
    n, x, y = F.col("pairs"), F.col("mean_x"), F.col("mean_y")
    mine = pieces.filter((F.col("currency_code") != F.lit(anchor)) & (n > 0)) \
        .select(*PIECE, "pairs", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy", "lo_x", "hi_x", "lo_y", "hi_y").repartition("currency_code")
    # an entity has few pieces (up to six a month of the calendar): first their common means, then the squares about them
    whole = Window.partitionBy("currency_code").orderBy("month", "week").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    days = F.sum(n).over(whole)
    mine = mine.withColumns({"_dx": x - F.sum(n * x).over(whole) / days, "_dy": y - F.sum(n * y).over(whole) / days})
    dx, dy = F.col("_dx"), F.col("_dy")
    merged = (mine.groupBy("currency_code")
              .agg(F.sum(F.col("m2_x") + n * dx * dx).alias("xx"), F.sum(F.col("m2_y") + n * dy * dy).alias("yy"), F.sum(F.col("c_xy") + n * dx * dy).alias("xy"),
                   F.sum("pairs").alias("days_count"), ((F.min("lo_x") < F.max("hi_x")) & (F.min("lo_y") < F.max("hi_y"))).alias("varying"))
              .filter(F.col("days_count") > min_days))
    value = F.when(F.col("varying"), F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy")))
    return merged.select("currency_code", F.round(value, 4).alias("correlation_with_anchor"), "days_count") \
        .orderBy(F.col("correlation_with_anchor").desc_nulls_first(), "currency_code")


def top_volatile(pieces: DataFrame, raw: DataFrame, as_of, anchor: str, days: int = 30, n: int | None = 10) -> DataFrame:
    """``marts.top_volatile`` from the moments; of ``raw`` only the one piece of a week that the window cuts is read."""
    bound = F.date_sub(date_lit(as_of), days)
    start = F.greatest("month", "week")
    inside = pieces.filter((F.col("rate_month") >= F.date_format(bound, "yyyy-MM")) & (start > bound))
    week, month = F.trunc(bound, "week"), F.trunc(bound, "month")
    rows = raw.filter((F.col("rate_date") > bound) & (F.col("rate_date") < F.date_add(week, 7)) & (F.trunc("rate_date", "month") == month))
    if "rate_month" in raw.columns:
        rows = rows.filter(F.col("rate_month") == F.date_format(bound, "yyyy-MM"))
    edge = moments(rows, anchor).select(*pieces.columns)
    merged = inside.unionByName(edge).groupBy("currency_code").agg(_spread().alias("m"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                                   _mean_rate().alias("mean"))
    out = merged.select(
        "currency_code", F.round(_stddev(F.col("m")), 4).alias("volatility"), F.round("mean", 2).alias("avg_rate"),
        F.round("lo", 2).cast("double").alias("min_rate"), F.round("hi", 2).cast("double").alias("max_rate"),
        F.round(F.col("hi") - F.col("lo"), 2).cast("double").alias("range"), pct_range(F.col("hi"), F.col("lo"), F.col("mean")).alias("pct_range"))
    out = out.orderBy(F.col("volatility").desc_nulls_first(), "currency_code")
    return out.limit(n) if n is not None else out


def months_of(touched: DataFrame) -> list[str]:
    """The months of the touched rows: a short list, one text a month of the calendar."""
    return sorted(r[0] for r in touched.select(F.date_format("rate_date", "yyyy-MM")).distinct().collect() if r[0] is not None)


def refresh_moments(spark: SparkSession, raw: DataFrame, touched: DataFrame | None, table: str, base: str, anchor: str) -> list[str]:
    """Recompute the pieces of the months of ``touched`` (rows of a load; all months if None) in the moments table; returns these months.
    ``raw`` is the raw store after the load, with ``rate_month``, so other months are not read."""
    months = None
    if touched is not None:
        months = months_of(touched)
        raw = raw.filter(F.col("rate_month").isin(months)) if months else raw.limit(0)
    if months is None or months:
        sizes = month_sizes(raw.filter(F.col("rate_type") == "daily"))
        replace_months(spark, table, moments(raw, anchor, sizes=sizes), base, months)
    return months or []


def _carried(pieces: DataFrame) -> DataFrame:
    """(entity, month, carry): the last rate before the month, for each month of an entity with rows. An entity has one row a month of the
    calendar here, so one window by entity holds few."""
    per_month = pieces.groupBy("currency_code", "month").agg(F.max_by("last_rate", "last_date").alias("last_rate"))
    return with_previous_period(per_month, ["currency_code"], "month", ["last_rate"]).select("currency_code", "month", F.col("prev_last_rate").alias("carry"))


def daily_changes_of(raw: DataFrame, pieces: DataFrame, months: list[str] | None = None, rate_type: str = "daily") -> DataFrame:
    """``marts.daily_changes`` of ``months`` (all if None), with ``rate_month``: the row before a month's first comes from the pieces.

    It joins the rows as one more of its entity and month, without a date, so it sorts before them; one shuffle by month (:func:`deal`) and one
    sort serve the look at the row before and the folders of the write."""
    if months is not None:
        raw = raw.filter(F.col("rate_month").isin(months)) if months else raw.limit(0)
    rows = raw.filter(F.col("rate_type") == F.lit(rate_type))
    carried = _carried(pieces).filter(F.col("currency_code").isNotNull() & F.col("carry").isNotNull()) \
        .select("currency_code", F.date_format("month", "yyyy-MM").alias("rate_month"), "carry")
    if months is not None:
        carried = carried.filter(F.col("rate_month").isin(months)) if months else carried.limit(0)
    sizes = month_sizes(rows)
    both = rows.select("currency_code", "rate_date", "exchange_rate", "rate_month", F.lit(True).alias("_row")).unionByName(
        carried.filter(F.col("rate_month").isNotNull()).withColumn("_row", F.lit(False)), allowMissingColumns=True)
    series = Window.partitionBy(*MONTH, "_share", "currency_code").orderBy("rate_date")
    before = F.coalesce(F.lag("exchange_rate").over(series), F.first("carry").over(series.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return deal(both, sizes, MONTH).withColumn("prev_rate", before).filter("_row").select(
        "currency_code", "rate_date", "exchange_rate", "prev_rate", (F.col("exchange_rate") - F.col("prev_rate")).alias("abs_change"),
        pct_change(F.col("exchange_rate"), F.col("prev_rate")).alias("pct_change"), "rate_month")


def refresh_daily_changes(spark: SparkSession, raw: DataFrame, pieces: DataFrame, touched: DataFrame | None, table: str, base: str) -> list[str]:
    """Bring the daily changes table up to date after a load (build it if ``touched`` is None): the months of the touched rows and, for
    their entities, the next months with rows are done again; returns them. ``pieces`` are the moments after the load."""
    if touched is None:
        replace_months(spark, table, daily_changes_of(raw, pieces), base)
        return []
    months = months_of(touched)
    mine = touched.select("currency_code", F.trunc("rate_date", "month").alias("month")).distinct()
    # years of four digits sort as text, and any other year's text sorts before them
    later = pieces.filter(F.col("month") > F.lit(f"{months[0]}-01").cast("date")) if months and len(months[0]) == 7 else pieces
    following = (later.select("currency_code", F.col("month").alias("later")).distinct()
                 .join(mine, "currency_code").filter(F.col("later") > F.col("month")).groupBy("currency_code", "month").agg(F.min("later").alias("later")))
    again = sorted(set(months) | {r[0] for r in following.select(F.date_format("later", "yyyy-MM")).distinct().collect()})
    replace_months(spark, table, daily_changes_of(raw, pieces, again), base, again)
    return again


# ---- load statistics from bitmaps -------------------------------------------------

EPOCH_BIT = 1_000_000  # days before 1970 have a place too


def load_bitmaps(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Mergeable statistics of a load: for each load day one row of counts and bounds (``kind`` 'rows'), and the bitmaps of its entities and
    dates by bucket (32,768 bits each). ``ids`` gives every entity (``currency_code``) a number ``id``; numbers never change."""
    day = F.to_date("load_timestamp").alias("load_date")
    none = F.lit(None)
    rows = raw.groupBy(day).agg(F.count(F.lit(1)).alias("records"), F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
                                F.min("load_timestamp").alias("first_load"), F.max("load_timestamp").alias("last_load")) \
        .select("load_date", F.lit("rows").alias("kind"), F.lit(0).cast("long").alias("bucket"), none.cast("binary").alias("bits"),
                "records", "min_date", "max_date", "first_load", "last_load")

    def bitmap(df: DataFrame, number: Column, kind: str) -> DataFrame:
        return df.groupBy(day, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")) \
            .select("load_date", F.lit(kind).alias("kind"), "bucket", "bits", none.cast("long").alias("records"), none.cast("date").alias("min_date"),
                    none.cast("date").alias("max_date"), none.cast("timestamp_ntz").alias("first_load"), none.cast("timestamp_ntz").alias("last_load"))

    entities = bitmap(raw.select("load_timestamp", "currency_code").join(ids, "currency_code"), F.col("id") + 1, "entities")
    dates = bitmap(raw.filter(F.col("rate_date").isNotNull()), F.unix_date("rate_date").cast("long") + EPOCH_BIT, "dates")
    return rows.unionByName(entities).unionByName(dates)


def merge_bitmaps(parts: DataFrame) -> DataFrame:
    """The statistics of several loads as those of one: sums, bounds, and bitmaps by OR."""
    return parts.groupBy("load_date", "kind", "bucket").agg(
        F.when(F.col("kind") != "rows", F.bitmap_or_agg(F.coalesce("bits", F.lit(b"")))).alias("bits"), F.sum("records").alias("records"), F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"), F.min("first_load").alias("first_load"), F.max("last_load").alias("last_load"))


def load_stats(merged: DataFrame) -> DataFrame:
    """``marts.load_stats`` from merged bitmaps. For stores that only grow; an upsert that moves rows to a new load day needs that day and the old ones anew."""
    ones = F.bitmap_count("bits")

    def distinct(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, ones)), F.lit(0)).cast("long")

    return merged.groupBy("load_date").agg(
        F.sum("records").alias("records_loaded"), distinct("entities").alias("currencies_count"), distinct("dates").alias("dates_count"),
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.min("first_load").alias("first_load"), F.max("last_load").alias("last_load")) \
        .orderBy(F.col("load_date").desc())
