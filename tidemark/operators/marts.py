"""The seven marts: daily changes, weekly / monthly / quarterly statistics, top volatile
entities, correlation with an anchor series and load statistics.

All take the raw rates relation (``schema.RAW_COLUMNS``) and return a DataFrame; nothing
is collected. Parameters that the original hard-codes (anchor entity, window length,
list size, the rate type filter) are arguments.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import guarded_corr, mean, pct_change, pct_range
from tidemark.functions.series import with_previous, with_previous_in_ranges, with_previous_period
from tidemark.sources.tables import after

PERIOD_COLUMN = {"week": "week_start", "month": "month_start", "quarter": "quarter_start"}


def _typed(raw: DataFrame, rate_type: str | None) -> DataFrame:
    return raw if rate_type is None else raw.filter(F.col("rate_type") == F.lit(rate_type))


def _value(per_unit: bool):
    rate = F.col("exchange_rate")
    return (rate / F.col("nominal")).cast("decimal(12,6)") if per_unit else rate


def by_entity(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows dealt to ``tasks`` tasks by ranges of entities. What an entity has of one type is one row a day of the calendar, so however
    large the relation, an entity is small; all groups and windows by entity, and the layout of a mart's files, work where the rows lie."""
    return rows.repartitionByRange(tasks, "currency_code")


def daily_changes(raw: DataFrame, rate_type: str | None = "daily", per_unit: bool = False,
                  block: str = "year", tasks: int | None = None) -> DataFrame:
    """Per entity and date: rate, previous existing rate, absolute and percent change. With ``tasks`` the rows are shuffled once
    (:func:`by_entity`) instead of by ``block``, and the result lies by ranges of entities."""
    base = _typed(raw, rate_type).select(
        "currency_code", "rate_date", _value(per_unit).alias("exchange_rate"))
    if tasks:
        withprev = with_previous_in_ranges(by_entity(base, tasks), ["currency_code"], "rate_date", ["exchange_rate"])
    else:
        withprev = with_previous(base, ["currency_code"], "rate_date", ["exchange_rate"], block=block)
    return withprev.select(
        "currency_code", "rate_date", "exchange_rate",
        F.col("prev_exchange_rate").alias("prev_rate"),
        (F.col("exchange_rate") - F.col("prev_exchange_rate")).alias("abs_change"),
        pct_change(F.col("exchange_rate"), F.col("prev_exchange_rate")).alias("pct_change"),
    )


def period_aggregates(rate, volatility_digits: int | None = None) -> list:
    """The columns of a period's statistics."""
    vol = F.stddev_samp(rate.cast("double"))
    if volatility_digits is not None:
        vol = F.round(vol, volatility_digits)
    return [mean(rate).alias("avg_rate"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"),
            vol.alias("volatility"), F.count(F.lit(1)).alias("days_count")]


def with_change(rows: DataFrame, columns) -> DataFrame:
    """``columns`` and the change of ``avg_rate`` against ``prev_avg_rate``."""
    return rows.select(
        *columns,
        (F.col("avg_rate") - F.col("prev_avg_rate")).alias("abs_change"),
        pct_change(F.col("avg_rate"), F.col("prev_avg_rate")).alias("pct_change"),
    )


def period_stats(raw: DataFrame, unit: str, rate_type: str | None = "daily",
                 volatility_digits: int | None = None, per_unit: bool = False,
                 block: str | None = None, tasks: int | None = None) -> DataFrame:
    """Per entity and week / month / quarter: avg, min, max, sample stddev, count, and the
    change of the average against the previous existing period of the entity. With ``tasks`` the daily rows are shuffled once
    (:func:`by_entity`), and the result lies by ranges of entities: a row is a fifth as wide as the sums of a period, of which there are
    half as many for weeks, and the look at the period before needs no shuffle of its own."""
    if unit not in PERIOD_COLUMN:
        raise ValueError(f"unit must be one of {sorted(PERIOD_COLUMN)}")
    period = PERIOD_COLUMN[unit]
    rows = _typed(raw, rate_type).select("currency_code", "rate_date", _value(per_unit).alias("exchange_rate"))
    stats = ((by_entity(rows, tasks) if tasks else rows)
             .groupBy("currency_code", F.trunc("rate_date", unit).alias(period))
             .agg(*period_aggregates(F.col("exchange_rate"), volatility_digits)))
    return with_change(with_previous_period(stats, ["currency_code"], period, ["avg_rate"], block), stats.columns)


def _volatility_agg(rows: DataFrame, with_range: bool, with_name: bool, with_days: bool) -> DataFrame:
    rate = F.col("exchange_rate")
    aggs = []
    if with_name:
        aggs.append(F.max("currency_name").alias("currency_name"))
    aggs += [
        F.round(F.stddev_samp(rate.cast("double")), 4).alias("volatility"),
        F.round(mean(rate), 2).alias("avg_rate"),
        F.round(F.min(rate), 2).cast("double").alias("min_rate"),
        F.round(F.max(rate), 2).cast("double").alias("max_rate"),
    ]
    if with_range:
        aggs.append(F.round(F.max(rate) - F.min(rate), 2).cast("double").alias("range"))
    aggs.append(pct_range(F.max(rate), F.min(rate), mean(rate)).alias("pct_range"))
    if with_days:
        aggs.append(F.count(F.lit(1)).alias("days_count"))
    return rows.groupBy("currency_code").agg(*aggs)


def _ranked(df: DataFrame, n: int | None, nulls: str) -> DataFrame:
    key = F.col("volatility").desc_nulls_first() if nulls == "first" else F.col("volatility").desc_nulls_last()
    out = df.orderBy(key, F.col("currency_code"))
    return out.limit(n) if n is not None else out


def top_volatile(raw: DataFrame, as_of, days: int = 30, n: int | None = 10,
                 rate_type: str | None = "daily", nulls: str = "first") -> DataFrame:
    """Entities ranked by sample stddev over the trailing window. NULL stddev (one
    observation) sorts first, as PostgreSQL's DESC does; ties break by code."""
    rows = after(_typed(raw, rate_type), as_of, days)
    return _ranked(_volatility_agg(rows, with_range=True, with_name=False, with_days=False), n, nulls)


def volatility_panel(raw: DataFrame, as_of, days: int = 30, n: int | None = 10,
                     rate_type: str | None = None, nulls: str = "first") -> DataFrame:
    """Dashboard variant: all rate types, entity name and day count, no range column."""
    rows = after(_typed(raw, rate_type), as_of, days)
    return _ranked(_volatility_agg(rows, with_range=False, with_name=True, with_days=True), n, nulls)


def anchor_correlation(raw: DataFrame, anchor: str, min_days: int = 10,
                       rate_type: str | None = "daily", nulls: str = "first") -> DataFrame:
    """Pearson correlation of every other entity with the anchor on common dates.

    The anchor is made unique per date first (its largest rate, should all types be taken), so
    no day counts twice. It has one row a day of the calendar, so it is broadcast, and the others are not shuffled by date.
    """
    typed = _typed(raw, rate_type)
    anchor_rows = typed.filter(F.col("currency_code") == F.lit(anchor)).select(
        "rate_date", "exchange_rate").groupBy("rate_date").agg(F.max("exchange_rate").alias("anchor_rate"))
    others = typed.filter(F.col("currency_code") != F.lit(anchor)).select(
        "currency_code", "rate_date", "exchange_rate")
    joined = others.join(F.broadcast(anchor_rows), "rate_date")
    out = (joined.groupBy("currency_code")
           .agg(F.round(guarded_corr("exchange_rate", "anchor_rate"), 4).alias("correlation_with_anchor"),
                F.count(F.lit(1)).alias("days_count"))
           .filter(F.col("days_count") > F.lit(min_days)))
    key = F.col("correlation_with_anchor")
    return out.orderBy(key.desc_nulls_first() if nulls == "first" else key.desc_nulls_last(), "currency_code")


def load_stats(raw: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per load day: rows, distinct entities, distinct dates, date range, first / last load. With ``tasks``, for a keyed relation, the
    rows are shuffled once (:func:`by_entity`) and entities counted where they lie: hardly two rows share a load day and an entity, so
    combining them before a shuffle only takes memory, and more of it with larger files."""
    if tasks:
        rows = raw.select(F.to_date("load_timestamp").alias("load_date"), "currency_code", "rate_date", "load_timestamp")
        days = (by_entity(rows, tasks).groupBy("load_date", "currency_code")
                .agg(F.count(F.lit(1)).alias("n"), F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
                     F.min("load_timestamp").alias("first_load"), F.max("load_timestamp").alias("last_load"))
                .groupBy("load_date")
                .agg(F.sum("n").alias("records_loaded"), F.count("currency_code").alias("currencies_count"), F.min("min_date").alias("min_date"),
                     F.max("max_date").alias("max_date"), F.min("first_load").alias("first_load"), F.max("last_load").alias("last_load")))
        dates = rows.groupBy(F.col("load_date").alias("_day")).agg(F.countDistinct("rate_date").alias("dates_count"))
        return (days.join(dates, F.col("load_date").eqNullSafe(F.col("_day")))
                .select("load_date", "records_loaded", "currencies_count", "dates_count", "min_date", "max_date", "first_load", "last_load")
                .orderBy(F.col("load_date").desc()))
    return (raw.groupBy(F.to_date("load_timestamp").alias("load_date"))
            .agg(F.count(F.lit(1)).alias("records_loaded"),
                 F.countDistinct("currency_code").alias("currencies_count"),
                 F.countDistinct("rate_date").alias("dates_count"),
                 F.min("rate_date").alias("min_date"),
                 F.max("rate_date").alias("max_date"),
                 F.min("load_timestamp").alias("first_load"),
                 F.max("load_timestamp").alias("last_load"))
            .orderBy(F.col("load_date").desc()))


def refresh_period_stats(raw: DataFrame, mart: DataFrame, touched: DataFrame, unit: str,
                         rate_type: str | None = "daily", volatility_digits: int | None = None,
                         block: str | None = None) -> DataFrame:
    """Period statistics after a load, re-aggregating only the touched periods.

    ``touched`` holds (currency_code, rate_date) of the loaded rows. Their (entity, period)
    groups are re-aggregated from ``raw`` (a semi join on the group, so only those rows are
    read and shuffled); every other period keeps its row from ``mart``. The change columns
    are then recomputed over the mart-sized frame, which also fixes the period after each
    touched one. Equal to ``period_stats(raw, unit)`` when ``mart`` was built from the
    same raw before the load."""
    period = PERIOD_COLUMN[unit]
    keys = ["currency_code", period]
    groups = touched.select("currency_code", F.trunc("rate_date", unit).alias(period)).distinct()
    typed = _typed(raw, rate_type)
    if "rate_month" in raw.columns:  # only the months from the first to the last touched period are read
        span = groups.agg(F.min(period).alias("a"), F.max(F.add_months(F.col(period), 3)).alias("b")).first()
        if span["a"] is not None:
            typed = typed.filter(F.col("rate_month").between(f"{span['a']:%Y-%m}", f"{span['b']:%Y-%m}"))
    typed = typed.withColumn(period, F.trunc("rate_date", unit))
    rows = typed.join(groups, keys, "left_semi")
    rate = F.col("exchange_rate")
    vol = F.stddev_samp(rate.cast("double"))
    if volatility_digits is not None:
        vol = F.round(vol, volatility_digits)
    fresh = (rows.groupBy(*keys)
             .agg(mean(rate).alias("avg_rate"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"),
                  vol.alias("volatility"), F.count(F.lit(1)).alias("days_count")))
    stat_cols = keys + ["avg_rate", "min_rate", "max_rate", "volatility", "days_count"]
    kept = mart.select(*stat_cols).join(groups, keys, "left_anti")
    stats = kept.unionByName(fresh.select(*stat_cols))
    withprev = with_previous_period(stats, ["currency_code"], period, ["avg_rate"], block)
    return withprev.select(
        *stat_cols,
        (F.col("avg_rate") - F.col("prev_avg_rate")).alias("abs_change"),
        pct_change(F.col("avg_rate"), F.col("prev_avg_rate")).alias("pct_change"),
    )
