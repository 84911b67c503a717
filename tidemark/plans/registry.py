"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query derives its input from the given tables (``rates_from_lines`` or
``rates_from_events``), so its work grows with them. Decimal outputs are cast to double
so the numbers compare across engines; the marts themselves keep decimals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.numeric import decimals_to_double
from tidemark.operators import marts, panels
from tidemark.plans import params as P
from tidemark.sources.tables import rates_from_events, rates_from_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@register("daily_changes")
def _daily_changes(spark, sf):
    return marts.daily_changes(rates_from_lines(spark, sf))


@register("weekly_stats")
def _weekly(spark, sf):
    return marts.period_stats(rates_from_lines(spark, sf), "week", volatility_digits=4)


@register("monthly_stats")
def _monthly(spark, sf):
    return marts.period_stats(rates_from_lines(spark, sf), "month", volatility_digits=4)


@register("quarterly_stats")
def _quarterly(spark, sf):
    return marts.period_stats(rates_from_lines(spark, sf), "quarter", volatility_digits=4)


@register("top_volatile")
def _top_volatile(spark, sf):
    return marts.top_volatile(rates_from_lines(spark, sf), P.AS_OF, days=30, n=10)


@register("top5_volatile")
def _top5(spark, sf):
    return marts.top_volatile(rates_from_lines(spark, sf), P.AS_OF, days=30, n=5)


@register("volatility_panel")
def _vol_panel(spark, sf):
    return marts.volatility_panel(rates_from_lines(spark, sf), P.AS_OF, days=30, n=10)


@register("anchor_correlation")
def _anchor(spark, sf):
    return marts.anchor_correlation(rates_from_lines(spark, sf), P.ANCHOR, min_days=10)


@register("load_stats")
def _load_stats(spark, sf):
    return marts.load_stats(rates_from_events(spark, sf))


@register("loads_last_7d")
def _loads_7d(spark, sf):
    return panels.loads_last_days(rates_from_events(spark, sf), P.EVENTS_AS_OF, days=7)


@register("total_records")
def _total(spark, sf):
    return panels.total_records(rates_from_lines(spark, sf))


@register("distinct_entities")
def _distinct(spark, sf):
    return panels.distinct_entities(rates_from_lines(spark, sf))


@register("entity_trailing")
def _entity_trailing(spark, sf):
    return panels.entity_trailing(rates_from_lines(spark, sf), P.ANCHOR, P.AS_OF, days=30)


@register("entity_last_week_changes")
def _entity_week(spark, sf):
    return panels.entity_last_week_changes(rates_from_lines(spark, sf), P.ANCHOR, P.WEEK_AS_OF, days=7)


@register("majors_labelled")
def _majors(spark, sf):
    return panels.majors_labelled(rates_from_lines(spark, sf), P.MAJOR_LABELS, P.AS_OF, days=30)


@register("majors_wide")
def _majors_wide(spark, sf):
    return panels.majors_wide(rates_from_lines(spark, sf), P.MAJOR_LABELS, P.AS_OF, days=30)


# ---- validation, store, reports -------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions import calendar as cal  # noqa: E402
from tidemark.operators import quality, store, validate  # noqa: E402
from tidemark.sources.records import dirty_records  # noqa: E402
from tidemark.operators.tables import load_raw, upsert_into  # noqa: E402
from tidemark.session import shared_dir, shuffles_released  # noqa: E402
from tidemark.sources.tables import MAX_CODE, daily_from_lines, read_raw  # noqa: E402


def _checked(spark, sf, since=None):
    """The parsed records (of the days from ``since``; a record has its rate's date or one that cannot be read)."""
    daily = daily_from_lines(spark, sf).drop("k")
    return validate.parsed(dirty_records(daily if since is None else daily.filter(F.col("rate_date") >= F.lit(since))), max_code=MAX_CODE)


def _staged(df, name):
    """``df`` written once and read back, as the jobs stage a load that several steps read."""
    path = shared_dir(df.sparkSession, "staged", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batch(spark, sf, since=None):
    """Valid records (from the day ``since``) twice: the second copy (rate + 1, seq 2) must win every key."""
    ok = validate.valid(_checked(spark, sf, since))
    ok = _staged(ok if since is None else ok.filter(F.col("rate_date") >= F.lit(since)), "batch")
    first = ok.withColumn("seq", F.lit(1))
    second = ok.withColumn("exchange_rate", (F.col("exchange_rate") + F.lit(1)).cast("decimal(12,6)")) \
        .withColumn("seq", F.lit(2))
    return first.unionByName(second)


def _raw_table(spark, sf, kept=None):
    """A raw table of its own in the catalogue, filled with the rates (with those that are ``kept``), which lie by month."""
    name = f"tidemark_raw.rates_{uuid.uuid4().hex}"
    rates = rates_from_lines(spark, sf, by_month=True)
    load_raw(spark, name, rates if kept is None else rates.filter(kept), shared_dir(spark, "raw"), dealt=True)
    return name


@register("upsert_raw_table")
def _upsert_raw_table(spark, sf):
    """The raw table of the catalogue after an upsert that switches the touched months."""
    name = _raw_table(spark, sf)
    upsert_into(spark, name, _batch(spark, sf), P.UPSERT_AS_OF, seq="seq")
    return read_raw(spark, name)


@register("validate_records")
def _validate(spark, sf):
    return _checked(spark, sf)


@register("reject_reasons")
def _reasons(spark, sf):
    return validate.reason_counts(_checked(spark, sf))


@register("constraint_violations")
def _constraints(spark, sf):
    return validate.constraint_violations(rates_from_lines(spark, sf))


@register("upsert_rates")
def _upsert(spark, sf):
    return store.upsert(rates_from_lines(spark, sf), _batch(spark, sf), P.UPSERT_AS_OF, seq="seq")


@register("upsert_counts")
def _upsert_counts(spark, sf):
    return store.upsert_counts(rates_from_lines(spark, sf), _batch(spark, sf))


@register("insert_ignore_facts")
def _insert_ignore(spark, sf):
    rates = rates_from_lines(spark, sf)
    return store.insert_ignore_table(rates, _batch(spark, sf), seq="seq")


@register("sync_dimension")
def _sync_dim(spark, sf):
    rates = rates_from_lines(spark, sf)
    dim = store.init_dimension(rates.filter(F.col("rate_type") == "monthly"), P.DIM_INIT_DATE)
    return store.sync_dimension(dim, rates, P.AS_OF)


@register("union_sources")
def _union(spark, sf):
    rates = rates_from_lines(spark, sf)
    return store.union_sources(rates.filter(F.col("rate_type") == "daily"),
                               rates.filter(F.col("rate_type") == "monthly"), "both")


@register("dq_report")
def _dq(spark, sf):
    return quality.dq_report(rates_from_lines(spark, sf), P.CHECK_DATE, P.MAJORS, upper=P.ANOMALY_UPPER)


@register("dq_major_values")
def _dq_major(spark, sf):
    return quality.dq_major_values(rates_from_lines(spark, sf), P.CHECK_DATE, P.MAJORS)


@register("record_stats")
def _record_stats(spark, sf):
    return quality.record_stats(rates_from_lines(spark, sf))


@register("batch_stats")
def _batch_stats(spark, sf):
    return quality.batch_stats(validate.valid(_checked(spark, sf)))


@register("run_totals")
def _run_totals(spark, sf):
    return quality.run_totals(validate.valid(_checked(spark, sf)))


@register("load_report")
def _load_report(spark, sf):
    return quality.load_report(rates_from_lines(spark, sf), P.PERIOD_START, P.PERIOD_END)


@register("rows_per_date")
def _rows_per_date(spark, sf):
    return quality.rows_per_date(rates_from_lines(spark, sf).filter(F.col("rate_type") == "daily"))


@register("period_analysis")
def _period_analysis(spark, sf):
    return quality.period_analysis(rates_from_lines(spark, sf).filter(F.col("rate_type") == "daily"))


@register("existing_dates")
def _existing_dates(spark, sf):
    return quality.existing_dates(rates_from_lines(spark, sf), "daily")


@register("calendar_days")
def _calendar(spark, sf):
    return cal.calendar_of(rates_from_lines(spark, sf).filter(F.col("rate_type") == "daily"), skip_weekends=True)


@register("day_status")
def _day_status(spark, sf):
    daily = rates_from_lines(spark, sf).filter(F.col("rate_type") == "daily")
    return cal.day_status(spark, daily, skip_weekends=True)


@register("period_day_summary")
def _day_summary(spark, sf):
    daily = rates_from_lines(spark, sf).filter(F.col("rate_type") == "daily")
    return cal.day_status_summary(cal.day_status(spark, daily, skip_weekends=True))


@register("sample_rows")
def _sample(spark, sf):
    return rates_from_lines(spark, sf).orderBy("currency_code", "rate_date", "rate_type").limit(P.SAMPLE_ROWS)


# ---- payloads, code extraction, streaming ingest, mart refresh ------------------

from tidemark.functions.codes import code_from_name  # noqa: E402
from tidemark.plans import jobs  # noqa: E402
from tidemark.sources import payloads  # noqa: E402
from tidemark.streaming.ingest import incremental_ingest  # noqa: E402


@register("entity_code_from_name")
def _codes(spark, sf):
    names = rates_from_lines(spark, sf).select("currency_name").distinct()
    return names.select("currency_name", code_from_name("currency_name").alias("code"))


@register("daily_xml_normalise")
def _daily_xml(spark, sf):
    docs = payloads.daily_documents(daily_from_lines(spark, sf).drop("k"))
    return payloads.parse_daily_xml(docs)


@register("catalogue_normalise")
def _catalogue(spark, sf):
    return payloads.parse_catalogue_xml(payloads.catalogue_elements(rates_from_lines(spark, sf)))


def _monthly_docs(spark, sf, broken=False):
    monthly = rates_from_lines(spark, sf).filter(F.col("rate_type") == "monthly")
    docs = payloads.monthly_documents(monthly)
    if broken:  # of every fifth year's documents a cut-off copy, a null one and one without its array come too
        copies = F.array(F.substring("doc", 1, 40), F.lit(None).cast("string"), F.lit('{"RawData":null,"headerData":[]}'))
        docs = docs.unionByName(docs.filter("y % 5 = 0").withColumn("doc", F.explode(copies)))
    return payloads.parse_monthly_json(docs)


@register("monthly_json_normalise")
def _monthly_json(spark, sf):
    return payloads.normalise_monthly(_monthly_docs(spark, sf))


@register("monthly_json_rejects")
def _monthly_rejects(spark, sf):
    checked = payloads.monthly_checked(_monthly_docs(spark, sf, broken=True))
    return checked.filter(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register("incremental_ingest")
def _ingest(spark, sf):
    """Raw store from the derived rates, two landed record files (the valid records and
    their corrections), one availableNow stream run; returns the raw store."""
    root = shared_dir(spark, "ingest")
    raw, landing = _raw_table(spark, sf), f"{root}/landing"
    recs = dirty_records(daily_from_lines(spark, sf).drop("k"))
    recs.withColumn("seq", F.lit(1).cast("long")).write.json(f"{landing}/part=1")
    fixed = validate.valid(validate.parsed(recs, max_code=MAX_CODE))
    second = fixed.select(
        "currency_code", "currency_name",
        (F.col("exchange_rate") + F.lit(1)).cast("decimal(12,6)").cast("string").alias("exchange_rate"),
        F.col("rate_date").cast("string").alias("rate_date"), "rate_type",
        F.col("nominal").cast("string").alias("nominal"), F.lit(2).cast("long").alias("seq"))
    second.write.json(f"{landing}/part=2")
    incremental_ingest(spark, f"{landing}/*", raw, f"{root}/_checkpoint", P.UPSERT_AS_OF,
                       rejects_path=f"{root}/rejects", max_code=MAX_CODE)
    return read_raw(spark, raw)


@register("refresh_marts")
def _refresh(spark, sf):
    base = shared_dir(spark, "marts")
    return jobs.refresh_marts(spark, rates_from_lines(spark, sf), base, P.AS_OF, P.ANCHOR,
                              database="tidemark_marts")


@register("weekly_stats_incremental")
def _weekly_incremental(spark, sf):
    """Weekly mart built before the load, refreshed for the loaded rows only; equals the
    weekly mart of the upserted table."""
    rates = rates_from_lines(spark, sf)
    batch = _batch(spark, sf)
    before = marts.period_stats(rates, "week", volatility_digits=4)
    after_raw = store.upsert(rates, batch, P.UPSERT_AS_OF, seq="seq")
    return marts.refresh_period_stats(after_raw, before, batch.select("currency_code", "rate_date"),
                                      "week", volatility_digits=4)


# ---- the rest of the relation, landed files, period reads and jobs ------------------

import datetime as dt  # noqa: E402

from tidemark.sources.tables import superseded_lines  # noqa: E402


@register("superseded_lines")
def _superseded(spark, sf):
    return superseded_lines(spark, sf)


@register("per_unit_changes")
def _per_unit(spark, sf):
    return marts.daily_changes(rates_from_lines(spark, sf), per_unit=True)


@register("daily_xml_files")
def _xml_files(spark, sf):
    """All daily payloads landed as files, and a period read back from its date folders; an earlier read must not matter."""
    root = shared_dir(spark, "daily_xml")
    payloads.write_daily_xml(daily_from_lines(spark, sf).drop("k"), root)
    payloads.read_daily_xml(spark, root)
    return payloads.read_daily_xml(spark, root, P.PERIOD_START, P.PERIOD_END)


@register("daily_xml_rejects")
def _xml_rejects(spark, sf):
    """Daily documents as text, some of them cut off or null: rows by reason, nothing lost."""
    docs = payloads.daily_documents(daily_from_lines(spark, sf).drop("k"))
    day = F.dayofmonth("rate_date")
    broken = docs.withColumn("doc", F.when(day == 3, F.substring("doc", 1, 30)).when(day == 17, F.lit(None)).otherwise(F.col("doc")))
    return validate.reason_counts(payloads.daily_checked(payloads.parse_daily_valutes(broken), max_code=MAX_CODE))


@register("period_load")
def _period_load(spark, sf):
    """The resumable period load over all landed days, one of which has a broken file besides its own, and a second run, which reads
    the unfinished days only: counts of both, rejects by reason, and the report."""
    root = shared_dir(spark, "period_load")
    rates = rates_from_lines(spark, sf)
    wanted = (F.col("rate_type") == "daily") & F.col("rate_date").between(F.lit(P.PERIOD_START), F.lit(P.PERIOD_END))
    raw = _raw_table(spark, sf, ~(wanted & (F.col("nominal") == 1)))
    payloads.write_daily_xml(rates.filter(F.col("rate_type") == "daily"), f"{root}/landing")
    spark.createDataFrame([("<ValuteData><ValuteCursOnDate><Vname>cut", P.BROKEN_DAY)], "doc string, rate_date date") \
        .write.mode("append").partitionBy("rate_date").text(f"{root}/landing")

    def load(day):
        return jobs.load_landed_period(spark, f"{root}/landing", raw, f"{root}/manifest", P.PERIOD_START, P.PERIOD_END,
                                       dt.datetime.combine(P.AS_OF + dt.timedelta(days=day), dt.time(18)), skip_weekends=True, load_type="daily_only", max_code=MAX_CODE)

    first, second = load(1), load(2)
    one = {f"{k}_{n}": v[k] for n, v in ((1, first), (2, second)) for k in ("read_days", "inserted", "updated")}
    counted = spark.createDataFrame(sorted(one.items()), "name string, value bigint")
    reasons = first["rejected"].groupBy(F.concat(F.lit("rejected_"), "reason").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    long = [df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.col(c).cast("long") for c in names]))).alias("name", "value"))
            for df, names in ((second["summary"], ["successful_days", "failed_days", "skipped_days", "total_rows"]),
                              (second["report"], ["days", "records_loaded", "total_records", "currencies"]))]
    return counted.unionByName(reasons).unionByName(long[0]).unionByName(long[1])


@register("period_rows")
def _period_rows(spark, sf):
    """A closed period without weekends, read from the month folders of a raw store that it touches."""
    rows = read_raw(spark, _raw_table(spark, sf), P.PERIOD_START, P.PERIOD_END)
    return rows.filter((F.col("rate_type") == "daily") & ~F.dayofweek("rate_date").isin(1, 7))


@register("run_daily")
def _run_daily(spark, sf):
    """The daily job on a landed day and the landed monthly documents of all years, over a raw store that lacks a part of that day's rates."""
    root = shared_dir(spark, "run_daily")
    rates = rates_from_lines(spark, sf)
    today = (F.col("rate_type") == "daily") & (F.col("rate_date") == F.lit(P.CHECK_DATE))
    raw = _raw_table(spark, sf, ~(today & (F.col("nominal") == 1)))
    payloads.write_daily_xml(rates.filter(today), f"{root}/landing")
    as_of = dt.datetime.combine(P.CHECK_DATE + dt.timedelta(days=1), dt.time(18))
    payloads.write_monthly_json(rates.filter(F.col("rate_type") == "monthly"), f"{root}/monthly")
    out = jobs.run_daily(spark, f"{root}/landing", f"{root}/monthly", raw, as_of, P.MAJORS, P.ANOMALY_UPPER, rejects_path=f"{root}/rejects", max_code=MAX_CODE,
                         monthly_multiline=False)
    one = {"daily": out["totals"]["daily"], "monthly": out["totals"]["monthly"], "outside_years": out["outside_years"], "total": out["totals"]["total"], "inserted": out["inserted"], "updated": out["updated"],
           "rejected": sum(out["rejected"].values())}
    counted = spark.createDataFrame(sorted(one.items()), "name string, value bigint")
    report = out["dq"].filter(F.col("check") == "total_records").select(F.col("check").alias("name"), "value")
    return counted.unionByName(report)


@register("mart_status")
def _mart_status(spark, sf):
    """The marts as the catalog has them after a refresh."""
    base = shared_dir(spark, "status")
    jobs.refresh_marts(spark, rates_from_lines(spark, sf), base, P.AS_OF, P.ANCHOR, database="tidemark_status")
    return jobs.catalog_status(spark, "tidemark_status")


@register("upsert_facts")
def _upsert_facts(spark, sf):
    return store.load_facts(rates_from_lines(spark, sf), _batch(spark, sf), mode="upsert", seq="seq")


@register("published_weekly_stats")
def _published(spark, sf):
    """The contents of a published mart, read through the catalog."""
    base = shared_dir(spark, "published")
    jobs.refresh_marts(spark, rates_from_lines(spark, sf), base, P.AS_OF, P.ANCHOR, names=("weekly_stats",), database="tidemark_published")
    return spark.table("tidemark_published.weekly_stats").withColumn("volatility", F.round("volatility", 4))


# ---- marts kept up to date from stored summaries ------------------------------------

from tidemark.operators import incremental  # noqa: E402


def _after_load(spark, sf):
    """A raw table and its moments, built before a load of the last months and brought up to date after it: the raw
    table's name, the moments, and the loaded rows with the table and folder of the daily changes built before."""
    root, tag = shared_dir(spark, "incremental"), uuid.uuid4().hex
    raw, moments, changes = _raw_table(spark, sf), f"tidemark_inc.moments_{tag}", f"tidemark_inc.changes_{tag}"
    before = read_raw(spark, raw, with_month=True)
    incremental.refresh_moments(spark, before, None, moments, root, P.ANCHOR)
    load = _batch(spark, sf, since=P.LOAD_START)

    def finish(with_changes=False):
        if with_changes:
            incremental.refresh_daily_changes(spark, before, spark.table(moments), None, changes, root)
        upsert_into(spark, raw, load, P.UPSERT_AS_OF, seq="seq")
        after = read_raw(spark, raw, with_month=True)
        incremental.refresh_moments(spark, after, load, moments, root, P.ANCHOR)
        pieces = spark.table(moments)
        if with_changes:
            incremental.refresh_daily_changes(spark, after, pieces, load, changes, root)
        return after, pieces, changes
    return finish


@register("moments_weekly_stats")
def _moments_weekly(spark, sf):
    """The weekly mart after a load, merged from moments of which only the loaded months were made anew."""
    return incremental.period_stats(_after_load(spark, sf)()[1], "week", volatility_digits=4)


@register("moments_correlation")
def _moments_correlation(spark, sf):
    return incremental.anchor_correlation(_after_load(spark, sf)()[1], P.ANCHOR)


@register("moments_top_volatile")
def _moments_top(spark, sf):
    after, pieces, _ = _after_load(spark, sf)()
    return incremental.top_volatile(pieces, after, P.AS_OF, P.ANCHOR)


@register("daily_changes_incremental")
def _changes_incremental(spark, sf):
    """The daily changes table after a load that redid the touched months and the months that follow them."""
    return spark.table(_after_load(spark, sf)(with_changes=True)[2]).drop("rate_month")


@register("load_stats_bitmaps")
def _load_stats_bitmaps(spark, sf):
    """Load statistics of two loads (the morning's and the afternoon's), each summarised alone and merged by OR."""
    raw = rates_from_events(spark, sf)
    ids = _staged(raw.select("currency_code").distinct().withColumn("id", F.monotonically_increasing_id()), "entity_ids")
    morning = F.hour("load_timestamp") < 12
    parts = [_staged(incremental.load_bitmaps(raw.filter(half), ids), "load_bitmaps") for half in (morning, ~morning)]
    return incremental.load_stats(incremental.merge_bitmaps(parts[0].unionByName(parts[1])))


@register("refresh_log")
def _refresh_log(spark, sf):
    """What the log of a refresh says of it."""
    base = shared_dir(spark, "marts_log")
    with shuffles_released(spark):
        raw = read_raw(spark, _raw_table(spark, sf), with_month=True)
    jobs.refresh_marts(spark, raw, base, P.AS_OF, P.ANCHOR, database="tidemark_logged", log_path=f"{base}/log")
    return jobs.refresh_log(spark, f"{base}/log").select("log_message", "mart", "rows")


# ---- the bucketed layout ------------------------------------------------------------

from tidemark.operators import bucketed  # noqa: E402


def _bucketed_after_load(spark, sf):
    """A bucketed table of all rates, upserted with the last months' load."""
    name = f"tidemark_bucketed.rates_{uuid.uuid4().hex}"
    bucketed.load(spark, name, rates_from_lines(spark, sf), shared_dir(spark, "bucketed"))
    bucketed.upsert(spark, name, _batch(spark, sf, since=P.LOAD_START), P.UPSERT_AS_OF, seq="seq")
    return name


@register("bucketed_daily_changes")
def _bucketed_changes(spark, sf):
    return bucketed.daily_changes(spark, _bucketed_after_load(spark, sf))


@register("bucketed_monthly_stats")
def _bucketed_monthly(spark, sf):
    return bucketed.period_stats(spark, _bucketed_after_load(spark, sf), "month", volatility_digits=4)


@register("bucketed_entity")
def _bucketed_entity(spark, sf):
    """All rows of one entity, by the files' bloom filters."""
    return bucketed.entity(spark, _bucketed_after_load(spark, sf), P.ANCHOR)


# ---- payloads whose fields drift ----------------------------------------------------

from tidemark.sources import drifting  # noqa: E402


def _drifting_docs(spark, sf):
    """The monthly documents: by year with ids as texts, values as numbers, a new field, or values as objects."""
    docs = payloads.monthly_documents(rates_from_lines(spark, sf).filter(F.col("rate_type") == "monthly"))
    doc, way = F.col("doc"), F.col("y") % 4
    return docs.select(F.when(way == 0, F.regexp_replace(doc, r'"element_id":(-?[0-9]+)', r'"element_id":"$1"'))
                       .when(way == 1, F.regexp_replace(doc, r'"obs_val":"([0-9.]+)"', r'"obs_val":$1'))
                       .when(way == 2, F.replace(doc, F.lit('"date":'), F.lit('"unit":"RUB","date":')))
                       .otherwise(F.regexp_replace(doc, r'"obs_val":("[^"]*")', r'"obs_val":{"v":$1}')).alias("doc"))


@register("monthly_json_drift")
def _monthly_drift(spark, sf):
    checked = drifting.drifting_checked(_drifting_docs(spark, sf))
    return checked.filter(F.col("reason").isNull()).drop("reason", "original")


@register("monthly_json_drift_rejects")
def _monthly_drift_rejects(spark, sf):
    checked = drifting.drifting_checked(_drifting_docs(spark, sf)).filter(F.col("reason").isNotNull())
    return checked.groupBy("reason", "extra").agg(F.count(F.lit(1)).alias("rows"))


@register("monthly_json_fields")
def _monthly_fields(spark, sf):
    return drifting.drift_report(_drifting_docs(spark, sf))
