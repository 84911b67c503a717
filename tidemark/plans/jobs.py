"""Jobs composed of the operators: mart refresh with status report, the daily ETL run
and the period load. Scheduling and retries belong to the caller's scheduler."""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import marts, quality, store, validate
from tidemark.operators.tables import create_raw, ensure_database, fs_path, publish, upsert_into
from tidemark.schema import LOG_SCHEMA, RAW_SCHEMA
from tidemark.session import shuffles_released
from tidemark.sources import payloads
from tidemark.sources.tables import read_raw

MART_NAMES = ("daily_changes", "weekly_stats", "monthly_stats", "quarterly_stats",
              "top_volatile", "anchor_correlation", "load_stats")


def build_marts(raw: DataFrame, as_of, anchor: str, tasks: int | None = None) -> dict[str, DataFrame]:
    """The marts; with ``tasks`` those of ``SORT_OF`` lie by ranges of entities."""
    return {
        "daily_changes": marts.daily_changes(raw, tasks=tasks),
        "weekly_stats": marts.period_stats(raw, "week", tasks=tasks),
        "monthly_stats": marts.period_stats(raw, "month", tasks=tasks),
        "quarterly_stats": marts.period_stats(raw, "quarter", tasks=tasks),
        "top_volatile": marts.top_volatile(raw, as_of),
        "anchor_correlation": marts.anchor_correlation(raw, anchor),
        "load_stats": marts.load_stats(raw, tasks),
    }


def mart_status(spark: SparkSession, versions: dict[str, str]) -> DataFrame:
    """Rows per published mart (read back from its files) plus a total row."""
    parts = [spark.read.parquet(path).agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"))
             for name, path in versions.items()]
    counts = reduce(DataFrame.unionByName, parts)
    total = counts.agg(F.lit("total").alias("mart"), F.sum("rows").cast("long").alias("rows"))
    return counts.unionByName(total)


SORT_OF = {"daily_changes": ("currency_code", "rate_date"), "weekly_stats": ("currency_code", "week_start"),
           "monthly_stats": ("currency_code", "month_start"), "quarterly_stats": ("currency_code", "quarter_start")}


#: The marts that shuffle the whole relation, and the daily rows that one task of theirs takes.
WHOLE = (*SORT_OF, "load_stats")
MART_TASK_ROWS = 500_000


def refresh_marts(spark: SparkSession, raw: DataFrame, base: str, as_of, anchor: str,
                  names=MART_NAMES, log_path: str | None = None, database: str = "marts",
                  parallel: int = 4) -> DataFrame:
    """Recompute and publish the marts, return their status.

    Nothing is cached: each mart reads only its columns and, on a raw store, its month folders. The marts are
    independent jobs, submitted from ``parallel`` driver threads so their stages share the cluster. Those which shuffle the whole
    relation (once, by entity) go one at a time beside the others, and a mart's shuffle files go when it is written, so the disk holds one
    such shuffle besides the marts. On a raw store read with its months, the files' footers give the number of rows and so that of the tasks.
    Each mart is written, sorted by entity and period, to a new version folder and switched in the catalog; a failed
    mart raises after the others finish, and the old versions stay readable. With ``log_path`` the run is logged: one row a mart with
    the rows that its write counted (an observation of the same pass), the seconds and the time it was done; a failed one has no rows
    and its error as the message."""
    ensure_database(spark, database, base)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if "rate_month" in raw.columns:
        tasks = max(tasks, -(-raw.filter(F.col("rate_type") == "daily").count() // MART_TASK_ROWS))
    plans = build_marts(raw, as_of, anchor, tasks)
    run, one_whole = uuid.uuid4().hex, Lock()

    def one(name: str) -> tuple[str | None, tuple, Exception | None]:
        with one_whole if name in WHOLE else nullcontext():
            seen, began = Observation(f"{name}_{run}"), time.monotonic()
            try:
                version = publish(spark, plans[name], base, name, database, SORT_OF.get(name, ()), seen, dealt=True)
            except Exception as error:  # noqa: BLE001 - logged here, raised below
                return None, (f"{type(error).__name__}: {error}"[:1000], dt.datetime.now(), run, name, None, time.monotonic() - began), error
            return version, ("mart refreshed", dt.datetime.now(), run, name, seen.get["rows"], time.monotonic() - began), None

    order = sorted(names, key=lambda name: name in SORT_OF)
    with shuffles_released(spark), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = dict(zip(order, pool.map(one, order)))
    if log_path:
        spark.createDataFrame([row for _, row, _ in (done[n] for n in names)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    for _, _, error in done.values():
        if error is not None:
            raise error
    return mart_status(spark, {n: done[n][0] for n in names})


def refresh_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The rows of the refresh log, latest runs first."""
    return spark.read.schema(LOG_SCHEMA).parquet(log_path).orderBy(F.col("log_time").desc(), "mart")


BATCH = ["currency_code", "currency_name", "exchange_rate", "rate_date", "rate_type", "nominal"]
ARRIVAL = ["arrived", "file", "position"]


def run_daily(spark: SparkSession, daily_xml: str | None, monthly_json: str | None, raw: str,
              as_of: dt.datetime, majors=("USD", "EUR", "CNY"), upper: float = 1000.0,
              target_date: dt.date | None = None, rejects_path: str | None = None, max_code: int = validate.MAX_CODE,
              monthly_multiline: bool = True) -> dict:
    """Daily ETL: landed payloads -> validate -> upsert -> quality report and totals.

    ``raw`` is the raw table (``database.name``), created if absent. ``daily_xml`` is the landing root; only the folder of ``target_date`` (by default the run date's yesterday,
    which is also the check date) is read. Monthly payloads are kept for the previous and the current year of
    the run date; rows of other years are counted in ``outside_years``. Rejected rows, and broken documents, keep their original text
    and reason, are counted and, with ``rejects_path``, written (one folder a run, overwritten by a rerun):
    valid + rejected + outside_years = input. Later files win over earlier ones, and
    later rows of a file over earlier ones. Without payloads the run goes on with no rows."""
    check_date = as_of.date() - dt.timedelta(days=1)
    target = target_date or check_date
    good, bad, outside = [], [], 0
    if daily_xml:
        checked = payloads.daily_checked(payloads.read_daily_valutes(spark, daily_xml, target, target), max_code=max_code)
        good.append(validate.valid(checked))
        bad.append(validate.rejected(checked).select(F.lit("daily").alias("source"), "original", "reason"))
    if monthly_json:
        items = payloads.monthly_checked(payloads.read_monthly_json(spark, monthly_json, monthly_multiline)).withColumns(
            {"arrived": F.lit(None).cast("timestamp"), "file": F.lit(""), "position": F.monotonically_increasing_id()})
        in_years = F.year("rate_date").between(as_of.year - 1, as_of.year)
        ok = items.filter(F.col("reason").isNull() & in_years)
        outside = items.filter(F.col("reason").isNull() & ~in_years).count()
        checked = validate.parsed(ok.select(*BATCH, *ARRIVAL), max_code=max_code)
        good.append(validate.valid(checked))
        bad.append(items.filter(F.col("reason").isNotNull()).select(F.lit("monthly").alias("source"), "original", "reason"))
        bad.append(validate.rejected(checked).select(F.lit("monthly").alias("source"), "original", "reason"))
    totals, counts, reasons = {"daily": 0, "monthly": 0, "total": 0}, {"inserted": 0, "updated": 0}, {}
    if good:
        batch = reduce(DataFrame.unionByName, [g.select(*BATCH, *ARRIVAL) for g in good])
        rejects = reduce(DataFrame.unionByName, bad)
        if rejects_path:
            stored = f"{rejects_path}/run={as_of:%Y-%m-%dT%H%M%S}"
            rejects.write.mode("overwrite").parquet(stored)
            rejects = spark.read.schema(rejects.schema).parquet(stored)
        totals = quality.run_totals(batch).first().asDict()
        reasons = {r["reason"]: r["n"] for r in rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        counts = upsert_into(spark, raw, batch, as_of, seq=ARRIVAL)
    else:
        create_raw(spark, raw)
    report = quality.dq_report(read_raw(spark, raw), check_date, majors, upper)
    return {"totals": totals, **counts, "rejected": reasons, "outside_years": outside, "dq": report, "check_date": check_date}


def period_load(spark: SparkSession, daily: DataFrame, monthly: DataFrame | None, raw: str,
                start, end, as_of: dt.datetime, skip_weekends: bool = False,
                load_type: str = "both", today=None, seq=None) -> dict:
    """Period load: argument checks, day status over the calendar and its summary, validation, rows of the closed
    range start..end by their parsed date (daily and / or monthly), upsert, load report. ``rejected`` holds the
    rows left out with reason and original text, also those whose date cannot be read. ``daily`` may come from
    :func:`landed_period`, which reads only the folders of the period."""
    info = cal.check_period(start, end, today=today)
    s, e = dt.date.fromisoformat(info["start_date"]), dt.date.fromisoformat(info["end_date"])
    d = daily.withColumn("__daily", F.lit(True))
    m = monthly.withColumn("__daily", F.lit(False)) if monthly is not None else None
    status = cal.day_status(spark, daily.select(validate.day_of(daily).alias("rate_date")), s, e, skip_weekends)
    day = F.col("rate_date")
    wanted = day.between(F.lit(s), F.lit(e))
    if skip_weekends:
        wanted = wanted & ~(F.col("__daily") & F.dayofweek(day).isin(1, 7))
    checked = validate.parsed(store.union_sources(d, m, load_type)).filter(day.isNull() | wanted).drop("__daily")
    counts = upsert_into(spark, raw, validate.valid(checked), as_of, seq=seq)
    report = quality.load_report(read_raw(spark, raw), s, e)
    return {"check": info, "day_status": status, "summary": cal.day_status_summary(status), **counts,
            "rejected": validate.rejected(checked), "report": report}


def landed_period(spark: SparkSession, daily_xml: str, start, end, skip_weekends: bool = False) -> DataFrame:
    """Text records of the landed daily files from ``start`` to ``end``; other date folders are not read. Broken files are
    left out here; :func:`load_landed_period` rejects them."""
    rows = payloads.daily_records(payloads.whole(payloads.read_daily_valutes(spark, daily_xml, start, end))).drop("document")
    weekend = F.coalesce(F.dayofweek(validate.day_of(rows)).isin(1, 7), F.lit(False))
    return rows.filter(~weekend) if skip_weekends else rows


MANIFEST = "run string, rate_date date, status string, rows bigint, rejected bigint, loaded_at timestamp_ntz"


def manifest_days(spark: SparkSession, manifest: str) -> DataFrame:
    """The last state of each day in a manifest: (rate_date, status, rows, rejected); no rows if there is none yet."""
    fs, path = fs_path(spark, manifest)
    runs = spark.read.schema(MANIFEST).parquet(manifest) if fs.exists(path) else spark.createDataFrame([], MANIFEST)
    last = runs.groupBy("rate_date").agg(*[F.max_by(c, F.struct("loaded_at", "run")).alias(c) for c in ("status", "rows", "rejected")])
    return last.select("rate_date", "status", "rows", "rejected")


def load_landed_period(spark: SparkSession, daily_xml: str, raw: str, manifest: str, start, end, as_of: dt.datetime,
                       skip_weekends: bool = False, monthly_json: str | None = None, monthly_multiline: bool = True,
                       load_type: str = "both", today=None, max_code: int = validate.MAX_CODE) -> dict:
    """Resumable period load of landed files: reads only the days that ``manifest`` does not have as done.

    1. Arguments are checked and the days of the period that are still to do are listed (a few thousand at most): not done before, and
       no weekends with ``skip_weekends``.
    2. Their folders are read and validated, with broken documents as rejects, and staged as one table beside the manifest.
    3. The valid rows are upserted.
    4. The manifest gets a row for each day: ``done``; ``failed``, if it had no rows or a broken document; ``skipped``.

    A run that is cut off before step 4 leaves the manifest as it was, and the next one does its days again; the upsert makes that
    harmless. Monthly rows of the period, if ``load_type`` and ``monthly_json`` ask for them, come with the first run of a period only
    (when any of its days is still to do). Returns the check, ``read_days``, the inserted and updated keys, the rejects, the state of every day of
    the period with its summary, and the load report."""
    if load_type not in ("daily_only", "monthly_only", "both"):
        raise ValueError("load_type must be daily_only, monthly_only or both")
    info = cal.check_period(start, end, today=today)
    s, e = dt.date.fromisoformat(info["start_date"]), dt.date.fromisoformat(info["end_date"])
    days = cal.calendar(spark, s, e, skip_weekends, keep_skipped=True)
    known = manifest_days(spark, manifest)
    left = F.col("status").isNull() | (F.col("status") == "failed") | (~F.col("skipped") & (F.col("status") == "skipped"))
    open_days = days.join(known, "rate_date", "left").filter(left)
    todo = sorted(r["rate_date"] for r in open_days.filter(~F.col("skipped")).collect())
    run = uuid.uuid4().hex
    stage = f"{manifest.rstrip('/')}_staged/{run}"
    good = [*BATCH, *ARRIVAL]
    parts = []
    if load_type != "monthly_only":
        valutes = payloads.read_daily_valutes(spark, daily_xml, days=todo)
        parts.append(payloads.daily_checked(valutes, max_code=max_code).select(*good, "reason", "original").withColumn("day", F.col("rate_date")))
    if load_type != "daily_only" and monthly_json and todo:
        items = payloads.monthly_checked(payloads.read_monthly_json(spark, monthly_json, monthly_multiline)).withColumns(
            {"arrived": F.lit(None).cast("timestamp"), "file": F.lit(""), "position": F.monotonically_increasing_id()})
        wanted = items.filter(F.col("reason").isNotNull() | F.col("rate_date").between(F.lit(s), F.lit(e)))
        bad = wanted.filter(F.col("reason").isNotNull())
        checked = validate.parsed(wanted.filter(F.col("reason").isNull()).select(*good), max_code=max_code)
        parts += [df.select(*good, "reason", "original").withColumn("day", F.lit(None).cast("date")) for df in (checked, bad)]
    counts = {"inserted": 0, "updated": 0}
    schema = parts[0].schema if parts else spark.createDataFrame([], RAW_SCHEMA).select(*BATCH).schema
    if todo and parts:
        reduce(DataFrame.unionByName, parts).write.parquet(stage)
        staged = spark.read.schema(schema).parquet(stage)
        counts = upsert_into(spark, raw, validate.valid(staged).drop("day"), as_of, seq=ARRIVAL)
        rejected = validate.rejected(staged).drop("day")
        per_day = staged.filter(F.col("day").isNotNull()).groupBy(F.col("day").alias("rate_date")).agg(
            F.count_if(F.col("reason").isNull()).alias("rows"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
            F.count_if(F.col("reason") == payloads.BAD_DOCUMENT).alias("broken"))
    else:
        create_raw(spark, raw)
        rejected = spark.createDataFrame([], schema).drop("day")
        per_day = spark.createDataFrame([], "rate_date date, rows bigint, rejected bigint, broken bigint")
    if load_type != "monthly_only":
        status = F.when(F.col("skipped"), "skipped").when(F.coalesce("rows", F.lit(0)) + F.coalesce("broken", F.lit(0)) == 0, "failed") \
            .when(F.col("broken") > 0, "failed").otherwise("done")
        state = open_days.select("rate_date", "skipped").join(per_day, "rate_date", "left").select(
            F.lit(run).alias("run"), "rate_date", status.alias("status"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
            F.coalesce("rejected", F.lit(0).cast("long")).alias("rejected"), F.lit(as_of).cast("timestamp_ntz").alias("loaded_at"))
        state.coalesce(1).write.mode("append").parquet(manifest)
    now = days.select("rate_date").join(manifest_days(spark, manifest), "rate_date", "left")
    summary = now.agg(F.count_if(F.col("status") == "done").alias("successful_days"), F.count_if(F.col("status") == "failed").alias("failed_days"),
                      F.count_if(F.col("status") == "skipped").alias("skipped_days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))
    return {"check": info, "read_days": len(todo), **counts, "rejected": rejected, "day_status": now, "summary": summary,
            "report": quality.load_report(read_raw(spark, raw), s, e)}


def catalog_status(spark: SparkSession, database: str = "marts", names=MART_NAMES,
                   pattern: str | None = None) -> DataFrame:
    """Per expected mart: whether the catalog has it and its row count (NULL if absent).
    ``pattern`` (a LIKE pattern such as 'daily%') narrows the expected names."""
    if pattern:
        like = re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), re.S)
        names = [n for n in names if like.fullmatch(n)]
    present = {t.name for t in spark.catalog.listTables(database)} if spark.catalog.databaseExists(database) else set()
    parts = [spark.table(f"{database}.{n}").agg(F.lit(n).alias("mart"), F.lit(True).alias("exists"),
                                                 F.count(F.lit(1)).alias("rows"))
             for n in names if n in present]
    missing = [n for n in names if n not in present]
    if missing:
        parts.append(spark.createDataFrame([(n, False, None) for n in missing], "mart string, exists boolean, rows long"))
    return reduce(DataFrame.unionByName, parts)


PERIOD_MARTS = {"week": "weekly_stats", "month": "monthly_stats", "quarter": "quarterly_stats"}


def refresh_period_marts_after_load(spark: SparkSession, raw: DataFrame, touched: DataFrame, base: str,
                                    database: str = "marts", units=("week", "month", "quarter"),
                                    current: dict[str, str] | None = None) -> DataFrame:
    """After a load, refresh the published period marts from the touched rows only.

    ``touched`` = (currency_code, rate_date) of the loaded rows. Each mart re-aggregates
    just the touched (entity, period) groups of ``raw`` and recomputes the change columns
    over the mart itself; the result goes to a new version and the catalog is switched. The current version is the
    catalog's; a session whose catalog does not outlive it passes the folders in ``current`` (mart -> path)."""
    touched = touched.select("currency_code", "rate_date").distinct()
    versions = {}
    for unit in units:
        name = PERIOD_MARTS[unit]
        if current and name in current:
            before = spark.read.parquet(current[name])
        elif spark.catalog.tableExists(f"{database}.{name}"):
            before = spark.table(f"{database}.{name}")
        else:
            raise RuntimeError(f"{database}.{name} is not in this session's catalog: use a persistent catalog, or pass its folder in current")
        versions[name] = publish(spark, marts.refresh_period_stats(raw, before, touched, unit),
                                 base, name, database, SORT_OF[name])
    return mart_status(spark, versions)
