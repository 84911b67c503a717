"""A refresh shuffles the relation once a mart, gives the shuffle files back and keeps one such shuffle at a time."""

import datetime as dt
import threading
import time

from pyspark.sql import functions as F

from conftest import D, raw_rows, raw_table
from tidemark.operators import marts
from tidemark.plans import jobs, registry
from tidemark.session import shared_dir
from tidemark.sources.tables import read_raw

AS_OF = D(2024, 3, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df):
    return [x for x in _plan(df).split("\n") if "Exchange" in x and "Broadcast" not in x]


def _odd(spark):
    """Gaps over years, null codes and dates, days and whole rows that come twice, loads of several days at once and without a time."""
    day = lambda i: D(2021, 11, 20) + dt.timedelta(days=11 * i)
    rows = [(c, day(i), 10 + (i * 7 + ord(c)) % 13) for i in range(80) for c in "ABCDE" if (i + ord(c)) % 4]
    rows += [("A", day(i), 99, "monthly") for i in range(5)] + [("F", day(3), 5), ("F", day(3), 5), ("G", day(1), 1, "daily", 1, "g", dt.datetime(2024, 1, 1))]
    raw = raw_rows(spark, rows)
    raw = raw.select([F.col(c) for c in raw.columns])
    null = lambda c, kind: F.lit(None).cast(kind).alias(c)
    some = raw.filter("currency_code in ('C', 'F')")
    no_code = some.select(null("currency_code", "string"), *raw.columns[1:])
    no_date = some.filter("currency_code = 'C'").orderBy("rate_date").limit(1).withColumn("rate_date", F.lit(None).cast("date"))
    no_load = raw.filter("currency_code = 'B'").withColumns({"currency_code": F.lit("H"), "load_timestamp": F.lit(None).cast("timestamp_ntz")})
    return raw.unionByName(no_code).unionByName(no_date).unionByName(no_load)


def _rows(df):
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_marts_dealt_by_entity_are_the_marts(spark):
    raw = _odd(spark)
    plain, dealt = jobs.build_marts(raw, AS_OF, "A"), jobs.build_marts(raw, AS_OF, "A", 3)
    for name in jobs.MART_NAMES:
        assert dealt[name].dtypes == plain[name].dtypes, name
        assert _rows(dealt[name]) == _rows(plain[name]) and plain[name].count() > 0, name


def test_sorted_marts_are_shuffled_once(spark, tmp_path):
    _odd(spark).write.parquet(str(tmp_path / "raw"))
    plans = jobs.build_marts(spark.read.parquet(str(tmp_path / "raw")), AS_OF, "A", 3)
    for name, order in jobs.SORT_OF.items():
        moved = _shuffles(plans[name].sortWithinPartitions(*order))
        assert len(moved) == 1 and "rangepartitioning(currency_code" in moved[0], name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in _plan(jobs.build_marts(spark.read.parquet(str(tmp_path / "raw")), AS_OF, "A")["anchor_correlation"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {f.rsplit("/", 1)[-1] for f in files.split(",") if "shuffle_" in f}


def test_refresh_gives_its_shuffle_files_back(spark):
    raw = read_raw(spark, raw_table(spark, raw_rows(spark, [(c, D(2024, 1, 1) + dt.timedelta(days=i), 10 + i % 7) for i in range(60) for c in "ABCD"])), with_month=True)
    base, key = shared_dir(spark, "test-disk"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), _shuffle_files(spark)
    status = jobs.refresh_marts(spark, raw, base, AS_OF, "A", database="disk_marts", log_path=f"{base}/log")
    until = time.time() + 5  # executors delete them behind the driver's back
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before and spark.conf.get(key, None) == was
    assert {r.mart: r.rows for r in status.collect()}["daily_changes"] == 240


def test_marts_of_the_whole_relation_go_one_at_a_time(spark, monkeypatch):
    raw = raw_rows(spark, [(c, D(2024, 1, 1) + dt.timedelta(days=i), 10 + i % 7) for i in range(30) for c in "AB"])
    real, now, most, lock = jobs.publish, set(), [], threading.Lock()

    def publish(spark, df, base, name, *a, **b):
        with lock:
            now.add(name)
            most.append(len(now & {*jobs.WHOLE}))
        try:
            return real(spark, df, base, name, *a, **b)
        finally:
            with lock:
                now.discard(name)

    monkeypatch.setattr(jobs, "publish", publish)
    base = shared_dir(spark, "test-one")
    jobs.refresh_marts(spark, raw, base, AS_OF, "A", database="one_marts", log_path=f"{base}/log")
    assert max(most) == 1 and len(most) == len(jobs.MART_NAMES)
    assert [r.mart for r in spark.read.parquet(f"{base}/log").collect()] == [*jobs.MART_NAMES]


def test_tasks_follow_the_rows_of_a_raw_store(spark, monkeypatch):
    rows = raw_rows(spark, [(c, D(2024, 1, 1) + dt.timedelta(days=i), 10 + i % 7) for i in range(30) for c in "AB"])
    stored, seen = read_raw(spark, raw_table(spark, rows), with_month=True), []
    real = jobs.build_marts
    monkeypatch.setattr(jobs, "MART_TASK_ROWS", 6)
    monkeypatch.setattr(jobs, "build_marts", lambda raw, as_of, anchor, tasks: seen.append(tasks) or real(raw, as_of, anchor, tasks))
    for raw in (stored, rows):
        jobs.refresh_marts(spark, raw, shared_dir(spark, "test-tasks"), AS_OF, "A", names=("monthly_stats",), database="task_marts")
    assert seen == [10, int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_logged_refresh_makes_the_rates_once(spark, tmp_path, monkeypatch):
    rows = [(o, 1 + o % 7, 1, 100.0 + o, dt.datetime(2001, 1 + o % 10, 1 + o % 28)) for o in range(400)] + [(900, None, 1, 5.0, dt.datetime(2001, 1, 1)), (901, 3, 1, 6.0, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    real, given = jobs.refresh_marts, []
    monkeypatch.setattr(jobs, "refresh_marts", lambda spark, raw, *a, **b: given.append(raw) or real(spark, raw, *a, **b))
    log = {r.mart: r.rows for r in registry.QUERIES["refresh_log"](spark, str(tmp_path)).collect()}
    assert not _shuffles(given[0])  # stored, not made again by each mart
    rates = registry.rates_from_lines(spark, str(tmp_path))
    assert log == {name: df.count() for name, df in jobs.build_marts(rates, registry.P.AS_OF, registry.P.ANCHOR).items()}
    assert log["load_stats"] == marts.load_stats(rates).count()
