"""The bucketed layout: equal marts, plans without a shuffle of the table, upserts by year, bloom filters."""

import datetime as dt
import uuid

import pytest
from conftest import raw_rows

from tidemark.operators import bucketed, marts, store
from tidemark.session import shared_dir

AS_OF = dt.datetime(2003, 1, 1)


def _table(spark, rows=None, **kw):
    base, name = shared_dir(spark, "bucketed"), f"tests_bucketed.t_{uuid.uuid4().hex}"
    if rows is None:
        bucketed.create(spark, name, base)
    else:
        bucketed.load(spark, name, rows, base, **kw)
    return name


def _series(spark, codes=("AAA", "AAB", "AAC"), start=dt.date(2000, 11, 20), days=500, step=3):
    rows = []
    for k, code in enumerate(codes):
        for d in range(k, days, step + k):
            rows.append((code, start + dt.timedelta(days=d), 10 + (d * 7 + k) % 13, "daily"))
            if d % 2 == 0:
                rows.append((code, start + dt.timedelta(days=d), 1 + d, "monthly"))
    return raw_rows(spark, rows)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _shuffled_scans(df):
    """Exchanges of the plan below which a scan is reached without an aggregate between."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-*()0123456789"))
    found = []
    for i, line in enumerate(lines):
        if "Exchange " not in line:
            continue
        for below in lines[i + 1:]:
            if depth(below) <= depth(line) or "Aggregate" in below:
                break
            if "FileScan" in below:
                found.append(below.strip())
                break
    return found


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marts_equal_the_plain_ones(spark):
    rows = _series(spark)
    name = _table(spark, rows)
    assert _sorted(bucketed.daily_changes(spark, name)) == _sorted(marts.daily_changes(rows))
    for unit in ("month", "quarter"):
        assert _sorted(bucketed.period_stats(spark, name, unit, volatility_digits=6)) == _sorted(marts.period_stats(rows, unit, volatility_digits=6))
    with pytest.raises(ValueError):
        bucketed.period_stats(spark, name, "week")


def test_no_shuffle_of_the_table(spark, static_plans):
    name = _table(spark, _series(spark))
    assert not _shuffled_scans(bucketed.daily_changes(spark, name))
    assert not _shuffled_scans(bucketed.period_stats(spark, name, "month"))
    assert _shuffled_scans(marts.daily_changes(spark.table(name)))  # the plain form does shuffle it
    batch = _table(spark, _series(spark, days=30)).split(".")[1]
    new = spark.read.parquet(spark.table(f"tests_bucketed.{batch}").inputFiles()[0].rsplit("/", 2)[0])
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        rows = bucketed.merged(spark.table(name), bucketed.with_year(new.select(*bucketed.RAW_COLUMNS)))
        assert len(_shuffled_scans(rows)) == 1 and "SortMergeJoin" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")


def test_upsert_rewrites_touched_years_only(spark):
    rows = _series(spark)
    name = _table(spark, rows)
    before = {f for f in spark.table(name).inputFiles()}
    batch = raw_rows(spark, [("AAA", dt.date(2001, 1, 1), 7, "daily"), ("ZZZ", dt.date(2001, 5, 5), 8, "daily"), ("ZZZ", dt.date(2003, 5, 5), 9, "daily"),
                             ("AAA", dt.date(2001, 1, 4), 6, "monthly")])
    want = store.upsert(rows, batch, AS_OF)
    have = rows.select("currency_code", "rate_date", "rate_type").intersect(batch.select("currency_code", "rate_date", "rate_type")).count()
    assert bucketed.upsert(spark, name, batch, AS_OF) == {"inserted": 4 - have, "updated": have}
    assert _sorted(spark.table(name).select(*bucketed.RAW_COLUMNS)) == _sorted(want)
    after = set(spark.table(name).inputFiles())
    assert {f for f in before if "rate_part=2001" not in f} <= after
    assert not {f for f in before if "rate_part=2001" in f} & after
    per_bucket = [f.rsplit("/", 2)[1:] for f in after]
    assert len({(year, f.split("_")[-1]) for year, f in per_bucket}) == len(per_bucket)  # one file a year and bucket
    assert bucketed.vacuum(spark, name) == 1 and bucketed.vacuum(spark, name) == 0
    assert _sorted(bucketed.daily_changes(spark, name)) == _sorted(marts.daily_changes(want))
    # the same upsert again changes nothing
    assert bucketed.upsert(spark, name, batch, AS_OF) == {"inserted": 0, "updated": 4}
    assert _sorted(spark.table(name).select(*bucketed.RAW_COLUMNS)) == _sorted(want)


def test_empty_table_and_batch(spark):
    name = _table(spark)
    assert bucketed.daily_changes(spark, name).count() == 0
    none = raw_rows(spark, [])
    assert bucketed.upsert(spark, name, none, AS_OF) == {"inserted": 0, "updated": 0}
    assert bucketed.upsert(spark, name, _series(spark, days=10), AS_OF)["updated"] == 0
    assert spark.table(name).count() == _series(spark, days=10).count()


def test_repeated_keys_need_an_order(spark):
    name = _table(spark, _series(spark, days=10))
    batch = raw_rows(spark, [("AAA", dt.date(2000, 11, 20), 1, "daily"), ("AAA", dt.date(2000, 11, 20), 2, "daily")])
    with pytest.raises(Exception, match="twice"):
        bucketed.upsert(spark, name, batch, AS_OF)


def _rows_read(df):
    """Rows that the scan hands on, by its own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_bloom_filters_skip_row_groups_without_the_entity(spark):
    # codes between others, so minima and maxima do not help; no dictionary, as of a column with very many codes
    codes = [f"{a}{b}{c}" for a in "AC" for b in "ACE" for c in "ABCDEFGH"]
    rows = _series(spark, codes, days=40, step=20)
    plain = {"parquet.enable.dictionary#currency_code": "false"}
    name = _table(spark, rows, buckets=8, options=plain)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _rows_read(bucketed.entity(spark, name, "BAA")) == 0
        found = _rows_read(bucketed.entity(spark, name, "CCC"))
        assert 0 < found < spark.table(name).count() / 2
        assert bucketed.entity(spark, name, "CCC").count() == rows.filter("currency_code = 'CCC'").count()
        without = _table(spark, rows, buckets=8, options={**plain, "parquet.bloom.filter.enabled#currency_code": "false"})
        assert _rows_read(bucketed.entity(spark, without, "BAA")) > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
