"""Marts from stored summaries equal the full build, and untouched months are not read."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import D, raw_rows, raw_table
from tidemark.operators import incremental as inc
from tidemark.operators import marts, tables
from tidemark.operators import store as store_ops
from tidemark.session import shared_dir
from tidemark.sources.tables import read_raw

AS_OF = dt.datetime(2024, 7, 10, 18)


def series(seed=1):
    r = random.Random(seed)
    rows = []
    for code in ("ANC", "BBB", "CCC", "DDD", "EEE"):
        for k in range(200):
            if r.random() < (0.05 if code == "EEE" else 0.6):
                rows.append((code, D(2023, 12, 20) + dt.timedelta(days=k), 7 if code == "DDD" else 1000 + r.random() * 50))
    return rows + [("BBB", D(2023, 3, 1), 5), ("ANC", D(2024, 1, 1), 3, "monthly")]


def rounded(df):
    kinds = dict(df.dtypes)
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*[F.col(c).cast("double") if kinds[c].startswith("decimal") else c for c in df.columns]).collect()), key=repr)


@pytest.fixture
def store(spark):
    name = raw_table(spark, raw_rows(spark, series()))
    base = shared_dir(spark, "incremental")
    mom, chg = (f"inc_{uuid.uuid4().hex[:8]}.{t}" for t in ("moments", "changes"))
    raw = lambda: read_raw(spark, name, with_month=True)
    inc.refresh_moments(spark, raw(), None, mom, base, "ANC")
    inc.refresh_daily_changes(spark, raw(), spark.table(mom), None, chg, base)
    return name, base, mom, chg, raw


def check(spark, raw, mom, chg):
    pieces = spark.table(mom)
    for unit in ("week", "month", "quarter"):
        assert rounded(inc.period_stats(pieces, unit)) == rounded(marts.period_stats(raw(), unit))
    assert rounded(inc.anchor_correlation(pieces, "ANC")) == rounded(marts.anchor_correlation(raw(), "ANC"))
    for day in (D(2024, 7, 8), D(2024, 6, 30), D(2024, 7, 3), D(2024, 2, 1)):
        got = inc.top_volatile(pieces, raw(), day, "ANC", n=None)
        assert rounded(got) == rounded(marts.top_volatile(raw(), day, n=None))
    assert rounded(spark.table(chg).drop("rate_month")) == rounded(marts.daily_changes(raw()))


def test_full_build(spark, store):
    name, base, mom, chg, raw = store
    check(spark, raw, mom, chg)


def test_after_loads(spark, store):
    name, base, mom, chg, raw = store
    loads = [
        [("BBB", D(2023, 3, 5), 6), ("BBB", D(2024, 2, 29), 1234)],  # the next row of the first is months later
        [("EEE", D(2024, 1, 31), 1), ("ZZZ", D(2024, 5, 5), 2), ("ANC", D(2024, 4, 4), 900)],
        [("BBB", D(2025, 1, 1), 1.5), ("BBB", D(2022, 1, 1), 2.5)],
    ]
    for rows in loads:
        batch = raw_rows(spark, rows).drop("load_timestamp")
        tables.upsert_into(spark, name, batch, AS_OF)
        kept = tables._catalogue(spark, chg, tables.MONTH)[1]
        months = inc.refresh_moments(spark, raw(), batch, mom, base, "ANC")
        again = inc.refresh_daily_changes(spark, raw(), spark.table(mom), batch, chg, base)
        assert months == sorted({f"{r[1]:%Y-%m}" for r in rows}) and set(months) <= set(again) and len(again) <= 2 * len(rows)
        now = tables._catalogue(spark, chg, tables.MONTH)[1]
        assert {k[0] for k in now if now[k] != kept.get(k)} == set(again)
        check(spark, raw, mom, chg)


def test_plans_read_the_touched_months_only(spark, store):
    name, base, mom, chg, raw = store
    text = inc.daily_changes_of(raw(), spark.table(mom), ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert any("rate_month" in p.split("]")[0] and "2024-02" in p.split("]")[0] for p in text.split("PartitionFilters: [")[1:])
    top = inc.top_volatile(spark.table(mom), raw(), D(2024, 7, 8), "ANC")._jdf.queryExecution().executedPlan().toString()
    assert all("rate_month" in p.split("]")[0] for p in top.split("PartitionFilters: [")[1:])


def test_empty_load_and_emptied_month(spark, store):
    name, base, mom, chg, raw = store
    assert inc.refresh_moments(spark, raw(), raw_rows(spark, []), mom, base, "ANC") == []
    assert inc.refresh_daily_changes(spark, raw(), spark.table(mom), raw_rows(spark, []), chg, base) == []
    check(spark, raw, mom, chg)


def test_load_bitmaps_merge(spark):
    r = random.Random(3)
    rows = [(f"C{r.randrange(70_000):05d}", D(1960, 1, 1) + dt.timedelta(days=r.randrange(40_000)), 1, "daily", 1, "n",
             dt.datetime(2024, 1, 1 + r.randrange(3), r.randrange(24))) for _ in range(3000)]
    raw = raw_rows(spark, rows)
    ids = spark.range(70_000).select(F.concat(F.lit("C"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("currency_code"), "id")
    parts = [inc.load_bitmaps(raw.filter(F.pmod(F.xxhash64("currency_code", "rate_date"), F.lit(3)) == k), ids) for k in range(3)]
    two = inc.merge_bitmaps(parts[0].unionByName(parts[1]))
    got = inc.load_stats(inc.merge_bitmaps(two.select(*parts[2].columns).unionByName(parts[2])))
    assert got.collect() == marts.load_stats(raw).collect()
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert inc.load_stats(inc.merge_bitmaps(inc.load_bitmaps(raw.limit(0), ids))).count() == 0


def test_tables_by_months_are_shuffled_once_as_they_are_written(spark, store, monkeypatch):
    name, base, mom, chg, raw = store
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    daily = raw().filter("rate_type = 'daily'")
    sizes = tables.month_sizes(daily)
    assert sum(sizes) == daily.count()
    text = plan(inc.moments(raw(), "ANC", sizes=sizes))
    assert "SortMergeJoin" not in text and [x for x in text.split("\n") if "Exchange hashpartitioning(" in x and "rate_date" not in x] == \
        [x for x in text.split("\n") if "Exchange hashpartitioning(rate_month" in x and "REPARTITION_BY_NUM" in x]
    text = plan(inc.daily_changes_of(raw(), spark.table(mom)))
    assert text.count("hashpartitioning(rate_month") == 1 and "Join" not in text
    monkeypatch.setattr(tables, "TASK_ROWS", 3)  # several shares a month
    inc.refresh_moments(spark, raw(), None, mom, base, "ANC")
    inc.refresh_daily_changes(spark, raw(), spark.table(mom), None, chg, base)
    check(spark, raw, mom, chg)


def test_change_after_a_row_without_a_rate(spark):
    rows = raw_rows(spark, [("A", D(2024, 1, 5), 4), ("A", D(2024, 2, 1), 5), ("A", D(2024, 2, 2), 6), ("A", D(2024, 2, 3), 8)])
    pieces = inc.moments(rows, "ANC")
    raw = tables.with_partition(rows.withColumn("exchange_rate", F.when(F.col("rate_date") != D(2024, 2, 2), F.col("exchange_rate"))))
    got = {r["rate_date"]: r["prev_rate"] for r in inc.daily_changes_of(raw, pieces).collect()}
    assert got == {D(2024, 1, 5): None, D(2024, 2, 1): 4, D(2024, 2, 2): 5, D(2024, 2, 3): 4}  # as before: the month's carry stands in


def test_periods_are_made_once_for_the_change_against_the_one_before(spark, store):
    name, base, mom, chg, raw = store
    gaps = raw().withColumn("rate_date", F.when(F.dayofmonth("rate_date") != 3, F.col("rate_date")))  # rows without a date are a period that no other follows
    batch = gaps.filter("rate_month = '2024-02'").select("currency_code", "rate_date")
    for make in (lambda block: marts.period_stats(gaps, "week", block=block), lambda block: inc.period_stats(inc.moments(gaps, "ANC"), "week", block=block),
                 lambda block: marts.refresh_period_stats(gaps, marts.period_stats(gaps, "week"), batch, "week", block=block)):
        one = make(None)
        text = one._jdf.queryExecution().executedPlan().toString()
        assert text.count("Window ") == 1
        assert rounded(one) == rounded(make("year"))


def test_upsert_aggregates_the_batch_once(spark):
    rows = raw_rows(spark, [("AAA", D(2024, 1, 1), 1), ("BBB", D(2024, 1, 1), 2)])
    batch = raw_rows(spark, [("AAA", D(2024, 1, 1), 5), ("AAA", D(2024, 1, 1), 6)]).withColumn("seq", F.col("exchange_rate").cast("long"))
    out = store_ops.upsert(rows, batch, AS_OF, seq="seq")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert sorted((r["currency_code"], float(r["exchange_rate"])) for r in out.collect()) == [("AAA", 6.0), ("BBB", 2.0)]


def _without_lists_and_shuffled_once(df, extra=0):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in text and "collect_list" not in text
    assert text.count("Exchange hashpartitioning(currency_code") == text.count("Exchange ") - extra == 1


def test_weeks_are_merged_without_lists_after_one_shuffle(spark, store):
    name, base, mom, chg, raw = store
    pieces = spark.table(mom)
    _without_lists_and_shuffled_once(inc.period_stats(pieces, "week"))
    odd = raw_rows(spark, [("A", D(2024, 1, 29), 5), ("A", D(2024, 2, 1), 9), ("A", D(2024, 2, 2), 1), ("B", D(2024, 1, 30), 4), ("B", D(2024, 1, 30), 8), ("C", D(2024, 2, 1), 3)]) \
        .withColumn("currency_code", F.when(F.col("currency_code") != "C", F.col("currency_code")))
    gaps = odd.unionByName(odd.withColumn("rate_date", F.lit(None).cast("date"))).unionByName(odd.filter("currency_code = 'A'").withColumn("exchange_rate", F.lit(None).cast("decimal(12,6)")))
    dated = gaps.filter("exchange_rate IS NOT NULL")
    assert rounded(inc.period_stats(inc.moments(dated, "ANC"), "week")) == rounded(marts.period_stats(dated, "week"))
    assert inc.moments(gaps, "ANC").count() == inc.moments(dated, "ANC").count()


def test_sums_of_pieces_are_whole_numbers(spark):
    rows = raw_rows(spark, [("A", D(2024, 1, 2), 1), ("A", D(2024, 1, 3), 2), ("B", D(2024, 1, 2), 3)]).withColumn(
        "exchange_rate", F.when(F.col("currency_code") == "B", F.lit("-0.000003")).otherwise(F.lit("999999.999999")).cast("decimal(12,6)"))
    pieces = inc.moments(rows, "ANC")
    assert dict(pieces.dtypes)["total"] == "bigint"
    assert {r["currency_code"]: r["total"] for r in pieces.collect()} == {"A": 1999999999998, "B": -3}
    assert inc.top_volatile(tables.with_partition(pieces.drop("rate_month").withColumn("rate_date", F.col("month"))).drop("rate_date"), rows, D(2024, 1, 31), "ANC").count() == 2


def test_correlation_is_merged_without_lists_after_one_shuffle(spark, store):
    name, base, mom, chg, raw = store
    got = inc.anchor_correlation(spark.table(mom), "ANC")
    _without_lists_and_shuffled_once(got, extra=1)  # the other one orders the result
    assert rounded(got) == rounded(marts.anchor_correlation(raw(), "ANC")) and got.count() > 2
