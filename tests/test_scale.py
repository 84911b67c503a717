"""Steps that must not sort or shuffle whole tables, and whose tasks follow the size of the input."""

import datetime as dt
import re

from conftest import D, raw_rows, raw_table
from pyspark.sql import functions as F

from tidemark.operators import store, tables, validate
from tidemark.session import TASK_BYTES, input_tasks
from tidemark.sources import payloads
from tidemark.sources.tables import rates_from_lines

AS_OF = dt.datetime(2024, 2, 1, 12)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, path):
    rows = [(o, o % 7, 1, 100.0 + o, dt.datetime(2024, 1 + o % 3, 1 + o % 28)) for o in range(400)] + [(900, None, 1, 5.0, dt.datetime(2024, 1, 1)), (901, 3, 1, 6.0, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{path}/lineitem.parquet")


def test_tasks_follow_the_stored_bytes(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    (tmp_path / "t").write_bytes(b"")
    assert input_tasks(spark, str(tmp_path / "t")) == cores
    with open(tmp_path / "t", "wb") as f:
        f.truncate(TASK_BYTES * 3 * cores + 1)
    assert input_tasks(spark, str(tmp_path / "t")) == 3 * cores + 1


def test_rates_deal_the_lines_once_by_supplier_and_month(spark, tmp_path):
    _lines(spark, tmp_path)
    rates = rates_from_lines(spark, str(tmp_path))
    dealt = [x for x in _plan(rates).split("\n") if "Exchange" in x]
    assert len(dealt) == 2 and all("month" in x and "REPARTITION_BY_NUM" in x for x in dealt)
    got = rates.filter("rate_type = 'monthly'").collect()
    best = {}
    for r in rates.filter("rate_type = 'daily'").collect():
        at = (r["currency_code"], r["rate_date"] and r["rate_date"].replace(day=1))
        best[at] = max(best.get(at, 0), r["exchange_rate"])
    assert {(r["currency_code"], r["rate_date"]): r["exchange_rate"] for r in got} == best and len(got) == len(best)


def _deepest_aggregate(df):
    return [re.search(r"(\w+Aggregate)\(", x)[1] for x in _plan(df).split("\n") if "Aggregate(" in x][-1]


def test_names_are_aggregated_by_hash_before_any_sort(spark):
    raw = raw_rows(spark, [("A", D(2024, 1, 1), 1, "daily", 1, "old"), ("A", D(2024, 1, 2), 1, "daily", 1, "new"), ("A", D(2024, 3, 1), 1, "monthly", 1, "zz"),
                           ("B", D(2024, 1, 1), 1, "monthly", 1, "b")])
    assert _deepest_aggregate(store.dimension_names(raw)) == "HashAggregate"
    assert _deepest_aggregate(payloads.catalogue_elements(raw)) == "HashAggregate"
    assert sorted(tuple(r) for r in store.dimension_names(raw).collect()) == [("A", "new", D(2024, 1, 1), D(2024, 3, 1)), ("B", "b", D(2024, 1, 1), D(2024, 1, 1))]
    parsed = payloads.parse_catalogue_xml(payloads.catalogue_elements(raw)).select("vcommoncode", "vname").collect()
    assert sorted(tuple(r) for r in parsed) == [("A", "new"), ("B", "b")]


def test_layout_takes_no_sample_and_merge_one_shuffle(spark):
    raw = tables.with_partition(raw_rows(spark, [("A", D(2024, 1, 1), 1)]))
    assert "rangepartitioning" not in _plan(tables._laid_out(raw, tables.PART_COLS, "currency_code"))
    plan = _plan(tables._merged(raw, raw, [1, 500_000]))
    assert plan.count("Exchange ") == 1 and "Join" not in plan and plan.count("Sort ") == 1


def test_upsert_of_large_months_counts_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 2)  # several shares a month
    held = [("AAA", D(2024, 1, k), k) for k in range(1, 6)] + [("BBB", D(2024, 1, 3), 1), ("BBB", D(2024, 1, 3), 2), ("CCC", D(2023, 12, 1), 7)]
    name = raw_table(spark, raw_rows(spark, held))
    batch = raw_rows(spark, [("AAA", D(2024, 1, 2), 20), ("BBB", D(2024, 1, 3), 30), ("DDD", D(2024, 1, 9), 40), ("AAA", D(2024, 1, 2), 21, "monthly")]) \
        .unionByName(raw_rows(spark, [("X", D(2024, 1, 4), 50)]).withColumn("currency_code", F.lit(None).cast("string")))
    want = store.upsert(spark.table(name), batch, AS_OF).collect()
    counts = store.upsert_counts(spark.table(name), batch).first().asDict()
    assert tables.upsert_into(spark, name, batch, AS_OF) == counts == {"inserted": 3, "updated": 3}
    got = spark.table(name).drop("rate_month").select(*want[0].asDict()).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_days_read_by_a_cast_are_those_of_the_formatter(spark):
    texts = ["2024-1-5", "2024-01-05", "2024-02-30", "2024-13-01", "0000-01-01", "0001-01-01", " 2024-1-5", "2024-1-5 ", "2024-1-5\n", "2024/01/05", "24-1-5", "2024-1", "12024-1-5",
             "+2024-1-5", "2024-001-05", "2024-1-5T00:00", "9999-12-31", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "rate_date string")
    differ = rows.filter(~validate.day_of(rows).eqNullSafe(F.try_to_date("rate_date", "yyyy-M-d")))
    assert differ.collect() == []


def test_documents_are_parsed_once(spark):
    docs = payloads.daily_documents(raw_rows(spark, [("USD", D(2024, 1, 2), 90), ("EUR", D(2024, 1, 2), 95)]))
    got = payloads.parse_daily_xml(docs)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    assert sorted(r["currency_code"] for r in got.collect()) == ["EUR", "USD"]


def test_landed_daily_files_are_compressed(spark, tmp_path):
    rows = raw_rows(spark, [("USD", D(2024, 1, 2), 90), ("EUR", D(2024, 1, 3), 95)])
    payloads.write_daily_xml(rows, str(tmp_path / "landing"))
    assert all(f.name.endswith(".xml.gz") for f in (tmp_path / "landing").rglob("part-*"))
    back = payloads.read_daily_xml(spark, str(tmp_path / "landing"), D(2024, 1, 2), D(2024, 1, 3))
    assert sorted((r["currency_code"], r["rate_date"]) for r in back.collect()) == [("EUR", D(2024, 1, 3)), ("USD", D(2024, 1, 2))]


def test_rates_by_month_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    from tidemark.sources import tables as source
    monkeypatch.setattr(source, "MONTH_TASK_LINES", 20)  # several shares a month
    _lines(spark, tmp_path)
    plain, dealt = rates_from_lines(spark, str(tmp_path)), rates_from_lines(spark, str(tmp_path), by_month=True)
    key = lambda r: tuple(str(x) for x in r)
    shuffles = [x for x in _plan(dealt).split("\n") if "Exchange" in x]
    assert sorted(plain.collect(), key=key) == sorted(dealt.collect(), key=key)
    assert len(shuffles) == 2 and all("hashpartitioning(month" in x and "_share" in x for x in shuffles)
    tables.write_raw(dealt, str(tmp_path / "raw"), dealt=True)
    back = spark.read.parquet(str(tmp_path / "raw")).select(*plain.columns)
    assert sorted(back.collect(), key=key) == sorted(plain.collect(), key=key)


def test_load_of_last_months_makes_only_its_records(spark, tmp_path):
    from tidemark.plans import params, registry
    rows = [(o, 1 + o % 5, 1, 100.0 + o, dt.datetime(2001, 5 + o % 6, 1 + o % 28)) for o in range(400)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = validate.valid(registry._checked(spark, str(tmp_path))).filter(F.col("rate_date") >= F.lit(params.LOAD_START))
    part = registry._checked(spark, str(tmp_path), params.LOAD_START)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(validate.valid(part).collect(), key=key) == sorted(whole.collect(), key=key) and whole.count() > 50
    assert any("Filter" in x and "l_shipdate" in x for x in _plan(part).split("\n"))


def test_cents_and_months_of_lines_take_whole_numbers(spark, tmp_path):
    from tidemark.sources.tables import whole_cents
    prices = [0.0, 0.004, 0.005, 0.0049999999999999994, 1.004999, 1.005, 2.675, 12.345, 104949.995, 167772.15, -2.505, -0.005, 1e13, None]
    df = spark.createDataFrame([(p,) for p in prices], "p double").select(whole_cents(F.col("p")).alias("a"), F.round(F.col("p") * 100).cast("long").alias("b"))
    assert all(r["a"] == r["b"] for r in df.collect())
    _lines(spark, tmp_path)
    text = _plan(rates_from_lines(spark, str(tmp_path)))
    assert " / 100" not in text and "max(exchange_rate" not in text
