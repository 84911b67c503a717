"""Order of arrival, crash safety, pruned reads, NULL keys, rejects and empty runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import D, raw_rows, raw_table
from tidemark.functions.series import with_previous
from tidemark.operators import marts, panels, store, tables
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import payloads
from tidemark.sources.tables import read_raw

AS_OF = dt.datetime(2024, 1, 10, 18)
ELEMENT = ("<ValuteCursOnDate><Vname>{name}</Vname><Vnom>{nom}</Vnom><Vcurs>{rate}</Vcurs><Vcode>1</Vcode>"
           "<VchCode>{code}</VchCode><VunitRate>1</VunitRate></ValuteCursOnDate>")


def land(root, day, file, rows, mtime):
    folder = f"{root}/rate_date={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{file}", "w") as f:
        f.write("<ValuteData>" + "".join(ELEMENT.format(code=c, name=n, rate=r, nom=m) for c, n, r, m in rows) + "</ValuteData>")
    os.utime(f"{folder}/{file}", (mtime, mtime))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", ["year", "month", "none"])
def test_previous_keeps_null_keys(spark, block):
    rows = [(None, D(2023, 12, 30), 1.0), (None, D(2024, 1, 2), 2.0), ("A", D(2023, 5, 1), 5.0), ("A", D(2024, 2, 1), 6.0)]
    got = with_previous(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", ["v"], block=block)
    assert sorted((r.k or "", r.v, r.prev_v) for r in got.collect()) == [("", 1.0, None), ("", 2.0, 1.0), ("A", 5.0, None), ("A", 6.0, 5.0)]


def test_batch_without_order_must_be_unique(spark):
    base = raw_rows(spark, [("USD", D(2024, 1, 1), 90)])
    batch = raw_rows(spark, [("USD", D(2024, 1, 1), 91), ("USD", D(2024, 1, 1), 92)])
    with pytest.raises(Exception, match="without an order"):
        store.upsert(base, batch, AS_OF).collect()
    last = store.upsert(base, batch.withColumn("n", F.col("exchange_rate").cast("int")), AS_OF, seq=["n"]).collect()
    assert [float(r.exchange_rate) for r in last] == [92.0]


def test_upsert_does_not_aggregate_the_target(spark):
    base = raw_rows(spark, [("USD", D(2024, 1, 1), 90)])
    text = plan(store.upsert(base, raw_rows(spark, [("EUR", D(2024, 1, 1), 91)]).withColumn("n", F.lit(1)), AS_OF, seq="n"))
    assert "LeftAnti" in text and text.count("SortAggregate") <= 4


def values(df):
    return sorted((r.currency_code, float(r.exchange_rate)) for r in df.collect())


def test_first_load_and_cut_off_upsert(spark, monkeypatch):
    """A switch that is cut off leaves whole months, old or new, and the same upsert completes it."""
    name = raw_table(spark)
    first = raw_rows(spark, [("USD", D(2024, 1, 1), 90), ("EUR", D(2024, 2, 2), 99)])
    assert tables.upsert_into(spark, name, first, AS_OF) == {"inserted": 2, "updated": 0}
    change = raw_rows(spark, [("USD", D(2024, 1, 1), 91), ("EUR", D(2024, 2, 2), 98), ("CNY", D(2024, 3, 3), 12)])
    real = tables._switch

    def dies(session, table, folders):
        real(session, table, dict(list(folders.items())[:1]))
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "_switch", dies)
        with pytest.raises(KeyboardInterrupt):
            tables.upsert_into(spark, name, change, AS_OF)
    assert len(values(read_raw(spark, name))) >= 2
    assert tables.upsert_into(spark, name, change, AS_OF)["inserted"] <= 1
    assert values(read_raw(spark, name)) == [("CNY", 12.0), ("EUR", 98.0), ("USD", 91.0)]
    assert tables.upsert_into(spark, name, change.limit(0), AS_OF) == {"inserted": 0, "updated": 0}


def test_readers_see_every_month_during_an_upsert(spark, monkeypatch):
    name = raw_table(spark, raw_rows(spark, [("USD", D(2024, m, 1), m) for m in range(1, 7)]))
    under_way = read_raw(spark, name).repartition(6).toLocalIterator()
    began = [float(next(under_way).exchange_rate)]
    seen = []
    real = spark.__class__.sql

    def watched(session, text, *a, **k):
        out = real(session, text, *a, **k)
        if text.startswith("ALTER TABLE"):  # between any two switches
            seen.append(sorted({int(r.rate_date.month) for r in read_raw(session, name).collect()}))
        return out

    monkeypatch.setattr(spark.__class__, "sql", watched)
    tables.upsert_into(spark, name, raw_rows(spark, [("USD", D(2024, m, 1), 10 * m) for m in range(1, 8)]), AS_OF)
    monkeypatch.undo()
    assert len(seen) == 7 and all(months[:6] == [1, 2, 3, 4, 5, 6] for months in seen)
    # the old files are there for a reader that began before
    assert sorted(began + [float(r.exchange_rate) for r in under_way]) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert tables.vacuum(spark, name) == 1 and tables.vacuum(spark, name) == 0
    assert values(read_raw(spark, name)) == [("USD", 10.0 * m) for m in range(1, 8)]


def test_untouched_months_are_neither_read_nor_written(spark):
    name = raw_table(spark, raw_rows(spark, [("USD", D(2024, m, 1), m) for m in range(1, 5)]))
    before = tables._catalogue(spark, name)[1]
    tables.upsert_into(spark, name, raw_rows(spark, [("EUR", D(2024, 2, 1), 9)]), AS_OF)
    after = tables._catalogue(spark, name)[1]
    assert {k[1] for k in after if after[k] != before.get(k)} == {"2024-02"}


def test_raw_table_definition(spark):
    name = raw_table(spark)
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {name}").collect()}
    from tidemark.schema import RAW_SCHEMA
    assert all(described[f.name] == f.metadata["comment"] for f in RAW_SCHEMA.fields) and described["rate_month"]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["tidemark.check.code_pattern"] == "currency_code RLIKE '^[A-Z]{3}$'" and properties["tidemark.key"]
    rows = [("USD", D(2024, 1, 1), 9)]
    tables.load_raw(spark, name, raw_rows(spark, rows))
    for rule in [v for k, v in properties.items() if k.startswith("tidemark.check.")]:  # the rules are SQL
        assert spark.table(name).where(rule).count() == 1


def test_month_folders_are_pruned(spark):
    rows = [("A", D(2023, 1, 1) + dt.timedelta(days=9 * i), 10 + i % 7) for i in range(60)]
    root = raw_table(spark, raw_rows(spark, rows))
    raw = read_raw(spark, root, with_month=True)
    weekly = marts.period_stats(raw, "week")
    touched = raw_rows(spark, [("A", D(2024, 1, 5), 3)])
    for df in (marts.top_volatile(raw, D(2024, 1, 31)), panels.entity_trailing(raw, "A", D(2024, 1, 31)),
               panels.majors_labelled(raw, {"A": "a"}, D(2024, 1, 31), rate_type="daily"), read_raw(spark, root, D(2023, 5, 1), D(2023, 6, 1)),
               marts.refresh_period_stats(raw, weekly.limit(0), touched, "week")):
        assert any("rate_month" in x.split("]")[0] for x in plan(df).split("PartitionFilters: [")[1:])
    assert read_raw(spark, root, D(2023, 5, 1), D(2023, 6, 1)).count() == sum(D(2023, 5, 1) <= r[1] <= D(2023, 6, 1) for r in rows)


def test_reading_twice_then_parsing(spark):
    root = shared_dir(spark, "test-twice")
    land(root, "2024-01-09", "a.xml", [("USD", "Dollar", "90", "1")], 1000)
    for _ in range(2):
        assert payloads.read_daily_xml(spark, root).count() == 1
    docs = spark.createDataFrame([("<ValuteData>" + ELEMENT.format(code="EUR", name="Euro", rate="1234567.5", nom="x") + "</ValuteData>", D(2024, 1, 9))], "doc string, rate_date date")
    row = payloads.parse_daily_xml(docs).first()
    assert row["exchange_rate"] is None and row["nominal"] is None


def test_daily_run_last_file_wins_and_rejects_are_kept(spark):
    root = shared_dir(spark, "test-run")
    land(f"{root}/xml", "2024-01-09", "old.xml", [("USD", "Dollar", "1", "1")], 1000)
    land(f"{root}/xml", "2024-01-09", "new.xml", [("EUR", "Euro " + "x" * 80, "9", "1"), ("USD", "Dollar", "2", "1"), ("GBP", "Pound", "n/a", "1"),
                                                  ("JPY", "Yen", "60", "abc"), ("BIG", "Big", "1234567.5", "1")], 2000)
    land(f"{root}/xml", "2024-01-08", "other.xml", [("CNY", "Yuan", "7", "1")], 3000)
    name = raw_table(spark)
    for _ in range(2):  # a rerun changes nothing
        out = jobs.run_daily(spark, f"{root}/xml", None, name, AS_OF, rejects_path=f"{root}/rejects")
    assert out["totals"] == {"daily": 3, "monthly": 0, "total": 3} and (out["inserted"], out["updated"]) == (0, 2)
    assert out["rejected"] == {"bad_rate": 1, "bad_nominal": 1, "rate_overflow": 1}
    stored = {r.currency_code: float(r.exchange_rate) for r in read_raw(spark, name).collect()}
    assert stored == {"USD": 2.0, "EUR": 9.0}
    rejects = spark.read.parquet(f"{root}/rejects").collect()
    assert sorted(r.original.split("|")[2] for r in rejects) == ["1234567.5", "60", "n/a"]


def test_daily_run_without_payloads(spark):
    out = jobs.run_daily(spark, None, None, raw_table(spark), AS_OF)
    assert out["totals"]["total"] == 0 and out["rejected"] == {}
    assert {r["check"]: r["value"] for r in out["dq"].collect()}["total_records"] == 0


def test_monthly_items_out_of_range(spark):
    doc = ('{"RawData":[{"element_id":1,"date":"2024-02-01","obs_val":"Infinity","dt":""},{"element_id":1,"date":"2024-02-01","obs_val":"1234567.5","dt":""},'
           '{"element_id":1,"date":"2024-02-01","obs_val":"5","dt":""}],"headerData":[{"id":1,"elname":"Евро"},{"id":1,"elname":"Лари"}]}')
    rows = payloads.monthly_checked(payloads.parse_monthly_json(spark.createDataFrame([(doc,)], "doc string"))).collect()
    assert [r.reason for r in rows] == ["bad_value", "value_overflow", None]
    assert rows[2].currency_name == "Лари" and rows[1].original == "1|2024-02-01|1234567.5|"


def test_period_load_counts(spark):
    root = shared_dir(spark, "test-period")
    for day, rate in (("2024-01-05", "1"), ("2024-01-06", "2"), ("2024-01-08", "x")):
        land(f"{root}/xml", day, "a.xml", [("USD", "Dollar", rate, "1")], 1000)
    rows = jobs.landed_period(spark, f"{root}/xml", "2024-01-05", "2024-01-08", skip_weekends=True)
    assert rows.count() == 2
    out = jobs.period_load(spark, rows, None, raw_table(spark), "2024-01-05", "2024-01-08", AS_OF, skip_weekends=True, load_type="daily_only",
                           today="2024-01-10", seq=["arrived", "file", "position"])
    assert (out["inserted"], out["updated"]) == (1, 0) and [r.reason for r in out["rejected"].collect()] == ["bad_rate"]
    assert out["summary"].first()["skipped_days"] == 2


def test_period_load_keeps_unreadable_dates(spark):
    schema = "currency_code string, currency_name string, exchange_rate string, rate_date string, rate_type string, nominal string"
    days = ["2024-01-05", "2024-1-8", "2024-01-06", "2024-01-20", "no date", "2024/01/05", None]
    rows = spark.createDataFrame([("USD", "Dollar", "1", d, "daily", "1") for d in days] + [("USD", "Dollar", "x", None, "daily", "1")], schema)
    out = jobs.period_load(spark, rows, None, raw_table(spark), "2024-01-05", "2024-01-08", AS_OF, skip_weekends=True,
                           load_type="daily_only", today="2024-01-21")
    assert (out["inserted"], out["updated"]) == (2, 0)
    assert sorted((r.reason, r.original.split("|")[3]) for r in out["rejected"].collect()) == [
        ("bad_date", ""), ("bad_date", "2024/01/05"), ("bad_date", "no date"), ("bad_rate", "")]
    assert {str(r.rate_date): r.status for r in out["day_status"].collect()} == {
        "2024-01-05": "loaded", "2024-01-06": "skipped", "2024-01-07": "skipped", "2024-01-08": "loaded"}


def test_mart_versions_and_catalogue(spark):
    raw = raw_rows(spark, [("A", D(2024, 1, 1) + dt.timedelta(days=i), 10 + i % 5) for i in range(30)])
    base = shared_dir(spark, "test-versions")
    paths = [tables.publish(spark, marts.period_stats(raw, "week"), base, "weekly_stats", "versions_db", jobs.SORT_OF["weekly_stats"]) for _ in range(4)]
    assert tables.retain(spark, base, "weekly_stats", paths[-1], keep=1) == 2
    touched = raw.limit(1)
    with pytest.raises(RuntimeError, match="persistent catalog"):
        jobs.refresh_period_marts_after_load(spark, raw, touched, base, database="no_such_db", units=("week",))
    got = jobs.refresh_period_marts_after_load(spark, raw, touched, base, database="versions_db2", units=("week",), current={"weekly_stats": paths[-1]})
    assert {r.mart: r.rows for r in got.collect()}["weekly_stats"] == marts.period_stats(raw, "week").count()


def test_anchor_day_counts_once(spark):
    rows = [(c, D(2024, 1, 1) + dt.timedelta(days=i), 5 + i % 4 + (c == "B")) for i in range(12) for c in "AB"]
    raw = raw_rows(spark, rows + [("A", D(2024, 1, 1), 7, "monthly")])
    assert marts.anchor_correlation(raw, "A", rate_type=None).first()["days_count"] == 12
