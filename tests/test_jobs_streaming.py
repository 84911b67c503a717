import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import D, raw_rows, raw_table
from tidemark.operators import quality, store, validate
from tidemark.operators.tables import publish, upsert_into
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import payloads
from tidemark.sources.tables import read_raw
from tidemark.streaming.ingest import Checks, incremental_ingest

AS_OF = dt.datetime(2024, 1, 10, 18)


def _records(spark, rows):
    return spark.createDataFrame(rows, "currency_code string, currency_name string, exchange_rate string, "
                                       "rate_date string, rate_type string, nominal string, seq long")


def test_touched_partition_upsert(spark):
    base = raw_rows(spark, [("USD", D(2024, 1, 1), 90), ("USD", D(2023, 12, 1), 80), ("EUR", D(2024, 1, 1), 99, "monthly")])
    root = raw_table(spark, base)
    batch = raw_rows(spark, [("USD", D(2024, 1, 1), 91), ("CNY", D(2024, 1, 2), 12)]).drop("load_timestamp")
    upsert_into(spark, root, batch, AS_OF)
    upsert_into(spark, root, batch, AS_OF)  # re-run: same result
    out = read_raw(spark, root)
    assert out.count() == 4
    usd = out.filter((F.col("currency_code") == "USD") & (F.col("rate_date") == D(2024, 1, 1))).first()
    assert float(usd["exchange_rate"]) == 91.0 and usd["load_timestamp"] == AS_OF
    old = out.filter(F.col("rate_date") == D(2023, 12, 1)).first()
    assert float(old["exchange_rate"]) == 80.0


def test_stream_in_two_files_equals_one_batch(spark):
    rows1 = [("USD", "Dollar", "90.5", "2024-01-02", "daily", "1", 1), ("EUR", "Euro", "99", "2024-01-02", None, None, 2),
             ("", "bad", "1", "2024-01-02", "daily", "1", 3)]
    rows2 = [("USD", "Dollar", "91.5", "2024-01-02", "daily", "1", 4), ("CNY", "Yuan", "12.1", "2024-1-3", "daily", "1", 5)]
    base = raw_rows(spark, [("USD", D(2024, 1, 1), 90)])

    root = shared_dir(spark, "test-stream")
    raw = raw_table(spark, base)
    how = {"rejects_path": f"{root}/rej", "metrics_path": f"{root}/metrics", "checks": Checks(D(2024, 1, 2), ("USD", "CNY"), 95.0)}
    _records(spark, rows1).coalesce(1).write.json(f"{root}/landing/a")
    incremental_ingest(spark, f"{root}/landing/*", raw, f"{root}/ckpt", AS_OF, **how)
    _records(spark, rows2).coalesce(1).write.json(f"{root}/landing/b")
    incremental_ingest(spark, f"{root}/landing/*", raw, f"{root}/ckpt", AS_OF, **how)
    streamed = read_raw(spark, raw)

    batch = validate.valid(validate.parsed(_records(spark, rows1 + rows2)))
    one = store.upsert(base, batch, AS_OF, seq="seq")
    assert streamed.count() == 4
    assert streamed.exceptAll(one).count() == 0 and one.exceptAll(streamed).count() == 0
    assert spark.read.parquet(f"{root}/rej").count() == 1
    # each epoch's metrics are the quality report of its valid rows
    metrics = {r.epoch: r for r in spark.read.parquet(f"{root}/metrics").collect()}
    for epoch, rows in enumerate((rows1, rows2)):
        ok = validate.valid(validate.parsed(_records(spark, rows)))
        report = {r["check"]: r["value"] for r in quality.dq_report(ok, D(2024, 1, 2), ("USD", "CNY"), 95.0).collect()}
        assert {k: metrics[epoch][k] for k in report} == report and metrics[epoch].rows == len(rows) == metrics[epoch].rejected + ok.count()


def test_refresh_marts_publishes_and_switches(spark):
    rows = []
    for i in range(40):
        d = D(2024, 1, 1) + dt.timedelta(days=i)
        rows += [("ANC", d, 10 + i), ("B", d, 20 + (i % 7)), ("C", d, 30 - i * 0.5)]
    raw = raw_rows(spark, rows)
    base = shared_dir(spark, "test-marts")
    status = {r["mart"]: r["rows"] for r in jobs.refresh_marts(spark, raw, base, D(2024, 2, 9), "ANC",
                                                               database="test_marts", log_path=f"{base}/log").collect()}
    assert status["daily_changes"] == 120 and status["anchor_correlation"] == 2 and status["top_volatile"] == 3
    assert status["total"] == sum(v for k, v in status.items() if k != "total")
    assert spark.table("test_marts.daily_changes").count() == 120
    v2 = publish(spark, spark.table("test_marts.top_volatile").limit(1), base, "top_volatile", "test_marts")
    assert spark.table("test_marts.top_volatile").count() == 1 and "v_" in v2
    log = {r.mart: r for r in jobs.refresh_log(spark, f"{base}/log").collect()}
    assert {m: r.rows for m, r in log.items()} == {k: v for k, v in status.items() if k != "total"}
    assert len({r.run for r in log.values()}) == 1 and all(r.seconds > 0 and r.log_message == "mart refreshed" for r in log.values())


def test_failed_mart_is_logged_and_raised(spark, monkeypatch):
    raw = raw_rows(spark, [("A", D(2024, 1, 1) + dt.timedelta(days=i), 10 + i) for i in range(20)])
    base = shared_dir(spark, "test-failed-mart")
    plans = jobs.build_marts(raw, D(2024, 1, 20), "A")
    plans["weekly_stats"] = plans["weekly_stats"].withColumn("x", F.raise_error(F.lit("no weeks today")))
    monkeypatch.setattr(jobs, "build_marts", lambda *a: plans)
    with pytest.raises(Exception, match="no weeks today"):
        jobs.refresh_marts(spark, raw, base, D(2024, 1, 20), "A", names=("monthly_stats", "weekly_stats"), database="failed_marts", log_path=f"{base}/log")
    log = {r.mart: (r.rows, "no weeks today" in r.log_message) for r in jobs.refresh_log(spark, f"{base}/log").collect()}
    assert log == {"monthly_stats": (1, False), "weekly_stats": (None, True)}
    assert spark.table("failed_marts.monthly_stats").count() == 1


def test_run_daily_and_period_load(spark):
    root = shared_dir(spark, "test-daily")
    raw = raw_table(spark, raw_rows(spark, [("USD", D(2024, 1, 8), 90)]))
    daily = raw_rows(spark, [("USD", D(2024, 1, 9), 91), ("EUR", D(2024, 1, 9), 99)])
    payloads.write_daily_xml(daily, f"{root}/xml")
    monthly_doc = payloads.monthly_documents(raw_rows(spark, [("USD", D(2024, 1, 1), 95, "monthly", 1, "Доллара США к рублю")]))
    monthly_doc.select("doc").write.text(f"{root}/json")
    out = jobs.run_daily(spark, f"{root}/xml", f"{root}/json", raw, AS_OF)
    assert out["totals"] == {"daily": 2, "monthly": 1, "total": 3}
    dq = {r["check"]: (r["value"], r["status"]) for r in out["dq"].collect()}
    assert dq["rows_on_date"] == (2, "ok") and dq["total_records"] == (4, "info")

    pl = jobs.period_load(spark, daily, None, raw, "2024-01-06", "2024-01-09", AS_OF,
                          skip_weekends=True, load_type="daily_only", today="2024-01-10")
    st = {r["status"] for r in pl["day_status"].collect()}
    assert st == {"skipped", "missing", "loaded"}
    rep = pl["report"].first()
    assert rep["records_loaded"] == 3 and rep["days"] == 4  # the 8th was already stored


def test_catalog_status_and_sample_sink(spark):
    from tidemark.operators.tables import write_sample_json
    raw = raw_rows(spark, [("A", D(2024, 1, i + 1), 10 + i) for i in range(30)])
    base = shared_dir(spark, "test-status")
    publish(spark, raw, base, "daily_changes", "status_db")
    st = {r["mart"]: (r["exists"], r["rows"]) for r in jobs.catalog_status(spark, "status_db").collect()}
    assert st["daily_changes"] == (True, 30) and st["load_stats"] == (False, None)
    only = jobs.catalog_status(spark, "status_db", pattern="daily%").collect()
    assert [r["mart"] for r in only] == ["daily_changes"]
    write_sample_json(raw, f"{base}/sample", n=5)
    assert spark.read.json(f"{base}/sample").count() == 5


def test_period_marts_refresh_after_load(spark):
    rows = [("A", D(2024, 1, 1) + dt.timedelta(days=i), 10 + (i * 5) % 9) for i in range(50)]
    rows += [("B", D(2024, 1, 2) + dt.timedelta(days=3 * i), 40 + i) for i in range(15)]
    raw = raw_rows(spark, rows)
    base = shared_dir(spark, "test-inc-marts")
    jobs.refresh_marts(spark, raw, base, D(2024, 2, 19), "A", database="inc_marts")
    batch = raw_rows(spark, [("A", D(2024, 1, 20), 77), ("B", D(2024, 2, 2), 3)]).drop("load_timestamp")
    after = store.upsert(raw, batch, AS_OF)
    st = {r["mart"]: r["rows"] for r in
          jobs.refresh_period_marts_after_load(spark, after, batch, base, database="inc_marts").collect()}
    from tidemark.operators import marts
    for unit, name in jobs.PERIOD_MARTS.items():
        got = spark.table(f"inc_marts.{name}").withColumn("volatility", F.round("volatility", 9))
        want = marts.period_stats(after, unit).withColumn("volatility", F.round("volatility", 9))
        assert st[name] == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
