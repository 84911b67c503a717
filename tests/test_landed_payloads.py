"""Broken payloads become rejects with their text; the period load resumes by its manifest."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import D, raw_table
from tidemark.operators import validate
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import payloads
from tidemark.sources.tables import read_raw

AS_OF = dt.datetime(2024, 1, 10, 18)
ELEMENT = "<ValuteCursOnDate><Vname>n</Vname><Vnom>1</Vnom><Vcurs>{rate}</Vcurs><VchCode>{code}</VchCode></ValuteCursOnDate>"


def land(root, day, name, text):
    folder = f"{root}/rate_date={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def doc(*codes, rate=1):
    return "<ValuteData>" + "".join(ELEMENT.format(code=c, rate=rate) for c in codes) + "</ValuteData>"


def test_daily_files_break_without_a_trace_lost(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2024-01-02", "a.xml", doc("AAA", "BBB"))
    land(root, "2024-01-02", "cut.xml", doc("CCC")[:-13] + "<ValuteCursOnDate><Vname>n</Vna")
    land(root, "2024-01-02", "junk.xml", "no payload at all")
    land(root, "2024-01-03", "none.xml", "<ValuteData></ValuteData>")
    land(root, "2024-01-03", "empty.xml", "")
    rows = payloads.daily_checked(payloads.read_daily_valutes(spark, root)).collect()
    got = sorted((r.reason or "", r.currency_code or "", r.rate_date) for r in rows)
    assert got == [("", "AAA", D(2024, 1, 2)), ("", "BBB", D(2024, 1, 2)), ("", "CCC", D(2024, 1, 2))] + [("bad_document", "", D(2024, 1, 2))] * 2
    texts = sorted(r.original.strip() for r in rows if r.reason)
    assert texts[1] == "no payload at all" and texts[0].endswith("<Vname>n</Vna") and "CCC" in texts[0]
    assert sorted(r.currency_code for r in payloads.read_daily_xml(spark, root).collect()) == ["AAA", "BBB", "CCC"]
    # counting reasons alone needs no other column of the files
    assert {r.reason: r.rows for r in validate.reason_counts(payloads.daily_checked(payloads.read_daily_valutes(spark, root))).collect()} == {"valid": 3, "bad_document": 2}


def test_daily_documents_in_a_column(spark):
    docs = spark.createDataFrame([(D(2024, 1, 2), doc("AAA", "BBB")), (D(2024, 1, 3), None), (D(2024, 1, 4), "<ValuteData><Valute"), (D(2024, 1, 5), "<ValuteData/>"), (D(2024, 1, 6), "")],
                                 "rate_date date, doc string")
    rows = payloads.daily_checked(payloads.parse_daily_valutes(docs)).collect()
    got = sorted((r.rate_date, r.currency_code, r.reason, r.original) for r in rows)
    assert got == [(D(2024, 1, 2), "AAA", None, None), (D(2024, 1, 2), "BBB", None, None), (D(2024, 1, 3), None, "bad_document", ""),
                   (D(2024, 1, 4), None, "bad_document", "<ValuteData><Valute"), (D(2024, 1, 6), None, "bad_document", "")]
    assert payloads.parse_daily_xml(docs).count() == 2


MONTHLY = ['{"RawData":[{"element_id":1,"date":"2024-01-01","obs_val":"1.5","dt":"x"}],"headerData":[{"id":1,"elname":"Евро к рублю"}]}',
           None, '{"RawData":null,"headerData":[]}', '{"RawData":[{"element_id"', "[]", '{"RawData":[],"headerData":[]}', '{"headerData":[]}']


def test_monthly_documents_give_one_reject_each(spark, tmp_path):
    rows = payloads.monthly_checked(payloads.parse_monthly_json(spark.createDataFrame([(d,) for d in MONTHLY], "doc string"))).collect()
    bad = sorted(r.original for r in rows if r.reason == "bad_document")
    assert bad == sorted([MONTHLY[1] or "", MONTHLY[2], MONTHLY[3], MONTHLY[4], MONTHLY[6]])
    assert [(r.currency_code, r.rate_date) for r in rows if r.reason is None] == [("EUR", D(2024, 1, 1))] and len(rows) == 6
    for k, text in enumerate(MONTHLY):
        if text is not None:
            (tmp_path / f"{k}.json").write_text(text)
    files = payloads.monthly_checked(payloads.read_monthly_json(spark, str(tmp_path)))
    counts = {r["reason"]: r["n"] for r in files.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert counts == {None: 1, "bad_document": 3}  # an array of no documents in a file is no document
    assert MONTHLY[3] in [r.original for r in files.collect()]


def test_run_daily_counts_all_input(spark, tmp_path):
    root = str(tmp_path)
    land(f"{root}/daily", "2024-01-09", "a.xml", doc("AAA", "TOOLONG"))
    land(f"{root}/daily", "2024-01-09", "b.xml", "<ValuteData><ValuteCursOnDate><Vcurs>")
    os.makedirs(f"{root}/monthly")
    for k, text in enumerate([MONTHLY[0], MONTHLY[0].replace("2024", "1999"), MONTHLY[3]]):
        (tmp_path / "monthly" / f"{k}.json").write_text(text)
    out = jobs.run_daily(spark, f"{root}/daily", f"{root}/monthly", raw_table(spark), AS_OF, rejects_path=f"{root}/rejects")
    assert out["totals"] == {"daily": 1, "monthly": 1, "total": 2} and out["outside_years"] == 1
    assert out["rejected"] == {"code_too_long": 1, "bad_document": 2}


@pytest.fixture
def period(spark):
    root, raw = shared_dir(spark, "period_test"), raw_table(spark)
    for day in range(1, 6):  # Monday the first to Friday; Thursday has no file, Saturday has one
        if day != 4:
            land(f"{root}/landing", f"2024-01-0{day}", "a.xml", doc("AAA", "BBB"))
    land(f"{root}/landing", "2024-01-06", "a.xml", doc("AAA"))
    land(f"{root}/landing", "2024-01-03", "b.xml", "<ValuteData><ValuteCursOnDate><Vname>")

    def load(**how):
        out = jobs.load_landed_period(spark, f"{root}/landing", raw, f"{root}/manifest", "2024-01-01", "2024-01-07",
                                      how.pop("as_of", AS_OF), today="2024-02-01", **{"skip_weekends": True, "load_type": "daily_only", **how})
        return out, {r.rate_date.day: r.status for r in out["day_status"].collect()}

    load.raw = raw
    return root, load


def test_period_load_reads_unfinished_days_only(spark, period):
    root, load = period
    out, days = load()
    assert out["read_days"] == 5 and (out["inserted"], out["updated"]) == (8, 0)
    assert days == {1: "done", 2: "done", 3: "failed", 4: "failed", 5: "done", 6: "skipped", 7: "skipped"}
    assert [r.reason for r in out["rejected"].collect()] == ["bad_document"]
    assert out["summary"].first().asDict() == {"successful_days": 3, "failed_days": 2, "skipped_days": 2, "total_rows": 8}
    # the missing day arrives and the broken one is mended: only those two are read
    land(f"{root}/landing", "2024-01-04", "a.xml", doc("AAA"))
    os.remove(f"{root}/landing/rate_date=2024-01-03/b.xml")
    land(f"{root}/landing", "2024-01-02", "late.xml", doc("ZZZ"))
    out, days = load(as_of=AS_OF + dt.timedelta(days=1))
    assert out["read_days"] == 2 and (out["inserted"], out["updated"]) == (1, 2) and out["rejected"].count() == 0
    assert set(days.values()) == {"done", "skipped"}
    # nothing is left: no day is read, nothing changes
    out, days = load(as_of=AS_OF + dt.timedelta(days=2))
    assert (out["read_days"], out["inserted"], out["updated"]) == (0, 0, 0) and out["report"].first().records_loaded == 9
    # the weekend alone is left for a load with weekends
    out, days = load(as_of=AS_OF + dt.timedelta(days=3), skip_weekends=False)
    assert out["read_days"] == 2 and out["inserted"] == 1 and days[6] == "done" and days[7] == "failed"


def test_period_load_cut_off_before_its_manifest(spark, period, monkeypatch):
    root, load = period
    real = jobs.upsert_into

    def cut(*a, **k):
        real(*a, **k)
        raise RuntimeError("cut off")

    monkeypatch.setattr(jobs, "upsert_into", cut)
    with pytest.raises(RuntimeError, match="cut off"):
        load()
    monkeypatch.setattr(jobs, "upsert_into", real)
    out, days = load(as_of=AS_OF + dt.timedelta(days=1))
    assert out["read_days"] == 5 and (out["inserted"], out["updated"]) == (0, 8)
    assert read_raw(spark, load.raw).count() == 8 and days[1] == "done"


def test_period_load_takes_monthly_rows_too(spark, period, tmp_path):
    root, load = period
    for k, text in enumerate([MONTHLY[0], MONTHLY[0].replace("2024", "2023"), MONTHLY[3]]):
        (tmp_path / f"{k}.json").write_text(text)
    out, _ = load(monthly_json=str(tmp_path), load_type="both")
    assert out["inserted"] == 9 and sorted(r.reason for r in out["rejected"].collect()) == ["bad_document", "bad_document"]
    only, _ = load(monthly_json=str(tmp_path), load_type="monthly_only", as_of=AS_OF + dt.timedelta(days=1))
    assert (only["inserted"], only["updated"]) == (0, 1)
    with pytest.raises(ValueError):
        load(load_type="some")
