import json
import os

from pyspark.sql import functions as F

from conftest import D
from tidemark.functions import calendar as cal
from tidemark.functions.codes import code_from_name
from tidemark.session import shared_dir
from tidemark.sources import payloads


def test_code_from_name_rules(spark):
    names = ["Доллара США к рублю", "Евро к рублю", "Юаня к рублю", "Some XYZ coin", "Йены", "Фунт", "Рупия"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["c"] for r in df.select(code_from_name("n").alias("c")).collect()]
    assert got == ["USD", "EUR", "CNY", "SOM", "JPY", "FUN", "РУП"]


def test_weekend_calendar(spark):
    days = [r["rate_date"] for r in cal.calendar(spark, "2024-01-05", "2024-01-08", skip_weekends=True).collect()]
    assert days == [D(2024, 1, 5), D(2024, 1, 8)]
    assert cal.calendar(spark, "2024-01-05", "2024-01-08").count() == 4


def test_period_checks():
    info = cal.check_period("2024-01-01", "2025-03-01", today="2025-06-01")
    assert info["days_count"] == 426 and info["long_period"]
    for a, b in (("2024-02-01", "2024-01-01"), ("2024-01-01", "2030-01-01")):
        try:
            cal.check_period(a, b, today="2025-06-01")
            raise AssertionError("expected ValueError")
        except ValueError:
            pass


def test_day_status(spark):
    rows = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 5),)], "rate_date date")
    st = {r["rate_date"]: (r["rows"], r["status"]) for r in
          cal.day_status(spark, rows, "2024-01-05", "2024-01-08", skip_weekends=True).collect()}
    assert st[D(2024, 1, 5)] == (2, "loaded") and st[D(2024, 1, 6)] == (0, "skipped")
    assert st[D(2024, 1, 8)] == (0, "missing")


SOAP = """<?xml version="1.0" encoding="utf-8"?>
<soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/"><soap:Body>
<GetCursOnDateXMLResponse><GetCursOnDateXMLResult><ValuteData>
<ValuteCursOnDate><Vname>Доллар США   </Vname><Vnom>1</Vnom><Vcurs>91.1234</Vcurs><Vcode>840</Vcode><VchCode>USD</VchCode><VunitRate>91.1234</VunitRate></ValuteCursOnDate>
<ValuteCursOnDate><Vname>Иены</Vname><Vnom>100</Vnom><Vcurs>60.5</Vcurs><Vcode>392</Vcode><VchCode>JPY </VchCode><VunitRate>0.605</VunitRate></ValuteCursOnDate>
</ValuteData></GetCursOnDateXMLResult></GetCursOnDateXMLResponse></soap:Body></soap:Envelope>"""


def test_daily_xml_files(spark):
    root = shared_dir(spark, "test-xml")
    os.makedirs(f"{root}/rate_date=2024-12-30")
    with open(f"{root}/rate_date=2024-12-30/payload.xml", "w") as f:
        f.write(SOAP)
    out = {r["currency_code"]: r for r in payloads.read_daily_xml(spark, root).collect()}
    assert set(out) == {"USD", "JPY"}
    assert out["USD"]["currency_name"] == "Доллар США" and out["USD"]["rate_date"] == D(2024, 12, 30)
    assert out["JPY"]["nominal"] == 100 and out["JPY"]["unit_rate"] == 0.605
    assert out["USD"]["source"] == payloads.SOURCE_TAG


def test_catalogue_missing_char_code(spark):
    el = ["<EnumValutes><Vname> Евро </Vname><Vnom>1</Vnom><Vcode>R01239</Vcode><VEngname>Euro</VEngname>"
          "<VcommonCode>R01239</VcommonCode><VnumCode>978</VnumCode><VcharCode>EUR</VcharCode></EnumValutes>",
          "<EnumValutes><Vname>Old</Vname><Vnom>1</Vnom><Vcode>R1</Vcode></EnumValutes>"]
    out = payloads.parse_catalogue_xml(spark.createDataFrame([(e,) for e in el], "doc string")).collect()
    assert out[0]["vname"] == "Евро" and out[0]["vcharcode"] == "EUR"
    assert out[1]["vcharcode"] == ""


def test_monthly_json_file(spark):
    doc = {"RawData": [
        {"element_id": 1, "date": "2024-02-01T00:00:00", "obs_val": "90.9999", "dt": "Feb 2024"},
        {"element_id": 7, "date": "2024-02-01T00:00:00", "obs_val": "1", "dt": ""},
        {"element_id": 1, "date": "bad", "obs_val": "1", "dt": ""},
        {"element_id": 2, "date": "2024-3-1", "obs_val": "x", "dt": ""},
        {"element_id": 2, "date": "2023-3-1", "obs_val": "98.5", "dt": "Mar 2023"}],
        "headerData": [{"id": 1, "elname": "Доллара США к рублю"}, {"id": 2, "elname": "Евро к рублю"}],
        "units": [], "DTRange": [], "SType": []}
    root = shared_dir(spark, "test-json")
    os.makedirs(root)
    with open(f"{root}/m.json", "w") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    docs = payloads.read_monthly_json(spark, root)
    chk = payloads.monthly_checked(docs)
    reasons = sorted(r["reason"] for r in chk.filter(F.col("reason").isNotNull()).collect())
    assert reasons == ["bad_date", "bad_value", "unknown_element"]
    ok = payloads.normalise_monthly(docs).orderBy("rate_date").collect()
    assert [(r["currency_code"], r["rate_date"]) for r in ok] == [("EUR", D(2023, 3, 1)), ("USD", D(2024, 2, 1))]
    assert payloads.normalise_monthly(docs, 2024, 2024).count() == 1
