"""Monthly documents whose fields drift, read as VARIANT."""

import datetime as dt
from decimal import Decimal

from tidemark.sources import drifting, payloads

HEAD = '"headerData":[{"id":301,"elname":"Доллар США"},{"id":"302","elname":"Евро"}]'


def _docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def _rows(df):
    return {(r.reason, r.original): r for r in df.collect()}


def test_retyped_and_unknown_fields(spark):
    doc = '{"RawData":[%s],' + HEAD + ',"version":2}'
    items = ['{"element_id":301,"date":"2001-2-1","obs_val":"1.5","dt":"a"}',
             '{"element_id":"302","date":"2001-03-01T00:00:00","obs_val":2.25,"dt":"b","unit":"RUB","tags":[1,null]}',
             '{"element_id":301.0,"date":"2001-4-1","obs_val":3e0,"dt":7}']
    good = [r for r in drifting.drifting_checked(_docs(spark, doc % ",".join(items))).collect()]
    assert [r.reason for r in good] == [None] * 3 and [r.original for r in good] == [None] * 3
    assert [(r.element_id, r.rate_date, r.exchange_rate, r.period, r.extra) for r in good] == [
        (301, dt.date(2001, 2, 1), Decimal("1.500000"), "a", None),
        (302, dt.date(2001, 3, 1), Decimal("2.250000"), "b", '{"tags":[1,null],"unit":"RUB"}'),
        (301, dt.date(2001, 4, 1), Decimal("3.000000"), "7", None)]
    bad = ['{"element_id":true,"date":"2001-2-1","obs_val":"1"}', '{"element_id":301.5,"date":"2001-2-1","obs_val":"1"}', "7", "null",
           '{"date":20010201,"element_id":301,"obs_val":"1"}', '{"date":"2001-2-1","element_id":301,"obs_val":{"v":1}}',
           '{"date":"2001-2-1","element_id":301,"obs_val":false}', '{"date":"2001-2-1","element_id":301,"obs_val":1234567}',
           '{"date":"2001-2-1","element_id":301}', '{"date":["2001-2-1"],"element_id":301,"obs_val":1}']
    got = drifting.drifting_checked(_docs(spark, doc % ",".join(bad))).collect()
    assert [r.reason for r in got] == ["unknown_element"] * 4 + ["bad_date", "bad_value", "bad_value", "value_overflow", "bad_value", "bad_date"]
    assert got[5].original == '{"date":"2001-2-1","element_id":301,"obs_val":{"v":1}}' and got[2].original == "7"


def test_broken_documents_and_single_objects(spark):
    texts = ['{"RawData":[', None, "", "[1]", "3", '{"RawData":null}', '{"RawData":"x"}', '{"headerData":[]}', '{"a":1,"a":2}']
    got = drifting.drifting_checked(_docs(spark, *texts)).collect()
    assert [(r.reason, r.original) for r in got] == [("bad_document", t or "") for t in texts]
    one = '{"RawData":{"element_id":301,"date":"2001-2-1","obs_val":4},"headerData":{"id":301,"elname":"Евро"}}'
    assert [(r.reason, r.currency_code) for r in drifting.drifting_checked(_docs(spark, one, '{"RawData":[]}')).collect()] == [(None, "EUR")]
    no_heads = '{"RawData":[{"element_id":301,"date":"2001-2-1","obs_val":4}],"headerData":5}'
    assert drifting.drifting_checked(_docs(spark, no_heads)).first().reason == "unknown_element"
    assert drifting.drifting_checked(_docs(spark)).count() == 0 and drifting.drift_report(_docs(spark)).count() == 0


def test_equals_the_fixed_schema_without_drift(spark):
    doc = '{"RawData":[{"element_id":301,"date":"2001-2-1","obs_val":"1.5","dt":"a"},{"element_id":9,"date":"x","obs_val":"1"}],' + HEAD + "}"
    docs = _docs(spark, doc)
    fixed = payloads.monthly_checked(payloads.parse_monthly_json(docs)).drop("original")
    assert drifting.drifting_checked(docs).drop("original", "extra").collect() == fixed.collect()


def test_drift_report(spark):
    docs = _docs(spark, '{"RawData":[{"element_id":1,"x":true},{"element_id":"1","x":null},5],"headerData":{"id":1.5},"v":{}}', '{"RawData":3}', "{")
    got = {(r.level, r.field, r.type, r.known): r.rows for r in drifting.drift_report(docs).collect()}
    assert got == {("document", "RawData", "ARRAY", True): 1, ("document", "RawData", "BIGINT", True): 1, ("document", "headerData", "OBJECT", True): 1,
                   ("document", "v", "OBJECT", False): 1, ("document", "", "BAD_DOCUMENT", False): 2,
                   ("RawData", "element_id", "BIGINT", True): 1, ("RawData", "element_id", "STRING", True): 1,
                   ("RawData", "x", "BOOLEAN", False): 1, ("RawData", "x", "VOID", False): 1, ("headerData", "id", "DECIMAL", True): 1}
