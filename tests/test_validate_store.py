import contextlib
import datetime as dt
import io
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import D, raw_rows
from tidemark.operators import store, validate
from tidemark.schema import RECORD_SCHEMA


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def test_every_reason_and_coercions(spark):
    rows = [
        ("  ", "n", "1", "2024-01-05", "daily", "1"),          # empty_code
        (None, "n", "1", "2024-01-05", "daily", "1"),          # empty_code (NULL)
        ("USD", " ", "1", "2024-01-05", "daily", "1"),         # empty_name
        ("USD", "n", "abc", "2024-01-05", "daily", "1"),       # bad_rate
        ("USD", "n", "NaN", "2024-01-05", "daily", "1"),       # bad_rate
        ("USD", "n", "inf", "2024-01-05", "daily", "1"),       # bad_rate
        ("USD", "n", "-1.5", "2024-01-05", "daily", "1"),      # non_positive_rate
        ("USD", "n", "0", "2024-01-05", "daily", "1"),         # non_positive_rate
        ("USD", "n", "1234567.5", "2024-01-05", "daily", "1"), # rate_overflow
        ("USD", "n", "1", "05.01.2024", "daily", "1"),         # bad_date
        ("USD", "n", "1", "2024-01-05", "daily", "1.9"),       # bad_nominal
        ("USD", "n", "1", "2024-01-05", "daily", "0"),         # non_positive_nominal
        (" USD ", " Dollar ", "91.1234", "2024-1-5", "Weekly", None),   # valid, coerced
        ("EUR", "Euro", "98.5678", "2024-01-15", "MONTHLY", " 10 "),   # valid
    ]
    out = validate.parsed(records(spark, rows)).collect()
    reasons = [r["reason"] for r in out]
    assert reasons[:12] == ["empty_code", "empty_code", "empty_name", "bad_rate", "bad_rate", "bad_rate",
                            "non_positive_rate", "non_positive_rate", "rate_overflow", "bad_date",
                            "bad_nominal", "non_positive_nominal"]
    a, b = out[12], out[13]
    assert a["reason"] is None and a["currency_code"] == "USD" and a["currency_name"] == "Dollar"
    assert a["rate_date"] == D(2024, 1, 5) and a["rate_type"] == "daily" and a["nominal"] == 1
    assert a["exchange_rate"] == Decimal("91.123400")
    assert b["reason"] is None and b["rate_type"] == "monthly" and b["nominal"] == 10
    more = validate.parsed(records(spark, [("USDX", "n", "1", "2024-01-05", "daily", "1"), ("USD", "n" * 101, "1", "2024-01-05", " MONTHLY ", "1"),
                                           ("USD", "n", "91.5d", "xx", "daily", "1"), ("usd", "n", "1", "2024-01-05", " MONTHLY ", "1")])).collect()
    assert [r["reason"] for r in more] == ["code_too_long", "name_too_long", "bad_rate", None]
    assert more[2]["original"] == "USD|n|91.5d|xx|daily|1" and more[3]["original"] is None and more[3]["rate_type"] == "daily"
    strict = validate.parsed(records(spark, [("usd", "n", "1", "2024-01-05", "daily", "1")]), strict=True).first()
    assert strict["reason"] == "bad_code"
    assert set(validate.REASONS) <= {*reasons, *(r["reason"] for r in more), "bad_code"}


def test_valid_plus_rejected_is_input(spark):
    rows = [("A", "a", str(i), "2024-01-%02d" % (1 + i % 28), None, None) for i in range(-5, 40)]
    chk = validate.parsed(records(spark, rows))
    assert validate.valid(chk).count() + validate.rejected(chk).count() == len(rows)


def test_upsert_last_wins_and_sets_load_time(spark):
    t0 = dt.datetime(2024, 1, 1, 18)
    target = raw_rows(spark, [("USD", D(2024, 1, 1), 90, "daily", 1, "old", t0),
                              ("EUR", D(2024, 1, 1), 99, "daily", 1, "eur", t0)])
    batch = raw_rows(spark, [("USD", D(2024, 1, 1), 1, "daily", 10, "new"),
                             ("USD", D(2024, 1, 1), 2, "daily", 10, "newer"),
                             ("CNY", D(2024, 1, 1), 12, "daily")]).drop("load_timestamp") \
        .withColumn("seq", F.monotonically_increasing_id())
    as_of = dt.datetime(2024, 1, 2, 18)
    out = {r["currency_code"]: r for r in store.upsert(target, batch, as_of, seq="seq").collect()}
    assert len(out) == 3
    assert out["USD"]["exchange_rate"] == Decimal("2.000000") and out["USD"]["currency_name"] == "newer"
    assert out["USD"]["nominal"] == 10 and out["USD"]["load_timestamp"] == as_of
    assert out["EUR"]["load_timestamp"] == t0 and out["CNY"]["load_timestamp"] == as_of
    counts = store.upsert_counts(target, batch).first()
    assert (counts["inserted"], counts["updated"]) == (1, 1)


def test_upsert_is_idempotent(spark):
    target = raw_rows(spark, [("USD", D(2024, 1, 1), 90)])
    batch = raw_rows(spark, [("USD", D(2024, 1, 1), 91), ("EUR", D(2024, 1, 2), 99)]).drop("load_timestamp")
    as_of = dt.datetime(2024, 1, 3)
    once = store.upsert(target, batch, as_of)
    twice = store.upsert(once, batch, as_of)
    assert once.exceptAll(twice).count() == 0 and twice.count() == 2


def test_insert_ignore_keeps_existing(spark):
    t0 = dt.datetime(2024, 1, 1, 18)
    target = raw_rows(spark, [("USD", D(2024, 1, 1), 90, "daily", 1, "x", t0)])
    batch = raw_rows(spark, [("USD", D(2024, 1, 1), 95), ("EUR", D(2024, 1, 1), 99),
                             ("EUR", D(2024, 1, 1), 100)]).withColumn("seq", F.monotonically_increasing_id())
    new = store.insert_ignore(target, batch, seq="seq").collect()
    assert len(new) == 1 and new[0]["currency_code"] == "EUR" and new[0]["exchange_rate"] == Decimal("99.000000")
    full = {r["currency_code"]: r for r in store.insert_ignore_table(target, batch, seq="seq").collect()}
    assert full["USD"]["exchange_rate"] == Decimal("90.000000")


def test_dimension_sync_one_name_per_code(spark):
    t = dt.datetime(2024, 1, 1, 18)
    raw = raw_rows(spark, [("USD", D(2024, 1, 1), 90, "daily", 1, "Dollar", t),
                           ("USD", D(2024, 1, 1), 91, "monthly", 1, "Dollar to ruble", t + dt.timedelta(days=1)),
                           ("EUR", D(2024, 1, 2), 99, "daily", 1, "Euro", t)])
    dim = store.init_dimension(raw.filter(F.col("currency_code") == "USD").filter(F.col("rate_type") == "monthly"),
                               D(2023, 1, 1))
    out = {r["currency_code"]: r for r in store.sync_dimension(dim, raw, D(2024, 2, 1)).collect()}
    assert out["USD"]["currency_name"] == "Dollar"
    assert out["USD"]["first_seen"] == D(2023, 1, 1) and out["USD"]["last_seen"] == D(2024, 2, 1)
    assert out["EUR"]["first_seen"] == D(2024, 2, 1) and out["EUR"]["is_active"] is True
    by_data = {r["currency_code"]: r for r in store.sync_dimension(dim, raw, D(2024, 2, 1), dates_from_data=True).collect()}
    assert by_data["EUR"]["first_seen"] == D(2024, 1, 2)


def test_constraint_violations(spark):
    raw = raw_rows(spark, [("USD", D(2024, 1, 1), 1), ("usd1", D(2024, 1, 1), 1), ("EUR", D(2024, 1, 1), 1, "weekly")])
    out = {r["rule"]: r["violations"] for r in validate.constraint_violations(raw).collect()}
    assert out["code_pattern"] == 1 and out["rate_type_known"] == 1 and out["code_length"] == 1


def test_hot_key_upsert_is_combined_not_sorted_whole(spark):
    # one key with thousands of versions in the batch: the aggregate picks the last one
    target = raw_rows(spark, [("USD", D(2024, 1, 1), 90)])
    batch = (spark.range(0, 5000)
             .select(F.lit("USD").alias("currency_code"), F.lit("Dollar").alias("currency_name"),
                     (F.col("id") + 1).cast("decimal(12,6)").alias("exchange_rate"),
                     F.lit(D(2024, 1, 1)).alias("rate_date"), F.lit("daily").alias("rate_type"),
                     F.lit(1).alias("nominal"), F.col("id").alias("seq"))
             .repartition(8))
    out = store.upsert(target, batch, dt.datetime(2024, 1, 2), seq="seq").collect()
    assert len(out) == 1 and out[0]["exchange_rate"] == Decimal("5000.000000")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        store.upsert(target, batch, dt.datetime(2024, 1, 2), seq="seq").explain()
    assert "partial_max_by" in buf.getvalue()  # map-side combine before the shuffle


def _filters(df):
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in text.splitlines() if "Filter" in line]


def test_valid_filters_on_the_reason_alone(spark):
    """No cast and no pattern is pushed into the filter of the valid rows, and each runs once in the plan."""
    recs = spark.createDataFrame([("USD", "Dollar", "1.5", "2024-01-01", "daily", "1")], RECORD_SCHEMA)
    ok = validate.valid(validate.parsed(recs, strict=True))
    assert [f.split("Filter ")[1].split("#")[0] + f[f.rindex("."):] for f in _filters(ok)] == ["isnull(_record.reason)"]
    assert ok._jdf.queryExecution().optimizedPlan().toString().count("RLIKE(exchange_rate") == 1


def test_code_length_is_a_parameter(spark):
    recs = spark.createDataFrame([("ABCD", "n", "1.5", "2024-01-01", "daily", "1")], RECORD_SCHEMA)
    assert [r.reason for r in validate.parsed(recs).collect()] == ["code_too_long"]
    assert [r.reason for r in validate.parsed(recs, max_code=4).collect()] == [None]


def test_relation_stays_valid_beyond_three_letters(spark):
    """Nine of ten suppliers have a valid code however many there are."""
    from pyspark.sql import functions as F
    from tidemark.sources.tables import MAX_CODE, entity_code

    keys = spark.range(0, 1_700_000_000, 9_999_991).union(spark.range(17_000, 18_000)).withColumnRenamed("id", "k")
    codes = keys.select("k", entity_code("k").alias("code"))
    wrong = codes.where((F.length("code") > MAX_CODE) != (F.col("k") % 10 == 7)).count()
    assert wrong == 0 and codes.select("code").distinct().count() == codes.count()
