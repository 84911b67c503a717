"""Record validation before load: parse, normalise, and give every rejected row a reason.

Rules, checked in this order (the first failing one is the reason):

* code and name are trimmed; NULL or empty -> ``empty_code`` / ``empty_name``; longer than the table's
  columns (``max_code`` and 100 characters) -> ``code_too_long`` / ``name_too_long``; with ``strict`` also a code that is
  not three capital letters -> ``bad_code``;
* rate: a plain decimal number (sign, digits, point, exponent) parsed as a double; NULL, unparsable, NaN or infinite -> ``bad_rate``;
  <= 0 -> ``non_positive_rate``; not representable as DECIMAL(12,6) -> ``rate_overflow``;
* date: ``yyyy-M-d`` text (one- or two-digit month and day); else ``bad_date``;
* type: lower-cased but not trimmed, NULL -> daily, anything but daily / monthly is coerced to daily;
* nominal: NULL -> 1; not an integer text -> ``bad_nominal``; <= 0 -> ``non_positive_nominal``.

A rejected row keeps its fields as they came, joined by ``|``, in ``original``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import RATE_TYPES

# Reason names, in rule order.
REASONS = ("empty_code", "code_too_long", "bad_code", "empty_name", "name_too_long", "bad_rate", "non_positive_rate", "rate_overflow",
           "bad_date", "bad_nominal", "non_positive_nominal")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
PLAIN_DAY = r"\A[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}\z"
MAX_CODE, MAX_NAME = 3, 100
# The table constraints of the raw store.
CODE_PATTERN = "^[A-Z]{3}$"
FIELDS = ("currency_code", "currency_name", "exchange_rate", "rate_date", "rate_type", "nominal")


def day_of(records: DataFrame) -> Column:
    """The record's date; NULL if it cannot be read."""
    if records.schema["rate_date"].dataType != T.StringType():
        return F.col("rate_date").cast("date")
    text = _text("rate_date")  # a year of four digits casts to the same date at a tenth of the formatter's time
    return F.when(text.rlike(PLAIN_DAY), text.try_cast(T.DateType())).otherwise(F.try_to_date(text, "yyyy-M-d"))


def parsed(records: DataFrame, strict: bool = False, max_code: int = MAX_CODE) -> DataFrame:
    """Input columns replaced by their parsed values, plus ``reason`` (NULL = valid) and ``original``.

    The casts run once in a projection and the reason chain reads their results. The whole record then goes through a
    generator of one row: no filter on ``reason`` is pushed below it, which would put every cast into the filter again, once
    for each of its uses (17 KB of text for :func:`valid`, and the more for each read of the result)."""
    is_text = lambda c: records.schema[c].dataType == T.StringType()
    rate_d = F.when(F.col("exchange_rate").rlike(NUMBER), F.expr("try_cast(exchange_rate AS DOUBLE)")) if is_text("exchange_rate") \
        else F.col("exchange_rate").cast("double")
    day = day_of(records)
    rtype = F.lower(_text("rate_type"))
    extra = [c for c in records.columns if c not in FIELDS]
    step1 = records.select(
        *extra, F.concat_ws("|", *[F.coalesce(_text(c), F.lit("")) for c in FIELDS]).alias("_original"),
        F.trim(_text("currency_code")).alias("currency_code"),
        F.trim(_text("currency_name")).alias("currency_name"),
        rate_d.alias("_rate"), day.alias("rate_date"),
        F.when(rtype.isin(*RATE_TYPES), rtype).otherwise(F.lit("daily")).alias("rate_type"),
        F.trim(_text("nominal")).alias("_nom_txt"))
    step1 = step1.select("*", F.col("_nom_txt").try_cast(T.IntegerType()).alias("_nom"),
                         F.col("_rate").try_cast(T.DecimalType(12, 6)).alias("exchange_rate"))
    code, name, rate, nom = F.col("currency_code"), F.col("currency_name"), F.col("_rate"), F.col("_nom")
    reason = (F.when(code.isNull() | (code == F.lit("")), F.lit("empty_code"))
              .when(F.length(code) > max_code, F.lit("code_too_long"))
              .when(F.lit(strict) & ~code.rlike(CODE_PATTERN), F.lit("bad_code"))
              .when(name.isNull() | (name == F.lit("")), F.lit("empty_name"))
              .when(F.length(name) > MAX_NAME, F.lit("name_too_long"))
              .when(rate.isNull() | F.isnan(rate) | (F.abs(rate) == F.lit(float("inf"))), F.lit("bad_rate"))
              .when(rate <= F.lit(0.0), F.lit("non_positive_rate"))
              .when(F.col("exchange_rate").isNull(), F.lit("rate_overflow"))
              .when(F.col("rate_date").isNull(), F.lit("bad_date"))
              .when(F.col("_nom_txt").isNotNull() & nom.isNull(), F.lit("bad_nominal"))
              .when(F.coalesce(nom, F.lit(1)) <= F.lit(0), F.lit("non_positive_nominal")))
    record = F.struct(
        *extra, "currency_code", "currency_name", "exchange_rate", "rate_date", "rate_type",
        F.coalesce(nom, F.lit(1)).alias("nominal"), reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("_original")).alias("original"))
    return step1.select(F.explode(F.array(record)).alias("_record")).select("_record.*")


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNull()).drop("reason", "original")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull())


def reason_counts(checked: DataFrame) -> DataFrame:
    return (checked.groupBy(F.coalesce(F.col("reason"), F.lit("valid")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def constraint_violations(raw: DataFrame) -> DataFrame:
    """Rows breaking each table rule (code pattern, rate > 0, known type, name length)."""
    rules = {
        "code_pattern": ~F.col("currency_code").rlike(CODE_PATTERN),
        "rate_positive": ~(F.col("exchange_rate") > F.lit(0)),
        "rate_type_known": ~F.col("rate_type").isin(*RATE_TYPES),
        "code_length": F.length("currency_code") > F.lit(3),
        "name_length": F.length("currency_name") > F.lit(100),
    }
    counts = raw.agg(*[F.count_if(F.coalesce(cond, F.lit(True))).alias(k) for k, cond in rules.items()])
    stack = "stack({n}, {pairs}) AS (rule, violations)".format(
        n=len(rules), pairs=", ".join(f"'{k}', `{k}`" for k in rules))
    return counts.select(F.expr(stack))
