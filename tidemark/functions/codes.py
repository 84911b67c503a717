"""Entity code from a (Russian) entity name, as one column expression -- no Python UDF.

Order of the rules: the first dictionary fragment contained in the name; else the first
run of three Latin letters, upper-cased; else the first three characters upper-cased,
through a rough transliteration table when listed there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name fragment -> code, checked in this order.
NAME_FRAGMENTS = (
    ("Доллара США", "USD"),
    ("Евро", "EUR"),
    ("Юаня", "CNY"),
    ("Фунта стерлингов", "GBP"),
    ("Йены", "JPY"),
    ("Франка", "CHF"),
    ("Казахстанского тенге", "KZT"),
    ("Белорусского рубля", "BYN"),
    ("Гривны", "UAH"),
    ("Лари", "GEL"),
)

# First three characters (upper-cased) -> transliteration.
PREFIX_TRANSLIT = (
    ("ДОЛ", "DOL"),
    ("ЕВР", "EUR"),
    ("ЮАН", "UAN"),
    ("ФУН", "FUN"),
    ("ЙЕН", "YEN"),
    ("ФРА", "FRA"),
)

LATIN3 = "[A-Za-z]{3}"


def _chain(pairs, test):
    expr = None
    for key, code in pairs:
        cond = test(key)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def code_from_name(name: Column | str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    by_fragment = _chain(NAME_FRAGMENTS, lambda frag: name.contains(frag))
    latin = F.regexp_extract(name, LATIN3, 0)
    first3 = F.upper(F.substring(name, 1, 3))
    translit = _chain(PREFIX_TRANSLIT, lambda pre: first3 == F.lit(pre)).otherwise(first3)
    return F.coalesce(by_fragment, F.when(latin != F.lit(""), F.upper(latin)), translit)
