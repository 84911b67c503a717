"""Operator 8, personal data: patterns propose, checksums confirm, context adjusts the score
(DataFrame functions only, no shuffle).

Base kinds are email, ip, card (Luhn) and phone; the method adds iban (mod 97). A pattern's
matches are leftmost and do not overlap within their kind; matches that fail their check are
dropped without a retry. Positions are code points, the end exclusive: a text is split at the
matches, and lengths of pieces and matches are summed up.

The score starts at the kind's own value and rises when a context word of the kind stands, as a whole word, within
``CONTEXT`` code points before or after the span. Base spans are reported whatever their score; the
added ones only from ``MIN_SCORE`` on. An account number has its country's length, so capitals behind it are not taken in;
one written neither as a whole nor in groups of four is reported only next to a context word.

The patterns are written for a backtracking matcher: possessive loops, and runs tried only from
their start, so that a long run of digits or letters costs linear time and no stack.

Defined results: null text counts as empty and has no spans; repeated rows get equal spans; extra
columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_replaced

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
CONTEXT = 40
MIN_SCORE = 0.5

#: fixed values: the countries by the length of their account numbers, as the public registry of ISO 13616 has them
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HU LB NI PL SV", 29: "BR PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}

_LOCAL = "A-Za-z0-9._%+-"
#: the same matches as the plain patterns: a run is entered at its start, or where the last match ended
PATTERNS = {
    "email": rf"[{_LOCAL}](?:(?<![{_LOCAL}][{_LOCAL}])|(?<=\G[{_LOCAL}]))[{_LOCAL}]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(
        rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_COUNTRIES.items()) + r")(?![A-Za-z0-9_])",
}
GROUPED = r"^[A-Z0-9]+$|^(?:[A-Z0-9]{4}\x20)+[A-Z0-9]{1,4}$"
#: a text without this string cannot match
NEEDS = {"email": "@", "phone": "+", "ip": "."}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8}
UNGROUPED_SCORE = 0.45
BONUS = 0.1
WORDS = {
    "email": "e-?mails?|mails?|mailto|contact|write", "ip": "ip|address|addresses|servers?|hosts?", "card": "cards?|credit|visa|payments?",
    "phone": "phones?|telephones?|tel|call|mobile|fax", "iban": "iban|banks?|accounts?|transfers?",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(text)), lambda i: F.substr(text, i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """Whether a non-empty string of digits passes the Luhn check."""
    def add(acc: Column, x: Column) -> Column:
        v = F.when(x["even"], x["d"] * 2).otherwise(x["d"])
        return acc + F.when(v > 9, v - 9).otherwise(v)

    values = F.transform(_chars(F.reverse(digits)), lambda c, i: F.struct(c.cast("int").alias("d"), (i % 2 == 1).alias("even")))
    return F.aggregate(values, F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (capital letters and digits) has remainder 1 modulo 97."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    values = F.transform(_chars(moved), lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, r"[\x20-]", "")
        return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def _near(before: Column, after: Column) -> Column:
    """The text around a span in small letters, without words that the window's edge cuts."""
    wide = CONTEXT + 1
    left = F.when(F.char_length(before) > CONTEXT, F.regexp_replace(F.right(before, F.lit(wide)), "^[A-Za-z0-9_]+", "")).otherwise(before)
    right = F.when(F.char_length(after) > CONTEXT, F.regexp_replace(F.left(after, F.lit(wide)), r"[A-Za-z0-9_]+\z", "")).otherwise(after)
    return F.lower(F.concat(left, F.lit(" "), right))


def _spans(kind: str, text: Column, found: Column) -> Column:
    """array<struct<start, order, end, kind, value, score>> of one kind's matches that hold.

    Positions are sums of lengths. They are summed in blocks of about the square root of the number of matches, as a fold
    copies what it has gathered with every match."""
    pieces = F.split(text, PATTERNS[kind], -1)
    parts = F.arrays_zip(F.transform(found, lambda m: m).alias("m"),
                         F.slice(pieces, 1, F.size(found)).alias("before"),
                         F.slice(pieces, 2, F.size(found)).alias("after"))
    block = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(found))).cast("int"))
    last = F.floor((F.size(found) - 1) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(parts, k * block + 1, block))
    size_of = lambda x: F.char_length(x["before"]) + F.char_length(x["m"])
    sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + size_of(x)))
    starts = F.aggregate(sizes, F.expr("struct(0 as at, cast(array() as array<int>) as out)"),
                         lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    none = F.expr("cast(array() as array<struct<start:int,m:string,around:string>>)")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["before"])
        one = F.struct(start.alias("start"), x["m"].alias("m"), _near(x["before"], x["after"]).alias("around"))
        return F.struct((start + F.char_length(x["m"])).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    placed = F.flatten(F.zip_with(blocks, starts, lambda b, at: F.aggregate(
        b, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])))
    held = F.filter(placed, lambda x: _valid(kind, x["m"]))
    own = lambda m: F.lit(SCORES[kind]) if kind != "iban" else F.when(m.rlike(GROUPED), SCORES[kind]).otherwise(UNGROUPED_SCORE)
    words = rf"(?:^|[^a-z0-9_])(?:{WORDS[kind]})(?:\z|[^a-z0-9_])"
    spans = F.transform(held, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"),
        (x["start"] + F.char_length(x["m"])).alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"),
        F.round(own(x["m"]) + F.when(x["around"].rlike(words), BONUS).otherwise(0.0), 2).alias("score")))
    if kind in BASE:
        return spans
    return F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


_EMPTY = "cast(array() as array<struct<start:int,order:int,end:int,kind:string,value:string,score:double>>)"


def find_pii(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array<struct<start, order, end, kind, value, score>> by start and kind."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    none = F.expr("cast(array() as array<string>)")
    found = {}
    for kind in KINDS:
        all_of = F.regexp_extract_all(F.col("t"), F.lit(PATTERNS[kind]), F.lit(0))
        found[kind] = F.when(F.contains(F.col("t"), F.lit(NEEDS[kind])), all_of).otherwise(none) if kind in NEEDS else all_of
    rows = rows.select("*", *[v.alias(f"m_{k}") for k, v in found.items()])
    each = [F.when(F.size(f"m_{k}") > 0, _spans(k, F.col("t"), F.col(f"m_{k}"))).otherwise(F.expr(_EMPTY)) for k in KINDS]
    rows = rows.select("kept", F.array_sort(F.concat(*each)).alias("__spans")).select("kept.*", "__spans")
    return with_replaced(rows, {"spans": F.col("__spans")}).drop("__spans")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, *, text: str = "text", mask: str = "[{kind}]") -> DataFrame:
    """``docs`` with every span of :func:`find_pii` replaced by its kind; of overlapping spans the first counts."""
    rows = find_pii(docs, text=text)
    start_of = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    source = F.col(f"`{text}`")

    def step(acc: Column, s: Column) -> Column:
        kept = F.substr(source, acc["at"] + 1, s["start"] - acc["at"])
        shown = F.concat(acc["out"], kept, F.replace(F.lit(mask), F.lit("{kind}"), s["kind"]))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), shown.alias("out"))).otherwise(acc)

    done = F.aggregate(F.col("spans"), start_of, step,
                       lambda acc: F.concat(acc["out"], F.substr(source, acc["at"] + 1)))
    return with_replaced(rows, {text: F.when(source.isNotNull(), done)})
