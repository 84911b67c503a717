"""Landed source payloads: daily XML (one document per date), the entity catalogue (XML)
and monthly JSON documents, read with Spark's built-in XML / JSON readers and normalised
with column expressions.

Files: ``read_daily_xml`` reads ``<dir>/rate_date=YYYY-MM-DD/*.xml`` with
rowTag ``ValuteCursOnDate`` (the date comes from the partition directory, as the request
date does in the original). ``read_monthly_json`` reads one JSON document per file.
Text columns: ``parse_daily_xml`` / ``parse_monthly_json`` take a string column holding a
whole document, for payloads that arrive as rows (queues, tables).

Broken documents are kept: what cannot be parsed, is null or lacks its array gives one row with its text in
``document``, which the checked forms (``daily_checked``, ``monthly_checked``) turn into a reject
``bad_document``. Elements before the break of an XML file are read as usual. A document whose array is empty, and a file
of no bytes, have no rows and no reject.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import as_date
from tidemark.functions.codes import code_from_name
from tidemark.functions.literals import date_lit
from tidemark.operators import validate

SOURCE_TAG = "soap_daily"

VALUTE = T.StructType([
    T.StructField("Vname", T.StringType()), T.StructField("Vnom", T.StringType()),
    T.StructField("Vcurs", T.StringType()), T.StructField("Vcode", T.StringType()),
    T.StructField("VchCode", T.StringType()), T.StructField("VunitRate", T.StringType()),
])
ENUM_VALUTE = T.StructType([
    T.StructField(c, T.StringType()) for c in
    ("Vname", "Vnom", "Vcode", "VEngname", "VcommonCode", "VnumCode", "VcharCode")
])
CORRUPT = T.StructField("_corrupt_record", T.StringType())  # Spark's column for text that does not parse
DAILY_DOC = T.StructType([T.StructField("ValuteCursOnDate", T.ArrayType(VALUTE)), CORRUPT])
RAW_ITEM = T.StructType([
    T.StructField("element_id", T.LongType()), T.StructField("date", T.StringType()),
    T.StructField("obs_val", T.StringType()), T.StructField("dt", T.StringType()),
])
HEADER_ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("elname", T.StringType())])
MONTHLY_DOC = T.StructType([
    T.StructField("RawData", T.ArrayType(RAW_ITEM)),
    T.StructField("headerData", T.ArrayType(HEADER_ITEM)),
    CORRUPT,
])
BAD_DOCUMENT = "bad_document"


# ---- daily XML --------------------------------------------------------------------

def whole(rows: DataFrame) -> DataFrame:
    """Without the rows that stand for broken documents."""
    return rows.filter(F.col("document").isNull()) if "document" in rows.columns else rows


def normalise_daily(valutes: DataFrame) -> DataFrame:
    """Rows with the ValuteCursOnDate fields and ``rate_date`` -> normalised records, without broken documents."""
    valutes = whole(valutes)
    # a missing nominal is 1; an unreadable one stays NULL here and is rejected by validation (daily_records)
    nominal = F.when(F.trim(F.coalesce(F.col("Vnom"), F.lit(""))) == "", F.lit(1)).otherwise(F.expr("try_cast(trim(Vnom) AS INT)"))
    return valutes.select(
        F.trim(F.coalesce(F.col("VchCode"), F.lit(""))).alias("currency_code"),
        F.trim(F.coalesce(F.col("Vname"), F.lit(""))).alias("currency_name"),
        F.expr("try_cast(try_cast(Vcurs AS DOUBLE) AS DECIMAL(12,6))").alias("exchange_rate"),
        F.col("rate_date").cast("date").alias("rate_date"),
        F.lit("daily").alias("rate_type"),
        nominal.alias("nominal"),
        F.expr("try_cast(VunitRate AS DOUBLE)").alias("unit_rate"),
        F.col("Vcode").alias("num_code"),
        F.trim(F.coalesce(F.col("VchCode"), F.lit(""))).alias("char_code"),
        F.lit(SOURCE_TAG).alias("source"),
    )


def daily_records(valutes: DataFrame) -> DataFrame:
    """The same fields as unparsed text (``schema.RECORD_SCHEMA``), for validation with reasons."""
    return valutes.select(
        F.col("VchCode").alias("currency_code"), F.col("Vname").alias("currency_name"), F.col("Vcurs").alias("exchange_rate"),
        F.col("rate_date").cast("string").alias("rate_date"), F.lit("daily").alias("rate_type"),
        F.when(F.trim("Vnom") != "", F.col("Vnom")).alias("nominal"),
        *[c for c in ("arrived", "file", "position", "document") if c in valutes.columns])


def daily_checked(valutes: DataFrame, strict: bool = False, max_code: int = validate.MAX_CODE) -> DataFrame:
    """Validated records (``validate.parsed``) of the elements; a broken document is one row with the reason
    ``bad_document`` and its text as ``original``."""
    checked = validate.parsed(daily_records(valutes), strict, max_code)
    broken = F.col("document").isNotNull()
    return checked.withColumns({
        "reason": F.when(broken, F.lit(BAD_DOCUMENT)).otherwise(F.col("reason")),
        "original": F.when(broken, F.col("document")).otherwise(F.col("original"))}).drop("document")


def read_daily_valutes(spark: SparkSession, path: str, start=None, end=None, days=None) -> DataFrame:
    """The elements of landed daily files, as text, with ``rate_date`` from the folder and the file's place in the
    order of arrival (``arrived``, ``file``, ``position``); ``document`` is the text of a broken file, else null. ``start`` and
    ``end`` (closed), or ``days``, a list of dates, choose the date folders; only those are listed and read."""
    schema = T.StructType([*VALUTE.fields, T.StructField("rate_date", T.DateType()), CORRUPT])
    rows = spark.read.format("xml").option("rowTag", "ValuteCursOnDate").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT.name).schema(schema)
    if days is None and start is not None and end is not None:
        days = [as_date(start) + dt.timedelta(days=k) for k in range((as_date(end) - as_date(start)).days + 1)]
    if days is None:
        rows = rows.load(path)
    else:
        folders = [f"{path.rstrip('/')}/rate_date={as_date(d).isoformat()}" for d in days]
        fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        there = [f for f in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]
        rows = rows.option("basePath", path).load(there) if there else spark.createDataFrame([], schema)
        if not there:
            return rows.select(*[f.name for f in VALUTE.fields], "rate_date", F.col(CORRUPT.name).alias("document"), F.lit(None).cast("timestamp").alias("arrived"),
                               F.lit("").alias("file"), F.lit(0).cast("long").alias("position"))
    if start is not None:
        rows = rows.filter(F.col("rate_date") >= date_lit(start))
    if end is not None:
        rows = rows.filter(F.col("rate_date") <= date_lit(end))
    # a broken file's row has no fields; a count must not read the text alone, which Spark refuses
    document = F.when(F.coalesce(*[f.name for f in VALUTE.fields]).isNull(), F.col(CORRUPT.name))
    return rows.select(*[f.name for f in VALUTE.fields], "rate_date", document.alias("document"), F.col("_metadata.file_modification_time").alias("arrived"),
                       F.col("_metadata.file_path").alias("file")).withColumn("position", F.monotonically_increasing_id())


def read_daily_xml(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    return normalise_daily(read_daily_valutes(spark, path, start, end))


def parse_daily_valutes(docs: DataFrame, doc_col: str = "doc", date_col: str = "rate_date") -> DataFrame:
    """The elements of documents held in a column; ``document`` is the text ('' for null) of one that does not parse.

    The parsed document goes through a generator of one row: a filter on ``document`` that is pushed down would parse it again, once
    for each of its uses."""
    parsed = docs.select(F.explode(F.array(F.struct(F.col(date_col).alias("rate_date"), F.col(doc_col).alias("_doc"),
                                                    F.from_xml(F.col(doc_col), DAILY_DOC).alias("p")))).alias("_parsed")).select("_parsed.*")
    broken = F.col("p").isNull() | F.col("p")[CORRUPT.name].isNotNull()
    return (parsed.select("rate_date", F.when(broken, F.coalesce("_doc", F.lit(""))).alias("document"), F.explode_outer("p.ValuteCursOnDate").alias("v"))
            .filter(F.col("document").isNotNull() | F.col("v").isNotNull())
            .select("rate_date", "v.*", "document"))


def parse_daily_xml(docs: DataFrame, doc_col: str = "doc", date_col: str = "rate_date") -> DataFrame:
    return normalise_daily(parse_daily_valutes(docs, doc_col, date_col))


def daily_documents(daily: DataFrame) -> DataFrame:
    """``<ValuteData>`` documents from raw daily rows, one element in each: nothing is collected, so
    a day of any size stays spread out."""
    el = F.to_xml(F.struct(
        F.col("currency_name").alias("Vname"), F.col("nominal").cast("string").alias("Vnom"),
        F.col("exchange_rate").cast("string").alias("Vcurs"),
        F.length("currency_code").cast("string").alias("Vcode"),
        F.col("currency_code").alias("VchCode"),
        (F.col("exchange_rate").cast("double") / F.col("nominal")).cast("string").alias("VunitRate"),
    ), {"rowTag": "ValuteCursOnDate"})
    return daily.select("rate_date", F.concat(F.lit("<ValuteData>"), el, F.lit("</ValuteData>")).alias("doc"))


def write_daily_xml(daily: DataFrame, path: str) -> None:
    """Land daily rows as XML files partitioned by date (one directory per date), compressed: markup takes most of their plain text."""
    (daily.select(F.col("currency_name").alias("Vname"), F.col("nominal").cast("string").alias("Vnom"),
                  F.col("exchange_rate").cast("string").alias("Vcurs"),
                  F.length("currency_code").cast("string").alias("Vcode"),
                  F.col("currency_code").alias("VchCode"),
                  (F.col("exchange_rate").cast("double") / F.col("nominal")).cast("string").alias("VunitRate"),
                  "rate_date")
     .repartition("rate_date")
     .write.format("xml").option("rowTag", "ValuteCursOnDate").option("rootTag", "ValuteData").option("compression", "gzip")
     .partitionBy("rate_date").mode("overwrite").save(path))


# ---- catalogue XML ----------------------------------------------------------------

def normalise_catalogue(items: DataFrame) -> DataFrame:
    """EnumValutes fields, trimmed; a missing VcharCode becomes ''."""
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    return items.select(
        t("Vname").alias("vname"),
        F.coalesce(F.expr("try_cast(trim(Vnom) AS INT)"), F.lit(1)).alias("vnom"),
        t("Vcode").alias("vcode"), t("VEngname").alias("vengname"),
        t("VcommonCode").alias("vcommoncode"), F.col("VnumCode").alias("vnumcode"),
        t("VcharCode").alias("vcharcode"))


def read_catalogue_xml(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "EnumValutes").schema(ENUM_VALUTE).load(path)
    return normalise_catalogue(raw)


def parse_catalogue_xml(elements: DataFrame, col: str = "doc") -> DataFrame:
    """One ``<EnumValutes>`` element per row."""
    return normalise_catalogue(elements.select(F.from_xml(F.col(col), ENUM_VALUTE).alias("p")).select("p.*"))


def catalogue_elements(raw: DataFrame) -> DataFrame:
    """Catalogue entries of the entities in ``raw``; VcharCode left out for codes of odd length."""
    # the names that differ first, by hash: a text as an aggregate's value makes Spark sort its rows. Their number keeps Spark from
    # taking the step out again, which it does with a plain distinct below a minimum
    names = raw.groupBy("currency_code", "currency_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    ents = names.groupBy("currency_code").agg(F.min("currency_name").alias("name"))
    return ents.select(F.to_xml(F.struct(
        F.concat(F.lit(" "), F.col("name"), F.lit(" ")).alias("Vname"),
        F.lit("1").alias("Vnom"),
        F.concat(F.lit("R"), F.col("currency_code")).alias("Vcode"),
        F.lower(F.col("name")).alias("VEngname"),
        F.col("currency_code").alias("VcommonCode"),
        F.length("currency_code").cast("string").alias("VnumCode"),
        F.when(F.length("currency_code") % 2 == 0, F.col("currency_code")).alias("VcharCode"),
    ), {"rowTag": "EnumValutes"}).alias("doc"))


# ---- monthly JSON -----------------------------------------------------------------

MONTHLY_REASONS = (BAD_DOCUMENT, "unknown_element", "bad_date", "bad_value", "value_overflow")


def monthly_checked(docs: DataFrame) -> DataFrame:
    """Parsed monthly documents (columns RawData, headerData, document) -> one row per RawData item
    with the header name looked up inside the document (no join, no shuffle), the code
    derived from the name, the date rule, and ``reason`` (NULL = valid). A document without RawData, whether null, unreadable or
    without that array, is one row ``bad_document``."""
    enriched = F.transform("RawData", lambda r: F.struct(
        r["element_id"].alias("element_id"), r["date"].alias("date"), r["obs_val"].alias("obs_val"),
        r["dt"].alias("dt"),
        # of repeated header ids the last counts
        F.try_element_at(F.filter("headerData", lambda h: h["id"] == r["element_id"]), F.lit(-1))["elname"].alias("elname")))
    text = F.col("document") if "document" in docs.columns else F.lit("")
    items = (docs.select(F.when(F.col("RawData").isNull(), F.coalesce(text, F.lit(""))).alias("document"), F.explode_outer(enriched).alias("r"))
             .filter(F.col("document").isNotNull() | F.col("r").isNotNull()).select("document", "r.*"))
    return checked_items(items)


def checked_items(items: DataFrame, *kept: str) -> DataFrame:
    """RawData items with their header name (``document`` set where the row stands for a broken document) -> code, date, value and
    ``reason``. Columns ``kept`` pass through; ``item``, if there is one, is the original text."""
    txt = F.coalesce(F.col("date"), F.lit(""))
    day = F.when(txt.contains("T"), F.try_to_date(F.split(txt, "T")[0], "yyyy-MM-dd")) \
        .otherwise(F.try_to_date(txt, "yyyy-M-d"))
    val = F.expr("try_cast(obs_val AS DOUBLE)")
    reason = (F.when(F.col("document").isNotNull(), F.lit(BAD_DOCUMENT))
              .when(F.col("elname").isNull(), F.lit("unknown_element"))
              .when(day.isNull(), F.lit("bad_date"))
              .when(val.isNull() | F.isnan(val) | (F.abs(val) == F.lit(float("inf"))), F.lit("bad_value"))
              .when(F.expr("try_cast(try_cast(obs_val AS DOUBLE) AS DECIMAL(12,6))").isNull(), F.lit("value_overflow")))
    text = F.col("item") if "item" in items.columns else F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
                                                                            ("element_id", "date", "obs_val", "dt")])
    return items.select(
        "element_id",
        code_from_name(F.col("elname")).alias("currency_code"),
        F.col("elname").alias("currency_name"),
        F.expr("try_cast(try_cast(obs_val AS DOUBLE) AS DECIMAL(12,6))").alias("exchange_rate"),
        day.alias("rate_date"),
        F.lit("monthly").alias("rate_type"),
        F.lit(1).alias("nominal"),
        F.coalesce(F.col("dt"), F.lit("")).alias("period"),
        reason.alias("reason"),
        F.when(F.col("document").isNotNull(), F.col("document")).when(reason.isNotNull(), text).alias("original"),
        *kept)


def normalise_monthly(docs: DataFrame, y1: int | None = None, y2: int | None = None) -> DataFrame:
    """Valid monthly rows, optionally restricted to years y1..y2."""
    out = monthly_checked(docs).filter(F.col("reason").isNull()).drop("reason", "original")
    if y1 is not None and y2 is not None:
        out = out.filter(F.year("rate_date").between(y1, y2))
    return out


def read_monthly_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Monthly documents: one a file, or one a line without ``multiline``; ``document`` is the text of one that does not
    parse, '' where only its array is missing."""
    rows = spark.read.schema(MONTHLY_DOC).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT.name) \
        .option("multiLine", multiline).json(path)
    return rows.withColumnRenamed(CORRUPT.name, "document")


def write_monthly_json(monthly: DataFrame, path: str) -> None:
    """Land monthly rows as JSON documents, one a line."""
    monthly_documents(monthly).select("doc").write.mode("overwrite").text(path)


def parse_monthly_json(docs: DataFrame, col: str = "doc") -> DataFrame:
    parsed = docs.select(F.col(col).alias("_doc"), F.from_json(F.col(col), MONTHLY_DOC).alias("p"))
    return parsed.select("p.RawData", "p.headerData", F.coalesce("_doc", F.lit("")).alias("document"))


def monthly_documents(monthly: DataFrame) -> DataFrame:
    """One JSON document per (entity, year) from raw monthly rows (at most 12 items each).
    Each carries its entity in headerData (element id = code length * 100000 + year) and
    five defective items (an unknown element id, a bad date, two bad values, one out of range); its header id
    comes twice, and the last name counts."""
    eid = F.length("currency_code") * F.lit(100000) + F.year("rate_date")
    item = F.struct(
        eid.cast("long").alias("element_id"),
        F.concat(F.date_format("rate_date", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("date"),
        F.col("exchange_rate").cast("string").alias("obs_val"),
        F.date_format("rate_date", "MMMM yyyy").alias("dt"))
    grouped = (monthly.groupBy("currency_code", F.year("rate_date").alias("y"))
               .agg(F.collect_list(item).alias("items"), F.max("currency_name").alias("name"),
                    F.max(eid).alias("eid")))
    extra = F.array(
        F.struct(F.lit(-1).cast("long").alias("element_id"), F.lit("2001-01-01").alias("date"),
                 F.lit("1.0").alias("obs_val"), F.lit("").alias("dt")),
        F.struct(F.col("eid").cast("long").alias("element_id"), F.lit("01.02.2001").alias("date"),
                 F.lit("1.0").alias("obs_val"), F.lit("").alias("dt")),
        F.struct(F.col("eid").cast("long").alias("element_id"), F.lit("2001-2-1").alias("date"),
                 F.lit("n/a").alias("obs_val"), F.lit("").alias("dt")),
        F.struct(F.col("eid").cast("long").alias("element_id"), F.lit("2001-2-1").alias("date"),
                 F.lit("Infinity").alias("obs_val"), F.lit("").alias("dt")),
        F.struct(F.col("eid").cast("long").alias("element_id"), F.lit("2001-2-1").alias("date"),
                 F.lit("1234567.5").alias("obs_val"), F.lit("").alias("dt")))
    doc = F.struct(
        F.concat(F.col("items"), extra).alias("RawData"),
        F.array(F.struct(F.col("eid").cast("long").alias("id"), F.lit("superseded").alias("elname")),
                F.struct(F.col("eid").cast("long").alias("id"), F.col("name").alias("elname"))).alias("headerData"),
        F.array().cast("array<string>").alias("units"))
    return grouped.select("currency_code", "y", F.to_json(doc).alias("doc"))
