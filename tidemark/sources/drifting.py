"""Monthly JSON documents whose fields drift: read as VARIANT, typed field by field.

A reader with a fixed schema drops fields that it does not know, and a field of another type costs it the row or the document.
Here each document is parsed as it is, and a field is typed when it is read:

* ``element_id`` and header ids may be numbers or texts of whole numbers; anything else is no id (``unknown_element``);
* ``obs_val`` and ``date`` may be texts or numbers and follow the rules of ``payloads.monthly_checked``; an object, array or
  boolean there is ``bad_value`` / ``bad_date``;
* ``RawData`` and ``headerData`` may be arrays, or a single object, which counts as an array of one;
* fields that are not known stay, as JSON text in ``extra`` (null if there are none); rejects keep the whole item as text.

A document that does not parse, is null, is no object, repeats a key within an object, is beyond Spark's size of a VARIANT, or
has no usable ``RawData`` is one reject ``bad_document``. An empty array gives nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.payloads import HEADER_ITEM, RAW_ITEM, checked_items

ITEM_FIELDS = tuple(f.name for f in RAW_ITEM.fields)
HEADER_FIELDS = tuple(f.name for f in HEADER_ITEM.fields)
_MAP = "map<string,variant>"


def _kind(value: Column) -> Column:
    """Type of a VARIANT without lengths and parts: BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _list(doc: Column, field: str) -> Column:
    """An array field as array<variant>; a single object is one element; null if it is neither."""
    path = f"$.{field}"
    one = F.when(F.try_variant_get(doc, path, _MAP).isNotNull(), F.array(F.try_variant_get(doc, path, "variant")))
    return F.coalesce(F.try_variant_get(doc, path, "array<variant>"), one)


def _whole_number(item: Column, field: str) -> Column:
    exact = F.try_variant_get(item, f"$.{field}", "decimal(38,6)")
    fits = (exact == F.floor(exact)) & (_kind(F.try_variant_get(item, f"$.{field}", "variant")) != "BOOLEAN")
    return F.when(fits, exact.try_cast("bigint"))


def _parsed(docs: DataFrame, col: str) -> DataFrame:
    text = F.coalesce(F.col(col), F.lit(""))
    return docs.select(text.alias("_text"), F.try_parse_json(F.col(col)).alias("_doc"))


def drifting_checked(docs: DataFrame, col: str = "doc") -> DataFrame:
    """One row a RawData item: the columns of ``payloads.monthly_checked`` and ``extra``."""
    rows = _parsed(docs, col).select("_text", _list(F.col("_doc"), "RawData").alias("_items"), _list(F.col("_doc"), "headerData").alias("_heads"))
    heads = F.transform("_heads", lambda h: F.named_struct(
        F.lit("id"), _whole_number(h, "id"), F.lit("elname"), F.try_variant_get(h, "$.elname", "string")))
    rows = rows.select(F.when(F.col("_items").isNull(), F.col("_text")).alias("document"), heads.alias("_heads"), F.explode_outer("_items").alias("_item"))
    rows = rows.filter(F.col("document").isNotNull() | F.col("_item").isNotNull())
    item = F.col("_item")
    unknown = F.map_filter(F.try_variant_get(item, "$", _MAP), lambda k, v: ~k.isin(*ITEM_FIELDS))
    typed = rows.select(
        "document", "_heads", _whole_number(item, "element_id").alias("element_id"),
        *[F.try_variant_get(item, f"$.{c}", "string").alias(c) for c in ("date", "obs_val", "dt")],
        F.to_json(item).alias("item"), F.when(F.size(unknown) > 0, F.to_json(unknown)).alias("extra"))
    name = F.try_element_at(F.filter("_heads", lambda h: h["id"] == F.col("element_id")), F.lit(-1))["elname"]
    return checked_items(typed.withColumn("elname", name), "extra")


def drift_report(docs: DataFrame, col: str = "doc") -> DataFrame:
    """Fields and types that the documents hold: level (document, RawData, headerData), field, type, whether the field is known, and how
    often it comes; broken documents are counted as level document, field '', type BAD_DOCUMENT."""
    doc = F.col("_doc")
    none = F.expr("cast(array() as array<struct<level:string,field:string,type:string,known:boolean>>)")

    def fields(level: str, of: Column, known: tuple) -> Column:
        entries = F.map_entries(F.try_variant_get(of, "$", _MAP))
        return F.coalesce(F.transform(entries, lambda e: F.named_struct(
            F.lit("level"), F.lit(level), F.lit("field"), e["key"], F.lit("type"), _kind(e["value"]), F.lit("known"), e["key"].isin(*known))), none)

    def of_items(level: str, known: tuple) -> Column:
        return F.flatten(F.transform(F.coalesce(_list(doc, level), F.expr("cast(array() as array<variant>)")), lambda i: fields(level, i, known)))

    broken = F.array(F.struct(F.lit("document").alias("level"), F.lit("").alias("field"), F.lit("BAD_DOCUMENT").alias("type"), F.lit(False).alias("known")))
    seen = F.concat(fields("document", doc, ("RawData", "headerData")), of_items("RawData", ITEM_FIELDS), of_items("headerData", HEADER_FIELDS),
                    F.when(_list(doc, "RawData").isNull(), broken).otherwise(none))
    return (_parsed(docs, col).select(F.explode(seen).alias("s")).select("s.*")
            .groupBy("level", "field", "type", "known").agg(F.count(F.lit(1)).alias("rows")))
