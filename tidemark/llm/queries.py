"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode
from tidemark.llm.common import materialise, table
from tidemark.llm import html_text
from tidemark.llm.collocations import collocations
from tidemark.llm.divergence import source_divergence
from tidemark.llm.fingerprint import compare_edited
from tidemark.llm.jaccard import near_groups
from tidemark.llm.lattice import near_vectors
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.pii import BASE, find_pii, listed
from tidemark.llm.quality import classify, held_out, train
from tidemark.llm.topk import top_k
from tidemark.llm.warc import audit, pack, pack_damaged, stored_index, write_warc
from tidemark.session import shared_dir

MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
MIX_SHARE = (4, 5)
MIX_EPOCHS = 2
MIX_SEED = 7


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "text", "n_lines", "n_removed")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train(pages)).select("page_id", "url", "text", "n_chars")


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs, k=4, percent=85)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs, MIX_WEIGHTS, budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED) \
        .select("doc_id", "domain", "lang", "source", "epoch")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of all pages as WARC records against a copy of that index with other digests for every 97th page, every
    389th record lost, every 499th there again behind the end of its file. Only the first side is hashed from records;
    :func:`op7_replicas` hashes both."""
    packed = materialise(pack(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("record"), "warc_index")
    page = F.col("page_id")
    copy = packed.where(~F.coalesce(page % 389 == 7, F.lit(False))).withColumn(
        "digest", F.when(page % 97 == 13, F.sha2(F.concat(F.col("digest"), F.lit("x")), 256)).otherwise(F.col("digest")))
    ends = packed.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("end"))
    again = packed.where(page % 499 == 3).join(ends, "file").withColumn("offset", F.col("end") + F.col("page_id")).drop("end")
    found = audit(packed, copy.unionByName(again))
    names = packed.select("file", "offset", F.col("page_id"), "uri")
    return found.join(names, ["file", "offset"], "left").select(
        "file", "offset", "length", "page_id", "uri", "fault", "digest", "other_digest")


def op7_replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records against a replica made and hashed from altered records, at the offsets it then has:
    another last character in every 97th page, every 389th record lost, every 499th there again at the end of its file."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    page = F.col("page_id")
    first = materialise(pack(pages).drop("record"), "warc_first")
    second = pack_damaged(pages, changed=page % 97 == 13, lost=page % 389 == 7, again=page % 499 == 3).drop("record")
    found = audit(first, second)
    names = first.select("file", "offset", "page_id", "uri")
    return found.join(names, ["file", "offset"], "left").select(
        "file", "offset", "length", "page_id", "uri", "fault", "digest", "other_digest")


def op7_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replicas of :func:`op7_replicas` written as WARC files, and audited by what is read back of them: every stored byte is hashed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    page = F.col("page_id")
    sides = {"first": pack(pages), "second": pack_damaged(pages, changed=page % 97 == 13, lost=page % 389 == 7, again=page % 499 == 3)}
    index = {}
    for name, packed in sides.items():
        path = shared_dir(spark, "llm", f"warc_{name}")
        write_warc(packed, path)
        index[name] = materialise(stored_index(spark, path), f"warc_{name}_index")
    found = audit(index["first"].drop("uri"), index["second"].drop("uri"))
    return found.join(index["first"].select("file", "offset", "uri"), ["file", "offset"], "left").select(
        "file", "offset", "length", "uri", "fault", "digest", "other_digest")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return find_pii(docs).select(
        "doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"), count("iban"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"))


def vocabulary() -> str:
    """Default tokenizer file of the queries; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, vocabulary(), digests=True, columns=["doc_id"])


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, is_query=lambda i: i % 50 == 0, k=5)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html": op2_html,
    "op3_fingerprint": op3_fingerprint,
    "op4_jaccard": op4_jaccard,
    "op5_bpe": op5_bpe,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op7_replicas": op7_replicas,
    "op7_stored": op7_stored,
    "op8_pii": op8_pii,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_lattice": op11_lattice,
    "op12_collocations": op12_collocations,
    "op13_divergence": op13_divergence,
}


