"""A training-data pipeline over ``documents``: drop what the quality classifier rejects, remove
repeated lines, keep one document of each group of near copies, mix sources to target
weights, and encode the result.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. A stage is written as Parquet and read again by the next one, so a lost executor costs no
more than its share of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import encode
from tidemark.llm.common import materialise, table
from tidemark.llm.jaccard import keep_one
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.quality import classify, train
from tidemark.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, vocabulary

THRESHOLD = 0.7
SHINGLE_WORDS, PERCENT = 5, 80


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches ``THRESHOLD``."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model, threshold=THRESHOLD).where("predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows."""
    return line_dedup(docs).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles, rows without an id too."""
    return keep_one(docs, k=SHINGLE_WORDS, percent=PERCENT, nameless=True).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken by their source's share of the token budget, one row for each epoch taken."""
    mixed = mix(docs, MIX_WEIGHTS, budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixed.select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return encode(docs, vocabulary(), digests=True, columns=["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", dedup_lines),
    ("jaccard", dedup_documents),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: the classifier and the encoder are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
