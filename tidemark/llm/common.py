"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Word characters are everything but ASCII space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner true file sizes, so a
    later join broadcasts the table only when it is below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that Arrow and the C library hold unused back to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of a task's batches, which holds no unused memory before and after. Spark keeps Python workers for later tasks; else each
    would keep the most that any of its tasks took, in every later stage of a job too."""
    def task(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def with_replaced(df: DataFrame, columns: dict) -> DataFrame:
    """``df`` with ``columns`` set; an input column of the same name (any case) is replaced."""
    taken = {c.lower() for c in columns}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*keep, *[v.alias(k) for k, v in columns.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text):
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
