"""Incremental ingest: landed record files -> validate -> upsert into the raw store.

``readStream`` on the landing folder with an explicit schema, ``trigger(availableNow)``,
and ``foreachBatch`` running validation and the touched-partition upsert. The stream's
checkpoint (in the shared checkpoint folder) records which files are done, so a restart
after a lost executor or driver picks up exactly the unfinished files; re-running a batch
is harmless because the upsert is idempotent.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality, validate
from tidemark.operators.tables import upsert_into
from tidemark.schema import RECORD_SCHEMA
from tidemark.session import shared_dir

LANDING_SCHEMA = T.StructType(RECORD_SCHEMA.fields + [T.StructField("seq", T.LongType(), True)])


@dataclass(frozen=True)
class Checks:
    """What the quality step of an ingest looks at: the parameters of ``quality.dq_report``."""

    check_date: dt.date
    majors: tuple[str, ...]
    upper: float = 1000.0


def ingest_batch(spark: SparkSession, raw: str, as_of, rejects_path: str | None = None, max_code: int = validate.MAX_CODE,
                 metrics_path: str | None = None, checks: Checks | None = None):
    """The work on one micro-batch: validate and stage it in one pass, which also observes its metrics; then rejects, metrics and upsert
    read the staged rows. Every folder is one of the epoch and overwritten: an epoch that runs again leaves one copy."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        checked = validate.parsed(batch, max_code=max_code)
        seen, good = Observation(), F.col("reason").isNull()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(~good).alias("rejected")]
        if checks is not None:
            counts += quality.dq_counts(checks.check_date, checks.majors, checks.upper, where=good)
        stage = shared_dir(spark, "ingest_staged")
        checked.observe(seen, *counts).write.parquet(stage)
        staged = spark.read.schema(checked.schema).parquet(stage)
        if rejects_path:
            validate.rejected(staged).write.mode("overwrite").parquet(f"{rejects_path}/epoch={epoch_id}")
        upsert_into(spark, raw, validate.valid(staged), as_of, seq="seq")
        if metrics_path:
            values = seen.get
            spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} bigint" for k in values)).coalesce(1) \
                .write.mode("overwrite").parquet(f"{metrics_path}/epoch={epoch_id}")
    return run


def incremental_ingest(spark: SparkSession, landing: str, raw: str, checkpoint: str, as_of,
                       rejects_path: str | None = None, fmt: str = "json",
                       max_files_per_trigger: int | None = None, max_code: int = validate.MAX_CODE,
                       metrics_path: str | None = None, checks: Checks | None = None) -> None:
    """Process every file landed so far and stop (availableNow). With ``metrics_path``, each epoch leaves a row of its counts there:
    rows, rejected and, with ``checks``, those of the quality report over its valid rows."""
    reader = spark.readStream.schema(LANDING_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(landing).writeStream
         .foreachBatch(ingest_batch(spark, raw, as_of, rejects_path, max_code, metrics_path, checks))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
