"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidemark", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The base is read from ``spark.checkpoint.dir``. Only when the session has none
    and runs on a local master (tests) do we create one ourselves.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, "tidemark", *parts, uuid.uuid4().hex)


@contextmanager
def shuffles_released(spark: SparkSession):
    """Inside, the shuffle files of a write or query of the session go when it ends; left to itself, Spark keeps them until the driver's
    garbage collector finds them, which may be never in a job of many writes. A query that is run again makes them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Stored bytes of a table that one task of a job over it takes.
TASK_BYTES = 4 << 20


def input_tasks(spark: SparkSession, path: str) -> int:
    """Number of tasks for rows of the table at ``path``: in proportion to its stored bytes, at least one a core."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-stored // TASK_BYTES))


def shares_and_tasks(spark: SparkSession, sizes: list[int], rows: int) -> tuple[int, int]:
    """Rows dealt by month, of which there are ``sizes``: the number of shares of a month, so that a share has about ``rows`` at most, and the
    number of tasks for all of them."""
    shares = max(1, -(-max(sizes, default=0) // rows))
    return shares, min(max(1, len(sizes)) * shares, max(-(-sum(sizes) // rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
