"""Session defaults, and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side (bytes) that any operator here ships to every executor. Sides are
# measured first; beyond this each operator takes its shuffled route instead.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "ticketmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Pattern work is all CPU: a few hundred kilobytes of text are worth a task of their own.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows are long texts and vectors, so Arrow batches stay small.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return os.path.join(tempfile.gettempdir(), f"ticketmill-{os.getpid()}-{uuid.uuid4().hex[:8]}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/ticketmill/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and survives the loss of any executor; unlike an RDD checkpoint
    the result stays columnar, so later reads still prune columns.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(big: DataFrame, side: DataFrame, on: str | list[str], how: str, row_bytes: str | int) -> DataFrame:
    """Join with ``side``, a settled frame, shipped whole only if its measured size allows.

    ``row_bytes`` is a number or an SQL expression for the bytes of one row. Beyond the
    bound the same join is shuffled; the rows are the same either way.
    """
    size = side.agg(F.coalesce(F.sum(F.expr(str(row_bytes))), F.lit(0)).cast("long")).first()[0]
    return big.join(F.broadcast(side) if size <= BROADCAST_BYTES // 4 else side.hint("merge"), on, how)
