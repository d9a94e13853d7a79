"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on.

    Large equi-joins are left to AQE: it turns a small side into a broadcast
    only after its size is measured, and splits partitions of hot keys.
    """
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": "1m",  # long texts: fewer rows, so workers stay small
    }.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    A cluster session must name one; a local session without one, as in a try-out, gets a
    temporary folder, since its executors are the driver.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="modelyard-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/modelyard/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables under the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


_FORGET: list[Callable[[], None]] = []


def on_release(forget: Callable[[], None]) -> None:
    """Have `release` call this as well, for whoever remembers paths of intermediate tables."""
    _FORGET.append(forget)


def release(spark: SparkSession) -> None:
    """Remove every intermediate table that this application wrote.

    Results are lazy and may read these tables, so call it when they have been used.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    for forget in _FORGET:
        forget()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor never changes the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder by column, for plans that read them again."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
