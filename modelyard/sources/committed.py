"""A table of batches: each counts as a whole, from the moment its entry is in the manifest.

The rows of an attempt go to a folder of their own. Its entry, one small file that names the
attempt, is written last, under a passing name, and renamed. Readers keep rows of entered
attempts only, so they never see half a batch, nor a batch that goes away while it is
replaced. A batch that was entered stays as it is: to write it again does nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

ENTRY = "stream string, batch_id bigint, attempt string"


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _entry_path(path: str, stream: str, batch_id: int) -> str:
    return f"{path}/entries/{stream}-{batch_id}.json"


def is_entered(spark: SparkSession, path: str, stream: str, batch_id: int) -> bool:
    place, store = _place(spark, _entry_path(path, stream, batch_id))
    return store.exists(place)


def enter(spark: SparkSession, path: str, stream: str, batch_id: int, attempt: str) -> None:
    """Make an attempt the batch. A writer that comes second leaves the first entry alone."""
    final, store = _place(spark, _entry_path(path, stream, batch_id))
    passing, _ = _place(spark, f"{path}/entries/_{uuid.uuid4().hex}")
    out = store.create(passing)
    try:
        out.write(json.dumps({"stream": stream, "batch_id": batch_id, "attempt": attempt}).encode())
    finally:
        out.close()
    if store.exists(final) or not store.rename(passing, final):
        store.delete(passing, False)
        if not store.exists(final):
            raise OSError(f"no entry could be made at {final}")


def write_batch(rows: DataFrame, batch_id: int, path: str, stream: str = "main") -> bool:
    """Add a batch of a stream to the table at `path`; false when it was there already."""
    spark = rows.sparkSession
    taken = set(T.StructType.fromDDL(ENTRY).names) & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are those of the table's folders")
    if is_entered(spark, path, stream, batch_id):
        return False
    attempt = uuid.uuid4().hex
    rows.write.parquet(f"{path}/rows/stream={stream}/batch_id={batch_id}/attempt={attempt}")
    enter(spark, path, stream, batch_id, attempt)
    return True


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: (stream, batch_id, attempt), one row per batch."""
    place, store = _place(spark, f"{path}/entries")
    store.mkdirs(place)
    return spark.read.schema(ENTRY).json(f"{path}/entries")


def read_batches(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of all entered batches with their `stream` and `batch_id`.

    The manifest is joined on the columns that are folders, so the scan prunes attempts
    that never were entered. A table without any batch is empty.
    """
    place, store = _place(spark, f"{path}/rows")
    store.mkdirs(place)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, *T.StructType.fromDDL(ENTRY).fields])
    rows = spark.read.schema(whole).parquet(f"{path}/rows")
    return rows.join(read_entries(spark, path), ["stream", "batch_id", "attempt"], "left_semi").drop("attempt")
