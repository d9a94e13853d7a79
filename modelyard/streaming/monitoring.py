"""Streaming monitoring: exactly-once ingest, windowed summaries, drift and progress."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.monitor import bin_counts, stability_index, window_summary
from ..operators.registry import LOG_SCHEMA
from ..sources.committed import read_batches, write_batch


def table_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def stream_name(checkpoint: str) -> str:
    """Batch ids belong to a checkpoint, so its name keeps the batches of streams apart."""
    return "s" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def ingest_stream(rows: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append a stream to a table of batches exactly once; `read_ingested` reads it."""
    stream = stream_name(checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("ingest_ts", F.current_timestamp()), batch_id, path, stream)

    writer = rows.writeStream.queryName(name) if name else rows.writeStream
    return (
        writer.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of finished batches; `schema` is that of the stream."""
    return read_batches(spark, path, T.StructType([*schema.fields, T.StructField("ingest_ts", T.TimestampType())]))


def summary_stream(
    rows: DataFrame,
    ts: str,
    every: str,
    value: str,
    category: str,
    categories: Sequence[str],
    out: str,
    checkpoint: str,
    late: str = "10 minutes",
) -> StreamingQuery:
    """Append each window once the watermark has passed it; later rows are dropped."""
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    summary = window_summary(timed, ts, every, value, category, categories)
    return (
        summary.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )


DRIFT = "window_start timestamp, n bigint, psi double"


def drift_stream(
    reference: DataFrame,
    rows: DataFrame,
    ts: str,
    every: str,
    value: str,
    edges: Sequence[float],
    out: str,
    checkpoint: str,
    late: str = "10 minutes",
    epsilon: float = 0.5,
) -> StreamingQuery:
    """Stability index of each tumbling window against the reference rows, as rows come in.

    The state of a window is its bin counts, so it does not grow with the rows. The bins of
    the reference are counted once and kept beside the results: after a restart the windows
    are still measured against the same reference. Every batch writes the windows that it
    changed; `read_drift` takes the last state of each. Rows later than `late` are dropped.
    """
    spark = rows.sparkSession
    kept = f"{out}/reference"
    write_batch(reference.agg(bin_counts(value, edges).alias("bins")), 0, kept)  # kept whole, or counted again
    bins = read_batches(spark, kept, "bins array<bigint>").first()["bins"]
    expected = F.array(*[F.lit(n) for n in bins])  # one number per bin
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counted = timed.groupBy(F.window(ts, every).alias("w")).agg(
        F.count(value).alias("n"), bin_counts(value, edges).alias("bins")
    )
    scored = counted.select(
        F.col("w.start").alias("window_start"), "n",
        stability_index(F.col("bins"), expected, len(edges) + 1, epsilon).alias("psi"),
    )
    stream = stream_name(checkpoint)
    return (
        scored.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, f"{out}/windows", stream) and None)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def read_drift(spark: SparkSession, out: str) -> DataFrame:
    """(window_start, n, psi): the last state written of each window."""
    last = F.max_by(F.struct("n", "psi"), "batch_id").alias("last")
    return (
        read_batches(spark, f"{out}/windows", DRIFT).groupBy("stream", "window_start").agg(last)
        .select("window_start", "last.n", "last.psi")
    )


class ProgressLog(StreamingQueryListener):
    """Log callback: each batch of the streams of this session goes to the run log.

    A batch gives `rows` and `seconds`, and a number per column of its observed metrics
    (`DataFrame.observe`) as `<name>_<column>`; the step is the batch id and the run the
    name of the query, or its id when it has none. Triggers that ran no batch are left out.
    A batch that is replayed is logged again; the later entry counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: object) -> threading.Event:
        return self._ended.setdefault(str(run), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if "addBatch" not in progress.durationMs:
            return
        found = {"rows": progress.numInputRows, "seconds": progress.batchDuration / 1000}
        for name, metrics in progress.observedMetrics.items():
            found |= {f"{name}_{key}": v for key, v in metrics.asDict().items()}
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        entries = [
            (progress.name or str(progress.id), key, float(v), progress.batchId, at)
            for key, v in found.items() if isinstance(v, (int, float))
        ]
        self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Return once all batches of a query that has ended are in the log."""
        if not self._end_of(query.runId).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was seen for {seconds} s")
