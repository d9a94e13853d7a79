"""Streaming scoring of request files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.models import load_model
from ..operators.registry import read_registry, resolve_asset
from ..sources.committed import is_entered, write_batch
from .monitoring import stream_name


def request_stream(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, whole_files: bool = False
) -> DataFrame:
    """One row per request, with the file it came in: a request per line, or per file."""
    return (
        spark.readStream.format("text")
        .option("wholetext", whole_files)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path"))
    )


def score_stream(
    requests: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    predict: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Parse, predict and append; the file sink commits each batch once."""
    return (
        predict(parse(requests))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )


def score_latest_stream(
    requests: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    predict: Callable[[PipelineModel, DataFrame], DataFrame],
    registry_path: str,
    name: str,
    out: str,
    checkpoint: str,
    until_done: bool = True,
) -> StreamingQuery:
    """Score each batch with the version of a model that is newest when the batch starts.

    The registry is asked once per batch, so a version registered meanwhile takes over with
    the next batch and no restart; its model is loaded once. Every row carries its `version`,
    and `sources.committed.read_batches` reads the rows of finished batches. A batch without
    any registered version fails and is tried again by the next start. The query ends with
    the requests there are, or runs on when `until_done` is false.
    """
    stream = stream_name(checkpoint)
    held: dict[int, PipelineModel] = {}

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_entered(spark, out, stream, batch_id):
            return
        newest = resolve_asset(read_registry(spark, registry_path), f"{name}@latest").first()
        if newest is None:
            raise LookupError(f"no version of {name} is registered")
        version = newest["version"]
        if version not in held:
            held.clear()
            held[version] = load_model(newest["path"])
        scored = predict(held[version], parse(batch))
        write_batch(scored.withColumn("version", F.lit(version)), batch_id, out, stream)

    writer = requests.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()
