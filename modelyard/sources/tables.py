"""Tabular sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalar import SWITCH_ON
from ..spec import FEATURE_SCHEMA, TRIP_SCHEMA, typed
from .headed import read_headed


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """CSV file, folder or glob with a header; columns are taken by name and cast.

    Every file is read by its own first line, whatever the order of its columns. Extra
    columns, such as a leading unnamed index, are never parsed; a file without a column
    of the schema is an error of the task that meets it.
    """
    return typed(read_headed(spark, path, schema.names), schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    df.write.mode(mode).option("header", True).csv(path, compression=compression)
    return path


def write_splits(df: DataFrame, path: str, split: str = "split") -> str:
    """One Parquet folder per split; later reads of one split prune the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == name)


def read_named_splits(
    spark: SparkSession, paths: Mapping[str, str], schema: str | T.StructType, fmt: str = "json"
) -> DataFrame:
    """Corpus kept as one dataset per split, read as one table with a split column."""
    merged = None
    for split, path in paths.items():
        part = spark.read.format(fmt).schema(schema).load(path).withColumn("split", F.lit(split))
        merged = part if merged is None else merged.unionByName(part)
    if merged is None:
        raise ValueError("no split given")
    return merged


def write_label_csvs(labels: DataFrame, folder: str, split: str = "split") -> dict[str, str]:
    """labels_<split>.csv per split, without the split column."""
    out = {}
    for name in ("train", "test"):
        part = labels.where(F.col(split) == name).drop(split)
        out[name] = write_csv(part, f"{folder}/labels_{name}.csv")
    return out


def read_labels(spark: SparkSession, path: str, key: str = "path", label: str = "label") -> DataFrame:
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(label, T.StringType())])
    return typed(read_headed(spark, path, schema.names), schema)


def read_scoring_files(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = FEATURE_SCHEMA,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows of scoring files with their file and their key columns.

    The columns of the schema and the keys are required, all others are optional to a file. A
    value that is absent or cannot be read names its column in `problem` and leaves `valid`
    false; a file without a required column is one such row, which says what it lacks.
    """
    raw = read_headed(spark, path, [*schema.names, *keys], bad="row")
    typed_columns = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    broken = [F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema]
    return raw.select(
        F.col("_file").alias("file_path"), *keys, *typed_columns,
        F.coalesce(F.col("_problem"), F.nullif(F.concat_ws(",", *broken), F.lit(""))).alias("problem"),
    ).withColumn("valid", F.col("problem").isNull())


def write_rejects(rows: DataFrame, path: str, keys: Sequence[str] = ()) -> str:
    """Rows that cannot be scored, with their file, key and the columns at fault."""
    rows.where(~F.col("valid")).select("file_path", *keys, "problem").write.mode("append").parquet(path)
    return path


def append_predictions(scored: DataFrame, path: str) -> str:
    """Append-row sink; file and key stay with each prediction. The file's name, the longest
    text of a row, is that of the rows around it, so the files are compressed."""
    return write_csv(scored, path, mode="append", compression="gzip")


def is_on(value: str | None) -> bool:
    """Driver-side reading of an on/off argument."""
    return (value or "").strip().lower() in SWITCH_ON


def append_monitoring(df: DataFrame, path: str, table_name: str, enabled: str | None) -> bool:
    """Append a whole batch to the named monitoring table when monitoring is on."""
    if not is_on(enabled):
        return False
    (
        df.withColumns({"table_name": F.lit(table_name), "ingest_ts": F.current_timestamp()})
        .write.mode("append").partitionBy("table_name").parquet(path)
    )
    return True


def read_monitoring(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("table_name") == table_name)
