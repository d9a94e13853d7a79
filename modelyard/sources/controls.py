"""Small control files: metrics, reports, flags, model info, label lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import version_id


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Metric dictionary of a run in long form (key, value)."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string,string>")))
    truth = F.when(F.col("value") == "true", 1.0).when(F.col("value") == "false", 0.0)
    return entries.select("key", F.coalesce(F.col("value").try_cast("double"), truth).alias("value")).where(
        F.col("value").isNotNull()
    )


def write_metrics_json(metrics: DataFrame, path: str) -> str:
    """One JSON object from the long form of one run's metrics."""
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    metrics.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode(
        "overwrite"
    ).text(path)
    return path


def score_report(metrics: DataFrame, model: str) -> DataFrame:
    """Report lines from one row of regression metrics."""
    lines = [
        F.lit(f"Scored with the following model:\n{model}"),
        F.format_string("Mean squared error: %.2f", "mse"),
        F.format_string("Root mean squared error: %.2f", "rmse"),
        F.format_string("Mean absolute error: %.2f", "mae"),
        F.format_string("Coefficient of determination: %.2f", "r2"),
    ]
    return metrics.select(F.posexplode(F.array(*lines)).alias("line", "value"))


def write_score_report(metrics: DataFrame, model: str, path: str) -> str:
    text = score_report(metrics, model).coalesce(1).sortWithinPartitions("line")
    text.select("value").write.mode("overwrite").text(path)
    return path


def write_flag(flag: DataFrame, folder: str) -> str:
    """One-row flag table as a '0' or '1' under <folder>/deploy_flag."""
    flag.select(F.col("deploy_flag").cast("int").cast("string").alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(f"{folder}/deploy_flag")
    return folder


def read_flag(spark: SparkSession, path: str) -> DataFrame:
    """One-row flag from a file, or from a folder that contains deploy_flag."""
    files = spark.read.option("recursiveFileLookup", True).text(path)
    source = F.col("_metadata.file_path")
    own = source.endswith("/" + path.rstrip("/").rsplit("/", 1)[-1])
    flag = files.where(own | source.rlike("/deploy_flag(/|$)"))
    return flag.select(F.trim("value").cast("int").alias("deploy_flag"))


def model_info(registry: DataFrame) -> DataFrame:
    """{"id": "name:version"} per registered model."""
    return registry.select(
        "name", "version",
        F.to_json(F.struct(version_id(F.col("name"), F.col("version")).alias("id"))).alias("info"),
    )


def write_model_info(registry: DataFrame, folder: str) -> str:
    """One model-info file per registered model, in a folder of its name and version."""
    model_info(registry).select("name", "version", F.col("info").alias("value")).write.mode("overwrite").partitionBy(
        "name", "version"
    ).text(folder)
    return folder


def read_model_info(spark: SparkSession, folder: str) -> DataFrame:
    """(name, version, id) of every model-info file."""
    return spark.read.text(folder).select(
        F.col("name").cast("string").alias("name"), "version", F.get_json_object("value", "$.id").alias("id")
    )


def write_label_mapping(index: DataFrame, path: str, label: str = "label", idx: str = "label_idx") -> str:
    """One label per line, in index order."""
    ordered = index.coalesce(1).sortWithinPartitions(idx)
    ordered.select(F.col(label).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path
