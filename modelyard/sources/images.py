"""Image listings: one folder per class, contents never decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..operators.lookup import encode_class, sorted_class_index


def list_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """(path, modificationTime, length[, content]) of every file below the root."""
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        )
    except AnalysisException as problem:
        raise FileNotFoundError(f"{root} is not a readable directory") from problem
    return files if content else files.drop("content")


def class_root(files: DataFrame) -> str:
    """Deepest folder shared by all files: the one whose children are the classes.

    The shared prefix of all path arrays is that of their minimum and maximum.
    """
    ends = files.select(F.split("path", "/").alias("s")).agg(F.min("s").alias("a"), F.max("s").alias("b")).first()
    if ends["a"] is None:
        raise FileNotFoundError("the image folder is empty")
    shared = []
    for left, right in zip(ends["a"], ends["b"]):
        if left != right:
            break
        shared.append(left)
    if len(shared) == len(ends["a"]):
        raise FileNotFoundError("a single file is not a class folder")
    return "/".join(shared)


def read_class_folders(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """File listing with `label` (folder below the class root) and `label_idx`."""
    files = list_files(spark, root, content)
    base = class_root(files)
    relative = F.split(F.expr(f"substring(path, {len(base) + 2})"), "/")
    labelled = files.withColumn("_rel", relative).withColumn(
        "label",
        F.when(F.size("_rel") > 1, F.element_at("_rel", 1)).otherwise(
            F.raise_error(F.concat(F.lit("file outside any class folder: "), F.col("path"))).cast("string")
        ),
    ).drop("_rel")
    return encode_class(labelled, sorted_class_index(labelled, "label"), "label")
