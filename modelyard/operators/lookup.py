"""The joins of the workflow: items by path, class dimensions, token ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .position import dense_position


def items_of_labels(labels: DataFrame, items: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Left join driven by the labels, with `found` telling whether the item exists.

    With `strict`, a label without an item is an error.
    """
    joined = labels.join(items.withColumn("_seen", F.lit(True)), key, "left").withColumn(
        "found", F.coalesce("_seen", F.lit(False))
    ).drop("_seen")
    if strict:
        missing = F.concat(F.lit("no item for label: "), F.col(key).cast("string"))
        joined = joined.withColumn(
            "found", F.when(F.col("found"), True).otherwise(F.raise_error(missing).cast("boolean"))
        )
    return joined


def missing_items(labels: DataFrame, items: DataFrame, key: str) -> DataFrame:
    return labels.join(items.select(key), key, "left_anti")


def restrict_to(items: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Items named in a label file."""
    return items.join(labels.select(key), key, "left_semi")


def sorted_class_index(df: DataFrame, label: str, name: str = "label_idx") -> DataFrame:
    """Dimension (label, index) with indices in alphabetical order."""
    classes = df.select(label).where(F.col(label).isNotNull()).distinct()
    return dense_position(classes, [label], name)


def first_seen_class_index(
    df: DataFrame, label: str, order_by: str, name: str = "label_idx"
) -> DataFrame:
    """Dimension (label, index) with indices in order of first appearance."""
    firsts = (
        df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(order_by).alias("_first"))
    )
    return dense_position(firsts, ["_first", label], name).drop("_first")


def encode_class(df: DataFrame, index: DataFrame, label: str, strict: bool = True) -> DataFrame:
    """Attach the index fitted on the training rows; unseen labels are errors."""
    name = [c for c in index.columns if c != label][0]
    joined = df.join(index, label, "left")
    if not strict:
        return joined
    unseen = F.concat(F.lit("label not seen in training: "), F.col(label).cast("string"))
    return joined.withColumn(
        name, F.when(F.col(name).isNotNull() | F.col(label).isNull(), F.col(name))
        .otherwise(F.raise_error(unseen).cast("int"))
    )


def decode_class(df: DataFrame, index: DataFrame, position: str, label: str, out: str) -> DataFrame:
    """Label text of a class position."""
    name = [c for c in index.columns if c != label][0]
    return df.join(index.select(F.col(name).alias(position), F.col(label).alias(out)), position, "left")


def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left lookup of hot keys in a dimension with unique keys, of any size.

    Adaptive execution measures the dimension: a small one is broadcast, and beside a
    large one the partitions of hot keys are split.
    """
    return facts.join(dim, list(on), "left")
