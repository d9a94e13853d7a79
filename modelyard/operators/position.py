"""Global row positions without a single-partition sort of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalar import key_text
from ..session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def hash_position(
    df: DataFrame,
    key: Sequence[str],
    seed: object = "",
    name: str = "position",
    digits: int = 4,
) -> DataFrame:
    """1-based position in the order of md5(seed|key): a reproducible shuffle.

    The leading hex digits of the digest are range buckets of equal expected size,
    so rows are shuffled once, each bucket is ranked on its own, and only the
    16**digits bucket sizes are summed up and broadcast. `key` must be unique.
    """
    keyed = df.withColumn("_digest", F.md5(key_text(key, seed)))
    keyed = keyed.withColumn("_bucket", F.substring("_digest", 1, digits))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = sizes.select("_bucket", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    within = W.partitionBy("_bucket").orderBy("_digest", *key)
    return (
        keyed.join(F.broadcast(before), "_bucket")
        .withColumn(name, F.col("_before") + F.row_number().over(within))
        .drop("_digest", "_bucket", "_before")
    )


def _range_sorted(df: DataFrame, order_by: Sequence, partitions: int | None) -> DataFrame:
    """Globally sorted rows, frozen on reliable storage with their place.

    Freezing matters: range boundaries are sampled, so two evaluations of the same
    plan may cut the data differently.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(partitions, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return cut_lineage(placed).withColumn("_part", F.shiftright("_at", _LOCAL_BITS))


def _offsets(frozen: DataFrame, weight) -> DataFrame:
    """Total weight before each sort partition; one row per partition."""
    sizes = frozen.groupBy("_part").agg(F.sum(weight).cast("bigint").alias("_n"))
    upto = W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    return sizes.select("_part", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))


def ordered_position(
    df: DataFrame,
    order_by: Sequence,
    name: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """1-based position in a total order given by `order_by`."""
    frozen = _range_sorted(df, order_by, partitions)
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        frozen.join(F.broadcast(_offsets(frozen, F.lit(1))), "_part")
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_part", "_at", "_before")
    )


def running_total(
    df: DataFrame,
    order_by: Sequence,
    weight: str,
    name: str = "running",
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sum of an integer column over a total order."""
    frozen = _range_sorted(df, order_by, partitions)
    upto = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        frozen.join(F.broadcast(_offsets(frozen, F.col(weight))), "_part")
        .withColumn(name, F.col("_before") + F.sum(weight).over(upto))
        .drop("_part", "_at", "_before")
    )


def dense_position(df: DataFrame, order_by: Sequence, name: str) -> DataFrame:
    """0-based position of the few rows of a class dimension, ranked in one sort.

    For dimensions only: a class has one row, so the rows are as few as the classes.
    """
    return df.withColumn(name, (F.row_number().over(W.orderBy(*order_by)) - 1).cast("int"))
