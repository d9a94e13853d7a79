"""Splits, head samples, shards, batches and the laws they obey."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalar import DEFAULT_SPLITS, in_split, key_digest, split_label
from .position import hash_position, ordered_position


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    splits: Sequence[tuple[str, float]] = DEFAULT_SPLITS,
    seed: object = None,
    name: str = "split",
) -> DataFrame:
    """Label each row with a split drawn from its key.

    Row-local: no shuffle, the same answer under any partitioning, and all rows
    of one key land in one split.
    """
    return df.withColumn(name, split_label(key_digest(key, seed), splits))


def split_rows(
    df: DataFrame,
    key: Sequence[str],
    split: str,
    splits: Sequence[tuple[str, float]] = DEFAULT_SPLITS,
    seed: object = None,
    rest: bool = False,
) -> DataFrame:
    """Only the rows of one split, or with `rest` all the others.

    A plain range filter on the key, which Catalyst pushes below joins on it.
    """
    inside = in_split(key_digest(key, seed), split, splits)
    return df.where(~inside if rest else inside)


def random_split(
    df: DataFrame,
    splits: Sequence[tuple[str, float]] = DEFAULT_SPLITS,
    seed: int = 0,
) -> dict[str, DataFrame]:
    """Independent draw per row; reproducible only for a fixed partitioning."""
    parts = df.randomSplit([share for _, share in splits], seed)
    return {name: part for (name, _), part in zip(splits, parts)}


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def head_per_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    limit: int,
    salts: int | None = None,
) -> DataFrame:
    """First `limit` rows of every group; a limit of zero or less keeps all rows.

    Each group is first cut down inside `salts` parts (one per shuffle partition unless
    given), so a group that holds most of the data is never sorted by one task. The
    engine's own group limit, which cuts before the shuffle, is raised to the limit asked for.
    """
    if limit <= 0:
        return df
    conf = df.sparkSession.conf
    salts = salts or int(conf.get("spark.sql.shuffle.partitions"))
    if limit > int(conf.get(GROUP_LIMIT)):
        conf.set(GROUP_LIMIT, str(limit))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order_by), F.lit(salts)))
    for part in ([*group, "_salt"], list(group)):
        rank = F.row_number().over(W.partitionBy(*part).orderBy(*order_by))
        salted = salted.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")
    return salted.drop("_salt")


def shard_rows(df: DataFrame, key: Sequence[str], workers: int, epoch: int = 0) -> DataFrame:
    """Rows of every worker's shard for one epoch.

    The order is a shuffle seeded by the epoch. Positions wrap around until every
    shard has ceil(rows / workers) rows; worker r gets positions r, r + W, ...
    """
    n = F.count(F.lit(1))
    size = df.select(*key).agg(
        F.struct(n.alias("rows"), (F.ceil(n / workers) * workers).cast("bigint").alias("padded"))
    )
    placed = hash_position(df, key, seed=epoch, name="_first").withColumn("_size", size.scalar())
    turns = F.sequence(F.col("_first"), F.col("_size.padded"), F.col("_size.rows"))
    return (
        placed.withColumn("position", F.explode(turns))
        .withColumn("shard", F.pmod(F.col("position") - 1, F.lit(workers)).cast("int"))
        .drop("_first", "_size")
    )


def replicate(df: DataFrame, workers: int) -> DataFrame:
    """Every row once per worker, made row by row."""
    return df.withColumn("worker", F.explode(F.sequence(F.lit(0), F.lit(workers - 1))))


def batch_id(position, size: int):
    """Zero-based batch of a 1-based position; the last batch may be short."""
    return F.floor((position - 1) / F.lit(size)).cast("bigint")


def batches(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """Fixed-size batches in the given order."""
    placed = ordered_position(df, order_by)
    return placed.withColumn("batch", batch_id(F.col("position"), size))


def shuffled_batches(df: DataFrame, key: Sequence[str], size: int, seed: object = 0) -> DataFrame:
    """Fixed-size batches of a reproducible shuffle."""
    placed = hash_position(df, key, seed)
    return placed.withColumn("batch", batch_id(F.col("position"), size))


def file_batches(files: DataFrame, path: str = "path", per_batch: int = 10) -> DataFrame:
    """Group a file listing into mini-batches, in path order."""
    return batches(files.select(path).distinct(), [path], per_batch)


def shuffle(df: DataFrame, key: Sequence[str], seed: object = 0) -> DataFrame:
    """Rows in a reproducible random order."""
    return hash_position(df, key, seed).orderBy("position")


def partition_law(source: DataFrame, parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: are the parts disjoint and do they exhaust the source?

    Copies of a key are counted, not paired, and the counts are pre-aggregated.
    """
    tagged = source.select(*key, F.lit(1).alias("_s"), F.lit(0).alias("_p")).unionByName(
        parts.select(*key, F.lit(0).alias("_s"), F.lit(1).alias("_p"))
    )
    per_key = tagged.groupBy(*key).agg(F.sum("_s").alias("s"), F.sum("_p").alias("p"))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("part_rows"),
        F.coalesce(F.sum(F.greatest(F.col("p") - F.col("s"), F.lit(0))), F.lit(0)).alias("overlap"),
        F.coalesce(F.sum(F.greatest(F.col("s") - F.col("p"), F.lit(0))), F.lit(0)).alias("missing"),
    )


def shared_keys(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys present in both splits; an empty answer means no leakage.

    Keys are reduced per task and meet in one shuffle, without a join.
    """
    sides = left.select(*key, F.lit(1).alias("_side")).unionByName(
        right.select(*key, F.lit(2).alias("_side"))
    )
    seen = sides.groupBy(*key).agg(F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    return seen.where((F.col("_first") == 1) & (F.col("_last") == 2)).select(*key)
