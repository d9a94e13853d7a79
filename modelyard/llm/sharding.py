"""A reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their key. The number is read as a pair of digits
(x, y) with bases close to the root of the row count; each round adds a keyed hash of one
digit to the other, so the rounds permute all pairs. Pairs beyond the last row are sent
through the permutation again until they fall inside (cycle walking), which permutes the
row numbers themselves. Position p lies in slot p div shards of shard p mod shards: both
can be computed for any row number alone, and shard sizes differ by one at most.

Only DataFrame functions are used. Numbering range-sorts narrow rows and adds the sizes
of the partitions before; equal keys are told apart by a row id so that one key may hold
any share of the rows.

Defined cases: a null key is numbered first; rows that are equal in all ordering columns
are interchangeable; an empty table has no shards.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.position import ordered_position
from .common import whole_row

ROUNDS = 6
WALKS = 24  # a walk longer than this is an error, never a wrong place


def bases(rows: int) -> tuple[int, int]:
    """Two bases whose product is the row count or little more."""
    a = max(1, isqrt(max(0, rows - 1)) + 1)
    return a, max(1, -(-rows // a))


def quotient(number: Column, by: int) -> Column:
    """Whole division; exact for row numbers below 2**53."""
    return ((number - F.pmod(number, F.lit(by))) / by).cast("long")


def keyed_hash(seed: int, turn: Column, digit: Column) -> Column:
    """60 hash bits of a digit, the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), turn, digit)), 1, 15), 16, 10).cast("long")


def feistel(number: Column, rows: int, seed: int) -> Column:
    """One pass of the permutation over the pairs of digits."""
    a, b = bases(rows)

    def two_rounds(pair: Column, turn: Column) -> Column:
        x = F.pmod(pair["x"] + F.pmod(keyed_hash(seed, turn, pair["y"]), F.lit(a)), F.lit(a))
        y = F.pmod(pair["y"] + F.pmod(keyed_hash(seed, turn + 1, x), F.lit(b)), F.lit(b))
        return F.struct(x.alias("x"), y.alias("y"))

    return F.aggregate(
        F.array(*[F.lit(r) for r in range(0, ROUNDS, 2)]),
        F.struct(quotient(number, b).alias("x"), F.pmod(number, F.lit(b)).alias("y")),
        two_rounds, lambda pair: pair["x"] * b + pair["y"],
    )


def permuted(number: Column, rows: int, seed: int = 0) -> Column:
    """The place of a row number among `rows`, by cycle walking."""
    walked = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALKS)), feistel(number, rows, seed),
        lambda p, _: F.when(p < rows, p).otherwise(feistel(p, rows, seed)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("long"))


def sharded(df: DataFrame, order_by: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """(doc, shard, slot): every row as a struct with its place."""
    rows = df.select(whole_row(df).alias("doc"), F.monotonically_increasing_id().alias("tie"))
    numbered = ordered_position(rows, [*(F.col(f"doc.`{c}`") for c in order_by), F.col("tie")], "number")
    n = numbered.count()
    place = permuted(F.col("number") - 1, max(1, n), seed)
    return numbered.select("doc", place.alias("place")).select(
        "doc", F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        quotient(F.col("place"), shards).alias("slot"),
    )


def write_shards(df: DataFrame, path: str, order_by: Sequence[str], shards: int, seed: int = 0) -> None:
    """Write every shard to its own folder, its rows in the order of their slots."""
    placed = sharded(df, order_by, shards, seed)
    (
        placed.repartition("shard", quotient(F.col("slot"), 1_000_000)).sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
