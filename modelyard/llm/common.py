"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import tune, workspace

#: The white space of all word and normalisation rules here: blank, tab to carriage return.
SPACES = " \t\n\v\f\r"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_SHIPPED: set[str] = set()


def tuned(spark: SparkSession) -> SparkSession:
    """The package's options, small batches for Python workers (rows hold whole texts), and
    the package itself for workers that have no copy of it."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        spark.sparkContext.addPyFile(_archive())
    return spark


def _archive() -> str:
    """The package's sources as a zip file in the driver's own temporary folder."""
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="modelyard-")) / "modelyard.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    return str(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table under the shared folder and read it again.

    The copy cuts the lineage, outlives executors and has a known size, so that
    the planner broadcasts it in a join only below the session's threshold.
    """
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that a later stored one replaces."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names given here cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def first_of(*columns: Column | str) -> Column:
    """A sort key whose smallest value has nulls last; column i is in the field v<i>."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.struct(*[x for i, c in enumerate(cols) for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])


def lowered(word: Column) -> Column:
    """A-Z in lower case, all else as it is; most words need no change."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, _UPPER, _UPPER.lower()))


def split_words(text: Column, between: str) -> Column:
    """The runs of a text that a pattern leaves; null has none. Cheaper than extracting them,
    which copies the text once for every match."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def blocks_of(df: DataFrame, size: Column, member: Column, block: int) -> DataFrame:
    """Deal a bucket of `size` rows into blocks and each row to every pair of its block.

    Adds `_i <= _j` and the row's own block `_mine`: any two members of a bucket meet in
    (_i, _j) of their blocks, and no (_i, _j) holds more than about two blocks. A bucket of
    one block is dealt once.
    """
    n = F.ceil(size / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64(member), n).cast("int")
    dealt = df.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1)))
    return (
        dealt.withColumn("_i", F.least("_mine", "_other")).withColumn("_j", F.greatest("_mine", "_other"))
        .drop("_other")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges; root is the smallest node reachable.

    Alternates large and small stars until the edges stay the same. Minima are
    aggregated before the shuffle and stored, so the joins back meet a stored table on
    either side, which adaptive execution may broadcast or split at hot nodes.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    spark = edges.sparkSession
    now, path = stored_at(oriented(edges), "edges")
    before = state(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        low, low_path = stored_at(both.groupBy("a").agg(F.min("b").alias("m")), "stars")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        mid, mid_path = stored_at(oriented(large), "large")
        low2, low2_path = stored_at(mid.groupBy("a").agg(F.min("b").alias("m")), "stars")
        small = mid.join(low2, "a").select(F.col("b").alias("x"), "m").union(low2.select("a", "m")).toDF("a", "b")
        then, then_path = stored_at(oriented(small), "edges")
        after = state(then)
        for old in (path, low_path, mid_path, low2_path):
            dropped(spark, old)
        now, path = then, then_path
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)
