"""Exact duplicates by distributed radix partitioning from the first byte on.

All texts begin in one group. A round cuts the next bytes off every text that is still
undecided, and splits each group by them: rows with other bytes go to other groups. A
group that is left with one row is a singleton; a group whose texts end in this round
holds equal texts. Nothing is digested: two rows stay together only while all their
bytes are equal. The digit of a round is four times as wide as the one before, so the
rounds grow with the logarithm of the longest text, and only rows of groups that are
still shared are written for the next round.

Groups are counted with map-side aggregation before the shuffle. The counts are stored
before rows meet them in a sort-merge join of the same shape at every size, in which
adaptive execution can split a group that holds a third of all rows; no group is collected.

Defined cases: null counts as empty; of equal texts the row with the most code points
stays, then the smallest key (nulls last), then any one; repeated rows are one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, dropped, first_of, stored, stored_at, whole_row

FIRST_DIGIT = 32  # bytes split by in the first round
WIDER = 4


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return reduce(lambda t, space: F.replace(t, F.lit(space), F.lit("")), SPACES, F.coalesce(text, F.lit("")))


def equal_rows(rows: DataFrame, first_digit: int = FIRST_DIGIT, wider: int = WIDER) -> DataFrame:
    """(row, same): rows whose bytes equal those of another row, with the group's smallest row.

    `rows` has a unique `row` and the binary column `bytes`; rows without an equal are left out.
    """
    spark = rows.sparkSession
    active, path = rows.select("row", F.lit(0).cast("long").alias("same"), F.col("bytes").alias("rest")), None
    width, ended = first_digit, None
    while True:
        cut = active.select(
            "row", "same", F.substring("rest", 1, width).alias("digit"),
            F.substring("rest", F.lit(width + 1), F.octet_length("rest")).alias("rest"),
        )
        groups, groups_path = stored_at(
            cut.groupBy("same", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("next"))
            .where("n > 1").drop("n"),
            "radix-groups",
        )
        split, split_path = stored_at(
            cut.join(groups.hint("merge"), ["same", "digit"]).select(
                "row", F.col("next").alias("same"), "rest", (F.octet_length("digit") < width).alias("ended")
            ),
            "radix-rows",
        )
        dropped(spark, groups_path)
        done, done_path = stored_at(split.where("ended").select("row", "same"), "radix-equal")
        active, before, path = split.where("not ended").select("row", "same", "rest"), path, split_path
        ended = done if ended is None else ended.union(done)
        if before:
            dropped(spark, before)
        if active.isEmpty():
            dropped(spark, path)
            return ended
        width *= wider


def _decided(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows, numbered, and for those with an equal the row that stays."""
    rows = stored(df.select(F.monotonically_increasing_id().alias("row"), whole_row(df).alias("doc")), "numbered")
    text_of = F.col(f"doc.`{text}`")
    same = equal_rows(rows.select("row", normalised(text_of).cast("binary").alias("bytes")))
    rank = rows.select("row", F.col(f"doc.`{key}`").alias("key"), F.char_length(F.coalesce(text_of, F.lit(""))).alias("long"))
    ranked = stored(same.join(rank, "row"), "equal-rows")
    stays = stored(
        ranked.groupBy("same")
        .agg(F.min(first_of(-F.col("long"), "key", "row")).alias("best"), F.count(F.lit(1)).alias("size"))
        .select("same", F.col("best.v2").alias("keep_row"), F.col("best.v1").alias("keep_key"), "size"),
        "equal-groups",
    )
    return rows, stored(ranked.select("row", "same").join(stays, "same").drop("same"), "decided")


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc, keep_row, keep_key, size): every row as a struct, the row that stays of
    those with an equal normalised text, and how many there are."""
    rows, decided = _decided(df, key, text)
    key_of = F.col(f"doc.`{key}`")
    own = F.col("keep_row").isNull()
    return rows.join(decided, "row", "left").select(
        "row", "doc",
        F.when(own, F.col("row")).otherwise(F.col("keep_row")).alias("keep_row"),
        F.when(own, key_of).otherwise(F.col("keep_key")).alias("keep_key"),
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
    )


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df`, one of each group of equal normalised texts.

    Only the numbers of the rows that go are joined with the texts.
    """
    rows, decided = _decided(df, key, text)
    gone = stored(decided.where("row <> keep_row").select("row"), "duplicates")
    return rows.join(gone, "row", "left_anti").select("doc.*")
