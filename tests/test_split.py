from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from modelyard.operators import position as ps
from modelyard.operators import split as sp


def as_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_split_is_stable_under_repartition(spark):
    a = as_map(sp.hash_split(spark.range(2000), ["id"]), "id", "split")
    b = as_map(sp.hash_split(spark.range(2000).repartition(7), ["id"]), "id", "split")
    assert a == b and set(a.values()) == {"train", "val", "test"}


def test_partition_law(spark):
    source = spark.range(500).select((F.col("id") % 100).alias("k"))
    parts = sp.hash_split(source, ["k"])
    assert sp.partition_law(source, parts, ["k"]).first().asDict() == {
        "source_rows": 500, "part_rows": 500, "overlap": 0, "missing": 0,
    }
    broken = parts.where("k <> 3").union(parts.where("k = 4"))
    row = sp.partition_law(source, broken, ["k"]).first()
    assert row["missing"] == 5 and row["overlap"] == 5


def test_random_split_covers_everything(spark):
    parts = sp.random_split(spark.range(1000), seed=4)
    assert sum(p.count() for p in parts.values()) == 1000


@pytest.mark.parametrize("limit,want", [(3, 6), (-1, 40), (0, 40), (1000, 40)])
def test_head_per_group(spark, limit, want):
    df = spark.range(40).withColumn("g", F.when(F.col("id") < 39, "hot").otherwise("cold"))
    if limit == 3:
        want = 4  # three of the hot group and the only cold row
    got = sp.head_per_group(df, ["g"], ["id"], limit)
    assert got.count() == want
    if limit == 3:
        assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 39]


@pytest.mark.parametrize("rows,workers", [(10, 3), (9, 3), (2, 8), (1, 4), (0, 3)])
def test_shards_have_equal_size(spark, rows, workers):
    got = sp.shard_rows(spark.range(rows), ["id"], workers, epoch=2).collect()
    per_shard = {}
    for r in got:
        per_shard.setdefault(r["shard"], []).append(r["id"])
    size = -(-rows // workers)
    if rows:
        assert {len(v) for v in per_shard.values()} == {size} and len(per_shard) == workers
        assert {r["id"] for r in got} == set(range(rows))
        assert sorted(r["position"] for r in got) == list(range(1, size * workers + 1))
    else:
        assert got == []


def test_epoch_changes_the_order(spark):
    def order(epoch):
        return as_map(sp.shard_rows(spark.range(50), ["id"], 1, epoch), "id", "position")

    assert order(0) != order(1) and order(0) == order(0)


def test_hash_position_is_a_permutation(spark):
    got = ps.hash_position(spark.range(3000).repartition(5), ["id"], 7)
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 3001))
    again = ps.hash_position(spark.range(3000), ["id"], 7)
    assert as_map(got, "id", "position") == as_map(again, "id", "position")


def test_ordered_position_and_running_total(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("m")).repartition(6)
    at = as_map(ps.ordered_position(df, ["m", "id"], partitions=5), "id", "position")
    want = {k: i + 1 for i, k in enumerate(sorted(range(1000), key=lambda x: (x % 7, x)))}
    assert at == want
    run = as_map(ps.running_total(df, ["id"], "m", partitions=5), "id", "running")
    total, expected = 0, {}
    for i in range(1000):
        total += i % 7
        expected[i] = total
    assert run == expected


def test_batches_keep_the_last_partial_one(spark):
    sizes = sp.batches(spark.range(10), ["id"], 4).groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in sizes) == [(0, 4), (1, 4), (2, 2)]


def test_replicas_and_leakage(spark):
    assert sp.replicate(spark.range(4), 3).count() == 12
    shared = sp.shared_keys(spark.range(0, 10), spark.range(8, 20), ["id"])
    assert sorted(r["id"] for r in shared.collect()) == [8, 9]


def test_shuffle_returns_all_rows_in_position_order(spark):
    rows = sp.shuffle(spark.range(30), ["id"], 5).collect()
    assert [r["position"] for r in rows] == list(range(1, 31))
    assert [r["id"] for r in rows] != list(range(30))


def test_file_batches(spark):
    files = spark.range(23).select(F.format_string("f-%02d", "id").alias("path"))
    sizes = sp.file_batches(files).groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in sizes) == [(0, 10), (1, 10), (2, 3)]
