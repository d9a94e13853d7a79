from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelyard.llm import sharding


def plain(number, rows, seed):
    a, b = sharding.bases(rows)

    def keyed(turn, digit):
        return int(hashlib.md5(f"{seed}:{turn}:{digit}".encode()).hexdigest()[:15], 16)

    while True:
        x, y = divmod(number, b)
        for turn in range(0, sharding.ROUNDS, 2):
            x = (x + keyed(turn, y)) % a
            y = (y + keyed(turn + 1, x)) % b
        number = x * b + y
        if number < rows:
            return number


@pytest.mark.parametrize("rows, seed", [(1, 0), (2, 0), (3, 5), (17, 1), (100, 2), (1000, 3), (4097, 0)])
def test_permutation(spark, rows, seed):
    got = [r[0] for r in spark.range(rows).orderBy("id").select(sharding.permuted(F.col("id"), rows, seed)).collect()]
    assert got == [plain(i, rows, seed) for i in range(rows)]
    assert sorted(got) == list(range(rows))


def test_places_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("shard"))
    one = sharding.sharded(df.repartition(1), ["k"], 8).collect()
    many = sharding.sharded(df.repartition(7), ["k"], 8).collect()
    assert sorted((r.doc.k, r.shard, r.slot) for r in one) == sorted((r.doc.k, r.shard, r.slot) for r in many)
    slots = {}
    for r in one:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a")] * 3 + [(1, None)] * 40 + [(2, "b")]
    df = spark.createDataFrame(rows, "k long, number string")
    got = sharding.sharded(df, ["k", "number"], 4).collect()
    assert Counter((r.doc.k, r.doc.number) for r in got) == Counter(rows)
    assert sorted((r.shard, r.slot) for r in got) == sorted((i % 4, i // 4) for i in range(44))
    assert sharding.sharded(df.limit(0), ["k"], 4).count() == 0


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(spark.range(50).toDF("k"), path, ["k"], 4, seed=9)
    assert spark.read.parquet(path).groupBy("shard").count().where("count in (12, 13)").count() == 4


def test_plan_is_native(spark):
    df = sharding.sharded(spark.range(50).toDF("k"), ["k"], 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
