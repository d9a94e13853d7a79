"""Plan shapes that must hold at any size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from modelyard.operators import encoding as en
from modelyard.operators import lookup as lk
from modelyard.operators import position as ps
from modelyard.operators import rouge as rg
from modelyard.operators import split as sp
from modelyard.plans.base import table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def options(spark):
    """Set session options for one test and put the old ones back."""
    before = {}

    def put(**named):
        for key, value in named.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hash_split_adds_no_shuffle_and_reads_only_the_key(spark):
    text = plan(sp.hash_split(table(spark, SF_DIR, "orders"), ["o_orderkey"]).select("o_orderkey", "split"))
    assert "Exchange" not in text and "ReadSchema: struct<o_orderkey:bigint>" in text


def test_split_filter_reaches_both_sides_of_a_join(spark):
    lines, orders = table(spark, SF_DIR, "lineitem"), table(spark, SF_DIR, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    text = plan(sp.split_rows(joined, ["l_orderkey"], "train").select("l_quantity", "o_orderdate"))
    assert text.count("Filter (") == 2 and text.count("md5(") >= 2


def test_split_folders_are_pruned(spark, tmp_path):
    sp.hash_split(spark.range(100), ["id"]).write.partitionBy("split").parquet(str(tmp_path / "s"))
    text = plan(spark.read.parquet(str(tmp_path / "s")).where("split = 'val'"))
    assert "PartitionFilters: [isnotnull(split" in text


def test_head_limits_inside_salted_parts_first(spark):
    df = spark.range(1000).withColumn("g", F.lit("hot"))
    text = plan(sp.head_per_group(df, ["g"], ["id"], 5))
    assert text.count("WindowGroupLimit") >= 2 and "_salt" in text


def test_positions_never_sort_all_rows_in_one_task(spark):
    text = plan(ps.hash_position(spark.range(1000), ["id"]))
    rows_window = [l for l in text.splitlines() if "Window [row_number()" in l]
    assert rows_window and all("_bucket" in l for l in rows_window)


def test_hot_join_keys_are_split(spark, options):
    options(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    facts = spark.range(0, 120_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"), "id"
    )
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = facts.join(dim, "k")
    assert len(joined.collect()) == 120_000
    assert "skew=true" in plan(joined)


def test_a_whole_vocabulary_is_never_broadcast_by_force(spark, options):
    options(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.createDataFrame([(1, "one two two three")], "k int, text string")
    words = en.build_vocabulary(df, "text")
    coded = en.token_ids(df, ["k"], {"ids": ("text", None)}, words)
    lookup = [line for line in plan(coded).splitlines() if "Join" in line and "token" in line]
    assert lookup and all("SortMergeJoin" in line for line in lookup)
    assert coded.first()["ids"][:2] == [5, 3] or len(coded.first()["ids"]) == 5


def test_group_limit_holds_at_large_limits(spark):
    df = spark.range(20_000).withColumn("g", F.lit("hot"))
    assert plan(sp.head_per_group(df, ["g"], ["id"], 5000)).count("WindowGroupLimit") >= 2


def test_encoding_cuts_before_it_spreads(spark):
    text = "word " * 5000
    df = spark.createDataFrame([(1, text)], "k int, text string")
    words = en.build_vocabulary(df, "text")
    coded = en.token_ids(df, ["k"], {"ids": ("text", 16)}, words)
    assert "slice(regexp_extract_all" in plan(coded)
    assert len(coded.first()["ids"]) == 16


def test_fit_and_score_are_one_plan(spark):
    from modelyard.plans.tabular import scored_test

    text = plan(scored_test(spark, SF_DIR))
    assert "ubquery" in text and text.count("FileScan parquet") >= 4  # the fit has its own scans in the same plan


def test_hot_counterfactual_profiles_meet_kept_answers(spark, options):
    from modelyard.operators import insights as ins

    options(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, 1.0).otherwise((F.col("id") % 50).cast("double")).alias("x"),
        F.lit("a").alias("u"), (F.col("id") % 2 * 10.0).alias("prediction"),
    )
    text = plan(ins.counterfactuals(df, "id", {"x": 1.0}, ["u"], 5.0, 15.0))
    last = text[text.index("SortMergeJoin"):]
    assert "Scan ExistingRDD" in last and "HashAggregate" not in last[:last.index("Scan ExistingRDD")].split("Exchange")[-1]


def test_a_long_pair_is_aligned_by_many_tasks(spark, options):
    options(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="8")
    text = " ".join(f"w{i % 97} x{i % 31} end{i % 7}." for i in range(2000))
    df = spark.createDataFrame([(1, " ".join(text.split()[:300]), text)], "k int, c string, r string")
    dealt = rg.rouge_lsum(df, ["k"], "c", "r")
    text_plan = plan(dealt)
    assert "_at" in [line for line in text_plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    row = dealt.first()
    assert row["precision"] == 1.0 and 0 < row["recall"] < 0.2


def test_csv_is_scanned_once_and_without_a_look_on_the_driver(spark, tmp_path):
    from modelyard.sources import headed, tables

    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("path,label\na,b\n" if i else "label,path\nb,a\n")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("headed", "headed")
    text = plan(tables.read_labels(spark, str(tmp_path)))
    ran = jobs("headed")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert text.count("BatchScan") == 1 and not ran
    reader = headed.HeadedReader(headed.T.StructType().add("path", "string"), {"path": str(tmp_path), "range": "30"})
    parts = [p for b in reader.partitions() for p in b.parts]
    assert len(parts) == 3 and len(reader.partitions()) < 3 + 1


def test_a_request_is_parsed_once(spark):
    from modelyard.plans.tabular import mixed_requests, positional_requests, table_requests

    for run in (positional_requests, table_requests, mixed_requests):
        assert plan(run(spark, SF_DIR)).count("from_json(") == 1, run.__name__


def test_the_bootstrap_never_spreads_rows_over_replicates(spark):
    df = spark.range(100).select("id", F.lit(0.5).alias("f1"))
    text = plan(rg.bootstrap_mid(df, ["id"], replicates=50))
    assert "xplode" not in text and "Generate" not in text and "MapInArrow" in text


def test_residual_effects_read_rows_once_for_all_products(spark):
    from modelyard.operators import insights as ins

    df = spark.range(200).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("y", F.col("a") * 2 + F.col("b"))
    text = plan(ins.causal_effect_residual(df, ["id"], "y", ["a"], ["a", "b"]))
    assert text.count("Exchange") == 1 and "MapInArrow" not in text  # the products are numbers by now


def test_encoding_joins_distinct_tokens(spark, tmp_path):
    df = spark.createDataFrame([(k, "one two two three one " * 50) for k in range(20)], "k int, text string")
    posted = en.postings(df, ["k"], {"text": en.tx.words(F.col("text"))}, "string")
    assert posted.count() == 20 * 3 and posted.select(F.sum(F.size("at"))).first()[0] == 20 * 250
    words = en.build_vocabulary(df, "text")
    coded = en.token_ids(df, ["k"], {"ids": ("text", None)}, words)
    text = plan(coded)
    assert "MapInArrow" in text and "explode" not in text
    back = en.decode_ids(coded, ["k"], "ids", words)
    assert {r["text"] for r in back.collect()} == {("one two two three one " * 50).strip()}


def test_a_block_looks_each_of_its_tokens_up_once(spark, monkeypatch):
    rows = [(k, "one two two three one " * 9) for k in range(40)] + [(50, ""), (51, None), (52, "two new"), (52, "one"), (None, "three"), (None, "two one")]
    df = spark.createDataFrame(rows, "k int, text string")
    names = spark.createDataFrame([("one", 5), ("two", 3), ("three", 4)], "token string, id int")
    sought, lookup = [], en.lookup
    monkeypatch.setattr(en, "lookup", lambda facts, *rest: sought.append(facts) or lookup(facts, *rest))
    coded = en.replaced(df, ["k"], {"ids": F.array_join(en.tx.words(F.col("text")), " ")}, names, en.tx.UNK, blocks=1)
    assert sorted(r["token"] for r in sought[0].collect()) == ["new", "one", "three", "two"]
    got = {r["k"]: r["ids"] for r in coded.collect()}
    assert len(got) == 44 and all(got[k] == [5, 3, 3, 4, 5] * 9 for k in range(40))
    assert got[50] == got[51] == [] and got[52] == [3, 5, 2] and got[None] == [3, 4, 5]
    back = {r["k"]: r["text"] for r in en.decode_ids(coded, ["k"], "ids", names).collect()}
    assert back[0] == ("one two two three one " * 9).strip()
    assert back[50] == back[51] == "" and back[52] == "two one" and back[None] == "two three one"


def test_overlap_scores_never_group_by_gram(spark):
    rows = [(1, "a b a b. c d.", "a b c. d d."), (2, None, "a"), (3, "", ""), (4, "a b", "b a"), (4, "a b", "a b"), (None, "x y", "x y z")]
    df = spark.createDataFrame(rows, "k int, c string, r string")
    one, union = rg.rouge_n(df, ["k"], "c", "r"), rg.rouge_lsum(df, ["k"], "c", "r")
    for scores in (one, union):
        keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan(scores))
        assert keys and all(re.fullmatch(r"k#\d+", k) for k in keys)
    got = {(r["k"], r["order"]): (r["precision"], r["recall"]) for r in one.collect()}
    assert len(got) == 10 and got[1, 1] == (4 / 6, 4 / 5) and got[1, 2] == (3 / 5, 3 / 4)
    assert got[2, 1] == got[3, 2] == (0.0, 0.0) and got[None, 2] == (1.0, 0.5)
    assert got[4, 1] == (1.0, 1.0) and got[4, 2] == (0.5, 0.5)  # rows of one key count together
    got = {r["k"]: (r["precision"], r["recall"]) for r in union.collect()}
    assert len(got) == 5 and got[4] == (3 / 4, 3 / 4) and got[None] == (1.0, 2 / 3) and got[2] == (0.0, 0.0)
