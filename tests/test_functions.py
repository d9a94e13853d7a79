from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from modelyard.functions import scalar as sc
from modelyard.functions import text as tx
from modelyard.functions import vector as vc


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_switch_spellings(spark):
    rows = spark.createDataFrame(
        [("TRUE",), ("yes",), ("1",), ("on",), ("0",), ("garbage",), (None,)], "v string"
    ).select(sc.switch(F.col("v")).alias("s"), sc.strict_bool(F.col("v"), "null").alias("b")).collect()
    assert [r["s"] for r in rows] == [True, True, True, False, False, False, False]
    assert [r["b"] for r in rows] == [True, True, True, True, False, None, None]


def test_strict_bool_raises_on_garbage(spark):
    with pytest.raises(Exception, match="not a boolean"):
        one(spark, sc.strict_bool(F.lit("garbage")))


def test_unknown_value_raises(spark):
    assert one(spark, sc.known_or_error(F.lit("a"), ["a", "b"]).alias("v"))["v"] == "a"
    with pytest.raises(Exception, match="unknown arch"):
        one(spark, sc.known_or_error(F.lit("zz"), ["a", "b"], "arch"))


def test_draw_and_digest_agree(spark):
    rows = spark.range(5000).select(
        sc.unit_draw(["id"]).alias("u"),
        sc.split_label(sc.key_digest(["id"])).alias("s"),
        *[sc.in_split(sc.key_digest(["id"]), n).alias(n) for n, _ in sc.DEFAULT_SPLITS],
    ).collect()
    for r in rows:
        want = "train" if r["u"] < 0.7 else "val" if r["u"] < 0.85 else "test"
        assert r["s"] == want
        assert [r[n] for n in ("train", "val", "test")] == [want == n for n in ("train", "val", "test")]
    share = sum(r["train"] for r in rows) / len(rows)
    assert abs(share - 0.7) < 0.03


def test_null_key_still_gets_a_split(spark):
    df = spark.createDataFrame([(None,), (1,)], "k bigint")
    labels = [r[0] for r in df.select(sc.split_label(sc.key_digest(["k"]))).collect()]
    assert None not in labels


def test_version_and_checkpoint_names(spark):
    row = one(
        spark,
        sc.version_parts(sc.version_id(F.lit("my:model"), F.lit(12))).alias("v"),
        sc.checkpoint_name(F.lit(-1), F.lit(0.0)).alias("name"),
        sc.checkpoint_parts(F.lit("model-checkpoint-epoch3-loss1.25.pt")).alias("c"),
    )
    assert row["v"]["name"] == "my:model" and row["v"]["version"] == "12"
    assert row["name"] == "model-checkpoint-epoch-1-loss0.0.pt"
    assert row["c"]["epoch"] == 3 and row["c"]["loss"] == 1.25


def test_calendar_starts_on_monday(spark):
    parts = sc.calendar_parts(F.lit("2016-01-03 04:05:06").cast("timestamp"), "at")
    assert one(spark, *parts).asDict() == {
        "at_weekday": 6, "at_month": 1, "at_monthday": 3, "at_hour": 4, "at_minute": 5, "at_second": 6,
    }


def test_merge_maps_last_wins(spark):
    a = F.create_map(F.lit("x"), F.lit(1), F.lit("y"), F.lit(2))
    b = F.create_map(F.lit("y"), F.lit(3), F.lit("z"), F.lit(4))
    assert one(spark, sc.merge_maps(a, b).alias("m"))["m"] == {"x": 1, "y": 3, "z": 4}


def test_sentence_lines_and_words(spark):
    row = one(
        spark,
        tx.sentence_lines(F.lit("  One two. Three!  Four? \n Five ")).alias("lines"),
        tx.words(F.lit("Ab-9 çD  e_f")).alias("words"),
        tx.ngrams(F.array(*map(F.lit, "abc")), 2).alias("two"),
        tx.ngrams(F.array(F.lit("a")), 2).alias("short"),
    )
    assert row["lines"] == "One two.\nThree!\nFour?\nFive"
    assert row["words"] == ["ab", "9", "d", "e", "f"]
    assert row["two"] == ["a b", "b c"] and row["short"] == []


def test_pad_mask_round_trip(spark):
    ids = F.array(*map(F.lit, (5, 6, 1)))
    padded = tx.pad(tx.truncate(ids, 2), 4)
    row = one(
        spark, padded.alias("p"), tx.attention_mask(tx.truncate(ids, 2), 4).alias("m"),
        tx.mask_padding(padded).alias("k"), tx.unmask_padding(tx.mask_padding(padded)).alias("u"),
        tx.used_length(padded).alias("n"),
    )
    assert row["p"] == [5, 6, 0, 0] and row["m"] == [1, 1, 0, 0]
    assert row["k"] == [5, 6, -100, -100] and row["u"] == row["p"] and row["n"] == 2


def test_arg_max_takes_first_of_ties(spark):
    assert one(spark, vc.arg_max(F.array(*map(F.lit, (1.0, 3.0, 3.0)))).alias("i"))["i"] == 1


def test_cross_entropy_is_stable(spark):
    logits = F.array(*map(F.lit, (1000.0, 1001.0)))
    got = one(spark, vc.cross_entropy(logits, F.lit(0)).alias("x"))["x"]
    assert got == pytest.approx(1 + math.log(1 + math.exp(-1)))


def test_channel_normalise_by_plane(spark):
    values = F.array(*[F.lit(0.5)] * 6)
    got = one(spark, vc.channel_normalise(values).alias("x"))["x"]
    want = [(0.5 - m) / s for m, s in zip(vc.CHANNEL_MEAN, vc.CHANNEL_STD) for _ in range(2)]
    assert got == pytest.approx(want)
