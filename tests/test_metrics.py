from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import metrics as mt


def regression(spark, rows):
    df = spark.createDataFrame(rows, "y double, p double")
    return mt.regression_metrics(df, "y", "p").first()


def test_regression_matches_formulas(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(10, 4, 300)
    p = y + rng.normal(0, 2, 300)
    got = regression(spark, [(float(a), float(b)) for a, b in zip(y, p)])
    assert got["n"] == 300
    assert got["mse"] == pytest.approx(np.mean((y - p) ** 2))
    assert got["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert got["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert got["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_r2_of_a_constant_target(spark):
    assert regression(spark, [(2.0, 2.0), (2.0, 2.0)])["r2"] == 1.0
    assert regression(spark, [(2.0, 2.0), (2.0, 3.0)])["r2"] == 0.0


def test_r2_is_not_squared_correlation(spark):
    assert regression(spark, [(1.0, 10.0), (2.0, 20.0), (3.0, 30.0)])["r2"] < 0


def brute(real, predicted):
    labels = sorted(set(real) | set(predicted))
    n = len(real)
    rows = []
    for l in labels:
        tp = sum(a == b == l for a, b in zip(real, predicted))
        t, q = real.count(l), predicted.count(l)
        p, r = tp / q if q else 0.0, tp / t if t else 0.0
        rows.append((t, q, p, r, 2 * p * r / (p + r) if p + r else 0.0))
    c = sum(a == b for a, b in zip(real, predicted))
    cross = sum(t * q for t, q, *_ in rows)
    den = (n * n - sum(q * q for _, q, *_ in rows)) * (n * n - sum(t * t for t, *_ in rows))
    return {
        "accuracy": c / n,
        "mcc": (c * n - cross) / den**0.5 if den else 0.0,
        "recall_micro": c / n,
        "precision_macro": sum(r[2] for r in rows) / len(rows),
        "recall_macro": sum(r[3] for r in rows) / len(rows),
        "f1_macro": sum(r[4] for r in rows) / len(rows),
        "precision_weighted": sum(r[0] * r[2] for r in rows) / n,
        "recall_weighted": sum(r[0] * r[3] for r in rows) / n,
        "f1_weighted": sum(r[0] * r[4] for r in rows) / n,
    }


@pytest.mark.parametrize(
    "real,predicted",
    [
        (list("aabbcc"), list("abbbca")),
        (list("aaab"), list("aacc")),  # one label only predicted, one only real
        (list("aaaa"), list("aaaa")),  # no spread: mcc is zero
        (list("ab"), list("ba")),
    ],
)
def test_classification(spark, real, predicted):
    df = spark.createDataFrame(list(zip(real, predicted)), "r string, p string")
    counts = mt.confusion_counts(df, "r", "p")
    assert counts.agg(F.sum("n")).first()[0] == len(real)
    got = mt.classification_metrics(counts).first()
    for name, value in brute(real, predicted).items():
        assert got[name] == pytest.approx(value), name
    assert got["recall_micro"] == pytest.approx(got["accuracy"])


def test_dense_confusion_has_every_pair(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "r string, p string")
    dense = mt.dense_confusion(mt.confusion_counts(df, "r", "p")).collect()
    assert len(dense) == 9 and sum(r["n"] for r in dense) == 3


def test_epoch_metrics_weigh_by_batch_size(spark):
    trace = spark.createDataFrame(
        [(0, "train", 2.0, 3, 3), (0, "train", 1.0, 1, 0)], "epoch int, phase string, loss double, n int, correct int"
    )
    row = mt.epoch_metrics(trace).first()
    assert row["loss"] == pytest.approx(7 / 4) and row["accuracy"] == pytest.approx(3 / 4)


def test_windowed_loss_drops_the_partial_run(spark):
    rows = [(e, "train", i, float(i)) for e in (0, 1) for i in range(57)] + [(0, "eval", i, 900.0) for i in range(30)]
    trace = spark.createDataFrame(rows, "epoch int, phase string, iter int, loss double")
    got = mt.windowed_loss(trace).collect()
    assert sorted((r["epoch"], r["run"], r["loss"]) for r in got) == [
        (0, 0, 12.0), (0, 1, 37.0), (1, 0, 12.0), (1, 1, 37.0),
    ]


def test_timing_and_counters(spark):
    steps = spark.createDataFrame([("a", 2, 0.5), ("a", 1, 3.0)], "name string, seq int, seconds double")
    row = mt.iterator_timing(steps).first()
    assert (row["count"], row["time_sum"], row["time_first"]) == (2, 3.5, 3.0)
    reads = spark.createDataFrame([("d", 1, 0), ("d", 5, 3 * 1048576)], "disk string, ts int, bytes bigint")
    assert mt.counter_delta_mb(reads, ["disk"], "bytes", F.col("ts")).first()["bytes_mb"] == 3.0


def test_a_null_label_is_a_miss_in_both_accuracies(spark):
    rows = spark.createDataFrame([("a", "a"), (None, None), ("b", None)], "real string, predicted string")
    plain = rows.agg(mt.accuracy(F.col("real"), F.col("predicted")).alias("a")).first()["a"]
    counted = mt.classification_metrics(mt.confusion_counts(rows, "real", "predicted")).first()["accuracy"]
    assert plain == pytest.approx(1 / 3) == pytest.approx(counted)


def test_class_summary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    row = mt.class_summary(df, "label").first()
    assert (row["samples"], row["classes"], row["class_list"]) == (3, 2, "a,b")


def test_long_form(spark):
    wide = spark.createDataFrame([("r", 1, 2.5)], "run string, a int, b double")
    got = {(r["run"], r["key"]): r["value"] for r in mt.long_form(wide, ["run"]).collect()}
    assert got == {("r", "a"): 1.0, ("r", "b"): 2.5}


def test_a_missing_prediction_is_a_miss_of_its_label(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", "b"), ("b", "a")], "real string, predicted string")
    counts = mt.confusion_counts(df, "real", "predicted")
    labels = {r["label"]: (r["hits"], r["support"], r["predictions"]) for r in mt.label_counts(counts).collect()}
    assert labels == {"a": (1, 2, 2), "b": (1, 2, 1)}
    dense = {(r["real"], r["predicted"]): r["n"] for r in mt.dense_confusion(counts).collect()}
    assert dense == {("a", "a"): 1, ("a", "b"): 0, ("b", "a"): 1, ("b", "b"): 1, ("a", None): 1}
    whole = mt.classification_metrics(counts).first()
    assert (whole["n"], whole["accuracy"], whole["recall_macro"]) == (4, 0.5, 0.5)
