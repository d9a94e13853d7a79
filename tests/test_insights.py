from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import insights as ins
from modelyard.operators import models as md
from modelyard.operators import monitor as mo
from modelyard.spec import FeatureSpec


def frame(spark, n=1500, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, p = round(rng.uniform(0, 30), 2), rng.randrange(1, 5)
        s, v = rng.randrange(2), 1 if rng.random() < 0.8 else 2
        rows.append((i, x, p, s, v, 4.0 + 2.0 * x + 3.0 * s + rng.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "id int, distance double, passengers int, store_forward int, vendor int, cost double")


def test_permutation_importance_finds_the_driver(spark):
    line = md.LinearBaseline("distance", 2.0, 4.0)
    got = ins.permutation_importance(
        frame(spark), ["id"], ["distance", "passengers"], "cost",
        lambda df, out: df.withColumn(out, line.predict()),
    )
    rows = {r["feature"]: r["importance"] for r in got.collect()}
    assert rows["distance"] > 100 and rows["passengers"] == 0


def test_causal_effect_is_the_planted_slope(spark):
    got = ins.causal_effect(
        frame(spark), "cost", ["distance"], ["store_forward", "vendor", "passengers"], ["store_forward", "vendor"]
    ).collect()
    assert len(got) == 5
    assert all(abs(r["effect"] - 2.0) < 0.05 for r in got)
    assert next(r for r in got if r["segment"] == "all")["n"] == 1500
    with pytest.raises(ValueError):
        ins.causal_effect(frame(spark), "cost", ["distance"], ["vendor"], ["store_forward"])


def test_residual_effect_is_the_planted_slope_among_all_controls(spark):
    rng = np.random.default_rng(3)
    n = 3000
    a, b = rng.normal(50, 10, n), rng.normal(0, 1, n)
    x = 0.4 * a + 3 * b + rng.normal(0, 2, n)  # the controls drive the treatment as well
    p = rng.integers(1, 5, n)
    s = rng.integers(0, 2, n)
    y = 2.0 * x - 1.5 * p + 7 * a - 4 * b + 100 + rng.normal(0, 1, n)
    df = spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(zip(x, p, a, b, s, y))],
        "id int, x double, p double, a double, b double, s double, y double",
    )
    got = {(r["treatment"], r["segment"], r["level"]): r for r in
           ins.causal_effect_residual(df, ["id"], "y", ["x", "p"], ["x", "p", "a", "b", "s"], ["s"]).collect()}
    assert len(got) == 6 and got["x", "all", "all"]["n"] == n
    assert abs(got["x", "all", "all"]["effect"] - 2.0) < 0.05 and abs(got["p", "all", "all"]["effect"] + 1.5) < 0.1
    assert abs(got["x", "s", "1.0"]["effect"] - 2.0) < 0.1
    design = np.column_stack([np.ones(n), x, p, a, b, s])
    assert abs(np.linalg.lstsq(design, y, rcond=None)[0][1] - got["x", "all", "all"]["effect"]) < 0.01
    with pytest.raises(ValueError):
        ins.causal_effect_residual(df.limit(0), ["id"], "y", ["x"], ["x", "a"])


def test_residual_effect_is_exact_with_collinear_and_missing_columns(spark):
    df = spark.range(0, 2000, 1, 7).select(
        "id", (F.col("id") % 50).cast("double").alias("x"), (40 + F.col("id") % 9 / 100).alias("lat"),
        (F.col("id") % 9 / 100 - 74).alias("lon"), F.lit(0.0).alias("hour"), (F.col("id") % 7).alias("p"),
    ).withColumn("y", 1e6 + 3 * F.col("x") + 2 * F.col("p") - 5 * F.col("lat"))
    odd = df.limit(2).withColumn("y", F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit(float("nan"))))
    got = ins.causal_effect_residual(df.unionByName(odd), ["id"], "y", ["x", "p"], ["x", "p", "lat", "lon", "hour"]).collect()
    effects = {r["treatment"]: (r["n"], round(r["effect"], 6)) for r in got}
    assert effects == {"x": (2000, 3.0), "p": (2000, 2.0)}


def test_error_analysis_totals(spark):
    df = frame(spark).withColumn("prediction", F.lit(30.0))
    rows = ins.error_analysis(df, "cost", "prediction", {"distance": 10.0, "passengers": 2.0}).collect()
    total = next(r for r in rows if r["distance_bin"] is None and r["passengers_bin"] is None)
    assert total["n"] == 1500 and total["error_share"] == pytest.approx(1.0)
    cells = [r for r in rows if r["distance_bin"] is not None and r["passengers_bin"] is not None]
    assert sum(r["n"] for r in cells) == 1500
    assert sum(r["error_share"] for r in cells) == pytest.approx(1.0)


@pytest.mark.parametrize("low,high,count", [(16.0, 30.0, 10), (16.0, 18.0, 3), (1000.0, 2000.0, 10)])
def test_counterfactuals_against_brute_force(spark, low, high, count):
    df = frame(spark, 250, 9).withColumn("prediction", 4.0 + 2.0 * F.col("distance") + F.col("passengers"))
    scales = {"distance": 8.0, "passengers": 1.5}
    got = {}
    for r in ins.counterfactuals(df, "id", scales, ["store_forward", "vendor"], low, high, count=count).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["feature"], r["new_value"], r["example"]))
    rows = df.collect()
    inside = [r for r in rows if low <= r["prediction"] <= high]
    want = {}
    for r in rows:
        if low <= r["prediction"] <= high:
            continue
        options = {}
        for f in scales:
            other = "passengers" if f == "distance" else "distance"
            for c in inside:
                if all(c[k] == r[k] for k in ("store_forward", "vendor", other)):
                    spot = (abs(float(r[f]) - float(c[f])) / scales[f], f, float(c[f]))
                    options[spot] = min(options.get(spot, c["id"]), c["id"])
        best = sorted(options)[:count]
        if best:
            want[r["id"]] = [(i + 1, *b, options[b]) for i, b in enumerate(best)]
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("low,high,count,n", [(16.0, 30.0, 10, 250), (16.0, 18.0, 3, 250), (20.0, 90.0, 2, 600), (1000.0, 2000.0, 10, 60)])
def test_nearest_counterfactuals_against_brute_force(spark, low, high, count, n):
    df = frame(spark, n, 9).withColumn("prediction", 4.0 + 2.0 * F.col("distance") + F.col("passengers"))
    odd = df.limit(4).withColumns({
        "id": F.col("id") + 100_000, "distance": F.element_at(F.array(F.lit(None), F.lit(float("nan")), F.lit(float("inf")), F.lit(5e6)),
                                                              (F.col("id") % 4 + 1).cast("int"))})
    df = df.unionByName(odd.select(df.columns)).cache()
    scales = {"distance": 8.0, "passengers": 1.5}
    got = {}
    for r in ins.nearest_counterfactuals(df, "id", scales, ["store_forward", "vendor"], low, high, count=count).collect():
        point = (r["new_distance"], r["new_passengers"])
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], *point, r["n_changed"], r["example"], r["support"]))
    rows = [r for r in df.collect() if r["distance"] is not None and math.isfinite(r["distance"])]
    want = {}
    for r in rows:
        if low <= r["prediction"] <= high:
            continue
        seen = {}
        for c in rows:
            if low <= c["prediction"] <= high and all(c[k] == r[k] for k in ("store_forward", "vendor")):
                seen.setdefault((float(c["distance"]), float(c["passengers"])), []).append(c["id"])
        gap = {v: abs(float(r["distance"]) - v[0]) / 8.0 + abs(float(r["passengers"]) - v[1]) / 1.5 for v in seen}
        best = sorted(seen, key=lambda v: (gap[v], v))[:count]
        if best:
            want[r["id"]] = [
                (i + 1, gap[v], *v, (v[0] != r["distance"]) + (v[1] != r["passengers"]), min(seen[v]), len(seen[v]))
                for i, v in enumerate(best)
            ]
    df.unpersist()
    assert {k: sorted(v) for k, v in got.items()} == want


def test_counterfactual_range_follows_the_predictions(spark):
    scored = frame(spark, 200).withColumn("prediction", 1000.0 * F.col("distance"))
    low, high = ins.prediction_range(scored, spread=0.5)
    row = scored.agg(F.avg("prediction").alias("m"), F.stddev("prediction").alias("s")).first()
    got = scored.limit(1).select(low.alias("low"), high.alias("high")).first()
    assert (got["low"], got["high"]) == (round(row["m"] - row["s"] / 2), round(row["m"] + row["s"] / 2))


def test_counterfactual_importance_sums_to_one(spark):
    df = frame(spark, 200).withColumn("prediction", 2.0 * F.col("distance"))
    found = ins.counterfactuals(df, "id", {"distance": 5.0, "passengers": 1.0}, ["vendor"], 16.0, 30.0)
    assert sum(r["share"] for r in ins.counterfactual_importance(found).collect()) == pytest.approx(1.0)


def test_context_checks_its_input(spark):
    spec = FeatureSpec(("distance", "passengers"), ("store_forward", "vendor"))
    scored = frame(spark, 20).withColumn("prediction", F.lit(1.0))
    context = ins.InsightContext.build(scored, spec, ["vendor"], title="t")
    assert context.scored.is_cached and context.describe().first()["n"] == 20
    context.release()
    with pytest.raises(ValueError, match="outside the contract"):
        ins.InsightContext.build(scored, spec, ["colour"], title="t")
    with pytest.raises(ValueError, match="prediction"):
        ins.InsightContext.build(frame(spark, 20), spec, ["vendor"], title="t")


def test_counterfactual_blocks_do_not_run_together(spark):
    rows = [(1, "a|b", "c", 1.0, 0.0), (2, "a", "b|c", 2.0, 10.0), (3, None, "null", 3.0, 0.0), (4, "null", None, 4.0, 10.0)]
    df = spark.createDataFrame(rows, "id int, u string, v string, x double, prediction double")
    assert ins.counterfactuals(df, "id", {"x": 1.0}, ["u", "v"], 5.0, 15.0).count() == 0


def test_permutation_reads_its_input_twice_at_most(spark, tmp_path):
    frame(spark, 50).write.parquet(str(tmp_path / "t"))
    line = md.LinearBaseline("distance", 2.0, 4.0)
    got = ins.permutation_importance(
        spark.read.parquet(str(tmp_path / "t")), ["id"], ["distance"], "cost", lambda df, out: df.withColumn(out, line.predict())
    )
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()  # the placed rows were kept


def test_gather_tags_and_fills(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    rows = ins.gather({"one": a, "two": b}).collect()
    assert [r.asDict() for r in rows] == [
        {"insight": "one", "x": 1, "y": None}, {"insight": "two", "x": None, "y": "q"},
    ]


def test_forest_importance_is_listed_in_contract_order(spark):
    spec = FeatureSpec(("distance", "passengers"), ("store_forward", "vendor"))
    model = md.fit_forest(frame(spark), spec, n_estimators=5, max_depth=5, max_features="auto")
    listed = ins.model_importance(model, spec)
    assert [f for f, _ in listed] == list(spec.features)
    assert max(listed, key=lambda x: x[1])[0] == "distance"


def test_drift_against_formula(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 500), rng.normal(1, 1, 400)
    edges = [-1.0, 0.0, 1.0]
    train = spark.createDataFrame([(float(x),) for x in a], "v double")
    scored = spark.createDataFrame([("w", float(x)) for x in b] + [("same", float(x)) for x in a], "w string, v double")
    got = {r["w"]: r["psi"] for r in mo.drift_scores(train, scored, "v", edges, ["w"]).collect()}
    bins = [-np.inf, *edges, np.inf]
    p, q = (np.histogram(x, bins)[0] + 0.5 for x in (b, a))
    p, q = p / p.sum(), q / q.sum()
    assert got["w"] == pytest.approx(float(np.sum((p - q) * np.log(p / q))))
    assert got["same"] == pytest.approx(0.0)


def test_residual_effect_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(300).selectExpr("id", "id % 7 * 1.0 AS t", "id % 11 * 1.0 AS c", "id % 7 * 3.0 + id % 11 AS y")
    found = ins.causal_effect_residual(rows.mapInArrow(watched, rows.schema), ["id"], "y", ["t"], ["t", "c"]).collect()
    assert [(r["n"], round(r["effect"], 6)) for r in found] == [(300, 3.0)]
    assert made.value == 300
