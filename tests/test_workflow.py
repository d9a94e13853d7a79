"""Models, registry, gates, sources, requests, user code and streams."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from modelyard.operators import insights as ins
from modelyard.operators import lookup as lk
from modelyard.operators import metrics as mt
from modelyard.operators import models as md
from modelyard.operators import monitor as mo
from modelyard.operators import registry as rg
from modelyard.operators import split as sp
from modelyard.operators.userdefined import apply_batches, apply_metrics, apply_partials, apply_scorer, observed
from modelyard.plans.base import trips
from modelyard.session import shared_dir, workspace
from modelyard.sources import committed as cm
from modelyard.sources import headed
from modelyard.sources import controls as ct
from modelyard.sources import images as im
from modelyard.sources import requests as rq
from modelyard.sources import tables as tb
from modelyard.spec import POSITIONAL_LAYOUT, TRIP_SCHEMA, TRIPS, FeatureSpec
from modelyard.streaming import monitoring as sm
from modelyard.streaming import scoring as ss

SF_DIR = "/root/testdata/sf0.001"
SPEC = FeatureSpec(numeric=("distance", "passengers"), nominal=("vendor",))


@pytest.fixture(scope="module")
def planted(spark):
    """Cost grows by 3 per unit of distance and 10 for the second vendor."""
    base = spark.range(3000).select(
        "id",
        (F.pmod(F.xxhash64("id"), F.lit(200)) / 10.0).alias("distance"),
        (F.pmod("id", F.lit(4)) + 1).alias("passengers"),
        (F.pmod("id", F.lit(2)) + 1).alias("vendor"),
    )
    return base.withColumn("cost", 5 + 3 * F.col("distance") + 10 * F.col("vendor"))


# --- contract ----------------------------------------------------------------


def test_contract_order_and_missing_column(spark):
    assert len(TRIPS.features) == 20 and TRIPS.columns[-1] == "cost"
    rows = trips(spark, SF_DIR)
    assert TRIPS.project(rows).columns == list(TRIPS.columns)
    with pytest.raises(ValueError, match="vendor"):
        TRIPS.project(rows.drop("vendor"))


# --- models ------------------------------------------------------------------


def test_forest_learns_the_planted_relation(spark, planted, tmp_path):
    train, test = sp.split_rows(planted, ["id"], "train"), sp.split_rows(planted, ["id"], "test")
    model = md.fit_forest(train, SPEC, n_estimators=10, max_depth=8, max_features="auto")
    loaded = md.load_model(md.save_model(model, str(tmp_path / "forest")))
    scored = md.predict(loaded, test)
    assert "features" not in scored.columns
    assert mt.regression_metrics(scored, "cost", "prediction").first()["r2"] > 0.95
    many = md.predict_versions(test, {"1": model, "2": loaded}, SPEC, ["id", "cost"])
    rows = md.version_metrics(many, "cost").collect()
    assert len(rows) == 2 and rows[0]["mse"] == pytest.approx(rows[1]["mse"])


def test_forest_grows_in_groups_on_all_rows_and_cores(spark, planted, tmp_path, monkeypatch):
    seen = []

    class Watched(md.RandomForestRegressor):
        def _fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count(), self.getNumTrees(), self.getSeed()))
            return super()._fit(rows)

    monkeypatch.setattr(md, "RandomForestRegressor", Watched)
    monkeypatch.setattr(md, "TREES_AT_ONCE", 4)
    train, test = sp.split_rows(planted, ["id"], "train"), sp.split_rows(planted, ["id"], "test")
    model = md.fit_forest(train.coalesce(1), SPEC, n_estimators=10, max_depth=8, max_features="auto")
    cores, n = spark.sparkContext.defaultParallelism, train.count()
    assert seen == [(cores, n, 4, 0), (cores, n, 4, 1), (cores, n, 2, 2)]
    loaded = md.load_model(md.save_model(model, str(tmp_path / "groups")))
    scored = md.predict(loaded, test)
    assert scored.columns == [*test.columns, "prediction"]
    assert mt.regression_metrics(scored, "cost", "prediction").first()["r2"] > 0.95
    trees = [t for f in md.forests_of(model) for t in f.trees]
    row = md.assembler(SPEC).transform(test).first()
    mean = sum(t.predict(row["features"]) for t in trees) / len(trees)
    both = md.predict_versions(test.where(F.col("id") == row["id"]), {"1": model, "2": loaded}, SPEC, ["id"]).collect()
    assert len(trees) == 10 and [r["prediction"] for r in both] == pytest.approx([mean, mean])
    assert scored.where(F.col("id") == row["id"]).first()["prediction"] == pytest.approx(mean)
    assert sum(share for _, share in ins.model_importance(loaded, SPEC)) == pytest.approx(1.0)


def test_forest_parameters():
    assert md.FOREST["n_estimators"] == 500 and md.FOREST["max_depth"] == 10
    with pytest.raises(ValueError, match="colour"):
        md.fit_forest(None, SPEC, colour="red")


def test_features_and_target(planted):
    row = md.features_and_target(planted.where("id = 0"), SPEC).first()
    assert len(row["features"]) == 3 and row["label"] == planted.where("id = 0").first()["cost"]


def test_baseline_line(spark):
    df = spark.range(10).select(F.col("id").alias("x"), (F.col("id") * 2 + 1).alias("y"), F.lit(7).alias("flat"))
    lines = md.fit_baselines(df, ["x", "flat"], "y")
    assert lines["x"].slope == pytest.approx(2) and lines["x"].intercept == pytest.approx(1)
    assert lines["flat"].slope == 0 and lines["flat"].intercept == pytest.approx(10)
    scored = md.score_versions(df, {"a": lines["x"].predict(), "b": F.lit(0.0)}, ["x", "y"])
    assert scored.count() == 20
    r2 = {r["version"]: r["r2"] for r in md.version_metrics(scored, "y").collect()}
    assert r2["a"] == pytest.approx(1.0) and r2["b"] < 0


def test_linear_probe_separates_clusters(spark):
    rows = [([float(i % 3 == k) + random.Random(i).random() / 10 for k in range(3)], i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "v array<float>, label int")
    probe = md.fit_linear_probe(df, "v", "label")
    scored = probe.transform(md.with_vector(df, "v"))
    assert scored.agg(mt.accuracy(F.col("label").cast("double"), F.col("prediction")).alias("a")).first()["a"] == 1.0


# --- lookups -----------------------------------------------------------------


def test_class_index_is_fitted_once(spark):
    train = spark.createDataFrame([(1, "dog"), (2, "cat"), (3, "dog")], "k int, label string")
    by_name = {r["label"]: r["label_idx"] for r in lk.sorted_class_index(train, "label").collect()}
    assert by_name == {"cat": 0, "dog": 1}
    index = lk.first_seen_class_index(train, "label", "k")
    assert {r["label"]: r["label_idx"] for r in index.collect()} == {"dog": 0, "cat": 1}
    unseen = spark.createDataFrame([(9, "fox")], "k int, label string")
    with pytest.raises(Exception, match="not seen"):
        lk.encode_class(unseen, index, "label").collect()


def test_labels_and_items(spark):
    labels = spark.createDataFrame([("a", "x"), ("b", "y")], "path string, label string")
    items = spark.createDataFrame([("a", 10), ("c", 30)], "path string, length int")
    found = {r["path"]: r["found"] for r in lk.items_of_labels(labels, items, "path").collect()}
    assert found == {"a": True, "b": False}
    assert [r["path"] for r in lk.missing_items(labels, items, "path").collect()] == ["b"]
    assert [r["path"] for r in lk.restrict_to(items, labels, "path").collect()] == ["a"]
    with pytest.raises(Exception, match="no item for label: b"):
        lk.items_of_labels(labels, items, "path", strict=True).collect()


# --- registry and gates ------------------------------------------------------


def test_registry_counts_up_and_honours_the_flag(spark, tmp_path):
    path = str(tmp_path / "registry")
    empty = spark.createDataFrame([], rg.REGISTRY_SCHEMA)
    empty.write.parquet(path)

    def registry():
        return spark.read.schema(rg.REGISTRY_SCHEMA).parquet(path)

    assert rg.register_version(registry(), path, "m", "p1", "r1", True, {"task": "x"}) == "m:1"
    assert rg.register_version(registry(), path, "m", "p2", "r2", False) is None
    assert rg.register_version(registry(), path, "m", "p3", "r3", True) == "m:2"
    for reference, want in (("m@latest", "p3"), ("m:latest", "p3"), ("m:1", "p1")):
        assert rg.resolve_asset(registry(), reference).first()["path"] == want
    with pytest.raises(ValueError):
        rg.resolve_asset(registry(), "m")
    info = {r["version"]: json.loads(r["info"]) for r in ct.model_info(registry()).collect()}
    assert info == {1: {"id": "m:1"}, 2: {"id": "m:2"}}


def test_gates(spark):
    scores = spark.createDataFrame([(0.5,), (0.8,)], "r2 double")
    none = scores.where("false")

    def flag(score, known):
        return spark.range(1).select(rg.tabular_gate(F.lit(score), rg.best_score(known)).alias("f")).first()["f"]

    assert [flag(0.8, scores), flag(0.79, scores), flag(-3.0, none)] == [1, 0, 1]


def metrics(spark, value, key="predict_rougeLsum"):
    return spark.createDataFrame([(key, value), ("other", 1.0)], "key string, value double")


def test_run_comparison(spark):
    def flag(c, b, **more):
        return rg.compare_runs(metrics(spark, b), metrics(spark, c), **more).first()["deploy_flag"]

    assert [flag(2.0, 1.0), flag(1.0, 1.0), flag(0.5, 1.0), flag(0.5, 1.0, force=True)] == [1, 0, 0, 1]
    with pytest.raises(Exception, match="missing"):
        rg.compare_runs(metrics(spark, 1.0), metrics(spark, 1.0, "x")).collect()


def test_leaderboard(spark):
    df = spark.createDataFrame([("1", 0.2), ("2", 0.9), ("3", 0.2)], "version string, r2 double")
    assert [(r["version"], r["rank"]) for r in rg.leaderboard(df).collect()] == [("2", 1), ("1", 2), ("3", 2)]


def test_run_log(spark, tmp_path):
    log = str(tmp_path / "log")
    for step, value in ((1, 0.5), (2, 0.25)):
        rg.log_metrics(metrics(spark, value, "loss"), log, "run", step)
    rows = {r["key"]: r for r in rg.latest_metrics(spark.read.parquet(log)).collect()}
    assert rows["loss"]["value"] == 0.25 and rows["loss"]["updates"] == 2
    rg.log_params(spark, {"trees": 500}, str(tmp_path / "params"), "run")
    assert spark.read.parquet(str(tmp_path / "params")).first()["value"] == "500"


def test_numeric_entries_keep_numbers_and_booleans(spark):
    lines = spark.createDataFrame(
        [(1, '{"a": 1, "b": 2.5, "c": true, "d": "7", "e": null, "f": "x"}')], "k int, line string"
    )
    got = {r["key"]: r["value"] for r in rg.numeric_entries(lines, "line", ["k"]).collect()}
    assert got == {"a": 1.0, "b": 2.5, "c": 1.0}


# --- sources -----------------------------------------------------------------


def test_csv_is_read_by_name(spark, tmp_path):
    rows = trips(spark, SF_DIR).select(F.monotonically_increasing_id().alias("_c"), *reversed(TRIPS.columns))
    path = tb.write_csv(rows.withColumnRenamed("_c", "index"), str(tmp_path / "csv"))
    back = tb.read_csv(spark, path)
    assert back.columns == list(TRIPS.columns) and back.schema == TRIP_SCHEMA
    assert back.count() == rows.count()
    assert back.agg(F.sum("vendor")).first()[0] == rows.agg(F.sum("vendor")).first()[0]


def test_scoring_files_keep_file_and_mark_bad_rows(spark, tmp_path):
    header = ",".join(TRIPS.features)
    good = ",".join(["1"] * 20)
    for i, lines in enumerate(([good, good], [good, good.replace("1", "oops", 1)])):
        (tmp_path / f"{i}.csv").write_text("\n".join([header, *lines]) + "\n")
    rows = tb.read_scoring_files(spark, str(tmp_path / "*.csv")).collect()
    assert len(rows) == 4 and sum(r["valid"] for r in rows) == 3
    assert {r["file_path"].rsplit("/", 1)[1] for r in rows} == {"0.csv", "1.csv"}


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("path,label\nimg1,cat\n")
    (tmp_path / "b.csv").write_text('"label","path"\ndog,img2\n')
    (tmp_path / "c.csv").write_text(",path,label\n0,img3,cow\n")
    got = {(r["path"], r["label"]) for r in tb.read_labels(spark, str(tmp_path)).collect()}
    assert got == {("img1", "cat"), ("img2", "dog"), ("img3", "cow")}
    (tmp_path / "d.csv").write_text("path,kind\nimg4,cat\n")
    with pytest.raises(Exception, match="the header of .*d.csv has no label"):
        tb.read_labels(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_csv_ranges_read_every_line_once(spark, tmp_path, size):
    want = []
    for f in range(4):
        names = ["k", "v", "w"] if f % 2 else ["w", "k", "v"]
        rows = [{"k": f"{f}-{i}", "v": ["", "a,b", "ü", 'say "x"', "x" * 40][i % 5], "w": str(i)} for i in range(23)]
        quoted = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set(',"') else v
        lines = [",".join(names), *[",".join(quoted(r[n]) for n in names) for r in rows]]
        (tmp_path / "in" / str(f % 2)).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / str(f % 2) / f"{f}.csv").write_bytes("\r\n".join(lines).encode() + (b"\n" if f > 1 else b""))
        want += [(r["k"], r["v"] or None) for r in rows]
    (tmp_path / "in" / "_SUCCESS").write_text("")
    (tmp_path / "in" / "empty.csv").write_text("")
    (tmp_path / "in" / "bare.csv").write_text("v,k\n")
    got = headed.read_headed(spark, str(tmp_path / "in"), ["k", "v"], range_bytes=size)
    assert sorted((r.k, r.v) for r in got.collect()) == sorted(want, key=lambda r: r[0])
    some = headed.read_headed(spark, [str(tmp_path / "in/0/*.csv"), f"file://{tmp_path}/in/1"], ["k", "v"], range_bytes=size)
    assert some.count() == len(want) and some.select("_file").distinct().count() == 4


def test_csv_files_that_do_not_fit(spark, tmp_path):
    (tmp_path / "short.csv").write_text("a,b,c\n1\n1,2,3,4\n\n,,x\n")
    (tmp_path / "latin.csv").write_bytes("c,b,a\nz,\xe9,y\n".encode("latin-1"))
    (tmp_path / "above.csv").write_text("a report\na,b,c\n1,2,3\n")
    rows = headed.read_headed(spark, str(tmp_path), ["a", "b"], bad="row").collect()
    got = {(r["_file"].rsplit("/", 1)[1], r.a, r.b, r["_problem"]) for r in rows}
    assert got == {
        ("short.csv", "1", None, None), ("short.csv", "1", "2", None), ("short.csv", None, None, None),
        ("latin.csv", "y", "\ufffd", None), ("above.csv", None, None, "no column a, b"),
    }
    with pytest.raises(Exception, match="No such|not found|NotFound|FileNotFound"):
        headed.read_headed(spark, str(tmp_path / "nowhere"), ["a"]).collect()


def test_scoring_files_name_what_is_wrong(spark, tmp_path):
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.IntegerType())])
    (tmp_path / "a.csv").write_text("k,x,y\n1,0.5,2\n2,oops,3\n")
    (tmp_path / "b.csv").write_text("y,x,k\n4,1.5,3\n,,4\n")
    rows = tb.read_scoring_files(spark, str(tmp_path), schema, ["k"])
    got = {r["k"]: (r["x"], r["y"], r["problem"], r["valid"]) for r in rows.collect()}
    assert got == {"1": (0.5, 2, None, True), "2": (None, 3, "x", False), "3": (1.5, 4, None, True), "4": (None, None, "x,y", False)}
    out = tb.write_rejects(rows, str(tmp_path / "rejects"), ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["2", "4"]


def test_broken_requests_are_errors_or_rejects(spark, tmp_path):
    raw = ['{"input_data": [[1, 2]]}', '{"input_data": [[1, 2]', "", None, '{"data": [[1, 2]]}', '{"input_data": [["a"]]}']
    df = spark.createDataFrame(list(enumerate(raw)), "id int, raw string")
    good, bad = rq.split_requests(df, "raw")
    assert [r["id"] for r in good.collect()] == [0]
    assert {r["id"]: r["reason"] for r in bad.collect()} == {
        1: "not of the expected shape", 2: "not of the expected shape", 3: "no text",
        4: "not of the expected shape", 5: "not of the expected shape",
    }
    spec = FeatureSpec(("a", "b"))
    more = df.unionByName(spark.createDataFrame([(6, '{"input_data": [[3, 4], [5], null]}'), (7, '{"input_data": []}')], "id int, raw string"))
    rows = [(r["id"], r["row"], r["a"], r["b"], r["reason"]) for r in rq.rows_and_rejects(more, "raw", ["id"], ["a", "b"], spec).collect()]
    shape, none = "not of the expected shape", (None, None, None)
    assert sorted(rows, key=lambda r: (r[0], r[1] or 0)) == [
        (0, 0, 1.0, 2.0, None), (1, *none, shape), (2, *none, shape), (3, *none, "no text"), (4, *none, shape), (5, *none, shape),
        (6, 0, 3.0, 4.0, None), (6, 1, None, None, "values in a request row: 1"), (6, 2, None, None, "a row without values"),
    ]
    with pytest.raises(Exception, match="does not parse"):
        rq.positional_rows(df.where("id = 1"), "raw", layout=["a", "b"], spec=FeatureSpec(("a", "b"))).collect()
    (tmp_path / "r.json").write_text('{\n  "input_data": [\n    [1, 2]\n  ]\n}\n')
    whole = rq.read_requests(spark, str(tmp_path))
    row = rq.positional_rows(whole, "raw", layout=["a", "b"], spec=FeatureSpec(("a", "b"))).first()
    assert (row["a"], row["b"]) == (1.0, 2.0)
    lines = ss.request_stream(spark, str(tmp_path), whole_files=True)
    assert lines.isStreaming


def test_two_writers_get_two_versions(spark, tmp_path):
    path = str(tmp_path / "registry")
    seen = spark.createDataFrame([], rg.REGISTRY_SCHEMA)
    assert rg.register_version(seen, path, "a b/c", "p1", "r", True) == "a b/c:1"
    assert rg.register_version(seen, path, "a b/c", "p2", "r", True) == "a b/c:2"
    rows = rg.read_registry(spark, path).orderBy("version").collect()
    assert [(r["name"], r["version"], r["path"]) for r in rows] == [("a b/c", 1, "p1"), ("a b/c", 2, "p2")]


def test_a_registered_model_is_found_and_loaded(spark, tmp_path):
    train = spark.range(50).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 2.0 + 1).alias("cost"))
    saved = md.save_model(md.fit_linear(train, ["x"], "cost"), str(tmp_path / "m"))
    path = str(tmp_path / "registry")
    rg.register_version(spark.createDataFrame([], rg.REGISTRY_SCHEMA), path, "line", saved, "r", True)
    model = md.load_asset(rg.read_registry(spark, path), "line@latest")
    assert model.transform(train).where(F.abs(F.col("prediction") - F.col("cost")) > 1e-6).count() == 0
    with pytest.raises(LookupError):
        md.load_asset(rg.read_registry(spark, path), "other@latest")


def test_partial_metrics(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").cast("double").alias("x"))
    got = apply_partials(df, lambda f: {"n": len(f), "s": f["x"].sum()}, ["n", "s"], lambda: [(F.col("s") / F.col("n")).alias("m")])
    assert got.first()["m"] == 499.5


def test_named_splits(spark, tmp_path):
    for name in ("train", "test"):
        spark.range(3).write.json(str(tmp_path / name))
    got = tb.read_named_splits(spark, {n: str(tmp_path / n) for n in ("train", "test")}, "id bigint")
    assert sp.split_sizes(got).count() == 2
    with pytest.raises(ValueError):
        tb.read_named_splits(spark, {}, "id bigint")


def test_monitoring_switch(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(5)
    flags = [tb.append_monitoring(df, path, "t", s) for s in ("true", "no", None, "YES")]
    assert flags == [True, False, False, True]
    assert tb.read_monitoring(spark, path, "t").count() == 10


def put(root, *names):
    for name in names:
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"dummy bytes")


def test_class_folders(spark, tmp_path):
    put(tmp_path, *[f"foo/bar/class_{i % 4}/image_{i}.jpg" for i in range(12)])
    rows = im.read_class_folders(spark, str(tmp_path)).collect()
    assert len(rows) == 12 and "content" not in rows[0].asDict()
    assert all(r["label"] == f"class_{r['label_idx']}" and r["label"] in r["path"] for r in rows)
    assert im.class_root(im.list_files(spark, str(tmp_path))).endswith("/foo/bar")


def test_bad_class_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        im.list_files(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        im.read_class_folders(spark, str(tmp_path / "empty"))
    put(tmp_path, "one/a.jpg")
    with pytest.raises(FileNotFoundError):
        im.read_class_folders(spark, str(tmp_path / "one"))
    put(tmp_path, "single/class_0/a.jpg", "single/class_0/b.jpg")
    with pytest.raises(Exception, match="outside any class folder"):
        im.read_class_folders(spark, str(tmp_path / "single")).collect()


def test_requests(spark):
    values = [float(i) for i in range(20)]
    by_name = dict(zip(POSITIONAL_LAYOUT, values))
    table_form = {"columns": list(by_name), "index": [0, 1], "data": [values, values]}
    df = spark.createDataFrame(
        [(json.dumps({"input_data": [values, values]}), json.dumps({"input_data": table_form}))], "p string, t string"
    )
    for rows in (rq.positional_rows(df, "p").collect(), rq.split_oriented_rows(df, "t").collect()):
        assert [r["row"] for r in rows] == [0, 1]
        assert all(rows[1][f] == by_name[f] for f in TRIPS.features)
    assert by_name["store_forward"] == 6.0 and by_name["pickup_weekday"] == 8.0


def test_bad_requests(spark):
    short = spark.createDataFrame([(json.dumps({"input_data": [[1.0] * 19]}),)], "p string")
    with pytest.raises(Exception, match="19"):
        rq.positional_rows(short, "p").collect()
    body = {"columns": list(TRIPS.features[:-1]), "index": [0], "data": [[1.0] * 19]}
    lacking = spark.createDataFrame([(json.dumps({"input_data": body}),)], "t string")
    with pytest.raises(Exception, match="vendor"):
        rq.split_oriented_rows(lacking, "t").collect()


def test_text_request(spark):
    df = spark.createDataFrame([('{"data": "Los Angeles"}',)], "raw string")
    assert df.select(rq.request_text(F.col("raw")).alias("t")).first()["t"] == "Los Angeles"


def test_control_files(spark, tmp_path):
    out = ct.write_metrics_json(metrics(spark, 41.5), str(tmp_path / "m"))
    assert {r["key"]: r["value"] for r in ct.read_metrics_json(spark, out).collect()} == {
        "predict_rougeLsum": 41.5, "other": 1.0,
    }
    (tmp_path / "all_results.json").write_text('{\n "a": 1,\n "b": 2.5\n}')
    assert ct.read_metrics_json(spark, str(tmp_path / "all_results.json")).count() == 2
    scores = spark.createDataFrame([(1.234, 2.0, 3.0, 0.5)], "mse double, rmse double, mae double, r2 double")
    report = spark.read.text(ct.write_score_report(scores, "forest", str(tmp_path / "score")))
    assert [r["value"] for r in report.collect()] == [
        "Scored with the following model:", "forest", "Mean squared error: 1.23",
        "Root mean squared error: 2.00", "Mean absolute error: 3.00", "Coefficient of determination: 0.50",
    ]
    index = spark.createDataFrame([("b", 1), ("a", 0), ("c", 2)], "label string, label_idx int")
    mapping = spark.read.text(ct.write_label_mapping(index, str(tmp_path / "labels")))
    assert [r["value"] for r in mapping.collect()] == ["a", "b", "c"]


def test_flag_file_or_folder(spark, tmp_path):
    flag = spark.createDataFrame([("m", 1)], "model_name string, deploy_flag int")
    folder = ct.write_flag(flag, str(tmp_path / "out"))
    (tmp_path / "out" / "notes.txt").write_text("not a flag")
    assert ct.read_flag(spark, folder).first()["deploy_flag"] == 1
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "deploy_flag").write_text("0")
    assert ct.read_flag(spark, str(tmp_path / "plain")).first()["deploy_flag"] == 0
    assert ct.read_flag(spark, str(tmp_path / "plain" / "deploy_flag")).first()["deploy_flag"] == 0


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x").startswith(shared_dir(spark).rstrip("/"))


# --- user code ---------------------------------------------------------------


def test_user_code(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 1.0)
    doubled = apply_batches(df, lambda f: f.assign(x=f["x"] * 2), "id bigint, x double")
    assert doubled.agg(F.sum("x")).first()[0] == 90
    scored = apply_scorer(df, lambda: 3.0, lambda m, f: f.assign(x=f["x"] * m), "id bigint, x double")
    assert scored.agg(F.sum("x")).first()[0] == 135
    assert apply_metrics(df, lambda: [F.max("x").alias("m")]).first()["m"] == 9.0
    watched, seen = observed(df, F.count(F.lit(1)).alias("n"))
    watched.collect()
    assert seen.get["n"] == 10


# --- streams -----------------------------------------------------------------


def test_stream_scoring_equals_batch(spark, tmp_path):
    values = [[float(i + r) for i in range(20)] for r in range(3)]
    (tmp_path / "in").mkdir()
    for i in range(4):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"input_data": values}))
    line = md.LinearBaseline("distance", 2.0, 1.0)

    def parse(df):
        return rq.positional_rows(df, "raw", ["file_path"])

    def predict(df):
        return df.withColumn("prediction", line.predict())

    for _ in range(2):  # a second run finds nothing new
        ss.score_stream(
            ss.request_stream(spark, str(tmp_path / "in"), 2), parse, predict,
            str(tmp_path / "out"), str(tmp_path / "log"),
        ).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = spark.read.text(str(tmp_path / "in")).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path")
    )
    want = predict(parse(batch))
    assert streamed.count() == 12
    assert streamed.exceptAll(want.select(*streamed.columns)).count() == 0


def test_replayed_batch_is_written_once(spark, tmp_path):
    rows = spark.range(5)
    for _ in range(2):
        cm.write_batch(rows, 7, str(tmp_path / "t"))
    assert cm.read_batches(spark, str(tmp_path / "t"), "id bigint").count() == 5
    with pytest.raises(ValueError, match="batch_id"):
        cm.write_batch(rows.withColumn("Batch_Id", F.lit(1)), 8, str(tmp_path / "t"))


def _three_files(spark, folder):
    for day in (1, 2, 3):
        rows = spark.range(40 * day).select(
            (F.timestamp_seconds(F.lit(86400 * day) + F.col("id"))).alias("ts"), (F.col("id") % 7).cast("double").alias("value")
        )
        rows.coalesce(1).write.parquet(f"{folder}/day={day}")
    return T.StructType.fromDDL("ts timestamp, value double")


def _files(spark, schema, folder, days):
    return sm.table_stream(spark, f"{folder}/day={days}", schema)


def test_batch_killed_before_its_entry_is_never_seen(spark, tmp_path, monkeypatch):
    schema = _three_files(spark, tmp_path / "in")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def ingest():
        sm.ingest_stream(_files(spark, schema, tmp_path / "in", "*"), out, log).awaitTermination()

    enter = cm.enter
    monkeypatch.setattr(cm, "enter", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(Exception, match="killed"):
        ingest()
    assert sum(1 for _ in (tmp_path / "out").rglob("*.parquet")) > 0  # rows are there,
    assert sm.read_ingested(spark, out, schema).count() == 0  # but count for nothing
    monkeypatch.setattr(cm, "enter", enter)
    ingest()
    rows = sm.read_ingested(spark, out, schema)
    assert rows.count() == 240 and rows.select("stream", "batch_id").distinct().count() == 1
    cm.enter(spark, out, sm.stream_name(log), 0, "late")  # a writer that comes second
    assert sm.read_ingested(spark, out, schema).count() == 240


def test_drift_survives_a_restart(spark, tmp_path):
    schema = _three_files(spark, tmp_path / "in")
    reference = spark.range(70).select((F.col("id") % 5).cast("double").alias("value"))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    (tmp_path / "inbox").mkdir()

    def go_on(days, reference):
        for day in days:  # half a day's rows at a time, so windows change after the restart
            part = spark.read.schema(schema).parquet(str(tmp_path / f"in/day={day[0]}"))
            part.where(F.pmod(F.unix_seconds("ts"), F.lit(2)) == day[1]).coalesce(1).write.mode("append").parquet(
                str(tmp_path / "inbox")
            )
        sm.drift_stream(
            reference, sm.table_stream(spark, str(tmp_path / "inbox"), schema), "ts", "1 day", "value",
            [2.0, 4.0], out, log, late="9 days",
        ).awaitTermination()

    go_on([(1, 0), (2, 0)], reference)
    go_on([(1, 1), (2, 1), (3, 0), (3, 1)], spark.range(9).select(F.lit(1.0).alias("value")))  # the first one stays
    got = {r["window_start"].day: (r["n"], r["psi"]) for r in sm.read_drift(spark, out).collect()}
    whole = spark.read.schema(schema).parquet(str(tmp_path / "inbox")).withColumn("day", F.dayofmonth("ts"))
    want = {r["day"]: (r["n"], r["psi"]) for r in mo.drift_scores(reference, whole, "value", [2.0, 4.0], ["day"]).collect()}
    assert set(got) == {2, 3, 4} and {k: v[0] for k, v in got.items()} == {2: 40, 3: 80, 4: 120}
    assert all(got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_progress_log_has_the_rows_of_each_batch(spark, tmp_path):
    schema = _three_files(spark, tmp_path / "in")
    source = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "day=*"))
        .observe("train", F.max("value").alias("top"))
    )
    listener = sm.ProgressLog(spark, str(tmp_path / "runs"))
    spark.streams.addListener(listener)
    try:
        query = sm.ingest_stream(source, str(tmp_path / "out"), str(tmp_path / "log"), "watched")
        query.awaitTermination()
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    log = spark.read.schema(rg.LOG_SCHEMA).parquet(str(tmp_path / "runs")).where("run_id = 'watched'")
    logged = {r["step"]: r["value"] for r in log.where("key = 'rows'").collect()}
    stored = sm.read_ingested(spark, str(tmp_path / "out"), schema).groupBy("batch_id").count().collect()
    assert len(logged) == 3 and logged == {r["batch_id"]: r["count"] for r in stored}
    assert {r["value"] for r in log.where("key = 'train_top'").collect()} == {6.0}
    assert log.where("key = 'seconds' AND value >= 0").count() == 3


def test_a_new_version_takes_over_between_batches(spark, tmp_path):
    texts = spark.createDataFrame([("one two three " * i,) for i in range(1, 9)], "text string").withColumn(
        "n", F.size(F.split(F.trim("text"), " "))
    )
    registry, inbox, out = (str(tmp_path / name) for name in ("registry", "inbox", "out"))

    def register(times):
        model = md.fit_text(texts.withColumn("y", F.col("n") * times), "text", "y", buckets=64)
        path = md.save_model(model, str(tmp_path / f"model-{times}"))
        known = rg.read_registry(spark, registry) if times > 1 else spark.createDataFrame([], rg.REGISTRY_SCHEMA)
        rg.register_version(known, registry, "length", path, "run", True)

    def send(*bodies):
        spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.mode("append").text(inbox)

    def scores():
        ss.score_latest_stream(
            ss.request_stream(spark, inbox), lambda df: df.select(rq.request_text(F.col("raw")).alias("text")),
            lambda model, df: md.predict_text(model, df, "text"), registry, "length", out, str(tmp_path / "log"),
        ).awaitTermination()
        rows = cm.read_batches(spark, out, "text string, prediction double, version int")
        return sorted(((r["version"], r["text"] or "", r["prediction"]) for r in rows.collect()), key=lambda r: r[:2])

    register(1)
    send('{"data": "one two three"}')
    assert scores() == [(1, "one two three", pytest.approx(3, abs=1e-3))]
    register(10)
    send('{"data": "three two one"}')
    assert scores()[-1:] == [(2, "three two one", pytest.approx(30, abs=1e-2))]
    send('{"other": 1}', "not json")
    assert [(v, t, p) for v, t, p in scores()[1:] if p is None] == [(2, "", None)] * 2


def test_step_history_carries_values_over_gaps_and_blocks(spark):
    draw = random.Random(5)
    entries = [(run, "loss", draw.random(), draw.randrange(-40, 400)) for run in "ab" for _ in range(30)]
    entries += [("one", "loss", 1.0, 7), ("far", "loss", 2.0, 0), ("far", "loss", None, 5000), ("no", "loss", 3.0, None)]
    log = spark.createDataFrame(entries, "run_id string, key string, value double, step bigint").withColumn(
        "ts", F.timestamp_seconds(F.coalesce((F.col("value") * 1000).cast("int"), F.lit(0)))
    )
    for every, width, levels in ((1, 4, 2), (3, 2, 3), (10, 4096, 2), (7, 5, 0)):
        want = {}
        for run in {e[0] for e in entries if e[3] is not None}:
            own = sorted((s, int((v or 0) * 1000), v) for r, _, v, s in entries if r == run and s is not None)
            for cell in range(-(-own[0][0] // every), -(-own[-1][0] // every) + 1):
                want[run, cell * every] = [v for s, _, v in own if s <= cell * every][-1]
        got = rg.step_history(log, every, width=width, levels=levels).collect()
        assert len(got) == len(want) and {(r["run_id"], r["step"]): r["value"] for r in got} == want
    assert rg.step_history(log.limit(0)).count() == 0


def test_step_history_fills_stretches_of_any_length(spark):
    big = 1 << 60  # beyond the whole numbers that a double holds
    entries = [("a", "loss", 1.0, -9), ("a", "loss", None, -2), ("a", "loss", 2.0, 11), ("b", "loss", 3.0, 4), ("b", "acc", 4.0, 5)]
    entries += [("b", "loss", 5.0, 9), ("big", "loss", 6.0, big), ("big", "loss", 7.0, big + 2048), (None, "loss", 8.0, 1)]
    log = spark.createDataFrame(entries, "run_id string, key string, value double, step bigint").withColumn(
        "ts", F.lit(None).cast("timestamp")
    )
    want = {("a", "loss", s): 1.0 if s < -2 else None if s < 11 else 2.0 for s in range(-9, 12)}
    want |= {("b", "loss", s): 3.0 if s < 9 else 5.0 for s in range(4, 10)} | {("b", "acc", 5): 4.0, (None, "loss", 1): 8.0}
    want |= {("big", "loss", s): 6.0 if s < big + 2048 else 7.0 for s in range(big, big + 2049)}
    for stretch, group in ((1, 1), (3, 2), (8, 4096), (512, 4096)):
        got = rg.step_history(log, stretch=stretch, group=group).collect()
        assert len(got) == len(want) and {(r["run_id"], r["key"], r["step"]): r["value"] for r in got} == want


def test_step_history_is_small_when_written(spark, tmp_path):
    runs = spark.range(200).select(F.concat(F.lit("run"), "id").alias("run_id"), F.lit("loss").alias("key"), "id")
    log = runs.select("*", F.explode(F.sequence(F.lit(0), F.lit(5000), F.lit(1000))).alias("at")).select(
        "run_id", "key", (F.col("id") + F.col("at") * 1.5).alias("value"),
        (F.col("at") + F.pmod(F.hash("id", "at"), F.lit(900))).cast("bigint").alias("step"), F.current_timestamp().alias("ts"),
    )
    out = tmp_path / "history"
    rg.step_history(log).write.option("compression", "snappy").parquet(str(out))
    rows = spark.read.parquet(str(out)).count()
    assert 900_000 < rows < 1_200_000
    assert sum(f.stat().st_size for f in out.glob("part-*")) < 0.8 * rows  # 13 bits a step, were none repeated


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "ts timestamp_ntz, value double, kind string"
    batches = [
        [("2024-01-01 00:05:00", 1.0, "a"), ("2024-01-01 03:00:00", 2.0, "b")],
        [("2024-01-01 00:30:00", 9.0, "a"), ("2024-01-01 06:00:00", 4.0, "a")],  # the first one is late
        [("2024-01-01 09:00:00", 5.0, "b")],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "ts string, value double, kind string")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )
        stream = sm.table_stream(spark, str(tmp_path / "in"), df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).schema)
        sm.summary_stream(
            stream, "ts", "1 hour", "value", "kind", ["a", "b"], str(tmp_path / "out"), str(tmp_path / "log")
        ).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    first = rows[0]
    assert (first["n"], first["mean"], first["share_a"]) == (1, 1.0, 1.0)
    assert len(rows) == 3 and schema


def test_release_forgets_saved_forests(spark):
    from modelyard import session
    from modelyard.plans import tabular

    tabular._FORESTS["here", "there"] = "gone"
    session.release(spark)
    assert not tabular._FORESTS


def test_prediction_files_are_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(2000).select(F.lit("file:///a/rather/long/name.csv").alias("file_path"), F.col("id").alias("trip_key"))
    out = tb.append_predictions(rows, str(tmp_path / "outbox"))
    tb.append_predictions(rows.limit(5), out)
    files = [f for f in (tmp_path / "outbox").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 2005 and back.agg(F.min("file_path")).first()[0] == "file:///a/rather/long/name.csv"


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    def measure(frame):
        return frame.assign(rows=len(frame), size=frame["text"].str.len().sum())[["id", "rows", "size"]]

    long = spark.range(400, numPartitions=1).select("id", F.repeat(F.lit("x"), 20000).alias("text"))
    seen = apply_batches(long, measure, "id bigint, rows bigint, size bigint").collect()
    assert sorted(r["id"] for r in seen) == list(range(400))
    assert max(r["size"] for r in seen) < 2 << 20 and max(r["rows"] for r in seen) < 100
