"""Tabular workflow: scan, split, baseline, predictions, metrics, gate, scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..operators import models as md
from ..operators import registry as rg
from ..operators import split as sp
from ..operators.userdefined import apply_partials, apply_scorer, read_rows
from ..session import on_release, workspace
from ..sources import controls as ct
from ..sources import requests as rq
from ..sources import tables as tb
from ..spec import POSITIONAL_LAYOUT, TRIPS
from .base import SPLIT_TRIPS_SQL, TRIPS_SQL, query, table, trips

_FIT_SQL = """fit AS (SELECT regr_slope(cost, distance) AS s, regr_intercept(cost, distance) AS i
                       FROM parts WHERE split = 'train')"""
_SCORED_SQL = f"""{SPLIT_TRIPS_SQL}, {_FIT_SQL},
  scored AS (SELECT t.*, fit.s * t.distance + fit.i AS prediction
             FROM parts t, fit WHERE t.split = 'test')"""
_METRICS_SQL = """
  SELECT {by} count(*) AS n, avg((cost - prediction) * (cost - prediction)) AS mse,
         sqrt(avg((cost - prediction) * (cost - prediction))) AS rmse,
         avg(abs(cost - prediction)) AS mae,
         1 - avg((cost - prediction) * (cost - prediction)) / var_pop(cost) AS r2
  FROM {rows} {group}"""


def rounded(metrics, *keep):
    return metrics.select(
        *keep, "n", F.round("mse", 0).alias("mse"), F.round("rmse", 2).alias("rmse"),
        F.round("mae", 2).alias("mae"), F.round("r2", 6).alias("r2"),
    )


_ROUND_SQL = "n, round(mse, 0) AS mse, round(rmse, 2) AS rmse, round(mae, 2) AS mae, round(r2, 6) AS r2"


ORDER = ["order_id"]  # a trip's lines share the split of their order


def split_trips(spark, d, *columns):
    """Contract columns needed by a query, labelled with their split."""
    return sp.hash_split(trips(spark, d).select("order_id", *columns), ORDER)


def train_and_test(spark, d, *columns):
    rows = trips(spark, d).select("order_id", *columns)
    return sp.split_rows(rows, ORDER, "train"), sp.split_rows(rows, ORDER, "test")


def scored_test(spark, d, *keep):
    """Test trips with the prediction of the line fitted on the training trips."""
    columns = dict.fromkeys(("distance", "cost", *keep))
    train, test = train_and_test(spark, d, *columns)
    model = md.baseline_lines(train, ["distance"], "cost")["distance"]
    return test.withColumn("prediction", model.predict())


@query(
    "baseline_workflow",
    f"""WITH {_SCORED_SQL}, {"m AS (" + _METRICS_SQL.format(by="", rows="scored", group="") + ")"},
    best AS (SELECT max(p_retailprice) / 2500.0 AS best FROM part WHERE p_brand = 'Brand#1')
    SELECT {_ROUND_SQL}, CAST(CASE WHEN best IS NULL OR r2 >= best THEN 1 ELSE 0 END AS INTEGER) AS deploy_flag
    FROM m, best""",
)
def baseline_workflow(spark, d):
    """Project, split, fit, predict, measure and gate in one plan."""
    metrics = mt.regression_metrics(scored_test(spark, d), "cost", "prediction")
    known = table(spark, d, "part").where(F.col("p_brand") == "Brand#1").select(
        (F.col("p_retailprice") / 2500.0).alias("r2")
    )
    gated = metrics.withColumn("deploy_flag", rg.tabular_gate(F.col("r2"), rg.best_score(known)))
    return rounded(gated, "deploy_flag")


@query(
    "parquet_scan_s2",
    """SELECT l_returnflag, count(*) AS rows, round(sum(l_quantity), 2) AS quantity
       FROM lineitem GROUP BY 1""",
)
def parquet_scan(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "split_parquet_s3",
    f"""WITH {SPLIT_TRIPS_SQL} SELECT count(*) AS rows, round(sum(cost), 0) AS cost FROM parts
        WHERE split = 'val'""",
)
def split_parquet(spark, d):
    out = tb.write_splits(split_trips(spark, d, *TRIPS.columns), workspace(spark, "splits"))
    return tb.read_split(spark, out, "val").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("cost"), 0).alias("cost")
    )


@query(
    "predictions_p6",
    f"""WITH {_SCORED_SQL} SELECT trip_id, {', '.join(TRIPS.features)}, cost AS real_label,
        round(prediction, 2) AS predicted_label FROM scored""",
)
def predictions(spark, d):
    scored = scored_test(spark, d, "trip_id", *TRIPS.features)
    return md.with_predictions(
        scored, "cost", F.round("prediction", 2), ["trip_id", *TRIPS.features]
    )


@query(
    "predictions_csv_s4",
    f"""WITH {_SCORED_SQL} SELECT count(*) AS rows, CAST(sum(length(trip_id)) AS BIGINT) AS key_characters,
        round(sum(cost), 0) AS real_label, round(sum(prediction), 0) AS predicted_label FROM scored""",
)
def predictions_csv(spark, d):
    scored = scored_test(spark, d, "trip_id", *TRIPS.features)
    frame = md.with_predictions(scored, "cost", F.col("prediction"), ["trip_id", *TRIPS.features])
    out = tb.write_csv(frame, workspace(spark, "predictions"))
    back = spark.read.option("header", True).csv(out)
    return back.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length("trip_id")).alias("key_characters"),
        F.round(F.sum(F.col("real_label").cast("double")), 0).alias("real_label"),
        F.round(F.sum(F.col("predicted_label").cast("double")), 0).alias("predicted_label"),
    )


@query(
    "trips_csv_s1",
    f"""WITH {TRIPS_SQL} SELECT vendor, count(*) AS rows, round(sum(cost), 0) AS cost,
        CAST(sum(dropoff_weekday) AS BIGINT) AS weekdays FROM trips GROUP BY vendor""",
)
def trips_csv(spark, d):
    out = tb.write_csv(trips(spark, d).select("trip_id", *TRIPS.columns), workspace(spark, "trips"))
    return tb.read_csv(spark, out).groupBy("vendor").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("cost"), 0).alias("cost"),
        F.sum("dropoff_weekday").alias("weekdays"),
    )


def _request_pairs(spark, d):
    """Trips with their values as one JSON row per layout."""
    rows = trips(spark, d)

    def values(names):
        return F.array(*[F.col(c).cast("double") for c in names])

    positional = F.to_json(F.struct(F.array(values(POSITIONAL_LAYOUT)).alias("input_data")))
    reversed_names = list(reversed(TRIPS.features))
    table_form = F.struct(
        F.array(*map(F.lit, reversed_names)).alias("columns"),
        F.array(F.lit(0)).alias("index"),
        F.array(values(reversed_names)).alias("data"),
    )
    return rows.select(
        "trip_id", positional.alias("positional"),
        F.to_json(F.struct(table_form.alias("input_data"))).alias("table_form"),
    )


_REQUEST_SQL = (
    f"WITH {TRIPS_SQL} SELECT trip_id, CAST(0 AS BIGINT) AS row, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in TRIPS.features)
    + " FROM trips"
)


@query("positional_requests_s12", _REQUEST_SQL)
def positional_requests(spark, d):
    rows = rq.positional_rows(_request_pairs(spark, d), "positional", ["trip_id"])
    return rows.withColumn("row", F.col("row").cast("bigint"))


@query("table_requests_s13", _REQUEST_SQL)
def table_requests(spark, d):
    return rq.split_oriented_rows(_request_pairs(spark, d), "table_form", ["trip_id"])


@query(
    "text_requests_s14",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def text_requests(spark, d):
    wrapped = F.regexp_replace(F.col("props"), '"k"', '"data"')
    return table(spark, d, "events").select("event_id", rq.request_text(wrapped).alias("k"))


@query(
    "regression_metrics_a1",
    f"""WITH {_SCORED_SQL}, m AS ({_METRICS_SQL.format(by="vendor,", rows="scored", group="GROUP BY vendor")})
        SELECT vendor, {_ROUND_SQL} FROM m""",
)
def regression_metrics(spark, d):
    scored = scored_test(spark, d, "vendor")
    return rounded(mt.regression_metrics(scored, "cost", "prediction", ["vendor"]), "vendor")


@query(
    "linear_baseline_m14",
    f"""WITH {SPLIT_TRIPS_SQL}, f AS (SELECT * FROM parts WHERE split = 'train')
    SELECT 'distance' AS feature, round(regr_slope(cost, distance), 4) AS slope,
           round(regr_intercept(cost, distance), 3) AS intercept FROM f
    UNION ALL SELECT 'passengers', round(regr_slope(cost, passengers), 4),
           round(regr_intercept(cost, passengers), 3) FROM f""",
)
def linear_baseline(spark, d):
    train, _ = train_and_test(spark, d, "distance", "passengers", "cost")
    lines = md.baseline_parameters(train, ["distance", "passengers"], "cost")
    return lines.select(
        "feature", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


_LINES = ("distance", "passengers", "pickup_latitude", "dropoff_latitude")


def _versions(spark, d):
    """Test trips scored by every version: one line per feature, and their blend."""
    train, test = train_and_test(spark, d, *_LINES, "cost")
    lines = md.baseline_lines(train, _LINES, "cost")
    versions = {str(i + 1): lines[f].predict() for i, f in enumerate(_LINES)}
    versions["current"] = md.blend(list(lines.values()))
    return md.score_versions(test, versions, ["cost"])


_VERSIONS_SQL = f"""{SPLIT_TRIPS_SQL}, fit AS (SELECT
    {', '.join(f"regr_slope(cost, {f}) AS s{i}, regr_intercept(cost, {f}) AS i{i}" for i, f in enumerate(_LINES, 1))}
    FROM parts WHERE split = 'train'),
  wide AS (SELECT trip_id, cost, {', '.join(f"s{i} * {f} + i{i} AS p{i}" for i, f in enumerate(_LINES, 1))}
    FROM parts, fit WHERE split = 'test'),
  scored AS ({' UNION ALL '.join(f"SELECT '{i}' AS version, trip_id, cost, p{i} AS prediction FROM wide" for i in range(1, 5))}
    UNION ALL SELECT 'current', trip_id, cost, (p1 + p2 + p3 + p4) / 4.0 FROM wide)"""


@query(
    "score_versions_j4",
    f"""WITH {_VERSIONS_SQL} SELECT version, count(*) AS rows, round(avg(prediction), 2) AS mean_prediction FROM scored GROUP BY version""",
)
def score_versions(spark, d):
    return _versions(spark, d).groupBy("version").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("prediction"), 2).alias("mean_prediction"),
    )


_VERSION_METRICS_SQL = f"""{_VERSIONS_SQL},
  m AS ({_METRICS_SQL.format(by="version,", rows="scored", group="GROUP BY version")})"""


@query("version_metrics_m10", f"WITH {_VERSION_METRICS_SQL} SELECT version, {_ROUND_SQL} FROM m")
def version_metrics(spark, d):
    return rounded(md.version_metrics(_versions(spark, d), "cost"), "version")


@query(
    "leaderboard_w3",
    f"""WITH {_VERSION_METRICS_SQL} SELECT version, round(r2, 6) AS r2,
        CAST(dense_rank() OVER (ORDER BY round(r2, 6) DESC) AS INTEGER) AS rank FROM m""",
)
def leaderboard(spark, d):
    scores = rounded(md.version_metrics(_versions(spark, d), "cost"), "version")
    return rg.leaderboard(scores.select("version", "r2"))


@query(
    "prediction_histogram_m13",
    f"""WITH {_SCORED_SQL} SELECT CAST(floor(cost / 5000) AS BIGINT) AS real_bin,
        CAST(floor(prediction / 5000) AS BIGINT) AS predicted_bin, count(*) AS n FROM scored GROUP BY 1, 2""",
)
def prediction_histogram(spark, d):
    return rg.prediction_histogram(scored_test(spark, d), "cost", "prediction", 5000)


def registered_line(spark, d):
    """A line fitted on the training trips, saved, registered, resolved and loaded again."""
    train, _ = train_and_test(spark, d, "distance", "cost")
    saved = md.save_model(md.fit_linear(train, ["distance"], "cost"), workspace(spark, "line"))
    path = workspace(spark, "registry")
    rg.register_version(spark.createDataFrame([], rg.REGISTRY_SCHEMA), path, "trips", saved, "run-1", True)
    return md.load_asset(rg.read_registry(spark, path), "trips@latest")


@query(
    "batch_scoring_m11",
    f"""WITH {SPLIT_TRIPS_SQL}, {_FIT_SQL} SELECT count(*) FILTER (order_id % 100 <> 0) AS rows,
        CAST(sum(length(trip_id)) FILTER (order_id % 100 <> 0) AS BIGINT) AS key_characters,
        round(sum(fit.s * distance + fit.i) FILTER (order_id % 100 <> 0), -2) AS predicted_label,
        count(*) FILTER (order_id % 100 = 0) AS rejected,
        count(DISTINCT trip_id) FILTER (order_id % 100 = 0) AS rejected_keys FROM parts, fit""",
)
def batch_scoring(spark, d):
    """Files in two column orders, some rows broken, scored by a registered model.

    Predictions keep file and key; rows that cannot be scored land in a reject table.
    """
    model = registered_line(spark, d)
    broken = F.col("order_id") % 100 == 0
    keyed = trips(spark, d).withColumn("distance", F.when(broken, F.lit("n/a")).otherwise(F.col("distance").cast("string")))
    inbox, rejects = workspace(spark, "inbox"), workspace(spark, "rejects")
    names = ["trip_key", *TRIPS.features]
    keyed = keyed.withColumnRenamed("trip_id", "trip_key")
    tb.write_csv(keyed.where("order_id % 2 = 0").select(*names), inbox, mode="append")
    tb.write_csv(keyed.where("order_id % 2 = 1").select(*reversed(names)), inbox, mode="append")
    files = tb.read_scoring_files(spark, inbox, keys=["trip_key"])
    tb.write_rejects(files, rejects, ["trip_key"])
    scored = md.predict(model, files.where("valid")).select(
        "file_path", "trip_key", F.col("prediction").alias("predicted_label")
    )
    out = tb.append_predictions(scored, workspace(spark, "outbox"))
    lost = spark.read.parquet(rejects).where("problem = 'distance'").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_distinct("trip_key").alias("rejected_keys")
    )
    back = spark.read.option("header", True).csv(out)
    return back.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("trip_key")).alias("key_characters"),
        F.round(F.sum(F.col("predicted_label").cast("double")), -2).alias("predicted_label"),
        F.max(lost.select("rejected").scalar()).alias("rejected"),
        F.max(lost.select("rejected_keys").scalar()).alias("rejected_keys"),
    )


@query(
    "mixed_requests_s12",
    """SELECT count(*) FILTER (o_orderkey % 7 <> 0) AS parsed, count(*) FILTER (o_orderkey % 7 = 0) AS rejected,
       round(sum(o_totalprice) FILTER (o_orderkey % 7 <> 0), 0) AS price FROM orders""",
)
def mixed_requests(spark, d):
    """Good and broken requests: the good ones are read, the others kept with a reason."""
    width = len(POSITIONAL_LAYOUT)
    body = F.to_json(F.struct(F.array(F.array_repeat(F.col("o_totalprice"), width)).alias("input_data")))
    cut = F.when(F.col("o_orderkey") % 21 == 0, F.substring(body, 1, 30)).when(
        F.col("o_orderkey") % 7 == 0, F.regexp_replace(body, "input_data", "data")
    )
    requests = table(spark, d, "orders").select("o_orderkey", F.coalesce(cut, body).alias("raw"))
    rows = rq.rows_and_rejects(requests, "raw", ["o_orderkey"])
    return rows.agg(
        F.count_if(F.col("reason").isNull()).alias("parsed"),
        F.count("reason").alias("rejected"),
        F.round(F.sum(TRIPS.features[0]), 0).alias("price"),
    )


@query(
    "user_scorer_udf",
    f"""WITH {SPLIT_TRIPS_SQL}, {_FIT_SQL} SELECT trip_id, round(fit.s * distance + fit.i, 2) AS predicted_label
       FROM parts, fit WHERE split = 'test'""",
)
def user_scorer(spark, d):
    """User scorer hook: saved parameters loaded once per task, rows scored in Arrow batches."""
    return _scored_by_user(spark, d, train_and_test(spark, d, "trip_id", "distance")[1].select("trip_id", "distance"))


def _scored_by_user(spark, d, rows):
    train, _ = train_and_test(spark, d, "distance", "cost")
    saved = workspace(spark, "line-parameters")
    md.baseline_parameters(train, ["distance"], "cost").coalesce(1).write.parquet(saved)

    def init():
        line = read_rows(saved)[0]
        return line["slope"], line["intercept"]

    def run(model, frame):
        frame["predicted_label"] = (frame.pop("distance") * model[0] + model[1]).round(2)
        return frame

    return apply_scorer(rows, init, run, "trip_id string, predicted_label double")


@query(
    "metric_callback_udf",
    f"""WITH {_SCORED_SQL} SELECT count(*) AS n, round(avg(abs(cost - prediction) / cost), 6) AS mape,
        round(sqrt(avg(power(ln(1 + cost) - ln(1 + greatest(prediction, 0)), 2))), 6) AS rmsle FROM scored""",
)
def metric_callback(spark, d):
    """Metrics of the user's own code: sums per Arrow batch, finished over the totals."""

    def partial(frame):
        import numpy as np

        real, predicted = frame["cost"], frame["prediction"]
        logs = np.log1p(real) - np.log1p(predicted.clip(lower=0))
        return {"n": len(frame), "ape": ((real - predicted).abs() / real).sum(), "sle": (logs ** 2).sum()}

    def finish():
        return [
            F.col("n").cast("bigint").alias("n"), F.round(F.col("ape") / F.col("n"), 6).alias("mape"),
            F.round(F.sqrt(F.col("sle") / F.col("n")), 6).alias("rmsle"),
        ]

    rows = scored_test(spark, d).select("cost", "prediction")
    return apply_partials(rows, partial, ["n", "ape", "sle"], finish)


_FORESTS: dict[tuple[str, str], str] = {}
on_release(_FORESTS.clear)

# A price with a known answer, since the driver's prices follow no feature.
KNOWN_PRICE_SQL = "(3 * distance + 20 * passengers)"


def _known_price(spark, d):
    """Training and test trips whose price is three per distance and twenty per passenger."""
    price = 3 * F.col("distance") + 20 * F.col("passengers")
    return tuple(t.withColumn("cost", price.cast("double")) for t in train_and_test(spark, d, *TRIPS.columns))


def saved_forest(spark, d):
    """Path of the forest of the declared size and all features over the training trips.

    It is fitted once per session and table; the queries that need it load the saved one.
    """
    place = (spark.sparkContext.applicationId, d)
    if place not in _FORESTS:
        train, _ = _known_price(spark, d)
        _FORESTS[place] = md.save_model(md.fit_forest(train, TRIPS), workspace(spark, "forest"))
    return _FORESTS[place]


@query(
    "features_and_target_p2",
    f"""WITH {TRIPS_SQL} SELECT trip_id, round({' + '.join(TRIPS.features)}, 4) AS feature_sum,
        CAST({len(TRIPS.features)} AS INTEGER) AS width, cost AS label FROM trips""",
)
def features_and_target(spark, d):
    """Feature vector in contract order beside the target."""
    vectors = md.assembler(TRIPS).transform(trips(spark, d))
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return vectors.select(
        "trip_id", F.round(total, 4).alias("feature_sum"), F.size(values).alias("width"),
        F.col(TRIPS.target).alias("label"),
    )


_PARTS_SQL = f"""{SPLIT_TRIPS_SQL}, sizes AS (SELECT count(*) FILTER (split = 'test') AS n FROM parts)"""


@query(
    "forest_workflow_m1",
    f"""WITH {SPLIT_TRIPS_SQL}, price AS (SELECT split, distance, passengers, {KNOWN_PRICE_SQL} AS y FROM parts),
        fit AS (SELECT regr_slope(y - 20 * passengers, distance) AS s, regr_slope(y - 3 * distance, passengers) AS p
                FROM price WHERE split = 'train')
        SELECT count(*) AS n, round(var_pop(y), 4) AS variance,
               1 - avg((y - s * distance - p * passengers) ** 2) / var_pop(y) > 0.9 AS explained FROM price, fit WHERE split = 'test'""",
)
def forest_workflow(spark, d):
    """The forest of a price with a known answer, measured on the test trips: their number, the
    variance of their prices, and whether the forest explains more than nine tenths of it."""
    _, test = _known_price(spark, d)
    scored = md.predict(md.load_model(saved_forest(spark, d)), test)
    spread = test.agg(F.round(F.var_pop("cost"), 4)).scalar()
    metrics = mt.regression_metrics(scored, "cost", "prediction")
    return metrics.select("n", spread.alias("variance"), (F.col("r2") > 0.9).alias("explained"))


@query(
    "forest_versions_m3",
    f"""WITH {_PARTS_SQL} SELECT version, n, CAST(0 AS BIGINT) AS differ FROM sizes, (SELECT unnest(['forest', 'line']) AS version)""",
)
def forest_versions(spark, d):
    """Saved models loaded again: rows on which a loaded and its first model differ."""
    train, test = train_and_test(spark, d, "trip_id", *TRIPS.columns)
    line = md.fit_linear(train, list(TRIPS.features[:4]), "cost")
    forest = md.load_model(saved_forest(spark, d))
    versions = {}
    for name, model in (("forest", forest), ("line", line)):
        versions[name] = (model, md.load_model(md.save_model(model, workspace(spark, f"again-{name}"))))
    wide = test
    for name, pair in versions.items():
        for side, model in zip(("first", "again"), pair):
            wide = model.transform(wide.drop("features")).withColumnRenamed("prediction", f"{name}_{side}")
    differ = [
        F.struct(F.lit(name).alias("version"), (~F.col(f"{name}_first").eqNullSafe(F.col(f"{name}_again"))).cast("int").alias("d"))
        for name in versions
    ]
    return wide.select(F.inline(F.array(*differ))).groupBy("version").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d").alias("differ")
    )


@query(
    "score_report_s18",
    f"""WITH {_SCORED_SQL}, m AS ({_METRICS_SQL.format(by="", rows="scored", group="")})
        SELECT unnest(['Scored with the following model:', 'distance baseline',
          'Mean squared error: ' || printf('%.0f', mse),
          'Root mean squared error: ' || printf('%.2f', rmse),
          'Mean absolute error: ' || printf('%.2f', mae),
          'Coefficient of determination: ' || printf('%.2f', r2)]) AS line FROM m""",
)
def score_report(spark, d):
    metrics = mt.regression_metrics(scored_test(spark, d), "cost", "prediction")
    out = ct.write_score_report(metrics, "distance baseline", workspace(spark, "score"))
    line = F.col("value")
    # two decimals of a mean of squares lie beyond what two engines sum alike
    whole = F.when(line.startswith("Mean squared"), F.concat(
        F.lit("Mean squared error: "), F.round(F.regexp_extract(line, "([0-9.]+)$", 1).cast("double"), 0).cast("bigint").cast("string")
    )).otherwise(line)
    return spark.read.text(out).select(whole.alias("line"))
