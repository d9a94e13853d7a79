"""Responsible-AI insight tables over scored test trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import insights as ins
from ..operators import models as md
from ..session import cut_lineage
from .base import SPLIT_TRIPS_SQL, TRIPS_SQL, query, trips
from ..spec import TRIPS
from .tabular import KNOWN_PRICE_SQL, saved_forest, train_and_test

_LINES_SQL = f"""{SPLIT_TRIPS_SQL}, fit AS (SELECT regr_slope(cost, distance) AS s1, regr_intercept(cost, distance) AS i1,
    regr_slope(cost, passengers) AS s2, regr_intercept(cost, passengers) AS i2 FROM parts WHERE split = 'train'),
  test AS (SELECT t.*, (s1 * distance + i1 + s2 * passengers + i2) / 2.0 AS prediction
           FROM parts t, fit WHERE split = 'test')"""


def _blended(spark, d, *columns):
    """Test trips with the blend of the distance and the passenger line."""
    train, test = train_and_test(spark, d, "trip_id", "distance", "passengers", "cost", *columns)
    return test, md.baseline_lines(train, ["distance", "passengers"], "cost")


def _scored(spark, d):
    test, lines = _blended(spark, d, "store_forward", "vendor")
    return test.withColumn("prediction", md.blend(list(lines.values()))), lines


_ERRORS_SQL = """SELECT avg((cost - prediction) ** 2) AS mse,
  avg((cost - (s1 * dd + i1 + s2 * passengers + i2) / 2.0) ** 2) AS m1,
  avg((cost - (s1 * distance + i1 + s2 * dp + i2) / 2.0) ** 2) AS m2 FROM r JOIN o USING (p), fit"""
_MATCHED_SQL = """r AS (SELECT *, row_number() OVER (ORDER BY md5('0-rows|' || trip_id), trip_id) AS p FROM test),
  o AS (SELECT distance AS dd, passengers AS dp, CASE WHEN p = 1 THEN (SELECT count(*) FROM r) ELSE p - 1 END AS p FROM r)"""
_IMPORTANCE_SQL = """SELECT 'distance' AS feature, round(mse, 0) AS mse, round(m1, 0) AS permuted_mse,
  round(m1 - mse, 0) AS importance FROM e
  UNION ALL SELECT 'passengers', round(mse, 0), round(m2, 0), round(m2 - mse, 0) FROM e"""


@query(
    "permutation_importance_i2",
    f"""WITH {_LINES_SQL}, {_MATCHED_SQL},
    e AS ({_ERRORS_SQL}) {_IMPORTANCE_SQL}""",
)
def permutation_importance(spark, d):
    test, lines = _blended(spark, d)
    model = md.blend(list(lines.values()))
    table = ins.permutation_importance(
        test, ["trip_id"], ["distance", "passengers"], "cost", lambda df, out: df.withColumn(out, model)
    )
    return table.select(
        "feature", *[F.round(c, 0).alias(c) for c in ("mse", "permuted_mse", "importance")]
    )


_CORRELATIONS_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CASE WHEN var_pop({f}) > 0 THEN abs(corr({f}, {KNOWN_PRICE_SQL})) ELSE 0 END AS c FROM train"
    for f in TRIPS.features
)


@query(
    "forest_importance_i2",
    f"""WITH {SPLIT_TRIPS_SQL}, train AS (SELECT * FROM parts WHERE split = 'train'), seen AS ({_CORRELATIONS_SQL})
        SELECT feature, rank() OVER (ORDER BY c DESC) <= 2 AS leading FROM seen""",
)
def forest_importance(spark, d):
    """Split importances of the forest over a price with a known answer: its two features lead."""
    listed = ins.model_importance(md.load_model(saved_forest(spark, d)), TRIPS)
    third = sorted((share for _, share in listed), reverse=True)[2]  # one number per feature of the contract
    rows = spark.createDataFrame(listed, "feature string, importance double")
    return rows.select("feature", (F.col("importance") > third).alias("leading"))


def _causal_sql(treatment: str, other: str, source: str = "trips") -> str:
    cell = f"store_forward, vendor, {other}"
    return f"""SELECT store_forward, vendor, '{treatment}' AS treatment,
        cost - avg(cost) OVER (PARTITION BY {cell}) AS y,
        {treatment} - avg({treatment}) OVER (PARTITION BY {cell}) AS t FROM {source}"""


def _segments_sql(source: str, digits: int = 3) -> str:
    head = f"SELECT treatment, {{}} AS segment, {{}} AS level, count(*) AS n, round(regr_slope(y, t), {digits}) AS effect FROM {source}"
    return " UNION ALL ".join(
        [
            head.format("'all'", "'all'") + " GROUP BY 1, 2, 3",
            head.format("'store_forward'", "CAST(store_forward AS VARCHAR)") + " GROUP BY 1, 2, 3",
            head.format("'vendor'", "CAST(vendor AS VARCHAR)") + " GROUP BY 1, 2, 3",
        ]
    )


def _causal_query(treatment: str, other: str):
    sql = f"WITH {TRIPS_SQL}, c AS ({_causal_sql(treatment, other)}) {_segments_sql('c')}"

    @query(f"causal_effect_{treatment}_i3", sql)
    def causal(spark, d):
        effect = ins.causal_effect(
            trips(spark, d), "cost", [treatment], ["store_forward", "vendor", other],
            ["store_forward", "vendor"],
        )
        return effect.withColumn("effect", F.round("effect", 3))


_causal_query("distance", "passengers")
_causal_query("passengers", "distance")


# A price with known effects: other features drive it as well, and are taken off as controls.
_KNOWN_SQL = f"""{TRIPS_SQL}, known AS (SELECT store_forward, vendor, distance, passengers,
    3 * distance + 2 * passengers + 5 * store_forward - 7 * vendor + 100 AS price FROM trips),
  alone AS (SELECT store_forward, vendor, 'distance' AS treatment, distance AS t,
      price - 2 * passengers - 5 * store_forward + 7 * vendor AS y FROM known
    UNION ALL SELECT store_forward, vendor, 'passengers', passengers,
      price - 3 * distance - 5 * store_forward + 7 * vendor FROM known)"""


@query("causal_effect_residual_i3", f"WITH {_KNOWN_SQL} {_segments_sql('alone', 6)}")
def causal_effect_residual(spark, d):
    """Effects on a price with known effects, with all other features as controls."""
    price = 3 * F.col("distance") + 2 * F.col("passengers") + 5 * F.col("store_forward") - 7 * F.col("vendor") + 100
    effects = ins.causal_effect_residual(
        trips(spark, d).withColumn("cost", price), ["trip_id"], "cost", ["distance", "passengers"],
        TRIPS.features, ["store_forward", "vendor"],
    )
    return effects.withColumn("effect", F.round("effect", 6))


_BINS_SQL = """SELECT CAST(floor(distance / 10) AS BIGINT) AS distance_bin,
  CAST(floor(passengers / 2) AS BIGINT) AS passengers_bin, (cost - prediction) ** 2 AS se FROM test"""
_CUBE_SQL = """SELECT distance_bin, passengers_bin, count(*) AS n, round(avg(se), 0) AS mse,
  round(sum(se) / (SELECT sum(se) FROM b), 6) AS error_share FROM b GROUP BY CUBE (distance_bin, passengers_bin)"""


@query("error_analysis_i4", f"WITH {_LINES_SQL}, b AS ({_BINS_SQL}) {_CUBE_SQL}")
def error_analysis(spark, d):
    scored, _ = _scored(spark, d)
    cube = ins.error_analysis(scored, "cost", "prediction", {"distance": 10.0, "passengers": 2.0})
    return cube.select(
        "distance_bin", "passengers_bin", "n", F.round("mse", 0).alias("mse"),
        F.round("error_share", 6).alias("error_share"),
    )


# The desired range follows the predictions: their mean, give or take a quarter of their deviation.
_COUNTERFACTUAL_SQL = f"""{_LINES_SQL},
  desired AS (SELECT round(avg(prediction) - stddev(prediction) / 4) AS low, round(avg(prediction) + stddev(prediction) / 4) AS high FROM test),
  marked AS (SELECT *, prediction BETWEEN low AND high AS inside FROM test, desired),
  views AS (SELECT trip_id, inside, 'distance' AS feature, store_forward || '|' || vendor || '|' || passengers AS block,
              distance AS value, 10.0 AS scale FROM marked
            UNION ALL SELECT trip_id, inside, 'passengers', store_forward || '|' || vendor || '|' || CAST(distance AS VARCHAR),
              CAST(passengers AS DOUBLE), 2.0 FROM marked),
  cand AS (SELECT feature, block, value AS new_value, count(*) AS support, min(trip_id) AS example FROM views WHERE inside GROUP BY 1, 2, 3),
  near AS (SELECT trip_id, feature, new_value, abs(value - new_value) / scale AS distance, example, support,
      row_number() OVER (PARTITION BY trip_id ORDER BY abs(value - new_value) / scale, feature, new_value) AS rank
    FROM views JOIN cand USING (feature, block) WHERE NOT inside)"""


def _counterfactuals(spark, d):
    scored, _ = _scored(spark, d)
    return _answers(scored)


def _answers(scored):
    return ins.counterfactuals(
        scored, "trip_id", {"distance": 10.0, "passengers": 2.0}, ["store_forward", "vendor"], *ins.prediction_range(scored)
    )


@query(
    "counterfactuals_i5",
    f"""WITH {_COUNTERFACTUAL_SQL} SELECT trip_id, CAST(rank AS INTEGER) AS rank, feature, new_value,
        round(distance, 6) AS distance, example, CAST(support AS BIGINT) AS support FROM near WHERE rank <= 10""",
)
def counterfactuals(spark, d):
    return _counterfactuals(spark, d).withColumn("distance", F.round("distance", 6))


@query(
    "counterfactual_importance_i5",
    f"""WITH {_COUNTERFACTUAL_SQL}, kept AS (SELECT * FROM near WHERE rank <= 10) SELECT feature, count(*) AS n,
        round(count(*) / (SELECT count(*) FROM kept), 6) AS share FROM kept GROUP BY 1""",
)
def counterfactual_importance(spark, d):
    shares = ins.counterfactual_importance(_counterfactuals(spark, d))
    return shares.withColumn("share", F.round("share", 6))


@query(
    "counterfactual_profiles_i5",
    f"""WITH {_COUNTERFACTUAL_SQL},
      profiles AS (SELECT store_forward, vendor, distance AS new_distance, CAST(passengers AS DOUBLE) AS new_passengers,
          count(*) AS support, min(trip_id) AS example FROM marked WHERE inside GROUP BY 1, 2, 3, 4),
      ranked AS (SELECT trip_id, new_distance, new_passengers, support, example,
          CAST(distance <> new_distance AS INTEGER) + CAST(passengers <> new_passengers AS INTEGER) AS n_changed,
          abs(m.distance - new_distance) / 10.0 + abs(m.passengers - new_passengers) / 2.0 AS distance
        FROM marked m JOIN profiles USING (store_forward, vendor) WHERE NOT inside)
      SELECT trip_id, CAST(rank AS INTEGER) AS rank, new_distance, new_passengers, round(distance, 6) AS distance, n_changed,
        example, support FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY distance, new_distance, new_passengers) AS rank
          FROM ranked) WHERE rank <= 10""",
)
def counterfactual_profiles(spark, d):
    """Nearest observed trips that agree on the categories, over distance and passengers together."""
    scored, _ = _scored(spark, d)
    found = ins.nearest_counterfactuals(
        scored, "trip_id", {"distance": 10.0, "passengers": 2.0}, ["store_forward", "vendor"], *ins.prediction_range(scored)
    )
    return found.withColumn("distance", F.round("distance", 6))


_GATHERED_COLUMNS = (
    "insight", "n", "feature", "mse", "permuted_mse", "importance", "treatment", "segment", "level",
    "effect", "distance_bin", "passengers_bin", "error_share", "share",
)


def _tagged_sql(insight: str, source: str, columns: str) -> str:
    named = set(columns.split(", "))
    shown = [c if c in named else f"NULL AS {c}" for c in _GATHERED_COLUMNS[1:]]
    return f"SELECT '{insight}' AS insight, {', '.join(shown)} FROM ({source})"


_GATHERED_SQL = f"""WITH {_COUNTERFACTUAL_SQL},
  kept AS (SELECT * FROM near WHERE rank <= 10),
  {_MATCHED_SQL},
  e AS ({_ERRORS_SQL}), c AS ({_causal_sql('distance', 'passengers', 'test')}
    UNION ALL {_causal_sql('passengers', 'distance', 'test')}), b AS ({_BINS_SQL})
  {_tagged_sql('constructor', 'SELECT count(*) AS n FROM test', 'n')}
  UNION ALL {_tagged_sql('explanation', _IMPORTANCE_SQL, 'feature, mse, permuted_mse, importance')}
  UNION ALL {_tagged_sql('causal', _segments_sql('c'), 'n, treatment, segment, level, effect')}
  UNION ALL {_tagged_sql('error_analysis', _CUBE_SQL, 'n, mse, distance_bin, passengers_bin, error_share')}
  UNION ALL {_tagged_sql('counterfactual', """SELECT feature, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM kept), 6) AS share FROM kept GROUP BY 1""", 'n, feature, share')}"""


def _context(spark, d):
    others = [c for c in TRIPS.features if c not in ("distance", "passengers")]
    test, lines = _blended(spark, d, *others)
    model = md.blend(list(lines.values()))
    context = ins.InsightContext.build(
        test.withColumn("prediction", model), TRIPS, ["store_forward", "vendor"],
        title="Fare prediction", model="line-blend:1",
        train=train_and_test(spark, d, *TRIPS.columns)[0],
    )
    return context, model


@query(
    "insight_constructor_i1",
    f"""WITH {_LINES_SQL} SELECT 'Fare prediction' AS title, 'regression' AS task_type, 'cost' AS target, 'line-blend:1' AS model,
        (SELECT count(*) FROM parts WHERE split = 'train') AS train_rows,
        'store_forward,vendor' AS categoricals, CAST({len(TRIPS.features)} AS INTEGER) AS features,
        count(*) AS n, round(avg(prediction), 2) AS mean_prediction FROM test""",
)
def insight_constructor(spark, d):
    context, _ = _context(spark, d)
    described = cut_lineage(context.describe())
    context.release()
    return described.withColumn("mean_prediction", F.round("mean_prediction", 2))


@query("gathered_insights_i6", _GATHERED_SQL)
def gathered_insights(spark, d):
    """Constructor, explanation, causal effects, error analysis and counterfactuals as one table."""
    context, model = _context(spark, d)
    gathered = ins.gather(
        {
            "constructor": context.scored.agg(F.count(F.lit(1)).alias("n")),
            "explanation": ins.permutation_importance(
                context.scored, ["trip_id"], ["distance", "passengers"], "cost",
                lambda df, out: df.withColumn(out, model),
            ),
            "causal": reduce(lambda a, b: a.unionByName(b), [
                ins.causal_effect(
                    context.scored, "cost", [treatment], ["store_forward", "vendor", other], ["store_forward", "vendor"]
                )
                for treatment, other in (("distance", "passengers"), ("passengers", "distance"))
            ]),
            "error_analysis": ins.error_analysis(
                context.scored, "cost", "prediction", {"distance": 10.0, "passengers": 2.0}
            ),
            "counterfactual": ins.counterfactual_importance(_answers(context.scored)),
        }
    )
    gathered = cut_lineage(gathered)  # a few dozen rows; the scored trips can go
    context.release()
    digits = {"mse": 0, "permuted_mse": 0, "importance": 0, "effect": 3, "error_share": 6, "share": 6}
    return gathered.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in _GATHERED_COLUMNS]
    )
