"""Run log, registry, versions and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import metrics as mt
from ..operators import registry as rg
from ..operators import split as sp
from ..operators.userdefined import observed
from ..session import workspace
from ..sources import controls as ct
from .base import REGISTRY_SQL, model_registry, query, split_sql, table


def _run_log(spark, d):
    """Events as a metric log: one run per user, one key per event type."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("key"),
        "value", F.col("event_id").alias("step"), F.col("ts").cast("timestamp").alias("ts"),
    )


_LATEST_SQL = """SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key,
  arg_max(value, event_id) AS value, max(event_id) AS step, count(*) AS updates FROM events GROUP BY 1, 2"""


@query("latest_metrics_w2", _LATEST_SQL)
def latest_metrics(spark, d):
    return rg.latest_metrics(_run_log(spark, d))


HISTORY_STEP = 500


@query(
    "step_history_w2",
    f"""WITH cells AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key,
          CAST(ceil(event_id / {HISTORY_STEP}) AS BIGINT) AS cell, arg_max(value, event_id) AS value
        FROM events GROUP BY 1, 2, 3),
      spans AS (SELECT *, coalesce(lead(cell) OVER (PARTITION BY run_id, key ORDER BY cell), cell + 1) AS following FROM cells)
    SELECT run_id, key, unnest(range(cell, following)) * {HISTORY_STEP} AS step, value FROM spans""",
)
def step_history(spark, d):
    """Every metric of every run on a grid of steps, the last value carried forward."""
    return rg.step_history(_run_log(spark, d), HISTORY_STEP)


@query(
    "best_score_a16",
    f"""WITH {REGISTRY_SQL} SELECT name, round(max(r2), 6) AS best, count(*) AS versions FROM registry GROUP BY 1""",
)
def best_scores(spark, d):
    return model_registry(spark, d).groupBy("name").agg(
        F.round(F.max("r2"), 6).alias("best"), F.count(F.lit(1)).alias("versions")
    )


@query(
    "next_version_w4",
    f"WITH {REGISTRY_SQL} SELECT name, max(version) + 1 AS next_version FROM registry GROUP BY 1",
)
def next_versions(spark, d):
    return rg.next_versions(model_registry(spark, d))


@query(
    "latest_asset_s22",
    f"""WITH {REGISTRY_SQL} SELECT name, max(version) AS version, arg_max(path, version) AS path
        FROM registry GROUP BY 1""",
)
def latest_asset(spark, d):
    return rg.resolve_assets(model_registry(spark, d))


@query(
    "pinned_asset_s22",
    f"WITH {REGISTRY_SQL} SELECT name, version, path FROM registry WHERE name = 'Brand#2' AND version = 0",
)
def pinned_asset(spark, d):
    return rg.resolve_asset(model_registry(spark, d), "Brand#2:0")


@query(
    "model_info_s20",
    f"""WITH {REGISTRY_SQL}, latest AS (SELECT name, max(version) AS version FROM registry GROUP BY 1)
    SELECT name, version, name || ':' || version AS id FROM latest""",
)
def model_info(spark, d):
    """Model-info files of the newest versions, written and read back."""
    latest = model_registry(spark, d).groupBy("name").agg(F.max("version").alias("version"))
    return ct.read_model_info(spark, ct.write_model_info(latest, workspace(spark, "model-info")))


@query(
    "version_id_f14",
    f"""WITH {REGISTRY_SQL} SELECT name || ':' || version AS id, name, CAST(version AS VARCHAR) AS version FROM registry""",
)
def version_ids(spark, d):
    ids = model_registry(spark, d).select(sc.version_id(F.col("name"), F.col("version")).alias("id"))
    return ids.select("id", sc.version_parts(F.col("id")).alias("p")).select("id", "p.name", "p.version")


@query(
    "checkpoint_name_f15",
    """SELECT event_id, 'model-checkpoint-epoch' || (event_id % 40 - 1) || '-loss' || CAST(value AS VARCHAR) || '.pt' AS name,
       CAST(event_id % 40 - 1 AS INTEGER) AS epoch, value AS loss FROM events""",
)
def checkpoint_names(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        sc.checkpoint_name(F.pmod("event_id", F.lit(40)) - 1, F.col("value")).alias("name"),
    )
    return rows.withColumn("_p", sc.checkpoint_parts(F.col("name"))).select("event_id", "name", "_p.epoch", "_p.loss")


@query(
    "metric_maps_f16",
    """SELECT event_id, true AS merged, value AS loss,
       CAST(user_id AS DOUBLE) AS count, CAST(event_id AS DOUBLE) AS step FROM events""",
)
def metric_maps(spark, d):
    """Two metric maps merged, the second winning on shared keys."""
    base = F.create_map(F.lit("loss"), F.lit(-1.0), F.lit("count"), F.col("user_id").cast("double"))
    update = F.create_map(F.lit("loss"), F.col("value"), F.lit("step"), F.col("event_id").cast("double"))
    rows = table(spark, d, "events").select("event_id", sc.merge_maps(base, update).alias("m"))
    return rows.select(
        "event_id", (F.size("m") == 3).alias("merged"),
        *[F.col("m")[k].alias(k) for k in ("loss", "count", "step")],
    )


@query(
    "metric_math_f13",
    """SELECT user_id, round(sqrt(avg(value)), 6) AS root, round(avg(value) * 100, 4) AS percent,
       round(sum(event_id) / 1048576.0, 6) AS mb FROM events GROUP BY 1""",
)
def metric_math(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(
        F.round(F.sqrt(F.avg("value")), 6).alias("root"),
        sc.percent4(F.avg("value")).alias("percent"),
        F.round(sc.megabytes(F.sum("event_id")), 6).alias("mb"),
    )


@query(
    "numeric_entries_p7",
    """SELECT event_id, 'loss' AS key, value FROM events
       UNION ALL SELECT event_id, 'flag', CAST(value > 100 AS DOUBLE) FROM events
       UNION ALL SELECT event_id, 'step', CAST(event_id AS DOUBLE) FROM events""",
)
def numeric_entries(spark, d):
    """Log lines with numbers, booleans and text; numbers and booleans stay."""
    line = F.to_json(
        F.struct(
            F.col("value").alias("loss"), (F.col("value") > 100).alias("flag"),
            F.col("event_id").alias("step"), F.col("event_type").alias("name"),
            F.col("user_id").cast("string").alias("user"),
        )
    )
    logs = table(spark, d, "events").select("event_id", line.alias("line"))
    return rg.numeric_entries(logs, "line", ["event_id"])


def _phase_metrics(spark, d, phase):
    """Mean value per event type for the two halves of the users: two runs."""
    rows = table(spark, d, "events").where(F.pmod("user_id", F.lit(2)) == phase)
    return rows.groupBy(F.col("event_type").alias("key")).agg(F.avg("value").alias("value"))


_RUNS_SQL = """b AS (SELECT event_type AS key, avg(value) AS v FROM events WHERE user_id % 2 = 0 GROUP BY 1),
  c AS (SELECT event_type AS key, avg(value) AS v FROM events WHERE user_id % 2 = 1 GROUP BY 1)"""


@query(
    "compare_metrics_j3",
    f"WITH {_RUNS_SQL} SELECT key, round(b.v, 6) AS baseline, round(c.v, 6) AS candidate FROM b JOIN c USING (key)",
)
def compare_metrics(spark, d):
    both = rg.compare_metrics(_phase_metrics(spark, d, 0), _phase_metrics(spark, d, 1))
    return both.select(
        "key", F.round("baseline", 6).alias("baseline"), F.round("candidate", 6).alias("candidate")
    )


@query(
    "summarization_gate_m7",
    f"""WITH {_RUNS_SQL} SELECT key, round(b.v, 6) AS baseline, round(c.v, 6) AS candidate,
        CAST(c.v > b.v AS INTEGER) AS deploy_flag FROM b JOIN c USING (key) WHERE key = 'purchase'""",
)
def summarization_gate(spark, d):
    """Both runs written as metric files, read back and compared on one key."""
    paths = [
        ct.write_metrics_json(_phase_metrics(spark, d, phase), workspace(spark, f"all-results-{phase}"))
        for phase in (0, 1)
    ]
    baseline, candidate = (ct.read_metrics_json(spark, p) for p in paths)
    flag = rg.compare_runs(baseline, candidate, "purchase")
    return flag.select(
        "key", F.round("baseline", 6).alias("baseline"), F.round("candidate", 6).alias("candidate"), "deploy_flag"
    )


@query(
    "metrics_json_s17",
    f"""WITH b AS (SELECT event_type AS key, avg(value) AS v FROM events GROUP BY 1)
        SELECT key, round(v, 6) AS value FROM b
        UNION ALL SELECT 'predict_samples', CAST(count(*) AS DOUBLE) FROM events
        UNION ALL SELECT 'better', CAST(CAST(avg(value) > 0 AS INTEGER) AS DOUBLE) FROM events""",
)
def metrics_json(spark, d):
    events = table(spark, d, "events")
    metrics = events.groupBy(F.col("event_type").alias("key")).agg(F.avg("value").alias("value"))
    samples = events.agg(F.lit("predict_samples").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))
    out = ct.write_metrics_json(metrics.unionByName(samples), workspace(spark, "metrics"))
    flags = workspace(spark, "flags")  # entries that are not numbers
    better = F.to_json(F.struct((F.avg("value") > 0).alias("better"), F.lit("text").alias("note")))
    events.agg(better.alias("value")).write.text(flags)
    both = ct.read_metrics_json(spark, out).unionByName(ct.read_metrics_json(spark, flags))
    return both.withColumn("value", F.round("value", 6))


_CANDIDATE_SQL = f"""{REGISTRY_SQL}, cut AS (SELECT median(p_partkey) AS m FROM part),
  old AS (SELECT * FROM registry, cut WHERE version < m AND name <> 'Brand#7'),
  new AS (SELECT name, arg_max(path, version) AS path, arg_max(run_id, version) AS run_id,
          arg_max(r2, version) - 0.2 AS score FROM registry, cut WHERE version >= m GROUP BY name),
  gated AS (SELECT new.*, CAST(CASE WHEN b.best IS NULL OR score >= b.best THEN 1 ELSE 0 END AS INTEGER) AS deploy_flag,
     coalesce(b.last, 0) + 1 AS next FROM new LEFT JOIN (SELECT name, max(r2) AS best, max(version) AS last FROM old GROUP BY 1) b USING (name))"""


def _gated(spark, d):
    """Older half of the registry on record; the newest model of each name competes."""
    registry = model_registry(spark, d)
    cut = registry.agg(F.median("version")).scalar()
    marked = registry.withColumn("_cut", cut)
    old = marked.where((F.col("version") < F.col("_cut")) & (F.col("name") != "Brand#7")).drop("_cut")
    new = marked.where(F.col("version") >= F.col("_cut")).groupBy("name").agg(
        *[F.max_by(c, "version").alias(c) for c in ("path", "run_id")],
        (F.max_by("r2", "version") - 0.2).alias("score"),
    )
    best = old.groupBy("name").agg(F.max("r2").alias("best"))
    gated = new.join(best, "name", "left").withColumn(
        "deploy_flag", rg.tabular_gate(F.col("score"), F.col("best"))
    )
    return old, gated


@query(
    "tabular_gate_m6",
    f"WITH {_CANDIDATE_SQL} SELECT name, round(score, 6) AS score, deploy_flag FROM gated",
)
def tabular_gate(spark, d):
    return _gated(spark, d)[1].select("name", F.round("score", 6).alias("score"), "deploy_flag")


@query(
    "register_versions_m5",
    f"""WITH {_CANDIDATE_SQL} SELECT name, CAST(next AS INTEGER) AS version, path, run_id FROM gated
        WHERE deploy_flag = 1""",
)
def register_versions(spark, d):
    old, gated = _gated(spark, d)
    return rg.accepted_versions(old, gated)


@query(
    "always_gate_m8",
    f"WITH {REGISTRY_SQL} SELECT name, CAST(1 AS INTEGER) AS deploy_flag FROM registry GROUP BY name",
)
def always_gate(spark, d):
    names = model_registry(spark, d).select("name").distinct()
    return names.withColumn("deploy_flag", rg.always_gate())


@query(
    "deploy_flag_s19",
    f"WITH {_RUNS_SQL} SELECT CAST(c.v > b.v AS INTEGER) AS deploy_flag FROM b JOIN c USING (key) WHERE key = 'view'",
)
def deploy_flag(spark, d):
    flag = rg.compare_runs(_phase_metrics(spark, d, 0), _phase_metrics(spark, d, 1), "view")
    return ct.read_flag(spark, ct.write_flag(flag, workspace(spark, "flag")))


@query(
    "run_tracking_m4",
    f"""SELECT 'run-1' AS run_id, split || '_size' AS key, CAST(count(*) AS DOUBLE) AS value FROM (
        SELECT {split_sql('o_orderkey')} AS split FROM orders) GROUP BY split
        UNION ALL SELECT 'run-1', 'written', CAST(count(*) AS DOUBLE) FROM orders""",
)
def run_tracking(spark, d):
    """Split sizes logged to the run log; the row count is observed while writing."""
    parts = sp.hash_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])
    out, log = workspace(spark, "parts"), workspace(spark, "runs")
    watched, seen = observed(parts, F.count(F.lit(1)).alias("written"))
    watched.write.parquet(out)
    sizes = sp.split_sizes(spark.read.parquet(out))
    rg.log_metrics(
        sizes.select(F.concat("split", F.lit("_size")).alias("key"), F.col("rows").alias("value")), log, "run-1", 0
    )
    written = spark.createDataFrame([("written", float(seen.get["written"]))], "key string, value double")
    rg.log_metrics(written, log, "run-1", 0)
    return rg.latest_metrics(spark.read.schema(rg.LOG_SCHEMA).parquet(log)).select("run_id", "key", "value")


@query(
    "long_metrics_s16",
    """SELECT event_type AS name, 'total' AS key, round(sum(value), 4) AS value FROM events GROUP BY 1
       UNION ALL SELECT event_type, 'calls', CAST(count(*) AS DOUBLE) FROM events GROUP BY 1""",
)
def long_metrics(spark, d):
    wide = mt.operation_table(table(spark, d, "events"), "event_type", "value").select(
        F.col("event_type").alias("name"), F.round("total", 4).alias("total"), "calls"
    )
    return mt.long_form(wide, ["name"])
