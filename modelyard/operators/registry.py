"""Run log, versioned models, leaderboards and promotion gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("path", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


def log_metrics(metrics: DataFrame, path: str, run_id: str, step: int | None = None) -> None:
    """Append long-form metrics (key, value) of one run to the run log."""
    rows = metrics.select(
        F.lit(run_id).alias("run_id"), "key", F.col("value").cast("double").alias("value"),
        F.lit(step).cast("bigint").alias("step"), F.current_timestamp().alias("ts"),
    )
    rows.write.mode("append").parquet(path)


def log_params(spark: SparkSession, params: Mapping[str, object], path: str, run_id: str) -> None:
    """Append a handful of run parameters as text."""
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "run_id string, key string, value string").write.mode("append").parquet(path)


def latest_metrics(log: DataFrame, by: Sequence[str] = ("run_id", "key")) -> DataFrame:
    """Last logged value per run and key, by step and then time."""
    return log.groupBy(*by).agg(
        F.max_by("value", F.struct("step", "ts")).alias("value"),
        F.max("step").alias("step"),
        F.count(F.lit(1)).alias("updates"),
    )


def _with_next(cells: DataFrame, by: Sequence[str], at: str, width: int, levels: int) -> DataFrame:
    """`_next`: the following value of `at` of the same group, null at its end.

    Each block of `width` values finds its own successors; the last of a block gets the first
    of the next block, which is found the same way among blocks. So no window holds more
    than `width` rows, but for the topmost, which holds a row per `width ** levels` values.
    """
    if levels == 0:
        return cells.withColumn("_next", F.lead(at).over(W.partitionBy(*by).orderBy(at)))
    block = f"_block{levels}"
    dealt = cells.withColumn(block, F.floor(F.col(at) / width).cast("bigint"))
    inside = dealt.withColumn("_inner", F.lead(at).over(W.partitionBy(*by, block).orderBy(at)))
    blocks = dealt.groupBy(*by, block).agg(F.min(at).alias("_first"))
    linked = _with_next(blocks, by, block, width, levels - 1)
    first_of = linked.select(*by, F.col(block).alias("_of"), F.col("_first").alias("_head"))
    follow = linked.where(F.col("_next").isNotNull()).select(*by, block, F.col("_next").alias("_of"))
    heads = follow.join(first_of, [*by, "_of"]).select(*by, block, "_head")
    joined = inside.join(heads, [*by, block], "left")
    return joined.select(*cells.columns, F.coalesce("_inner", "_head").alias("_next"))


def step_history(
    log: DataFrame, every: int = 1, by: Sequence[str] = ("run_id", "key"), width: int = 4096, levels: int = 2,
    stretch: int = 512, group: int = 4096,
) -> DataFrame:
    """(by..., step, value): each metric on a grid of steps, the last value carried forward.

    Grid steps are the multiples of `every` from the first at or after the first logged step
    to the first at or after the last one; the value is the last logged at or before the grid
    step, by step and then time. Entries without a step have no place and are left out; a null
    that was logged is a value. A run of any length is spread over tasks: entries
    are reduced to grid cells before they shuffle, successors are found in blocks, and a gap
    is filled stretch by stretch.

    The rows are as many as the grids are long, so their order matters where they are written: of
    each `group` neighbouring entries, the rows of one stretch of `stretch` cells stand together, so
    the same steps recur run after run and compress by column, as runs and values do.
    """
    placed = log.where(F.col("step").isNotNull()).withColumn("_cell", F.ceil(F.col("step") / every).cast("bigint"))
    cells = placed.groupBy(*by, "_cell").agg(
        F.max_by(F.struct("value"), F.struct("step", "ts")).alias("_last")
    )
    reach = F.coalesce(F.col("_next") - 1, F.col("_cell"))  # the last cell that shows this value
    shown = _with_next(cells, by, "_cell", width, levels).select(
        *by, "_cell", reach.alias("_reach"), F.col("_last.value").alias("value"),
        F.floor(F.monotonically_increasing_id() / group).alias("_group"),
    )
    each = F.lit(stretch).cast("bigint")
    starts = F.sequence(F.col("_cell") - F.pmod("_cell", each), F.col("_reach"), each)
    parts = shown.select("*", F.explode(starts).alias("_start")).sortWithinPartitions("_group", "_start", *by, "_cell")
    inside = F.sequence(F.greatest("_cell", "_start"), F.least("_reach", F.col("_start") + (stretch - 1)))
    filled = parts.select(*by, "value", F.explode(inside).alias("_at"))
    return filled.select(*by, (F.col("_at") * every).alias("step"), "value")


def numeric_entries(log: DataFrame, json: str, keep: Sequence[str]) -> DataFrame:
    """(keep..., key, value) for entries of a JSON log line that are numbers.

    Booleans count as 0 and 1; text is dropped even when it looks like a number.
    """
    spread = log.select(*keep, F.parse_json(F.col(json)).alias("_v")).lateralJoin(
        log.sparkSession.tvf.variant_explode(F.col("_v").outer())
    )
    kind = F.schema_of_variant("value")
    number = (
        F.when(kind == "BOOLEAN", F.try_variant_get("value", "$", "boolean").cast("double"))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get("value", "$", "double"))
    )
    return spread.select(*keep, "key", number.alias("value")).where(F.col("value").isNotNull())


def next_versions(registry: DataFrame) -> DataFrame:
    return registry.groupBy("name").agg((F.max("version") + 1).cast("int").alias("next_version"))


def next_version(registry: DataFrame, name: str) -> int:
    """Version the next model of this name gets; 1 for a new name."""
    row = registry.where(F.col("name") == name).agg(F.max("version").alias("v")).first()
    return (row["v"] or 0) + 1


def register_version(
    registry: DataFrame,
    registry_path: str,
    name: str,
    path: str,
    run_id: str,
    deploy_flag: bool,
    tags: Mapping[str, str] | None = None,
) -> str | None:
    """Record the next version when the flag is set; returns 'name:version'.

    A version has a folder of its own that must be new, so of two writers that saw the
    same registry one fails and takes the version after.
    """
    if not deploy_flag:
        return None
    entry = T.StructType(REGISTRY_SCHEMA.fields[2:])  # name and version are folders
    row = registry.sparkSession.createDataFrame([(path, run_id, dict(tags or {}))], entry)
    version = next_version(registry, name)
    while True:
        try:
            row.write.mode("error").parquet(f"{registry_path}/name={quote(name, safe='')}/version={version}")
            return f"{name}:{version}"
        except AnalysisException as problem:
            if "PATH_ALREADY_EXISTS" not in str(problem):
                raise
            version += 1


def read_registry(spark: SparkSession, registry_path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path)


def accepted_versions(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Registry rows for flagged candidates, numbered after the versions on record.

    `candidates` has (name, path, run_id, deploy_flag), one candidate per name.
    """
    flagged = candidates.where(F.col("deploy_flag") == 1)
    return flagged.join(next_versions(registry), "name", "left").select(
        "name", F.coalesce("next_version", F.lit(1)).alias("version"), "path", "run_id"
    )


def resolve_assets(catalog: DataFrame, version: int | None = None) -> DataFrame:
    """Path per asset name: the newest version, or the one asked for."""
    if version is not None:
        return catalog.where(F.col("version") == version).select("name", "version", "path")
    return catalog.groupBy("name").agg(
        F.max("version").alias("version"), F.max_by("path", "version").alias("path")
    )


def resolve_asset(catalog: DataFrame, reference: str) -> DataFrame:
    """One asset by 'name@latest', 'name:latest' or 'name:3'."""
    name, _, version = reference.replace("@", ":").rpartition(":")
    if not name or not (version == "latest" or version.isdigit()):
        raise ValueError(f"not an asset reference: {reference}")
    rows = catalog.where(F.col("name") == name)
    return resolve_assets(rows, None if version == "latest" else int(version))


def best_score(scores: DataFrame, score: str = "r2") -> Column:
    """Largest score on record as a scalar; null when there is none."""
    return scores.agg(F.max(score)).scalar()


def tabular_gate(score: Column, best: Column) -> Column:
    """1 when there is nothing to beat or the score is at least the best one."""
    return F.coalesce(score >= best, F.lit(True)).cast("int")


def summarization_gate(candidate: Column, baseline: Column, force: bool = False) -> Column:
    """1 when the candidate is strictly better, or always with `force`."""
    return (F.lit(True) if force else candidate > baseline).cast("int")


def always_gate() -> Column:
    return F.lit(1)


def compare_metrics(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Baseline and candidate side by side for the metric keys both have."""
    return baseline.select("key", F.col("value").alias("baseline")).join(
        candidate.select("key", F.col("value").alias("candidate")), "key"
    )


def compare_runs(
    baseline: DataFrame, candidate: DataFrame, metric: str = "predict_rougeLsum", force: bool = False
) -> DataFrame:
    """One row (key, baseline, candidate, deploy_flag); a missing metric is an error."""
    tagged = baseline.select("key", "value", F.lit("b").alias("side")).unionByName(
        candidate.select("key", "value", F.lit("c").alias("side"))
    ).where(F.col("key") == metric)

    def of(side: str) -> Column:
        found = F.max(F.when(F.col("side") == side, F.col("value")))
        return F.coalesce(found, F.raise_error(F.lit(f"metric {metric} is missing")).cast("double"))

    values = tagged.agg(of("b").alias("baseline"), of("c").alias("candidate"))
    return values.select(
        F.lit(metric).alias("key"), "baseline", "candidate",
        summarization_gate(F.col("candidate"), F.col("baseline"), force).alias("deploy_flag"),
    )


def leaderboard(metrics: DataFrame, score: str = "r2") -> DataFrame:
    """Versions ranked by score. `metrics` has one row per compared version."""
    rank = F.dense_rank().over(W.orderBy(F.desc_nulls_last(score)))
    return metrics.withColumn("rank", rank).orderBy("rank", "version")


def prediction_histogram(
    scored: DataFrame, real: str, predicted: str, width: float
) -> DataFrame:
    """Counts on a grid of real against predicted values: the scatter plot's data."""
    return scored.groupBy(
        F.floor(F.col(real) / width).cast("bigint").alias("real_bin"),
        F.floor(F.col(predicted) / width).cast("bigint").alias("predicted_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
