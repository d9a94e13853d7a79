"""Fitting, prediction, saving and multi-version scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from ..spec import FeatureSpec
from .forest import RandomForestRegressor
from .metrics import regression_metrics
from .registry import resolve_asset

# Hyperparameters of the forest.
FOREST = {"n_estimators": 500, "max_depth": 10, "max_features": "sqrt",
          "min_samples_leaf": 4, "min_samples_split": 5, "bootstrap": True, "random_state": 0}

# Trees grown at once: the sums that all tasks of a pass ship together grow with them.
TREES_AT_ONCE = 500

# 'auto' of the regressors meant all features; Spark's own 'auto' means a third.
_SUBSETS = {"auto": "all", "sqrt": "sqrt", "log2": "log2", None: "all"}


@dataclass(frozen=True)
class LinearBaseline:
    """Least-squares line in one feature; its numbers may be columns of a plan."""

    feature: str
    slope: float | Column
    intercept: float | Column

    def at(self, value: Column) -> Column:
        return value.cast("double") * self.slope + self.intercept

    def predict(self) -> Column:
        return self.at(F.col(self.feature))


def _line_columns(features: Sequence[str], target: str) -> dict[str, Column]:
    y = F.col(target).cast("double")
    lines = {}
    for name in features:
        x = F.col(name).cast("double")
        slope = F.coalesce(F.regr_slope(y, x), F.lit(0.0))
        intercept = F.coalesce(F.regr_intercept(y, x), F.avg(y))
        lines[name] = F.struct(slope.alias("slope"), intercept.alias("intercept"))
    return lines


def baseline_parameters(train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, slope, intercept) of the line fitted per feature."""
    named = [
        F.struct(F.lit(f).alias("feature"), line["slope"].alias("slope"), line["intercept"].alias("intercept"))
        for f, line in _line_columns(features, target).items()
    ]
    return train.agg(F.array(*named).alias("lines")).select(F.inline("lines"))


def fit_baselines(
    train: DataFrame, features: Sequence[str], target: str
) -> dict[str, LinearBaseline]:
    """One closed-form line per feature, all from a single aggregation to one row."""
    rows = baseline_parameters(train, features, target).collect()
    return {r["feature"]: LinearBaseline(r["feature"], r["slope"], r["intercept"]) for r in rows}


def baseline_lines(train: DataFrame, features: Sequence[str], target: str) -> dict[str, LinearBaseline]:
    """One closed-form line per feature as a scalar subquery: fitting and scoring are one
    plan, and all lines come from one aggregation."""
    named = [line.alias(name) for name, line in _line_columns(features, target).items()]
    lines = train.agg(F.struct(*named).alias("lines")).scalar()
    return {f: LinearBaseline(f, lines[f]["slope"], lines[f]["intercept"]) for f in features}


def blend(models: Sequence[LinearBaseline]) -> Column:
    """Mean prediction of several lines."""
    total = models[0].predict()
    for model in models[1:]:
        total = total + model.predict()
    return total / float(len(models))


def majority_class(train: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Most frequent label per group; ties go to the alphabetically last one."""
    counts = train.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*by).agg(F.max_by(label, F.struct("_n", label)).alias("predicted"))


def assembler(spec: FeatureSpec) -> VectorAssembler:
    """Feature vector in contract order; nulls and NaN are errors."""
    return VectorAssembler(
        inputCols=list(spec.features), outputCol="features", handleInvalid="error"
    )


def features_and_target(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    spec.require(df)
    vectors = assembler(spec).transform(df)
    return vectors.select("features", F.col(spec.target).cast("double").alias("label"))


def fit_forest(
    train: DataFrame,
    spec: FeatureSpec,
    prediction: str = "prediction",
    cache_node_ids: bool = True,
    **overrides,
) -> PipelineModel:
    """Random-forest regression; `min_samples_split` is implied by the leaf size.

    At most `TREES_AT_ONCE` trees are grown together, all on the whole input and each group with
    its own seed; the prediction is the mean over all trees. `cache_node_ids` keeps the node of each row instead of shipping all trees.
    """
    unknown = set(overrides) - set(FOREST)
    if unknown:
        raise ValueError(f"unknown forest parameters: {sorted(unknown)}")
    params = {**FOREST, **overrides}
    subset = params["max_features"]
    spec.require(train)
    ensure_checkpoint_dir(train.sparkSession)
    total = params["n_estimators"]
    sizes = [min(TREES_AT_ONCE, total - at) for at in range(0, total, TREES_AT_ONCE)]
    parts = [prediction] if len(sizes) == 1 else [f"_{prediction}_{i}" for i in range(len(sizes))]
    forests = [
        RandomForestRegressor(
            featuresCol="features",
            labelCol=spec.target,
            predictionCol=part,
            numTrees=size,
            maxDepth=params["max_depth"],
            minInstancesPerNode=params["min_samples_leaf"],
            featureSubsetStrategy=_SUBSETS.get(subset, str(subset)),
            bootstrap=params["bootstrap"],
            seed=params["random_state"] + i,
            maxMemoryInMB=512,
            cacheNodeIds=cache_node_ids,
            checkpointInterval=10,
        )
        for i, (size, part) in enumerate(zip(sizes, parts))
    ]
    # One partition per core: each pass over rows and trees is as wide as the cluster, and the
    # histograms of all nodes, which every partition ships, are no more than needed for that.
    cores = train.sparkSession.sparkContext.defaultParallelism
    rows = train.select(*spec.columns).repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:  # a fit reads its input several times before it keeps its own copy
        vectors = assembler(spec)
        wide = vectors.transform(rows)
        grown = [forest.fit(wide) for forest in forests]
    finally:
        rows.unpersist()
    return PipelineModel([vectors, *grown, *_mean_of(parts, sizes, prediction)])


def _mean_of(parts: Sequence[str], sizes: Sequence[int], prediction: str) -> list[SQLTransformer]:
    """The stage that makes the mean over all trees of the predictions of forests of these sizes."""
    if len(parts) == 1:
        return []
    total = " + ".join(f"{size} * `{part}`" for size, part in zip(sizes, parts))
    mean = f"({total}) / {float(sum(sizes))}D AS `{prediction}`"
    return [SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{p}`' for p in parts)}), {mean} FROM __THIS__")]


def forests_of(model: PipelineModel) -> list:
    """The fitted forests of a model, of which each holds some of its trees."""
    return [stage for stage in model.stages if hasattr(stage, "featureImportances")]


def fit_linear(
    train: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction"
) -> PipelineModel:
    """Least squares in some features, as a model that can be saved and registered."""
    line = LinearRegression(
        featuresCol="features", labelCol=target, predictionCol=prediction, solver="normal", standardization=False
    )
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[vectors, line]).fit(train)


def fit_text(
    train: DataFrame, text: str, target: str, buckets: int = 1 << 12, prediction: str = "prediction"
) -> PipelineModel:
    """Least squares in hashed word counts: words, counts and line are one model that can be
    saved and registered. Rows without text or target are left out."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern="[a-z0-9]+", gaps=False),
        HashingTF(inputCol="_words", outputCol="features", numFeatures=buckets),
        LinearRegression(featuresCol="features", labelCol=target, predictionCol=prediction, standardization=False),
    ]
    return Pipeline(stages=stages).fit(train.select(text, F.col(target).cast("double")).dropna())


def predict_text(model: PipelineModel, df: DataFrame, text: str, prediction: str = "prediction") -> DataFrame:
    """Predictions of a text model; a row without text gets none."""
    known = F.col(text).isNotNull()
    scored = model.transform(df.withColumn("_known", known).withColumn(text, F.coalesce(text, F.lit(""))))
    return scored.select(
        *[F.when(F.col("_known"), F.col(text)).alias(text) if c == text else c for c in df.columns],
        F.when(F.col("_known"), F.col(prediction)).alias(prediction),
    )


def load_asset(catalog: DataFrame, reference: str) -> PipelineModel:
    """The saved model that a registry names, such as 'trips@latest' or 'trips:3'."""
    found = resolve_asset(catalog, reference).first()
    if found is None:
        raise LookupError(f"no registered model {reference}")
    return load_model(found["path"])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_linear_probe(
    train: DataFrame, vector: str, label: str, max_iter: int = 50, reg: float = 0.0
) -> PipelineModel:
    """Multinomial logistic regression on frozen feature arrays."""
    head = LogisticRegression(
        featuresCol="features", labelCol=label, family="multinomial",
        maxIter=max_iter, regParam=reg,
    )
    vectors = with_vector(train, vector)
    return Pipeline(stages=[head]).fit(vectors.select("features", F.col(label).cast("double").alias(label)))


def with_vector(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array).cast("array<double>")))


def with_predictions(
    df: DataFrame, real: str, predicted: Column, keep: Sequence[str]
) -> DataFrame:
    """Feature columns followed by the real and the predicted label."""
    return df.select(*keep, F.col(real).alias("real_label"), predicted.alias("predicted_label"))


def score_versions(
    df: DataFrame, versions: Mapping[str, Column], keep: Sequence[str]
) -> DataFrame:
    """Every version's prediction for every row, from one read of the rows."""
    scored = F.array(
        *[F.struct(F.lit(v).alias("version"), p.alias("prediction")) for v, p in versions.items()]
    )
    return df.select(*keep, F.inline(scored))


def predict_versions(
    df: DataFrame, models: Mapping[str, PipelineModel], spec: FeatureSpec, keep: Sequence[str]
) -> DataFrame:
    """Long predictions of several saved forests, again from one read of the rows."""
    wide = assembler(spec).transform(df)
    columns = {}
    for i, (version, model) in enumerate(models.items()):
        forests, total = forests_of(model), 0.0
        for k, forest in enumerate(forests):
            column = f"_prediction_{i}_{k}"
            wide = forest.copy().setPredictionCol(column).transform(wide)
            total = total + F.col(column) * forest.getNumTrees
        columns[version] = total / float(sum(forest.getNumTrees for forest in forests))
    return score_versions(wide.drop("features"), columns, keep)


def version_metrics(scored: DataFrame, real: str) -> DataFrame:
    return regression_metrics(scored, real, "prediction", by=["version"])
