"""Quality and timing metrics as partial aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import megabytes, micros
from ..functions.text import PAD, used_length


def regression_metrics(
    df: DataFrame, real: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """n, mse, rmse, mae and r2 in one pass.

    r2 is one minus the ratio of residual to total variation; a constant target
    scores 1 when it is met exactly and 0 otherwise.
    """
    y, p = F.col(real), F.col(predicted)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("_var"),
    )
    r2 = (
        F.when(F.col("_var") != 0, 1 - F.col("mse") / F.nullif(F.col("_var"), F.lit(0.0)))
        .when(F.col("mse") == 0, 1.0)
        .when(F.col("mse").isNotNull(), 0.0)
    )
    return sums.select(
        *by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")
    )


def confusion_counts(df: DataFrame, real: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (real, predicted) pair that occurs."""
    return df.groupBy(*by, F.col(real).alias("real"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def dense_confusion(counts: DataFrame) -> DataFrame:
    """All labels on both axes; pairs that never occur count zero. Rows without a prediction,
    or without a label, follow as pairs with a null.

    Works on the class-pair counts, whose size depends on the classes only.
    """
    missing = F.col("real").isNull() | F.col("predicted").isNull()
    apart, counts = counts.where(missing), counts.where(F.col("real").isNotNull())
    axes = counts.select(F.explode(F.array("real", "predicted")).alias("label"))
    labels = axes.agg(F.collect_set("label").alias("labels")).scalar()
    grid = axes.select(F.col("label").alias("real")).where("real IS NOT NULL").distinct()
    grid = grid.withColumn("predicted", F.explode(labels))
    full = grid.join(counts, ["real", "predicted"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )
    return full.unionByName(apart.select("real", "predicted", "n"))


def label_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label: hits, support and number of predictions, from pair counts. A missing
    prediction is a miss of its label and counts for no label."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("real") == F.col("predicted"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("real").alias("label"), hit.alias("hits"),
            F.col("n").alias("support"), zero.alias("predictions"),
        ),
        F.struct(
            F.col("predicted").alias("label"), zero.alias("hits"),
            zero.alias("support"), F.col("n").alias("predictions"),
        ),
    )
    return (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(
            F.sum("hits").alias("hits"),
            F.sum("support").alias("support"),
            F.sum("predictions").alias("predictions"),
        )
        .where(F.col("label").isNotNull() | (F.col("support") > 0))
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def label_scores(labels: DataFrame) -> DataFrame:
    hits, support, predictions = F.col("hits"), F.col("support"), F.col("predictions")
    return labels.withColumns(
        {
            "precision": _ratio(hits, predictions),
            "recall": _ratio(hits, support),
            "f1": _ratio(2 * hits, support + predictions),
        }
    )


def classification_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, MCC and micro / macro / weighted recall, precision and F1."""
    scored = label_scores(label_counts(counts, by))
    hits, support, predictions = F.col("hits"), F.col("support"), F.col("predictions")
    total = F.sum(support).cast("double")
    found = F.sum(hits).cast("double")
    t, p = support.cast("double"), predictions.cast("double")
    cross, tt, pp = F.sum(t * p), F.sum(t * t), F.sum(p * p)
    spread = (total * total - pp) * (total * total - tt)
    aggregates = [
        total.cast("bigint").alias("n"),
        _ratio(found, total).alias("accuracy"),
        F.when(spread > 0, (found * total - cross) / F.sqrt(F.nullif(spread, F.lit(0.0))))
        .otherwise(0.0).alias("mcc"),
    ]
    micro = {
        "recall": _ratio(found, total),
        "precision": _ratio(found, F.sum(predictions).cast("double")),
        "f1": _ratio(2 * found, total + F.sum(predictions).cast("double")),
    }
    for metric in ("recall", "precision", "f1"):
        score = F.col(metric)
        aggregates += [
            micro[metric].alias(f"{metric}_micro"),
            F.avg(score).alias(f"{metric}_macro"),
            _ratio(F.sum(score * support), total).alias(f"{metric}_weighted"),
        ]
    return scored.groupBy(*by).agg(*aggregates)


def accuracy(real: Column, predicted: Column) -> Column:
    """Share of rows whose labels are present and equal; a null on either side is a miss."""
    return F.avg(F.coalesce(real == predicted, F.lit(False)).cast("double"))


def epoch_metrics(trace: DataFrame, by: Sequence[str] = ("epoch", "phase")) -> DataFrame:
    """Loss and accuracy per epoch and phase from per-batch means and sizes."""
    n = F.sum("n").cast("double")
    return trace.groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("samples"),
        (F.sum(F.col("loss") * F.col("n")) / n).alias("loss"),
        (F.sum("correct").cast("double") / n).alias("accuracy"),
    )


def windowed_loss(trace: DataFrame, every: int = 25, phase: str = "train") -> DataFrame:
    """Mean loss of each full run of `every` iterations of one phase inside an epoch.

    `iter` counts the phase's iterations from zero within the epoch; a short last run is
    not reported.
    """
    return (
        trace.where(F.col("phase") == phase).groupBy("epoch", F.floor(F.col("iter") / every).cast("bigint").alias("run"))
        .agg(F.count(F.lit(1)).alias("_n"), F.avg("loss").alias("loss"))
        .where(F.col("_n") == every)
        .drop("_n")
    )


def iterator_timing(trace: DataFrame, by: Sequence[str] = ("name",)) -> DataFrame:
    """Number of steps, total time and time of the first step."""
    return trace.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("seconds").alias("time_sum"),
        F.min_by("seconds", "seq").alias("time_first"),
    )


def block_elapsed(marks: DataFrame, block: str, ts: str = "ts") -> DataFrame:
    """Seconds between the first and the last mark of a block."""
    us = micros(F.col(ts))
    return marks.groupBy(block).agg(((F.max(us) - F.min(us)) / F.lit(1e6)).alias("seconds"))


def counter_delta_mb(counters: DataFrame, by: Sequence[str], value: str, order: Column) -> DataFrame:
    """Growth of a byte counter from the first to the last reading, in MB."""
    growth = F.max_by(value, order) - F.min_by(value, order)
    return counters.groupBy(*by).agg(megabytes(growth).alias(f"{value}_mb"))


def epoch_minutes(seconds: Column, epochs: int) -> Column:
    return seconds / 60.0 / epochs


def throughput(samples: Column, seconds: Column) -> Column:
    return F.try_divide(samples.cast("double"), seconds)


def mean_generated_length(ids: Column, pad_id: int = PAD) -> Column:
    return F.round(F.avg(used_length(ids, pad_id)), 4)


def class_summary(df: DataFrame, label: str) -> DataFrame:
    """Samples, number of classes and the sorted class list."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return per_class.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("samples"),
        F.count(label).alias("classes"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.col(label).cast("string")))).alias("class_list"),
    )


def operation_table(trace: DataFrame, name: str, cost: str) -> DataFrame:
    """Total, mean and number of calls per operation, dearest first."""
    return (
        trace.groupBy(name)
        .agg(
            F.sum(cost).alias("total"),
            F.avg(cost).alias("mean"),
            F.count(F.lit(1)).alias("calls"),
        )
        .orderBy(F.desc("total"), name)
    )


def long_form(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per metric: (keys..., key, value)."""
    names = [c for c in metrics.columns if c not in keys]
    wide = metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot(list(keys), names, "key", "value")
