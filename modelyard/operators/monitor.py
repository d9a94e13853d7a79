"""Monitoring summaries and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def window_summary(
    df: DataFrame,
    ts: str,
    every: str,
    value: str,
    category: str,
    categories: Sequence[str],
) -> DataFrame:
    """Per tumbling window: count, mean and the share of each known category.

    One aggregation per window, so the same plan serves batch and stream.
    """
    n = F.count(F.lit(1))
    shares = [
        (F.count_if(F.col(category) == c) / n).alias(f"share_{c}") for c in categories
    ]
    return (
        df.groupBy(F.window(ts, every).alias("w"))
        .agg(n.alias("n"), F.avg(value).alias("mean"), *shares)
        .select(
            F.col("w.start").alias("window_start"), "n", "mean",
            *[f"share_{c}" for c in categories],
        )
    )


def bin_counts(value: str, edges: Sequence[float]) -> Column:
    """Aggregate: counts per bin of fixed inner edges, outer bins open."""
    counts = []
    for low, high in zip([None, *edges], [*edges, None]):
        hit = F.col(value).isNotNull()
        if low is not None:
            hit = hit & (F.col(value) >= low)
        if high is not None:
            hit = hit & (F.col(value) < high)
        counts.append(F.count_if(hit))
    return F.array(*counts)


def stability_index(actual: Column, expected: Column, bins: int, epsilon: float = 0.5) -> Column:
    """Population stability index of two arrays of bin counts; `epsilon` keeps empty bins finite."""

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.transform(counts, lambda x: (x + epsilon) / (total + epsilon * bins))

    terms = F.zip_with(shares(actual), shares(expected), lambda p, q: (p - q) * F.log(p / q))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def drift_scores(
    train: DataFrame,
    scored: DataFrame,
    value: str,
    edges: Sequence[float],
    by: Sequence[str],
    epsilon: float = 0.5,
) -> DataFrame:
    """Population stability index of each scored window against the training rows.

    `epsilon` is added to every bin count, so empty bins stay finite. Counts are
    arrays of a fixed number of bins; no row-level join takes place.
    """
    expected = train.agg(bin_counts(value, edges).alias("c")).scalar()
    counted = scored.groupBy(*by).agg(
        F.count(value).alias("n"), bin_counts(value, edges).alias("_actual")
    ).withColumn("_expected", expected)
    psi = stability_index(F.col("_actual"), F.col("_expected"), len(edges) + 1, epsilon)
    return counted.select(*by, "n", psi.alias("psi"))
