"""Score vectors and channel arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Channel statistics of the image transform.
CHANNEL_MEAN = (0.485, 0.456, 0.405)
CHANNEL_STD = (0.229, 0.224, 0.225)


def arg_max(scores: Column) -> Column:
    """Zero-based index of the largest score; the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(logits: Column, target: Column) -> Column:
    """-log softmax(logits)[target], shifted by the maximum for stability."""
    values = logits.cast("array<double>")
    top = F.array_max(values)
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return top + F.log(total) - F.element_at(values, target.cast("int") + 1)


def channel_normalise(
    values: Column,
    mean: tuple[float, ...] = CHANNEL_MEAN,
    std: tuple[float, ...] = CHANNEL_STD,
) -> Column:
    """(x - mean) / std for planes laid out one channel after the other."""
    means, stds = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std))
    size = F.size(values)

    def scale(x: Column, i: Column) -> Column:
        channel = F.floor(i * len(mean) / size).cast("int") + 1
        return (x.cast("double") - F.element_at(means, channel)) / F.element_at(stds, channel)

    return F.transform(values, scale)
