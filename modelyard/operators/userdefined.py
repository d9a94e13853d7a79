"""Places where user code plugs in, all Arrow-batched."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F


def apply_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Batched map with a user function; row counts may change."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(task, schema)


def apply_scorer(
    df: DataFrame,
    init: Callable[[], Any],
    run: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """User scorer: `init` loads the model once per task, `run` scores each batch."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = init()
        for frame in frames:
            yield run(model, frame)

    return df.mapInPandas(task, schema)


def read_rows(path: str) -> list[dict]:
    """Rows of a small Parquet folder, read inside a task wherever the session keeps it."""
    from pyarrow import fs, parquet

    store, folder = fs.FileSystem.from_uri(path)
    return parquet.read_table(folder, filesystem=store).to_pylist()


def apply_metrics(df: DataFrame, compute: Callable[[], list[Column]]) -> DataFrame:
    """Metric callback: user code names aggregate columns, Spark evaluates them."""
    return df.agg(*compute())


def apply_partials(
    df: DataFrame,
    partial: Callable[[pd.DataFrame], dict[str, float]],
    names: Sequence[str],
    finish: Callable[[], list[Column]],
) -> DataFrame:
    """Metric callback with code of its own: `partial` reduces each Arrow batch to sums,
    which Spark adds up, and `finish` names columns over the totals."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = partial(frame)
            yield pd.DataFrame({name: [float(found[name])] for name in names})

    sums = df.mapInPandas(task, ", ".join(f"{name} double" for name in names))
    return sums.agg(*[F.sum(name).alias(name) for name in names]).select(*finish())


def observed(df: DataFrame, *aggregates: Column) -> tuple[DataFrame, Observation]:
    """Collect metrics in the job that writes the rows."""
    watch = Observation()
    return df.observe(watch, *aggregates), watch
