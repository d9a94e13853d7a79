"""Scoring requests in their three JSON shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..spec import POSITIONAL_LAYOUT, TRIPS, FeatureSpec


POSITIONAL_SHAPE = "input_data array<array<double>>"
TABLE_SHAPE = "input_data struct<columns:array<string>,index:array<bigint>,data:array<array<double>>>"


def _body(raw: str, shape: str) -> Column:
    """The parsed body, null if any part of the request is not what the shape says.

    The parse is bound to one variable, so it runs once however often its parts are used.
    """
    strict = F.from_json(F.col(raw), f"{shape}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    return F.get(F.transform(F.array(strict), lambda b: F.when(b["_broken"].isNull(), b["input_data"])), F.lit(0))


def _parsed(raw: str, shape: str) -> Column:
    problem = F.concat(F.lit("request does not parse: "), F.coalesce(F.substring(F.col(raw), 1, 80), F.lit("null")))
    kind = shape.removeprefix("input_data ")
    return F.coalesce(_body(raw, shape), F.raise_error(problem).cast(kind))


def split_requests(requests: DataFrame, raw: str, shape: str = POSITIONAL_SHAPE) -> tuple[DataFrame, DataFrame]:
    """Requests that parse, and a table of the others with the `reason`; nothing is lost."""
    good = _body(raw, shape).isNotNull()
    reason = F.when(F.col(raw).isNull(), "no text").otherwise("not of the expected shape")
    return requests.where(good), requests.where(~good).withColumn("reason", reason)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """One request per file, however many lines it spans."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path"))


def positional_rows(
    requests: DataFrame,
    raw: str,
    keep: Sequence[str] = (),
    layout: Sequence[str] = POSITIONAL_LAYOUT,
    spec: FeatureSpec = TRIPS,
) -> DataFrame:
    """{"input_data": [[...], ...]}: values are named by the layout, then put in
    contract order. A row of another width and a request that does not parse are errors."""
    body = _parsed(raw, POSITIONAL_SHAPE)
    # An outer generator: for an inner one the planner would parse again to test for empty bodies.
    rows = requests.select(*keep, F.posexplode_outer(body).alias("row", "_values")).where("row IS NOT NULL")
    problem = F.concat(F.lit("values in a request row: "), F.size("_values").cast("string"))
    checked = F.when(F.size("_values") == len(layout), F.col("_values")).otherwise(
        F.raise_error(problem).cast("array<double>")
    )
    at = {name: i for i, name in enumerate(layout)}
    rows = rows.withColumn("_values", checked)
    return rows.select(
        *keep, "row", *[F.col("_values").getItem(at[f]).alias(f) for f in spec.features]
    )


def rows_and_rejects(
    requests: DataFrame,
    raw: str,
    keep: Sequence[str] = (),
    layout: Sequence[str] = POSITIONAL_LAYOUT,
    spec: FeatureSpec = TRIPS,
) -> DataFrame:
    """Positional rows as `positional_rows` gives them, with a `reason` that is null, and one row
    without features for each request, or request row, that is not of the shape. Each
    request is parsed once; a request without rows gives none."""
    parsed = requests.select(
        *keep, F.col(raw).isNull().alias("_no_text"), _body(raw, POSITIONAL_SHAPE).alias("_b")
    )
    rows = parsed.select(
        *keep, "_no_text", F.col("_b").isNull().alias("_broken"), F.posexplode_outer("_b").alias("row", "_values")
    ).where("_broken OR row IS NOT NULL")
    fits = F.size("_values") == len(layout)
    reason = (
        F.when(F.col("_no_text"), "no text").when(F.col("_broken"), "not of the expected shape")
        .when(F.col("_values").isNull(), "a row without values")
        .when(~fits, F.concat(F.lit("values in a request row: "), F.size("_values").cast("string")))
    )
    at = {name: i for i, name in enumerate(layout)}
    return rows.select(*keep, "row", *[F.when(fits, F.get("_values", F.lit(at[f]))).alias(f) for f in spec.features], reason.alias("reason"))


def split_oriented_rows(
    requests: DataFrame, raw: str, keep: Sequence[str] = (), spec: FeatureSpec = TRIPS
) -> DataFrame:
    """{"input_data": {"columns", "index", "data"}}: values are selected by name. A request
    that lacks a column or does not parse is an error."""
    body = _parsed(raw, TABLE_SHAPE)
    parsed = requests.select(*keep, body.alias("_b"))

    # The places are found once per request, not once per row.
    names = F.array(*map(F.lit, spec.features))
    at = F.transform(names, lambda n: F.array_position(F.col("_b.columns"), n).cast("int"))
    placed = parsed.withColumn("_at", at)
    absent = F.array_join(F.array_except(names, "_b.columns"), ", ")
    problem = F.concat(F.lit("request lacks columns: "), absent)
    complete = F.when(F.array_min("_at") > 0, F.col("_at")).otherwise(
        F.raise_error(problem).cast("array<int>")
    )
    rows = placed.select(
        *keep, complete.alias("_at"),
        F.posexplode_outer(F.arrays_zip(F.col("_b.index").alias("index"), F.col("_b.data").alias("data"))).alias("_pos", "_z"),
    ).where("_pos IS NOT NULL")
    values = [
        F.element_at("_z.data", F.col("_at").getItem(i)).alias(f) for i, f in enumerate(spec.features)
    ]
    return rows.select(*keep, F.col("_z.index").alias("row"), *values)


def request_text(raw: Column) -> Column:
    """Text of {"data": ...}."""
    return F.get_json_object(raw, "$.data")
