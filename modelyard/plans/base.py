"""Query registry and the roles the driver tables play."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import calendar_parts
from ..session import tune

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query; `sql` is the equivalent statement over the same tables."""

    def add(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = Query(tuned, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- trips: lineitem joined with orders ------------------------------------


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the role of trips; the order key keeps a trip's lines together."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.date_format("l_shipdate", "yyyyMMdd"), F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        ).alias("trip_id"),
        F.col("l_quantity").alias("distance"),
        (F.col("l_tax") + 40).alias("dropoff_latitude"),
        (F.col("l_discount") - 74).alias("dropoff_longitude"),
        F.col("l_linenumber").alias("passengers"),
        (F.col("l_discount") + 40).alias("pickup_latitude"),
        (F.col("l_tax") - 74).alias("pickup_longitude"),
        *calendar_parts(F.col("o_orderdate"), "pickup"),
        *calendar_parts(F.col("l_shipdate"), "dropoff"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("store_forward"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("vendor"),
        F.col("l_extendedprice").alias("cost"),
    )


def _calendar_sql(column: str, prefix: str) -> str:
    return (
        f"CAST(isodow({column}) - 1 AS INTEGER) AS {prefix}_weekday, "
        f"CAST(month({column}) AS INTEGER) AS {prefix}_month, "
        f"CAST(day({column}) AS INTEGER) AS {prefix}_monthday, "
        f"CAST(hour({column}) AS INTEGER) AS {prefix}_hour, "
        f"CAST(minute({column}) AS INTEGER) AS {prefix}_minute, "
        f"CAST(second({column}) AS INTEGER) AS {prefix}_second"
    )


TRIPS_SQL = f"""trips AS (
  SELECT l_orderkey AS order_id,
         concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   strftime(l_shipdate, '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT)) AS trip_id,
         l_quantity AS distance,
         l_tax + 40 AS dropoff_latitude, l_discount - 74 AS dropoff_longitude,
         l_linenumber AS passengers,
         l_discount + 40 AS pickup_latitude, l_tax - 74 AS pickup_longitude,
         {_calendar_sql('o_orderdate', 'pickup')},
         {_calendar_sql('l_shipdate', 'dropoff')},
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS store_forward,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS vendor,
         l_extendedprice AS cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def draw_sql(text: str) -> str:
    """The hash draw of functions.scalar.unit_draw over an SQL text expression."""
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0)"


def split_sql(key: str) -> str:
    u = draw_sql(f"CAST({key} AS VARCHAR)")
    return f"CASE WHEN {u} < 0.7 THEN 'train' WHEN {u} < 0.85 THEN 'val' ELSE 'test' END"


SPLIT_TRIPS_SQL = f"{TRIPS_SQL}, parts AS (SELECT *, {split_sql('order_id')} AS split FROM trips)"


# --- pairs: a user turn and the assistant turn that follows -----------------


def dialogue_pairs(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """(conv_id, turn, candidate, reference); both key columns spread hot dialogues."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("candidate"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference")
    )
    return asked.join(answered, ["conv_id", "turn"], how)


PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS candidate, a.text AS reference
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

PAIR_KEY = ("conv_id", "turn")


# --- batch trace: events as training steps ----------------------------------

STEPS_PER_EPOCH = 990


def batch_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(epoch, phase, iter, loss, n, correct, seconds) with 990 steps per epoch."""
    n = F.pmod("user_id", F.lit(64)) + 1
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / STEPS_PER_EPOCH).cast("bigint").alias("epoch"),
        F.when(F.col("event_type").isin("purchase", "signup"), "eval").otherwise("train").alias("phase"),
        F.pmod("event_id", F.lit(STEPS_PER_EPOCH)).alias("iter"),
        F.col("value").alias("loss"),
        n.alias("n"),
        F.pmod("event_id", n + 1).alias("correct"),
    )


TRACE_SQL = f"""trace AS (
  SELECT event_id // {STEPS_PER_EPOCH} AS epoch,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'eval' ELSE 'train' END AS phase,
         event_id % {STEPS_PER_EPOCH} AS iter, value AS loss,
         user_id % 64 + 1 AS n, event_id % (user_id % 64 + 2) AS correct
  FROM events)"""


# --- registry: parts as registered models -----------------------------------


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"),
        F.col("p_partkey").cast("int").alias("version"),
        F.concat_ws("/", F.lit("models"), "p_brand", "p_partkey").alias("path"),
        F.md5(F.col("p_name")).alias("run_id"),
        (F.col("p_retailprice") / 2500.0).alias("r2"),
    )


REGISTRY_SQL = """registry AS (
  SELECT p_brand AS name, CAST(p_partkey AS INTEGER) AS version,
         concat_ws('/', 'models', p_brand, p_partkey) AS path, md5(p_name) AS run_id,
         p_retailprice / 2500.0 AS r2
  FROM part)"""
