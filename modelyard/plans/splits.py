"""Projection, split, shard and batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import split as sp
from ..session import workspace
from ..sources.tables import write_splits
from ..spec import TRIPS
from .base import (
    SPLIT_TRIPS_SQL, TRIPS_SQL, dialogue_pairs, draw_sql, query, split_sql, table, trips,
)


@query(
    "contract_projection_p1",
    f"WITH {TRIPS_SQL} SELECT trip_id, {', '.join(TRIPS.columns)} FROM trips",
)
def contract_projection(spark, d):
    return TRIPS.project(trips(spark, d), "trip_id")


# Spellings a switch may arrive in, good and bad.
_SPELLINGS = ("TRUE", "1", "Yes", "false", "0", "off", " on ", "maybe")
_SPELLING_SQL = "[" + ", ".join(f"'{s}'" for s in _SPELLINGS) + "]"


@query(
    "switch_normaliser_p3",
    f"""WITH raw AS (SELECT event_id, ({_SPELLING_SQL})[CAST(event_id % {len(_SPELLINGS)} AS INTEGER) + 1] AS raw
        FROM events)
    SELECT event_id, raw, lower(trim(raw)) IN ('true', '1', 'yes') AS is_on,
           CASE WHEN lower(trim(raw)) IN ('y','yes','t','true','on','1') THEN true
                WHEN lower(trim(raw)) IN ('n','no','f','false','off','0') THEN false END AS strict
    FROM raw""",
)
def switch_normaliser(spark, d):
    spellings = F.array(*map(F.lit, _SPELLINGS))
    slot = (F.pmod("event_id", F.lit(len(_SPELLINGS))) + 1).cast("int")
    raw = table(spark, d, "events").select("event_id", F.element_at(spellings, slot).alias("raw"))
    return raw.select(
        "event_id", "raw",
        sc.switch(F.col("raw")).alias("is_on"),
        sc.strict_bool(F.col("raw"), on_error="null").alias("strict"),
    )


@query(
    "null_pairs_p4",
    """SELECT u.conv_id, u.turn, u.text AS candidate, a.text AS reference
       FROM conversations u LEFT JOIN conversations a
         ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
       WHERE u.role = 'user' AND u.text IS NOT NULL AND a.text IS NOT NULL""",
)
def null_pairs(spark, d):
    from ..operators.encoding import drop_null_pairs

    return drop_null_pairs(dialogue_pairs(spark, d, "left"), "candidate", "reference")


_U_ORDER = draw_sql("CAST(o_orderkey AS VARCHAR)")


@query(
    "draw_ranges_p5",
    f"""SELECT o_orderkey, round({_U_ORDER}, 9) AS draw, {_U_ORDER} < 0.7 AS is_train,
        {_U_ORDER} >= 0.7 AND {_U_ORDER} < 0.85 AS is_val, {_U_ORDER} >= 0.85 AS is_test FROM orders""",
)
def draw_ranges(spark, d):
    drawn = table(spark, d, "orders").select("o_orderkey", sc.unit_draw(["o_orderkey"]).alias("u"))
    u = F.col("u")
    return drawn.select(
        "o_orderkey", F.round(u, 9).alias("draw"),
        (u < 0.7).alias("is_train"),
        ((u >= 0.7) & (u < 0.85)).alias("is_val"),
        (u >= 0.85).alias("is_test"),
    )


@query(
    "name_substring_p8",
    """SELECT p_partkey, p_type || '-T' || p_size AS arch,
       contains(lower(p_type || '-T' || p_size), 't5') AS wants_prefix FROM part""",
)
def name_substring(spark, d):
    arch = F.concat(F.col("p_type"), F.lit("-T"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", arch.alias("arch")).withColumn(
        "wants_prefix", sc.name_contains(F.col("arch"))
    )


# Event types of the stream, alphabetical.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("known_values_p9", "SELECT event_id, event_type FROM events")
def known_values(spark, d):
    checked = sc.known_or_error(F.col("event_type"), EVENT_TYPES, "event type")
    return table(spark, d, "events").select("event_id", checked.alias("event_type"))


@query(
    "calendar_parts_f17",
    """SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS at_weekday, CAST(month(ts) AS INTEGER) AS at_month,
       CAST(day(ts) AS INTEGER) AS at_monthday, CAST(hour(ts) AS INTEGER) AS at_hour,
       CAST(minute(ts) AS INTEGER) AS at_minute, CAST(second(ts) AS INTEGER) AS at_second FROM events""",
)
def calendar(spark, d):
    return table(spark, d, "events").select("event_id", *sc.calendar_parts(F.col("ts"), "at"))


@query(
    "hash_split_x1",
    f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders",
)
def three_way_split(spark, d):
    return sp.hash_split(table(spark, d, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


@query(
    "two_way_split_x2",
    f"""SELECT doc_id, CAST(quality AS VARCHAR) AS label,
        CASE WHEN {draw_sql("CAST(doc_id AS VARCHAR)")} < 0.7 THEN 'train' ELSE 'test' END AS split
        FROM labels""",
)
def two_way_split(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return sp.hash_split(labels, ["doc_id"], (("train", 0.7), ("test", 0.3)))


HEAD_ROWS = 100


@query(
    "head_per_split_x3",
    f"""WITH parts AS (SELECT doc_id, text, {split_sql('doc_id')} AS split FROM documents)
    SELECT split, doc_id, text FROM (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS r FROM parts)
    WHERE r <= {HEAD_ROWS}""",
)
def head_per_split(spark, d):
    parts = sp.hash_split(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"])
    return sp.head_per_group(parts, ["split"], ["doc_id"], HEAD_ROWS).select("split", "doc_id", "text")


@query(
    "split_sizes_x4",
    f"""WITH {SPLIT_TRIPS_SQL} SELECT split, count(*) AS rows FROM parts GROUP BY split""",
)
def split_sizes(spark, d):
    return sp.split_sizes(sp.hash_split(trips(spark, d).select("order_id"), ["order_id"]))


WORKERS, EPOCH = 7, 3
TRAIN_BATCH, PREDICT_BATCH = 64, 256


@query(
    "worker_shards_x5",
    f"""WITH placed AS (
      SELECT o_orderkey, row_number() OVER (ORDER BY md5('{EPOCH}|' || o_orderkey), o_orderkey) AS p,
             count(*) OVER () AS n FROM orders),
    sized AS (SELECT *, CAST(ceil(n / {WORKERS}.0) * {WORKERS} AS BIGINT) AS padded FROM placed),
    copies AS (SELECT o_orderkey, unnest(generate_series(p, padded, n)) AS position FROM sized)
    SELECT o_orderkey, position, CAST((position - 1) % {WORKERS} AS INTEGER) AS shard FROM copies""",
)
def worker_shards(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return sp.shard_rows(orders, ["o_orderkey"], WORKERS, EPOCH)


@query(
    "positions_w1",
    f"""WITH placed AS (
      SELECT event_id, row_number() OVER (ORDER BY md5('{EPOCH}|' || event_id), event_id) AS p,
             count(*) OVER () AS n FROM events),
    sized AS (SELECT *, CAST(ceil(n / {WORKERS}.0) * {WORKERS} AS BIGINT) AS padded FROM placed),
    copies AS (SELECT event_id, unnest(generate_series(p, padded, n)) AS position FROM sized)
    SELECT event_id, CAST((position - 1) % {WORKERS} AS INTEGER) AS shard,
           (position - 1) // {WORKERS} + 1 AS place, (position - 1) // {WORKERS} // 64 AS batch FROM copies""",
)
def positions(spark, d):
    """Place of each row inside its shard, and the batch of that place."""
    shards = sp.shard_rows(table(spark, d, "events").select("event_id"), ["event_id"], WORKERS, EPOCH)
    place = F.floor((F.col("position") - 1) / WORKERS).cast("bigint") + 1
    return shards.select("event_id", "shard", place.alias("place")).withColumn(
        "batch", sp.batch_id(F.col("place"), TRAIN_BATCH)
    )


@query(
    "validation_replicas_x6",
    f"""SELECT o_orderkey, CAST(worker AS INTEGER) AS worker FROM (
        SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders), range({WORKERS}) t(worker)
        WHERE split = 'val'""",
)
def validation_replicas(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return sp.replicate(sp.split_rows(orders, ["o_orderkey"], "val"), WORKERS)


@query(
    "ordered_batches_x7",
    f"""SELECT event_id, position, CAST((position - 1) // {PREDICT_BATCH} AS BIGINT) AS batch FROM (
        SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM events)""",
)
def ordered_batches(spark, d):
    rows = table(spark, d, "events").select("ts", "event_id")
    return sp.batches(rows, ["ts", "event_id"], PREDICT_BATCH).select("event_id", "position", "batch")


@query(
    "shuffled_batches_x8",
    f"""SELECT event_id, position, CAST((position - 1) // {TRAIN_BATCH} AS BIGINT) AS batch FROM (
        SELECT event_id, row_number() OVER (ORDER BY md5('11|' || event_id), event_id) AS position FROM events)""",
)
def shuffled_batches(spark, d):
    rows = table(spark, d, "events").select("event_id")
    return sp.shuffled_batches(rows, ["event_id"], TRAIN_BATCH, 11)


@query(
    "file_mini_batches_x9",
    f"""WITH files AS (
          SELECT row_number() OVER (ORDER BY url) - 1 AS r FROM (SELECT DISTINCT url FROM pages))
        SELECT CAST(r // 10 AS BIGINT) AS batch, count(*) AS files FROM files GROUP BY 1""",
)
def file_mini_batches(spark, d):
    listed = sp.file_batches(table(spark, d, "pages"), "url")
    return listed.groupBy("batch").agg(F.count(F.lit(1)).alias("files"))


@query(
    "split_leakage_x10",
    f"""WITH parts AS (SELECT l_orderkey, {split_sql("l_orderkey || '-' || l_linenumber")} AS split FROM lineitem)
    SELECT l_orderkey FROM parts WHERE split = 'train'
    INTERSECT SELECT l_orderkey FROM parts WHERE split = 'test'""",
)
def split_leakage(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")
    )
    train, test = (sp.split_rows(lines, ["line"], s) for s in ("train", "test"))
    return sp.shared_keys(train, test, ["l_orderkey"])


@query(
    "partition_law_u2",
    """SELECT count(*) AS source_rows, count(*) AS part_rows, CAST(0 AS BIGINT) AS overlap,
       CAST(0 AS BIGINT) AS missing FROM orders""",
)
def partition_law(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    out = write_splits(sp.hash_split(orders, ["o_orderkey"]), workspace(spark, "law"))
    return sp.partition_law(orders, spark.read.parquet(out), ["o_orderkey"])
