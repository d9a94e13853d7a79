"""Monitoring: batch summaries, drift and the append table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import monitor as mo
from ..operators import split as sp
from ..session import workspace
from ..sources import tables as tb
from .base import query, split_sql, table
from .splits import EVENT_TYPES

_SHARES_SQL = ", ".join(
    f"round(count(*) FILTER (event_type = '{t}') / count(*), 6) AS share_{t}" for t in EVENT_TYPES
)


@query(
    "window_summary_k3",
    f"""SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS window_start, count(*) AS n, round(avg(value), 6) AS mean,
        {_SHARES_SQL} FROM events GROUP BY 1""",
)
def window_summary(spark, d):
    summary = mo.window_summary(table(spark, d, "events"), "ts", "1 hour", "value", "event_type", EVENT_TYPES)
    return summary.select(
        F.unix_micros(F.col("window_start").cast("timestamp")).alias("window_start"), "n",
        F.round("mean", 6).alias("mean"),
        *[F.round(f"share_{t}", 6).alias(f"share_{t}") for t in EVENT_TYPES],
    )


EDGES = (5.0, 10.0, 20.0, 40.0, 60.0, 80.0, 120.0, 160.0, 240.0)


def _bin_sql(i: int) -> str:
    low = f"value >= {EDGES[i - 1]}" if i else "true"
    high = f"value < {EDGES[i]}" if i < len(EDGES) else "true"
    return f"count(*) FILTER ({low} AND {high}) AS c{i}"


_BINS = range(len(EDGES) + 1)
_PSI_SQL = " + ".join(
    f"((a.c{i} + 0.5) / (a.n + {0.5 * len(_BINS)}) - (e.c{i} + 0.5) / (e.n + {0.5 * len(_BINS)}))"
    f" * ln(((a.c{i} + 0.5) / (a.n + {0.5 * len(_BINS)})) / ((e.c{i} + 0.5) / (e.n + {0.5 * len(_BINS)})))"
    for i in _BINS
)


DRIFT_SQL = f"""WITH parts AS (SELECT *, {split_sql('event_id')} AS split FROM events),
e AS (SELECT count(*) AS n, {', '.join(map(_bin_sql, _BINS))} FROM parts WHERE split = 'train'),
a AS (SELECT dayofyear(ts) AS day, count(*) AS n, {', '.join(map(_bin_sql, _BINS))} FROM parts
      WHERE split <> 'train' GROUP BY 1)
SELECT CAST(a.day AS INTEGER) AS day, a.n, round({_PSI_SQL}, 6) AS psi FROM a, e"""


@query("drift_scores_k4", DRIFT_SQL)
def drift_scores(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "value")
    train = sp.split_rows(events, ["event_id"], "train")
    later = sp.split_rows(events, ["event_id"], "train", rest=True).withColumn("day", F.dayofyear("ts"))
    scores = mo.drift_scores(train, later, "value", EDGES, ["day"])
    return scores.withColumn("psi", F.round("psi", 6))


@query(
    "monitoring_append_s15",
    """SELECT 'mlmonitoring' AS table_name, event_type, 2 * count(*) AS rows FROM events GROUP BY 2""",
)
def monitoring_append(spark, d):
    """The whole batch appended twice with monitoring on, and once with it off."""
    path = workspace(spark, "monitoring")
    events = table(spark, d, "events")
    for switch in ("true", "Yes", "no"):
        tb.append_monitoring(events, path, "mlmonitoring", switch)
    stored = tb.read_monitoring(spark, path, "mlmonitoring")
    return stored.groupBy("table_name", "event_type").agg(F.count(F.lit(1)).alias("rows"))
