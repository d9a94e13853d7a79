"""Streaming scoring and monitoring, each run over everything available."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import models as md
from ..operators import registry as rg
from ..operators import split as sp
from ..session import workspace
from ..sources import requests as rq
from ..sources.committed import read_batches
from ..streaming import monitoring as sm
from ..streaming import scoring as ss
from .base import SPLIT_TRIPS_SQL, query, table, trips
from .monitoring import DRIFT_SQL, EDGES
from .splits import EVENT_TYPES
from .tabular import _request_pairs, _scored_by_user, registered_line


@query(
    "streaming_scoring_k1",
    f"""WITH {SPLIT_TRIPS_SQL}, fit AS (SELECT regr_slope(cost, distance) AS s, regr_intercept(cost, distance) AS i
          FROM parts WHERE split = 'train')
    SELECT passengers, count(*) AS rows, round(sum(fit.s * distance + fit.i), -2) AS predicted FROM parts, fit GROUP BY 1""",
)
def streaming_scoring(spark, d):
    """Request files streamed through parsing and a registered model."""
    model = registered_line(spark, d)
    inbox, out = workspace(spark, "requests"), workspace(spark, "scores")
    _request_pairs(spark, d).select("positional").write.text(inbox)
    running = ss.score_stream(
        ss.request_stream(spark, inbox),
        lambda df: rq.positional_rows(df, "raw", ["file_path"]),
        lambda df: md.predict(model, df),
        out, workspace(spark, "scores-log"),
    )
    running.awaitTermination()
    return spark.read.parquet(out).groupBy(F.col("passengers").cast("int").alias("passengers")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("prediction"), -2).alias("predicted")
    )


@query(
    "streaming_scorer_udf",
    f"""WITH {SPLIT_TRIPS_SQL}, fit AS (SELECT regr_slope(cost, distance) AS s, regr_intercept(cost, distance) AS i
          FROM parts WHERE split = 'train')
    SELECT trip_id, round(fit.s * distance + fit.i, 2) AS predicted_label FROM parts, fit""",
)
def streaming_scorer(spark, d):
    """The user's scorer on a stream: parameters loaded once per task of each batch."""
    inbox, out = workspace(spark, "trips"), workspace(spark, "user-scores")
    trips(spark, d).select("trip_id", "distance").write.parquet(inbox)
    incoming = spark.readStream.schema("trip_id string, distance double").parquet(inbox)
    ss.score_stream(
        incoming, lambda df: df, lambda df: _scored_by_user(spark, d, df), out, workspace(spark, "user-scores-log")
    ).awaitTermination()
    return spark.read.parquet(out)


@query(
    "streaming_text_m12",
    """SELECT count(*) AS requests, CAST(sum(length('summarize: ' || text)) AS BIGINT) AS characters,
       CAST(sum(len(regexp_extract_all(lower('summarize: ' || text), '[a-z0-9]+'))) AS BIGINT) AS words
       FROM conversations""",
)
def streaming_text(spark, d):
    """Text requests streamed through parsing and the model's prefix."""
    inbox, out = workspace(spark, "texts"), workspace(spark, "prompts")
    body = F.to_json(F.struct(F.col("text").alias("data")))
    table(spark, d, "conversations").select(body.alias("value")).write.text(inbox)
    ss.score_stream(
        ss.request_stream(spark, inbox),
        lambda df: df.select("file_path", rq.request_text(F.col("raw")).alias("text")),
        lambda df: df.withColumn("prompt", tx.with_prefix(F.col("text"))),
        out, workspace(spark, "prompts-log"),
    ).awaitTermination()
    prompt = F.col("prompt")
    return spark.read.parquet(out).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.length(prompt)).alias("characters"),
        F.sum(F.size(tx.words(prompt))).alias("words"),
    )


_WORDS_SQL = "len(regexp_extract_all(lower(text), '[a-z0-9]+'))"


@query(
    "streaming_text_versions_m12",
    f"""SELECT CAST(conv_id % 2 + 1 AS INTEGER) AS version, count(*) AS requests,
        CAST(sum(CASE WHEN conv_id % 2 = 0 THEN 2 * {_WORDS_SQL} + 3 ELSE 5 * {_WORDS_SQL} END) AS BIGINT) AS predicted
        FROM conversations GROUP BY 1""",
)
def streaming_text_versions(spark, d):
    """Text requests scored by a registered text model, and by its next version once that is
    registered, in one running query. Both versions are fitted to targets with a known answer."""
    turns = table(spark, d, "conversations").where(F.col("text").isNotNull())
    n = F.size(tx.words(F.col("text")))
    inbox, out, registry = (workspace(spark, name) for name in ("turns", "turn-scores", "text-registry"))
    running = None
    try:
        for half, target in enumerate((2 * n + 3, 5 * n)):
            model = md.fit_text(turns.withColumn("target", target), "text", "target", buckets=16)
            path = md.save_model(model, workspace(spark, "text-model"))
            on_record = rg.read_registry(spark, registry) if half else spark.createDataFrame([], rg.REGISTRY_SCHEMA)
            rg.register_version(on_record, registry, "summary-length", path, f"run-{half}", True)
            body = F.to_json(F.struct(F.col("text").alias("data")))
            wave = turns.where(F.pmod("conv_id", F.lit(2)) == half).select(body.alias("value"))
            wave.write.mode("append").text(inbox)
            running = running or ss.score_latest_stream(
                ss.request_stream(spark, inbox),
                lambda df: df.select(rq.request_text(F.col("raw")).alias("text")),
                lambda model, df: md.predict_text(model, df, "text").select("text", "prediction"),
                registry, "summary-length", out, workspace(spark, "turn-scores-log"), until_done=False,
            )
            running.processAllAvailable()
    finally:
        if running is not None:
            running.stop()
    scored = read_batches(spark, out, "text string, prediction double, version int")
    return scored.groupBy("version").agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.round("prediction").cast("bigint")).alias("predicted")
    )


@query(
    "streaming_ingest_k2",
    "SELECT event_type, count(*) AS rows, round(sum(value), 4) AS value FROM events GROUP BY 1",
)
def streaming_ingest(spark, d):
    """Events streamed into the monitoring table, one folder per batch."""
    events = sm.table_stream(spark, d, table(spark, d, "events").schema, "events.parquet")
    out = workspace(spark, "monitor")
    sm.ingest_stream(events, out, workspace(spark, "monitor-log")).awaitTermination()
    return sm.read_ingested(spark, out, events.schema).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 4).alias("value")
    )


@query(
    "streaming_summary_k3",
    """WITH edge AS (SELECT max(ts) - INTERVAL '10 minutes' AS e FROM events)
    SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS window_start, count(*) AS n, round(avg(value), 6) AS mean
    FROM events, edge WHERE time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= e GROUP BY 1""",
)
def streaming_summary(spark, d):
    """Hourly windows appended once the watermark has passed them."""
    stored = table(spark, d, "events")
    events = sm.table_stream(spark, d, stored.schema, "events.parquet")
    out = workspace(spark, "windows")
    sm.summary_stream(
        events, "ts", "1 hour", "value", "event_type", EVENT_TYPES, out, workspace(spark, "windows-log")
    ).awaitTermination()
    return spark.read.parquet(out).select(
        F.unix_micros(F.col("window_start").cast("timestamp")).alias("window_start"), "n",
        F.round("mean", 6).alias("mean"),
    )


@query("streaming_drift_k4", DRIFT_SQL)
def streaming_drift(spark, d):
    """Drift of each day, counted as the events come in from files of a few hours each."""
    stored = table(spark, d, "events").select("event_id", "ts", "value")
    inbox, out = workspace(spark, "drift-events"), workspace(spark, "drift")
    stored.repartitionByRange(8, "ts").write.parquet(inbox)
    later = sp.split_rows(
        spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 3).parquet(inbox),
        ["event_id"], "train", rest=True,
    )
    sm.drift_stream(
        sp.split_rows(stored, ["event_id"], "train"), later, "ts", "1 day", "value", EDGES,
        out, workspace(spark, "drift-log"), late="400 days",  # files come in any order
    ).awaitTermination()
    return sm.read_drift(spark, out).select(
        F.dayofyear("window_start").alias("day"), "n", F.round("psi", 6).alias("psi")
    )


@query(
    "stream_log_m4",
    """SELECT 'ingest' AS run_id, 'rows' AS key, CAST(count(*) AS DOUBLE) AS value FROM events
       UNION ALL SELECT 'ingest', 'train_n', CAST(count(value) AS DOUBLE) FROM events
       UNION ALL SELECT 'ingest', 'train_loss', round(sum(value), 4) FROM events""",
)
def stream_log(spark, d):
    """Batches of a stream logged by a listener, with their observed loss; totals of the log."""
    stored = table(spark, d, "events")
    inbox, out, log = (workspace(spark, name) for name in ("log-events", "log-out", "stream-log"))
    stored.repartition(4, "event_id").write.parquet(inbox)
    watched = (
        spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        .observe("train", F.count("value").alias("n"), F.sum("value").alias("loss"))
    )
    listener = sm.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        running = sm.ingest_stream(watched, out, workspace(spark, "log-checkpoint"), "ingest")
        running.awaitTermination()
        listener.wait(running)
    finally:
        spark.streams.removeListener(listener)
    steps = rg.latest_metrics(spark.read.schema(rg.LOG_SCHEMA).parquet(log), ("run_id", "key", "step"))
    return steps.where((F.col("run_id") == "ingest") & (F.col("key") != "seconds")).groupBy("run_id", "key").agg(
        F.round(F.sum("value"), 4).alias("value")
    )
