"""Image-classification side: labels, class indices, score vectors, metrics."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import vector as vc
from ..operators import lookup as lk
from ..operators import metrics as mt
from ..operators import models as md
from ..operators import split as sp
from ..session import workspace
from ..sources import controls as ct
from ..sources import images as im
from ..sources import tables as tb
from .base import TRACE_SQL, batch_trace, draw_sql, query, split_sql, table


@query(
    "labels_join_items_j1",
    """SELECT l.doc_id, quality, toxic, n_chars, d.doc_id IS NOT NULL AS found
       FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id""",
)
def labels_join_items(spark, d):
    items = table(spark, d, "documents").select("doc_id", "n_chars")
    return lk.items_of_labels(table(spark, d, "labels"), items, "doc_id")


@query(
    "missing_items_j1",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def missing_items(spark, d):
    documents = table(spark, d, "documents").select("doc_id")
    return lk.missing_items(documents, table(spark, d, "labels"), "doc_id")


@query(
    "restrict_items_j6",
    f"""SELECT doc_id, lang, source FROM documents WHERE doc_id IN (
        SELECT doc_id FROM (SELECT doc_id, {split_sql('doc_id')} AS split FROM labels) WHERE split = 'train')""",
)
def restrict_items(spark, d):
    parts = sp.hash_split(table(spark, d, "labels"), ["doc_id"])
    items = table(spark, d, "documents").select("doc_id", "lang", "source")
    return lk.restrict_to(items, parts.where(F.col("split") == "train"), "doc_id")


@query(
    "sorted_class_index_f11",
    """SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS label_idx
       FROM (SELECT DISTINCT c_mktsegment FROM customer)""",
)
def sorted_class_index(spark, d):
    return lk.sorted_class_index(table(spark, d, "customer"), "c_mktsegment")


_FIRST_SEEN_SQL = f"""idx AS (SELECT source, CAST(row_number() OVER (ORDER BY first, source) - 1 AS INTEGER) AS label_idx
    FROM (SELECT source, min(doc_id) AS first FROM documents WHERE {split_sql('doc_id')} = 'train' GROUP BY source))"""


def _first_seen(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "source")
    parts = sp.hash_split(documents, ["doc_id"])
    train = parts.where(F.col("split") == "train")
    return parts, lk.first_seen_class_index(train, "source", "doc_id")


@query("first_seen_class_index_f12", f"WITH {_FIRST_SEEN_SQL} SELECT source, label_idx FROM idx")
def first_seen_class_index(spark, d):
    return _first_seen(spark, d)[1]


@query(
    "class_lookup_j2",
    f"""WITH {_FIRST_SEEN_SQL} SELECT doc_id, d.source, label_idx, d.source AS decoded
        FROM documents d JOIN idx ON idx.source = d.source WHERE {split_sql('doc_id')} = 'test'""",
)
def class_lookup(spark, d):
    """Index fitted on the training rows, reused on the test rows, and back to text."""
    parts, index = _first_seen(spark, d)
    test = parts.where(F.col("split") == "test").drop("split")
    coded = lk.encode_class(test, index, "source")
    return lk.decode_class(coded, index, "label_idx", "source", "decoded").select(
        "doc_id", "source", "label_idx", "decoded"
    )


_LOGITS_SQL = """logits AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
                            FROM embeddings)"""


def _logits(spark, d):
    """All dimensions in the role of class scores."""
    return table(spark, d, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    )


@query(
    "arg_max_f8",
    f"""WITH {_LOGITS_SQL} SELECT vec_id, label,
        CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS predicted FROM logits""",
)
def arg_max(spark, d):
    return _logits(spark, d).select("vec_id", "label", vc.arg_max(F.col("v")).alias("predicted"))


@query(
    "cross_entropy_f9",
    f"""WITH {_LOGITS_SQL}, m AS (SELECT *, list_max(v) AS top FROM logits)
    SELECT vec_id, vec_id // 64 AS batch,
           round(top + ln(list_sum(list_transform(v, lambda x: exp(x - top)))) - v[label + 1], 6) AS loss FROM m""",
)
def cross_entropy(spark, d):
    loss = vc.cross_entropy(F.col("v"), F.col("label"))
    return _logits(spark, d).select(
        "vec_id", F.floor(F.col("vec_id") / 64).cast("bigint").alias("batch"), F.round(loss, 6).alias("loss")
    )


@query(
    "channel_normalise_f10",
    f"""WITH n AS (SELECT vec_id, list_transform(embedding, lambda x, i: (CAST(x AS DOUBLE)
          - CAST(({list(vc.CHANNEL_MEAN)})[CAST(floor((i - 1) * 3 / 64.0) AS INTEGER) + 1] AS DOUBLE))
          / CAST(({list(vc.CHANNEL_STD)})[CAST(floor((i - 1) * 3 / 64.0) AS INTEGER) + 1] AS DOUBLE)) AS v FROM embeddings)
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, round(v[i], 6) AS x FROM n, range(1, 65) r(i)""",
)
def channel_normalise(spark, d):
    scaled = vc.channel_normalise(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", F.posexplode(scaled).alias("i", "x")).withColumn(
        "x", F.round("x", 6)
    )


# Predicted class of an event: the most frequent training class of its hour of day,
# a dimension of at most 24 rows.
_EVENTS_SQL = f"""parts AS (SELECT event_id, event_type, hour(ts) AS h, {split_sql('event_id')} AS split FROM events),
  freq AS (SELECT h, event_type, count(*) AS n FROM parts WHERE split = 'train' GROUP BY 1, 2),
  rule AS (SELECT h, event_type AS predicted FROM freq
           QUALIFY row_number() OVER (PARTITION BY h ORDER BY n DESC, event_type DESC) = 1),
  scored AS (SELECT event_id, event_type AS real, predicted FROM parts LEFT JOIN rule USING (h) WHERE split <> 'train'),
  counts AS (SELECT real, predicted, count(*) AS n FROM scored GROUP BY 1, 2),
  per_label AS (SELECT label, sum(hits) AS hits, sum(support) AS support, sum(predictions) AS predictions FROM (
      SELECT real AS label, CASE WHEN real = predicted THEN n ELSE 0 END AS hits, n AS support, 0 AS predictions FROM counts
      UNION ALL SELECT predicted, 0, 0, n FROM counts WHERE predicted IS NOT NULL) GROUP BY label),
  per_score AS (SELECT *, coalesce(hits / nullif(predictions, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
      coalesce(2 * hits / nullif(support + predictions, 0), 0) AS f FROM per_label)"""


def _scored_events(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", F.hour("ts").alias("h"))
    rule = md.majority_class(sp.split_rows(events, ["event_id"], "train"), ["h"], "event_type")
    rest = sp.split_rows(events, ["event_id"], "train", rest=True)
    # an hour that training never saw leaves its events without a prediction
    return rest.join(F.broadcast(rule), "h", "left").select(
        "event_id", F.col("event_type").alias("real"), "predicted"
    )


def _event_counts(spark, d):
    return mt.confusion_counts(_scored_events(spark, d), "real", "predicted")


@query("accuracy_a2", f"WITH {_EVENTS_SQL} SELECT round(avg(coalesce(CAST(real = predicted AS INTEGER), 0)), 6) AS accuracy FROM scored")
def accuracy(spark, d):
    return _scored_events(spark, d).agg(
        F.round(mt.accuracy(F.col("real"), F.col("predicted")), 6).alias("accuracy")
    )


_CLASS_SQL = f"""WITH {_EVENTS_SQL}, t AS (SELECT CAST(sum(support) AS DOUBLE) AS s, CAST(sum(hits) AS DOUBLE) AS c,
    sum(CAST(support AS DOUBLE) * predictions) AS tp, sum(CAST(support AS DOUBLE) * support) AS tt,
    sum(CAST(predictions AS DOUBLE) * predictions) AS pp FROM per_label)"""


@query(
    "multiclass_mcc_a3",
    f"""{_CLASS_SQL} SELECT CAST(s AS BIGINT) AS n, round(CASE WHEN (s*s - pp) * (s*s - tt) > 0
        THEN (c*s - tp) / sqrt((s*s - pp) * (s*s - tt)) ELSE 0 END, 6) AS mcc FROM t""",
)
def multiclass_mcc(spark, d):
    scores = mt.classification_metrics(_event_counts(spark, d))
    return scores.select("n", F.round("mcc", 6).alias("mcc"))


_MICRO_SQL = {"recall": "sum(hits) / sum(support)", "precision": "sum(hits) / sum(predictions)",
              "f1": "2 * sum(hits) / (sum(support) + sum(predictions))"}


def _averages_sql(metric: str, column: str) -> str:
    return f"""WITH {_EVENTS_SQL} SELECT round({_MICRO_SQL[metric]}, 6) AS {metric}_micro,
        round(avg({column}), 6) AS {metric}_macro,
        round(sum({column} * support) / sum(support), 6) AS {metric}_weighted FROM per_score"""


def _averages(spark, d, metric):
    scores = mt.classification_metrics(_event_counts(spark, d))
    names = [f"{metric}_{kind}" for kind in ("micro", "macro", "weighted")]
    return scores.select(*[F.round(n, 6).alias(n) for n in names])


@query("recall_averages_a4", _averages_sql("recall", "r"))
def recall_averages(spark, d):
    return _averages(spark, d, "recall")


@query("precision_averages_a5", _averages_sql("precision", "p"))
def precision_averages(spark, d):
    return _averages(spark, d, "precision")


@query("f1_averages_a6", _averages_sql("f1", "f"))
def f1_averages(spark, d):
    return _averages(spark, d, "f1")


@query(
    "confusion_matrix_a7",
    f"""WITH {_EVENTS_SQL}, axis AS (SELECT real AS label FROM counts UNION SELECT predicted FROM counts WHERE predicted IS NOT NULL)
    SELECT r.label AS real, p.label AS predicted, CAST(coalesce(n, 0) AS BIGINT) AS n FROM axis r, axis p
    LEFT JOIN counts c ON c.real = r.label AND c.predicted = p.label
    UNION ALL SELECT real, predicted, n FROM counts WHERE predicted IS NULL""",
)
def confusion_matrix(spark, d):
    return mt.dense_confusion(_event_counts(spark, d))


@query(
    "class_count_a17",
    """SELECT count(DISTINCT event_type) AS classes, count(DISTINCT user_id) AS users FROM events""",
)
def class_count(spark, d):
    return table(spark, d, "events").agg(
        F.count_distinct("event_type").alias("classes"), F.count_distinct("user_id").alias("users")
    )


@query(
    "class_summary_a19",
    """SELECT count(*) AS samples, count(DISTINCT event_type) AS classes,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS class_list FROM events""",
)
def class_summary(spark, d):
    return mt.class_summary(table(spark, d, "events"), "event_type")


@query(
    "prediction_batches_u1",
    f"""WITH {_LOGITS_SQL} SELECT vec_id, CAST(label AS VARCHAR) AS label_real,
        CAST(list_position(v, list_max(v)) - 1 AS VARCHAR) AS label_predicted FROM logits""",
)
def prediction_batches(spark, d):
    """Batches scored apart and put together again."""
    rows = _logits(spark, d).select(
        "vec_id", F.col("label").cast("string").alias("label_real"),
        vc.arg_max(F.col("v")).cast("string").alias("label_predicted"),
    )
    even, odd = (rows.where(F.pmod("vec_id", F.lit(2)) == side) for side in (0, 1))
    return even.unionByName(odd)


@query(
    "linear_probe_m9",
    f"""WITH planted AS (SELECT CAST(embedding[1] + embedding[2] > 0 AS INTEGER) AS label,
          CASE WHEN embedding[1] > -embedding[2] THEN 1 ELSE 0 END AS known FROM embeddings
          WHERE {draw_sql('CAST(vec_id AS VARCHAR)')} >= 0.7)
        SELECT label, count(*) AS n, avg(CAST(label = known AS INTEGER)) > 0.9 AS found FROM planted GROUP BY label""",
)
def linear_probe(spark, d):
    """Linear head on frozen embeddings, with a known answer: the label is the sign of a sum of
    two components, which a linear head can learn. Per label, its held-out vectors and whether
    more than nine tenths of them are found."""
    halves = (("train", 0.7), ("test", 0.3))
    side = F.element_at("embedding", 1).cast("double") + F.element_at("embedding", 2).cast("double")
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding", (side > 0).cast("int").alias("label"))
    train, test = (sp.split_rows(vectors, ["vec_id"], s, halves) for s in ("train", "test"))
    probe = md.fit_linear_probe(train, "embedding", "label")
    scored = probe.transform(md.with_vector(test, "embedding"))
    counts = mt.confusion_counts(
        scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction"
    )
    scores = mt.label_scores(mt.label_counts(counts))
    return scores.where("support > 0").select("label", F.col("support").alias("n"), (F.col("recall") > 0.9).alias("found"))


@query(
    "label_csvs_s5",
    f"""SELECT split, count(*) AS rows, CAST(sum(CAST(label AS INTEGER)) AS BIGINT) AS positives FROM (
        SELECT CAST(quality AS VARCHAR) AS label, CASE WHEN {split_sql('doc_id')} = 'train' THEN 'train'
               ELSE 'test' END AS split FROM labels) GROUP BY split""",
)
def label_csvs(spark, d):
    labels = table(spark, d, "labels").select(
        "doc_id", F.col("doc_id").cast("string").alias("path"), F.col("quality").cast("string").alias("label")
    )
    parts = sp.hash_split(labels, ["doc_id"], (("train", 0.7), ("test", 0.3))).drop("doc_id")
    files = tb.write_label_csvs(parts, workspace(spark, "labels"))
    merged = tb.read_labels(spark, files["train"]).withColumn("split", F.lit("train")).unionByName(
        tb.read_labels(spark, files["test"]).withColumn("split", F.lit("test"))
    )
    return merged.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("label").cast("int")).alias("positives")
    )


@query(
    "class_folders_s6",
    """SELECT DISTINCT 'lang=' || lang AS label,
       CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_idx FROM documents""",
)
def class_folders(spark, d):
    """Texts written one folder per class, then listed as class folders."""
    root = workspace(spark, "folders")
    table(spark, d, "documents").select("lang", "text").write.partitionBy("lang").text(f"{root}/deep/er")
    listed = im.read_class_folders(spark, f"{root}/deep")
    return listed.select("label", "label_idx").distinct()


@query(
    "label_mapping_s21",
    """SELECT CAST(label AS VARCHAR) AS label, row_number() OVER (ORDER BY label) - 1 AS line
       FROM (SELECT DISTINCT label FROM embeddings)""",
)
def label_mapping(spark, d):
    """One label per line, read back with the number of its line."""
    index = lk.sorted_class_index(table(spark, d, "embeddings"), "label")
    out = ct.write_label_mapping(index, workspace(spark, "mapping"))
    lines = spark.read.text(out, wholetext=True).select(F.split(F.rtrim("value", F.lit("\n")), "\n").alias("lines"))
    return lines.select(F.posexplode("lines").alias("line", "label")).select("label", F.col("line").cast("bigint").alias("line"))


@query(
    "epoch_metrics_a8",
    f"""WITH {TRACE_SQL} SELECT epoch, phase, CAST(sum(n) AS BIGINT) AS samples,
        round(sum(loss * n) / sum(n), 6) AS loss, round(sum(correct) / sum(n), 6) AS accuracy
        FROM trace GROUP BY 1, 2""",
)
def epoch_metrics(spark, d):
    return mt.epoch_metrics(batch_trace(spark, d)).select(
        "epoch", "phase", "samples", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy")
    )


@query(
    "windowed_loss_a9",
    f"""WITH {TRACE_SQL}, steps AS (SELECT epoch, loss, row_number() OVER (PARTITION BY epoch ORDER BY iter) - 1 AS step
        FROM trace WHERE phase = 'train')
        SELECT epoch, step // 25 AS run, round(avg(loss), 6) AS loss FROM steps GROUP BY 1, 2 HAVING count(*) = 25""",
)
def windowed_loss(spark, d):
    """Training loss per 25 steps; the steps of a phase are counted within an epoch."""
    within = W.partitionBy("epoch", "phase").orderBy("iter")  # an epoch has a fixed number of steps
    steps = batch_trace(spark, d).withColumn("iter", F.row_number().over(within) - 1)
    return mt.windowed_loss(steps, 25).withColumn("loss", F.round("loss", 6))


@query(
    "iterator_timing_a10",
    """SELECT event_type AS name, count(*) AS count, round(sum(value), 4) AS time_sum,
       arg_min(value, event_id) AS time_first FROM events GROUP BY 1""",
)
def iterator_timing(spark, d):
    steps = table(spark, d, "events").select(
        F.col("event_type").alias("name"), F.col("event_id").alias("seq"), F.col("value").alias("seconds")
    )
    return mt.iterator_timing(steps).withColumn("time_sum", F.round("time_sum", 4))


@query(
    "block_elapsed_a11",
    """SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS seconds FROM events GROUP BY 1""",
)
def block_elapsed(spark, d):
    return mt.block_elapsed(table(spark, d, "events"), "user_id")


@query(
    "io_delta_a12",
    """SELECT event_type, (arg_max(b, event_id) - arg_min(b, event_id)) / 1048576.0 AS bytes_mb FROM (
       SELECT event_type, event_id, event_id * 4096 + user_id AS b FROM events) GROUP BY 1""",
)
def io_delta(spark, d):
    counters = table(spark, d, "events").select(
        "event_type", "ts", "event_id", (F.col("event_id") * 4096 + F.col("user_id")).alias("bytes")
    )
    return mt.counter_delta_mb(counters, ["event_type"], "bytes", F.struct("ts", "event_id"))


@query(
    "epoch_throughput_a18",
    f"""WITH e AS (SELECT user_id, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS s
        FROM events GROUP BY 1)
    SELECT user_id, round(s / 60 / 5, 4) AS minutes_per_epoch, round(n / nullif(s, 0), 9) AS samples_per_second FROM e""",
)
def epoch_throughput(spark, d):
    events = table(spark, d, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    spans = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), ((F.max(us) - F.min(us)) / F.lit(1e6)).alias("s")
    )
    return spans.select(
        "user_id",
        F.round(mt.epoch_minutes(F.col("s"), 5), 4).alias("minutes_per_epoch"),
        F.round(mt.throughput(F.col("n"), F.col("s")), 9).alias("samples_per_second"),
    )


@query(
    "operation_table_w5",
    """SELECT event_type, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, count(*) AS calls
       FROM events GROUP BY 1""",
)
def operation_table(spark, d):
    costs = mt.operation_table(table(spark, d, "events"), "event_type", "value")
    return costs.select(
        "event_type", F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), "calls"
    )
