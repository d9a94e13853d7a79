"""Summarization side: tokens, vocabulary, ids, overlap scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..functions import text as tx
from ..operators import encoding as en
from ..operators import metrics as mt
from ..operators import rouge as rg
from ..operators import split as sp
from ..operators.userdefined import apply_batches
from ..session import stored, workspace
from ..sources import tables as tb
from .base import PAIR_KEY, PAIRS_SQL, dialogue_pairs, draw_sql, query, split_sql, table

_WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')"


@query(
    "named_splits_s8",
    f"""SELECT split, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS characters FROM (
        SELECT text, {split_sql('doc_id')} AS split FROM documents) GROUP BY split""",
)
def named_splits(spark, d):
    """A corpus kept as one JSON dataset per split, read back as one table."""
    parts = sp.hash_split(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"])
    out = workspace(spark, "corpus")
    parts.write.partitionBy("split").json(out)
    paths = {s: f"{out}/split={s}" for s in ("train", "val", "test")}
    corpus = tb.read_named_splits(spark, paths, "doc_id bigint, text string")
    return corpus.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("characters")
    )


@query("text_prefix_f1", "SELECT doc_id, 'summarize: ' || text AS text FROM documents")
def text_prefix(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.with_prefix(F.col("text")).alias("text"))


@query(
    "sentence_lines_f2",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g'),
        '([.!?])[ \t\n\r\f]+', '\1' || chr(10), 'g') AS lines FROM documents""",
)
def sentence_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.sentence_lines(F.col("text")).alias("lines"))


@query(
    "word_tokens_t1",
    f"""SELECT doc_id, len({_WORDS.format('text')}) AS words,
        array_to_string({_WORDS.format('text')}, ' ') AS tokens FROM documents""",
)
def word_tokens(spark, d):
    tokens = tx.words(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id", F.size(tokens).cast("bigint").alias("words"), F.array_join(tokens, " ").alias("tokens")
    )


_VOCABULARY_SQL = """vocabulary AS (SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS INTEGER) AS id
    FROM (SELECT token, count(*) AS n FROM (SELECT unnest({words}) AS token FROM {source}) GROUP BY token))"""

_TRAIN_DOCS_SQL = f"train AS (SELECT * FROM documents WHERE {split_sql('doc_id')} = 'train')"


def _train_documents(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return sp.split_rows(documents, ["doc_id"], "train")


@query(
    "vocabulary_t2",
    f"""WITH {_TRAIN_DOCS_SQL}, {_VOCABULARY_SQL.format(words=_WORDS.format('text'), source='train')}
        SELECT token, n, id FROM vocabulary""",
)
def vocabulary(spark, d):
    """Every token of the training documents, numbered by frequency."""
    return en.build_vocabulary(_train_documents(spark, d), "text", max_size=None)


_TOP_SQL = f"""{_TRAIN_DOCS_SQL}, {_VOCABULARY_SQL.format(words=_WORDS.format('text'), source='train')},
  top AS (SELECT token, id FROM vocabulary)"""


def _words(spark, d):
    """The whole vocabulary of the training documents."""
    return en.build_vocabulary(_train_documents(spark, d), "text")


def _coded_sql(texts: str, limit: int) -> str:
    """Ids of texts(key, side, words) cut to the limit, with the end marker."""
    return f"""(SELECT key, side, list_append(coalesce(list(coalesce(id, 2) ORDER BY pos) FILTER (pos IS NOT NULL), []), 1) AS ids
      FROM (SELECT key, side, pos, id FROM (
        SELECT key, side, unnest(CASE WHEN len(words) = 0 THEN [NULL] ELSE range(1, len(words) + 1) END) AS pos, words
        FROM (SELECT key, side, words[1:{limit - 1}] AS words FROM {texts})) t
        LEFT JOIN top ON top.token = t.words[t.pos]) GROUP BY key, side)"""


@query(
    "encode_documents_t3",
    f"""WITH {_TOP_SQL}, texts AS (SELECT doc_id AS key, 'x' AS side, {_WORDS.format("'summarize: ' || text")} AS words FROM documents)
    SELECT key AS doc_id, array_to_string(ids, ' ') AS ids FROM {_coded_sql('texts', tx.MAX_INPUT)}""",
)
def encode_documents(spark, d):
    """Whole texts to id sequences of at most 512 with an end marker."""
    texts = table(spark, d, "documents").select("doc_id", tx.with_prefix(F.col("text")).alias("text"))
    coded = en.token_ids(
        texts, ["doc_id"], {"ids": ("text", tx.MAX_INPUT)}, _words(spark, d)
    )
    return coded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def _encoded_pairs(spark, d):
    return en.encode_pairs(
        dialogue_pairs(spark, d, "left"), list(PAIR_KEY), "candidate", "reference",
        _words(spark, d), prefix=tx.SUMMARY_PREFIX,
    )


_CODED_PAIRS_SQL = f"""{_TOP_SQL}, {PAIRS_SQL},
  texts AS (SELECT conv_id || '|' || turn AS key, 'in' AS side, {_WORDS.format("'summarize: ' || candidate")} AS words FROM pairs),
  targets AS (SELECT conv_id || '|' || turn AS key, 'out' AS side, {_WORDS.format('reference')} AS words FROM pairs),
  coded AS (SELECT i.key, i.ids AS input, o.ids AS target FROM {_coded_sql('texts', tx.MAX_INPUT)} i
    JOIN {_coded_sql('targets', tx.MAX_TARGET)} o USING (key))"""


@query(
    "encode_pairs_t3",
    f"""WITH {_CODED_PAIRS_SQL} SELECT key,
      array_to_string(list_concat(input, [0 FOR x IN range({tx.MAX_INPUT} - len(input))]), ' ') AS input_ids,
      CAST(len(input) AS BIGINT) AS attended, CAST({tx.MAX_INPUT} AS BIGINT) AS mask_size,
      array_to_string(list_concat(target, [-100 FOR x IN range({tx.MAX_TARGET} - len(target))]), ' ') AS labels
    FROM coded""",
)
def encode_pairs(spark, d):
    """Prefix, ids, truncation, padding, attention mask and masked labels."""
    mask = F.col("attention_mask")
    return _encoded_pairs(spark, d).select(
        sc.key_text(PAIR_KEY).alias("key"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate(mask, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("attended"),
        F.size(mask).cast("bigint").alias("mask_size"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
    )


@query(
    "truncate_pad_mask_f3_f4_f5_f6",
    f"""WITH t AS (SELECT user_id, list(CAST(event_id % 50 AS INTEGER) ORDER BY event_id) AS ids FROM events GROUP BY 1),
    c AS (SELECT user_id, ids[1:{tx.MAX_TARGET}] AS cut FROM t),
    p AS (SELECT *, list_concat(cut, [0 FOR x IN range({tx.MAX_TARGET} - len(cut))]) AS padded FROM c)
    SELECT user_id, array_to_string(padded, ' ') AS padded,
      array_to_string([CASE WHEN x <= len(cut) THEN 1 ELSE 0 END FOR x IN range(1, {tx.MAX_TARGET + 1})], ' ') AS mask,
      array_to_string([CASE WHEN x = 0 THEN -100 ELSE x END FOR x IN padded], ' ') AS masked,
      array_to_string(padded, ' ') AS unmasked FROM p""",
)
def truncate_pad_mask(spark, d):
    """Id sequences cut, padded, masked and unmasked again."""
    events = table(spark, d, "events").select("user_id", "event_id")
    first = sp.head_per_group(events, ["user_id"], ["event_id"], tx.MAX_TARGET)
    at = F.struct("event_id", F.pmod("event_id", F.lit(50)).cast("int").alias("x"))
    lists = first.groupBy("user_id").agg(F.array_sort(F.collect_list(at)).alias("s"))
    cut = tx.truncate(F.transform("s", lambda s: s["x"]), tx.MAX_TARGET)
    rows = lists.select("user_id", cut.alias("cut")).withColumn("padded", tx.pad(F.col("cut"), tx.MAX_TARGET))
    rows = rows.withColumns(
        {"mask": tx.attention_mask(F.col("cut"), tx.MAX_TARGET), "masked": tx.mask_padding(F.col("padded"))}
    ).withColumn("unmasked", tx.unmask_padding(F.col("masked")))
    return rows.select(
        "user_id",
        *[
            F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
            for c in ("padded", "mask", "masked", "unmasked")
        ],
    )


@query(
    "decode_ids_f7",
    f"""WITH {_TOP_SQL}, texts AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
    spread AS (SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM texts),
    kept AS (SELECT doc_id, string_agg(s.token, ' ' ORDER BY pos) AS text FROM spread s JOIN top ON top.token = s.token GROUP BY 1)
    SELECT t.doc_id, coalesce(k.text, '') AS text FROM texts t LEFT JOIN kept k USING (doc_id)""",
)
def decode_ids(spark, d):
    """Whole documents to padded, masked ids and back; special ids vanish."""
    words = _words(spark, d)
    coded = en.token_ids(
        table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], {"ids": ("text", None)}, words
    )
    padded = coded.select("doc_id", tx.mask_padding(tx.pad(F.col("ids"), tx.MAX_INPUT)).alias("ids"))
    return en.decode_ids(stored(padded, "padded"), ["doc_id"], "ids", words)


@query(
    "token_lookup_j5",
    f"""WITH {_TOP_SQL}, spread AS (SELECT unnest({_WORDS.format('text')}) AS token FROM documents)
    SELECT coalesce(id, 2) AS id, count(*) AS n FROM spread LEFT JOIN top USING (token) GROUP BY 1""",
)
def token_lookup(spark, d):
    """Every token of every document against the whole training vocabulary."""
    tokens = table(spark, d, "documents").select(F.explode(tx.words(F.col("text"))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    coded = en.lookup(counts, _words(spark, d).select("token", "id"), ["token"])
    return coded.groupBy(F.coalesce("id", F.lit(tx.UNK)).alias("id")).agg(F.sum("n").alias("n"))


@query(
    "generated_length_a13",
    f"""WITH {PAIRS_SQL} SELECT count(*) AS pairs,
        round(avg(len({_WORDS.format('candidate')}) + 1), 4) AS gen_len FROM pairs""",
)
def generated_length(spark, d):
    """Ids of the predictions that are not padding; the candidates are the predictions."""
    predicted = en.token_ids(
        dialogue_pairs(spark, d), list(PAIR_KEY), {"ids": ("candidate", None)}, _words(spark, d)
    )
    return predicted.agg(F.count(F.lit(1)).alias("pairs"), mt.mean_generated_length(F.col("ids")).alias("gen_len"))


_GRAMS_SQL = f"""tok AS (SELECT conv_id, turn, {_WORDS.format('candidate')} AS c, {_WORDS.format('reference')} AS r FROM pairs),
  g AS (SELECT conv_id, turn, o AS "order",
      [array_to_string(c[i:i + o - 1], ' ') FOR i IN range(1, len(c) - o + 2)] AS c,
      [array_to_string(r[i:i + o - 1], ' ') FOR i IN range(1, len(r) - o + 2)] AS r
    FROM tok, (SELECT unnest([1, 2]) AS o)),
  cg AS (SELECT conv_id, turn, "order", gram, count(*) AS n FROM (SELECT conv_id, turn, "order", unnest(c) AS gram FROM g) GROUP BY ALL),
  rgm AS (SELECT conv_id, turn, "order", gram, count(*) AS n FROM (SELECT conv_id, turn, "order", unnest(r) AS gram FROM g) GROUP BY ALL),
  both_sides AS (SELECT conv_id, turn, "order", sum(least(cg.n, rgm.n)) AS m
    FROM cg JOIN rgm USING (conv_id, turn, "order", gram) GROUP BY ALL),
  rouge AS (SELECT g.conv_id, g.turn, g."order", coalesce(m / nullif(len(c), 0), 0) AS p,
      coalesce(m / nullif(len(r), 0), 0) AS rc, coalesce(2 * m / nullif(len(c) + len(r), 0), 0) AS f1
    FROM g LEFT JOIN both_sides USING (conv_id, turn, "order"))"""


def _rouge_n(spark, d):
    return rg.rouge_n(dialogue_pairs(spark, d), list(PAIR_KEY), "candidate", "reference")


@query(
    "rouge_n_t4",
    f"""WITH {PAIRS_SQL}, {_GRAMS_SQL} SELECT conv_id, turn, "order", round(p, 6) AS "precision",
        round(rc, 6) AS recall, round(f1, 6) AS f1 FROM rouge""",
)
def rouge_n(spark, d):
    return _rouge_n(spark, d).select(
        *PAIR_KEY, "order", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    )


@query(
    "rouge_corpus_a14",
    f"""WITH {PAIRS_SQL}, {_GRAMS_SQL} SELECT "order", count(*) AS pairs, round(avg(f1) * 100, 4) AS score
        FROM rouge GROUP BY 1""",
)
def rouge_corpus(spark, d):
    return rg.corpus_score(_rouge_n(spark, d), ["order"])


@query(
    "rouge_benchmark_t4",
    f"""WITH pairs AS (SELECT d.doc_id AS conv_id, b.item_id AS turn, d.text AS candidate, b.text AS reference
        FROM benchmark b JOIN documents d ON d.doc_id = b.item_id), {_GRAMS_SQL}
        SELECT conv_id AS doc_id, "order", round(p, 6) AS "precision", round(rc, 6) AS recall,
        round(f1, 6) AS f1 FROM rouge""",
)
def rouge_benchmark(spark, d):
    """Documents of any length against the benchmark text with the same number."""
    targets = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("reference"))
    documents = table(spark, d, "documents").select("doc_id", F.col("text").alias("candidate"))
    scores = rg.rouge_n(documents.join(targets, "doc_id"), ["doc_id"], "candidate", "reference")
    return scores.select(
        "doc_id", "order", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    )


@query(
    "rouge_l_t5",
    f"""WITH RECURSIVE {PAIRS_SQL},
    tok AS (SELECT conv_id, turn, {_WORDS.format('candidate')} AS c, {_WORDS.format('reference')} AS r FROM pairs),
    dp AS (
      SELECT conv_id, turn, CAST(0 AS BIGINT) AS i, unnest(range(0, len(r) + 1)) AS j, CAST(0 AS BIGINT) AS l FROM tok
      UNION ALL
      SELECT conv_id, turn, i + 1, j, max(step) OVER (PARTITION BY conv_id, turn ORDER BY j) FROM (
        SELECT dp.conv_id, dp.turn, i, j, greatest(l, CASE WHEN j > 0 AND r[j] = c[i + 1]
            THEN lag(l) OVER (PARTITION BY dp.conv_id, dp.turn ORDER BY j) + 1 ELSE 0 END) AS step
        FROM dp JOIN tok ON tok.conv_id = dp.conv_id AND tok.turn = dp.turn WHERE i < len(c))),
    hits AS (SELECT conv_id, turn, max(l) AS h FROM dp GROUP BY 1, 2)
    SELECT conv_id, turn, round(coalesce(h / nullif(len(c), 0), 0), 6) AS "precision",
           round(coalesce(h / nullif(len(r), 0), 0), 6) AS recall,
           round(CASE WHEN len(c) * len(r) = 0 THEN 0 ELSE 2 * h / (len(c) + len(r)) END, 6) AS f1
    FROM tok JOIN hits USING (conv_id, turn)""",
)
def rouge_l(spark, d):
    scores = rg.rouge_l(dialogue_pairs(spark, d), list(PAIR_KEY), "candidate", "reference")
    return scores.select(*PAIR_KEY, *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("rouge_lsum_t6")
def rouge_lsum(spark, d):
    return rg.rouge_lsum(dialogue_pairs(spark, d), list(PAIR_KEY), "candidate", "reference")


@query("rouge_report_a14")
def rouge_report(spark, d):
    """rouge1, rouge2, rougeL and rougeLsum of the corpus."""
    return rg.corpus_report(dialogue_pairs(spark, d), list(PAIR_KEY), "candidate", "reference")


REPLICATES = 1000

_WEIGHT_SQL = " + ".join(f"CAST(u >= CAST({cut} AS DOUBLE) AS INTEGER)" for cut in rg.poisson_cuts())


@query(
    "bootstrap_mid_a15",
    f"""WITH {PAIRS_SQL}, {_GRAMS_SQL}, one AS (SELECT conv_id || '|' || turn AS key, f1 FROM rouge WHERE "order" = 1),
    drawn AS (SELECT b, f1, {draw_sql("'boot|' || b || '|' || key")} AS u FROM one, range({REPLICATES}) r(b)),
    weighted AS (SELECT b, f1, {_WEIGHT_SQL} AS w FROM drawn),
    means AS (SELECT b, sum(w * f1) / sum(w) AS mean FROM weighted GROUP BY b)
    SELECT count(*) AS replicates, round(quantile_cont(mean, 0.5), 6) AS mid FROM means""",
)
def bootstrap_mid(spark, d):
    ones = _rouge_n(spark, d).where(F.col("order") == 1)
    mid = rg.bootstrap_mid(ones, list(PAIR_KEY), "f1", REPLICATES)
    return mid.select("replicates", F.round("mid", 6).alias("mid"))


@query(
    "encoded_dataset_s9",
    f"""WITH {PAIRS_SQL} SELECT split, count(*) AS pairs FROM (SELECT {split_sql('conv_id')} AS split FROM pairs)
        GROUP BY split""",
)
def encoded_dataset(spark, d):
    """Encoded pairs persisted per split and loaded again."""
    parts = sp.hash_split(_encoded_pairs(spark, d), ["conv_id"])
    out = tb.write_splits(parts, workspace(spark, "encoded"))
    full = (F.size("input_ids") == tx.MAX_INPUT) & (F.size("labels") == tx.MAX_TARGET)
    return spark.read.parquet(out).where(full).groupBy("split").agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "batched_map_udf",
    "SELECT doc_id, length(text) AS characters FROM documents",
)
def batched_map(spark, d):
    """User code over Arrow batches of whole texts."""

    def measure(frame):
        return frame.assign(characters=frame["text"].str.len())[["doc_id", "characters"]]

    rows = table(spark, d, "documents").select("doc_id", "text")
    return apply_batches(rows, measure, "doc_id bigint, characters bigint")
