"""The registered queries of the training-data operators, each a thin view of its operator."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..plans.base import Runner
from . import (
    caps, contamination, langid, lattice, packing, periods, pii, radix, sharding, simhash, superkmer, variants, warc,
)
from .common import lowered, tuned

QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Runner) -> Runner:
        QUERIES[name] = lambda spark, sf_dir: run(tuned(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_simhash_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    "op7_exact_duplicates",
    r"""
    WITH clean AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body,
             length(coalesce(text, '')) AS chars
      FROM documents),
    ranked AS (
      SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
             count(*) OVER (PARTITION BY body) AS group_size
      FROM clean WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(radix.normalised(F.col("text")).cast("binary"), 256)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", digest.alias("text_sha256"))
    return radix.exact_duplicates(docs).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("keep_key").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("doc.text_sha256").alias("text_sha256"),
    )


@query(
    "op8_warc",
    r"""
    WITH p AS (
      SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
    d AS (
      SELECT page_id, octet_length(body) AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS best,
             array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda k:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 ((CAST('0x' || substr(hex, CAST(5 * i + 1 AS INT), 5) AS BIGINT) >> k) & 31) + 1, 1)), '')), '')
               AS payload_digest
      FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> best THEN best END AS refers_to
    FROM d""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SHARDS = 8

_CRC_TABLE = """crc_table AS (
      SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i)))"""


def _crc_sql(text: str) -> str:
    """crc32 of a text's UTF-8 in SQL, beside a table with the column t of crc_table."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(
              regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
            lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295)"""


def _rounds_sql() -> str:
    """The permutation in SQL: one nested query per round, over a, b, x and y."""
    body = "SELECT number, n, a, b, place // b AS x, place % b AS y FROM walk WHERE place >= n OR turn = 0"
    for r in range(sharding.ROUNDS):
        mine, other, base = ("x", "y", "a") if r % 2 == 0 else ("y", "x", "b")
        drawn = f"CAST('0x' || substr(md5(concat_ws(':', 0, {r}, {other})), 1, 15) AS BIGINT)"
        body = f"SELECT number, n, a, b, ({mine} + {drawn} % {base}) % {base} AS {mine}, {other} FROM ({body})"
    return body


@query(
    "op9_feistel_shards",
    rf"""
    WITH RECURSIVE {_CRC_TABLE},
    sized AS (
      SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        {_crc_sql("coalesce(text, '')")} AS text_crc32
      FROM documents, crc_table),
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS number, count(*) OVER () AS n
      FROM sized),
    based AS (
      SELECT number, n, a, greatest(1, (n + a - 1) // a) AS b
      FROM (SELECT number, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered)),
    walk AS (
      SELECT number, n, a, b, number AS place, 0 AS turn FROM based
      UNION ALL
      SELECT number, n, a, b, x * b + y, 1 FROM ({_rounds_sql()})),
    places AS (SELECT number, place FROM walk WHERE turn = 1 AND place < n)
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % {SHARDS} AS INTEGER) AS shard,
           place // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM numbered JOIN places USING (number)""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32")
    )
    return sharding.sharded(rows, ["doc_id", "size", "text_crc32"], SHARDS).select(
        "doc.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op10_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (
      SELECT doc_id, s, array_to_string(ws[s + 1:s + 20], ' ') AS words
      FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 19, 0))) AS s FROM w)),
    later AS (
      SELECT doc_id, s FROM windows
      QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, s) > 1),
    gone AS (SELECT DISTINCT doc_id, s + k AS place FROM later, (SELECT unnest(range(20)) AS k)),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS place FROM w),
    kept AS (
      SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS text
      FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.substring_dedup(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def tokenizer_definition(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's definition, read where the driver runs."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def placed_pieces(docs: DataFrame, definition: str, with_ids: bool = False) -> DataFrame:
    """Pieces with their places and the checksum of their ids, and if asked with the ids as
    little-endian unsigned 16-bit numbers."""
    cut = packing.pieces(docs, definition, width=2 if with_ids else 0).select(
        F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])
    )
    return packing.packed(cut).select("doc.*", "sequence_id", "offset")


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_pieces(table(spark, sf_dir, "documents"), tokenizer_definition())


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identified(docs, langid.text_model(docs), carry=["doc_id"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "language", F.round("probability", 6).alias("probability"), "accepted"
    )


@query("pages_language_id")
def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over raw pages: markup language, address suffix and host of the url."""
    seen = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace("html", "(?s)<script.*?</script>|<style.*?</style>|<[^>]*+>", " ").alias("text"),
        F.nullif(F.regexp_extract("html", '(?i)<html[^>]*?\\blang="?([a-z]+)', 1), F.lit("")).alias("declared"),
        F.nullif(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1), F.lit("")).alias("host"),
    )
    model = langid.text_model(seen, label="declared", key="page_id")
    return langid.identified(seen, model, declared="declared", host="host", carry=["page_id", "declared"]).select(
        F.col("doc.page_id").alias("page_id"), F.col("doc.declared").alias("declared"), "language", "accepted"
    )


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *counts,
        F.sha2(pii.spelled("base").cast("binary"), 256).alias("base_sha256"), pii.spelled("spans").alias("spans"),
    )


@query("op3_spherical_caps")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = caps.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select(
        F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("key") == F.col("component"), F.lit(False)).alias("kept"),
    )


def sentencepiece_model(name: str = "piece_bpe_32k.model") -> bytes:
    """A public SentencePiece model, read where the driver runs."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query("op4_sentencepiece_sampling")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = spark.sparkContext.broadcast(sentencepiece_model())
    body = F.coalesce(F.col("text"), F.lit(""))
    coded = table(spark, sf_dir, "documents").select(
        "doc_id", body.alias("text"), lattice.round_trip(body, F.xxhash64("doc_id"), model).alias("of")
    )
    ids, back = F.col("of.ids"), F.col("of.text")
    return coded.select(
        "doc_id", F.floor(F.octet_length(ids) / 4).cast("long").alias("n_ids"), F.crc32(ids).alias("ids_crc32"),
        F.sha2(back.cast("binary"), 256).alias("decoded_sha256"), (back == F.col("text")).alias("lossless"),
    )


@query(
    "op11_decontamination",
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, size, array_to_string(ws[s + 1:s + size], ' ') AS words
      FROM (SELECT item_id, ws, least(len(ws), 10) AS size, unnest(range(0, greatest(len(ws) - 9, 1))) AS s
            FROM b WHERE len(ws) > 0)),
    grams AS (
      SELECT doc_id, size, s, array_to_string(ws[s + 1:s + size], ' ') AS words
      FROM (SELECT doc_id, ws, size, unnest(range(0, greatest(len(ws) - size + 1, 0))) AS s
            FROM d, (SELECT DISTINCT size FROM windows))),
    met AS (SELECT doc_id, item_id, s, size FROM grams JOIN windows USING (size, words)),
    hits AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM met) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def spelled_words(docs: DataFrame) -> DataFrame:
    """(word, n): lower-cased letter runs; one in 31, by the checksum of document and run, has a
    letter left out. Without a doc_id none has."""
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z\u00C0-\u00FF]+"), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).select("doc_id", lowered(F.col("run")).alias("run"))
    mark = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run").cast("binary"))
    drawn = F.when(F.col("doc_id").isNotNull(), mark)
    at = (F.col("mark") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("mark") % 31 == 0, shorter).otherwise(F.col("run"))
    return (
        runs.withColumn("mark", drawn).select(word.alias("word")).where(F.char_length("word") >= variants.LEAST)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "op12_spelling_variants",
    rf"""
    WITH RECURSIVE {_CRC_TABLE},
    runs AS (
      SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
      FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
      GROUP BY ALL),
    marked AS (SELECT run, c, {_crc_sql("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM runs, crc_table),
    spelt AS (
      SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
      FROM marked),
    words AS (
      SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
    holes AS (
      SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
    met AS (
      SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT w.word, h.word, h.n FROM words w JOIN holes h ON h.rest = w.word
      UNION SELECT h.word, w.word, w.n FROM words w JOIN holes h ON h.rest = w.word),
    near AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n
      FROM met GROUP BY word),
    named AS (
      SELECT word, CASE WHEN best_n >= 10 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
      FROM words LEFT JOIN near USING (word)),
    chain AS (
      SELECT word, word AS root FROM named
      UNION ALL SELECT chain.word, named.form FROM chain JOIN named ON chain.root = named.word WHERE named.form IS NOT NULL),
    ends AS (SELECT chain.word, root FROM chain JOIN named ON root = named.word WHERE named.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM named JOIN ends USING (word)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(spelled_words(table(spark, sf_dir, "documents")))


@F.arrow_udf(StringType())
def with_periods(texts: pa.Array, keys: pa.Array) -> pa.Array:
    """The text of every tenth document, by the checksum of its key, repeats a stretch of its
    words to its end. Without a key none does."""
    out = []
    for text, key in zip(texts.cast(pa.binary()).to_pylist(), keys.to_pylist()):
        g, drawn = divmod(zlib.crc32(str(key).encode()), 10)
        if key is not None and drawn == 0 and (words := (text or b"").split()):
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            repeat = words[a:a + p] * (1 + (len(words) - a) // p)
            text = b" ".join((words[:a] + repeat)[:len(words)])
        out.append(text)
    return pa.array(out, pa.binary()).cast(pa.string())


@query(
    "op13_periodic_runs",
    rf"""
    WITH RECURSIVE {_CRC_TABLE},
    split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    marked AS (
      SELECT doc_id, ws, len(ws) AS n, {_crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM split, crc_table),
    chosen AS (
      SELECT doc_id, ws, n, a, 1 + (n - a) // (3 + g % 8) AS p
      FROM (SELECT *, h // 10 AS g, (h // 10) % n AS a FROM marked WHERE h % 10 = 0 AND n > 0)),
    texts AS (
      SELECT doc_id, n, ws FROM marked WHERE doc_id NOT IN (SELECT doc_id FROM chosen)
      UNION ALL SELECT doc_id, n, list_transform(range(0, n), lambda i:
        CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) FROM chosen),
    grams AS (
      SELECT doc_id, n, i, hash(ws[i + 1:i + 16]) AS h, ws[i + 1:i + 16] AS g
      FROM (SELECT doc_id, n, ws, unnest(range(0, greatest(n - 15, 0))) AS i FROM texts)),
    met AS (
      SELECT x.doc_id, x.i, y.i - x.i AS lag FROM grams x JOIN grams y
      ON x.doc_id = y.doc_id AND x.h = y.h AND x.i < y.i AND 3 * (y.i - x.i) <= x.n AND x.g = y.g),
    stretches AS (
      SELECT doc_id, lag, i, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS run FROM met),
    long AS (
      SELECT doc_id, min(i) AS start, count(*) + 15 + lag AS length, lag AS period
      FROM stretches GROUP BY doc_id, lag, run HAVING count(*) + 15 + lag >= greatest(24, 3 * lag)),
    runs AS (
      SELECT * FROM long x WHERE NOT EXISTS (
        SELECT 1 FROM long y WHERE y.doc_id = x.doc_id AND y.period < x.period AND y.start <= x.start
        AND y.start + y.length >= x.start + x.length)),
    listed AS (
      SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs
      FROM runs GROUP BY doc_id),
    best AS (
      SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM runs),
    kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
      FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, n)) AS place FROM texts) ANTI JOIN gone USING (doc_id, place)
      GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", periods.collapsed(with_periods("text", "doc_id")).alias("of"))
    found = found.select("doc_id", "of.runs", "of.kept")
    spelled = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", periods.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(spelled, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
