"""Passages of test items in documents, by a distributed positional inverted index.

Documents become postings (term, document, place), stored once, for every term that some
test item has. A window is `WINDOW` consecutive words of an item, or a shorter item as a
whole. The posting lists of its two rarest terms are intersected first, each adjusted by
the term's offset in the window, and only where they meet are the lists of the item's
other terms intersected as well. Places where all terms of a window stand at their
offsets are phrase matches; `proximity_matches` also takes places where the two rarest
terms stand up to `slop` words nearer or farther than in the window.

Equal items are matched once, and a pair of terms at one distance is looked up once for
all windows that have it. Lists meet by document, mark and place, so no list of a hot
term and no document is ever gathered; lists are only filtered by others (semi joins),
so repeated rows never multiply.

Defined cases: null has no words; an item without words occurs nowhere, an empty table of
items nowhere; items that share an id are one item, a null id is spelled as nothing;
rows that share key and text get equal answers, a null key is a key; columns beside the
key and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import lowered, split_words, stored

WINDOW = 10
SLOP = 3
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PLACE = ["doc", "mark", "place", "term"]


def words(text: Column) -> Column:
    """The words as they stand in a text; in lower case they are terms."""
    return split_words(text, _BETWEEN)


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Words (phrase, length, at, term) of the distinct items, and (phrase, item) members."""
    body = F.transform(words(F.col(f"`{text}`")), lowered)
    rows = items.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"), body.alias("ws"))
    rows = stored(
        rows.where(F.size("ws") > 0).select(F.md5(F.concat_ws(" ", "ws").cast("binary")).alias("phrase"), "item", "ws"),
        "item-words",
    )
    distinct = rows.groupBy("phrase").agg(F.first("ws").alias("ws"))
    terms = distinct.select("phrase", F.size("ws").alias("length"), F.posexplode("ws").alias("at", "term"))
    return stored(terms, "item-terms"), rows.select("phrase", "item").distinct()


def index(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored postings (term, doc, mark, place) of the given terms.

    `doc` and `mark` stand for the key and the text. At place -1 every row of `docs` has an
    entry without term, which holds its key and number of words.
    """
    read = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{key}`")).alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"), words(F.col(f"`{text}`")).alias("ws"),
    )
    spread = read.withColumn("n_words", F.size("ws").cast("long")).select(
        "key", "doc", "mark", "n_words", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), "ws")).alias("place", "word")
    )
    head = F.col("place") == 0
    spread = spread.select(
        F.when(head, F.col("key")).alias("key"), "doc", "mark", F.when(head, F.col("n_words")).alias("n_words"),
        (F.col("place") - 1).alias("place"), lowered(F.col("word")).alias("term"),
    )
    known = stored(terms.select("term").distinct(), "test-terms").withColumn("known", F.lit(True))
    return stored(spread.join(known, "term", "left").where("known or place = -1").drop("known"), "postings")


def rarest_pairs(postings: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """(phrase, start, at, first, second, apart): of each window the rarest term in the
    documents, its place in the item, and the second rarest with its distance. A window of
    one word has that word as both."""
    often = postings.where("place >= 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = terms.join(often, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    last = F.greatest(F.col("length") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("at") - window + 1, F.lit(0)), F.least("at", last))
    entry = F.struct("n", "at", "term")
    rare = (
        counted.select("phrase", "length", entry.alias("entry"), F.explode(starts).alias("start"))
        .groupBy("phrase", "start").agg(F.sort_array(F.collect_list("entry")).alias("by"))
    )
    one, two = F.col("by")[0], F.col("by")[F.least(F.size("by"), F.lit(2)) - 1]
    return stored(
        rare.select(
            "phrase", "start", one["at"].alias("at"), one["term"].alias("first"), two["term"].alias("second"),
            (two["at"] - one["at"]).alias("apart"),
        ),
        "rarest-pairs",
    )


def meetings(postings: DataFrame, pairs: DataFrame, slop: int = 0) -> DataFrame:
    """(first, second, apart, doc, mark, from, place): places of two terms at their distance,
    give or take `slop`."""
    wanted = stored(pairs.select("first", "second", "apart").distinct(), "term-pairs")
    lists = postings.where("place >= 0").select(*_PLACE)
    begin = lists.withColumnsRenamed({"term": "first", "place": "from"}).join(wanted, "first")
    off = F.explode(F.sequence(F.lit(-slop), F.lit(slop))) if slop else F.lit(0)
    begin = begin.withColumn("off", off).withColumn("place", F.col("from") + F.col("apart") + F.col("off"))
    others = lists.join(wanted.select(F.col("second").alias("term")).distinct(), "term", "left_semi")
    return begin.drop("off").withColumn("term", F.col("second")).join(others, _PLACE, "left_semi").drop("term")


def proximity_matches(postings: DataFrame, pairs: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc, mark, phrase, start, from, place): windows whose two rarest terms stand at `from`
    and `place`, at most `slop` words nearer or farther than in the window and not swapped."""
    same = (F.col("from") == F.col("place")) == (F.col("apart") == 0)
    ahead = (F.col("place") > F.col("from")) == (F.col("apart") > 0)
    near = meetings(postings, pairs, slop).where(same & ahead)
    return near.join(pairs, ["first", "second", "apart"]).select(
        "doc", "mark", "phrase", "start", "from", "place"
    ).distinct()


def phrase_matches(postings: DataFrame, terms: DataFrame, pairs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, mark, phrase, start, n): stretches of n words from word `start` of a document on
    that follow an item word for word, for at least a window."""
    anchors = pairs.select("phrase", "at", "first", "second", "apart").distinct()
    diagonals = stored(
        meetings(postings, anchors).join(anchors, ["first", "second", "apart"])
        .select("phrase", "doc", "mark", (F.col("from") - F.col("at")).alias("shift")).distinct(),
        "diagonals",
    )
    expected = diagonals.join(terms, "phrase").withColumn("place", F.col("shift") + F.col("at"))
    others = postings.where("place >= 0").select(*_PLACE).join(
        diagonals.select("doc", "mark").distinct(), ["doc", "mark"], "left_semi"
    )
    met = expected.join(others, _PLACE, "left_semi")
    diagonal = ["doc", "mark", "phrase", "shift"]
    order = F.row_number().over(W.partitionBy(*diagonal).orderBy("at"))
    runs = (
        met.withColumn("run", F.col("at") - order).groupBy(*diagonal, "run")
        .agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"), F.first("length").alias("length"))
    )
    return runs.where(F.col("n") >= F.least(F.lit(window), F.col("length"))).select(
        "doc", "mark", "phrase", "start", "n"
    )


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(key, n_words, n_hit, items) for every row: words inside matched windows, and the ids of
    the items with such windows, as a sorted array of strings."""
    terms, members = item_terms(items, item, item_text)
    postings = index(docs, terms, key, text)
    found = stored(phrase_matches(postings, terms, rarest_pairs(postings, terms, window), window), "phrases")
    one = W.partitionBy("doc", "mark").orderBy("start")
    stretch = found.groupBy("doc", "mark", "start").agg(F.max("n").alias("n"))
    seen = F.max(F.col("start") + F.col("n")).over(one.rowsBetween(W.unboundedPreceding, -1))
    end = F.col("start") + F.col("n")
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(seen, F.lit(0))))
    hit = stretch.select("doc", "mark", new.alias("new")).groupBy("doc", "mark").agg(F.sum("new").alias("n_hit"))
    named = (
        found.select("doc", "mark", "phrase").distinct().join(members, "phrase")
        .groupBy("doc", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    rows = postings.where("place = -1").select("key", "doc", "mark", "n_words")
    answers = stored(hit.join(named, ["doc", "mark"]), "contaminated")
    return rows.join(answers, ["doc", "mark"], "left").select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
