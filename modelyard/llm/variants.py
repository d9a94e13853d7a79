"""Spelling variants of words, found by asymmetric q-chunks.

Two words are near if one edit (a code point inserted, deleted or replaced) turns one
into the other. Of such a pair the word that is not longer contributes two disjoint
chunks, its halves. The edit leaves one of them whole, and the other word holds it at
the same place or, behind an inserted code point, at the next: the first half never
moves without the second half being whole as well, so the other word contributes the
grams of the chunk's length at shift 0 for first halves, and at shift 0 (equal lengths)
or 1 (one longer) for second halves. The half with the edit is chunked once more in the
same way, so that a key spells about three quarters of a word and lists stay short
whatever the size of the vocabulary. Words that meet under a key are verified by their
edit distance inside the join, so no list is gathered and no unverified pair is a row.

A word's form is its near word with the largest count, if that is `ratio` times its own
at least; forms are followed to their roots by pointer doubling, in as many rounds as
the logarithm of the longest chain, which is itself below the digits of a count.

Every join is a sort-merge join at every size: keys are exploded from a compressed table of
words, and what the planner takes for their size is far below what a broadcast would hold.

Defined cases: words that are null or have under `LEAST` code points take no part; a word
given twice counts with the sum of its counts, a null count as 0; ties between near words
go to the smallest in code-point order; an empty table gives an empty one; columns beside
`word` and `n` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

LEAST = 7
COUNT = 2
RATIO = 10
_KEY = ["size", "half", "quarter", "chunk", "sub"]


def _cut(word: Column, start: Column, length: Column) -> Column:
    return F.substring(word, start + F.lit(1), length)


def _keys(word: Column, size: Column, longer: int) -> list[Column]:
    """Keys (size, half, quarter, chunk, sub) of a word in the part of one whose partner has
    `size` code points; the word itself has `longer` more."""
    h = F.floor(size / 2).cast("int")
    rest_of = {0: (h, size - h), 1: (F.lit(0), h)}  # where the half with the edit begins, and its length there
    keys = []
    for half in (0, 1):
        chunk = _cut(word, F.lit(0), h) if half == 0 else _cut(word, h + longer, size - h)
        start, length = rest_of[half]
        q = F.floor(length / 2).cast("int")
        for quarter in (0, 1):
            sub = _cut(word, start, q) if quarter == 0 else _cut(word, start + q + longer, length - q)
            keys.append(F.struct(
                size.alias("size"), F.lit(half).alias("half"), F.lit(quarter).alias("quarter"),
                chunk.alias("chunk"), sub.alias("sub"),
            ))
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of near words once, of rows (word, n) with distinct words."""
    size = F.char_length("word")
    chunks = words.select("word", "n", F.explode(F.array(*_keys(F.col("word"), size, 0))).alias("key"))
    grams = words.select(
        "word", "n",
        F.explode(F.array(*_keys(F.col("word"), size, 0), *_keys(F.col("word"), size - 1, 1))).alias("key"),
    )
    left = chunks.select(F.col("word").alias("a"), F.col("n").alias("na"), "key.*")
    right = grams.select(F.col("word").alias("b"), F.col("n").alias("nb"), "key.*")
    a, b = F.col("a"), F.col("b")
    long_b = F.char_length(b)
    h = F.floor(F.col("l.size") / 2).cast("int")
    start = F.when(F.col("l.half") == 0, h).otherwise(0)
    q = F.floor(F.when(F.col("l.half") == 0, F.col("l.size") - h).otherwise(h) / 2).cast("int")
    # a pair met under a second part was not met under the first
    once = ((F.col("l.half") == 0) | (_cut(a, F.lit(0), h) != _cut(b, F.lit(0), h))) & (
        (F.col("l.quarter") == 0) | (_cut(a, start, q) != _cut(b, start, q))
    )
    ordered = (long_b > F.col("l.size")) | (a < b)
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in _KEY]
    met = left.alias("l").join(right.hint("merge").alias("r"), [*same, ordered, once, F.levenshtein(a, b, 1) == 1])
    return met.select("a", "na", "b", "nb")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows, whose forms never come back to a word."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = stored(now.join(onward.hint("merge"), "root", "left").select("word", "root", "onward"), "roots")
        now = step.select("word", F.coalesce("onward", "root").alias("root"))
        if step.where("onward is not null").limit(1).count() == 0:
            return now


def spelling_variants(words: DataFrame, least: int = LEAST, count: int = COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows, which may repeat a word."""
    known = stored(
        words.where(F.char_length("word") >= least).groupBy("word")
        .agg(F.sum(F.coalesce(F.col("n").cast("long"), F.lit(0))).alias("n")).where(F.col("n") >= count),
        "words",
    )
    pairs = stored(near_pairs(known), "near-pairs")
    both = pairs.union(pairs.select("b", "nb", "a", "na"))
    best = F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = -F.col("best.less")
    formed = F.coalesce(found >= F.col("n") * ratio, F.lit(False))
    named = stored(
        known.join(near.hint("merge"), "word", "left").select(
            "word", F.when(formed, F.col("best.word")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, found).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.where("form is not null").select("word", "form"))
    return named.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
