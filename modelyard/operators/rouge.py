"""Summary overlap scores and their corpus values."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lcs
from ..functions import text as tx
from ..functions.scalar import key_text, percent4


def _share(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def rouge_n(
    pairs: DataFrame,
    key: Sequence[str],
    candidate: str,
    reference: str,
    orders: Sequence[int] = (1, 2),
) -> DataFrame:
    """(key, order, precision, recall, f1) by clipped n-gram overlap.

    The texts of a key meet in one row, and grams are counted there, so texts are shuffled
    and sorted but never grams.
    """
    sides = pairs.select(*key, F.struct(_joined(candidate).alias("c"), _joined(reference).alias("r")).alias("_t"))
    texts = sides.groupBy(*key).agg(F.collect_list("_t").alias("_t"))
    counted = texts.select(*key, F.inline(overlaps(orders)("_t.c", "_t.r")))
    both, c, r = F.col("both"), F.col("c"), F.col("r")
    return counted.select(
        *key, "order",
        _share(both, c).alias("precision"),
        _share(both, r).alias("recall"),
        _share(2 * both, c + r).alias("f1"),
    )


def _joined(column: str) -> Column:
    """The words of a text parted by one space; empty for null."""
    return F.coalesce(F.array_join(tx.words(F.col(column)), " "), F.lit(""))


def overlaps(orders: Sequence[int]) -> Callable[..., Column]:
    """Function of two lists of texts: per order the grams on both sides (clipped), and on each."""
    orders = list(orders)
    counts = "array<struct<order: int, both: bigint, c: bigint, r: bigint>>"

    @F.pandas_udf(counts)
    def run(cand: pd.Series, ref: pd.Series) -> pd.Series:
        def grams(texts, n):
            words = [text.split() for text in texts]
            return Counter(w for t in words for w in (t if n == 1 else zip(*(t[i:] for i in range(n)))))

        out = []
        for cs, rs in zip(cand, ref):
            row = []
            for n in orders:
                c, r = grams(cs, n), grams(rs, n)
                row.append({"order": n, "both": sum((c & r).values()), "c": sum(c.values()), "r": sum(r.values())})
            out.append(row)
        return pd.Series(out)

    return run


def rouge_l(pairs: DataFrame, key: Sequence[str], candidate: str, reference: str) -> DataFrame:
    """(key, precision, recall, f1) by the longest common subsequence."""
    scored = pairs.select(*key, _rouge_l(candidate, reference).alias("s"))
    return scored.select(*key, "s.*")


SENTENCES = 16  # reference sentences aligned in one row


def rouge_lsum(
    pairs: DataFrame, key: Sequence[str], candidate: str, reference: str, sentences: int = SENTENCES
) -> DataFrame:
    """(key, precision, recall, f1) by the union of sentence-wise subsequences.

    A few reference sentences are one row, and rows are dealt out, so a long pair is aligned
    by many tasks. A token counts as often as it is matched, but no more often than the
    candidate holds it; the matched and the held tokens of a key meet in one row.
    """
    sides = pairs.select(*key, _sentences(candidate).alias("_cand"), _sentences(reference).alias("_ref"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_ref"), F.lit(1)), F.lit(sentences))
    some = F.transform(starts, lambda at: F.slice("_ref", at, sentences))
    dealt = sides.select(*key, "_cand", F.posexplode(some).alias("_at", "_part")).repartition(*key, "_at")
    # The first row of a pair brings the candidate's tokens; every row counts its own sentences.
    held = F.when(F.col("_at") == 0, F.array_join(F.flatten("_cand"), " ")).otherwise("")
    rows = dealt.select(
        *key, F.struct(F.array_join(lcs.matched_tokens("_cand", "_part"), " ").alias("m"), held.alias("c")).alias("_t"),
        F.size(F.flatten("_part")).alias("_r"),
    )
    per_key = rows.groupBy(*key).agg(F.collect_list("_t").alias("_t"), F.sum("_r").alias("_r"))
    counted = per_key.select(*key, "_r", F.inline(overlaps([1])("_t.m", "_t.c")))
    both, c, r = F.col("both"), F.col("r"), F.col("_r")
    return counted.select(
        *key, _share(both, c).alias("precision"), _share(both, r).alias("recall"), _share(2 * both, c + r).alias("f1")
    )


def _rouge_l(candidate: str, reference: str) -> Column:
    none = F.array().cast("array<string>")
    cand, ref = (F.coalesce(tx.words(F.col(c)), none) for c in (candidate, reference))
    return lcs.rouge_l(cand, ref)


def _sentences(column: str) -> Column:
    lines = F.split(tx.sentence_lines(F.coalesce(F.col(column), F.lit(""))), "\n")
    return F.transform(lines, tx.words)


def corpus_score(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F measure of the corpus times 100, with four decimals."""
    return scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pairs"), percent4(F.avg("f1")).alias("score")
    )


def corpus_report(pairs: DataFrame, key: Sequence[str], candidate: str, reference: str) -> DataFrame:
    """Long table (key, value) with rouge1, rouge2, rougeL and rougeLsum."""
    n_scores = rouge_n(pairs, key, candidate, reference).select(
        F.concat(F.lit("rouge"), F.col("order").cast("string")).alias("metric"), "f1"
    )
    whole = rouge_l(pairs, key, candidate, reference).select(F.lit("rougeL").alias("metric"), "f1")
    summed = rouge_lsum(pairs, key, candidate, reference).select(F.lit("rougeLsum").alias("metric"), "f1")
    long = n_scores.unionByName(whole).unionByName(summed)
    return corpus_score(long, ["metric"]).select(F.col("metric").alias("key"), F.col("score").alias("value"))


def poisson_cuts(bits: int = 32) -> list[float]:
    """Cumulative Poisson(1) probabilities P(X <= k), as far as `bits` hash bits tell them from 1."""
    total, cuts, k = 0.0, [], 0
    while 1 - total > 2.0 ** -bits:
        total += math.exp(-1.0) / math.factorial(k)
        cuts.append(round(total, 12))
        k += 1
    return cuts


#: Rows whose weights are drawn at once: so many times the replicates are numbers in memory.
_ROWS_AT_ONCE = 64


def _replicate_sums(replicates: int, seed: str, cuts: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function from (key, value) to (replicate, sum of weight * value, sum of weight) of a task."""
    at_once = _ROWS_AT_ONCE

    def run(batches):
        heads = [hashlib.md5(f"{seed}|{b}|".encode()) for b in range(replicates)]
        edges, top, bottom, some = np.array(cuts), np.zeros(replicates), np.zeros(replicates, dtype="int64"), False
        for batch in batches:
            keys = batch.column(0).to_pylist()
            values = batch.column(1).fill_null(0.0).to_numpy(zero_copy_only=False)
            some = some or bool(keys)
            for at in range(0, len(keys), at_once):
                digits = []
                for key in keys[at:at + at_once]:
                    tail = key.encode()
                    for head in heads:
                        digest = head.copy()
                        digest.update(tail)
                        digits.append(digest.digest()[:4])
                draws = np.frombuffer(b"".join(digits), dtype=">u4").reshape(-1, replicates) / 2.0**32
                weights = np.searchsorted(edges, draws, side="right")
                top += values[at:at + at_once] @ weights
                bottom += weights.sum(axis=0)
        if some:
            yield pa.RecordBatch.from_pydict({"replicate": pa.array(np.arange(replicates), pa.int32()), "top": top, "bottom": bottom})

    return run


def bootstrap_mid(
    scores: DataFrame,
    key: Sequence[str],
    value: str = "f1",
    replicates: int = 1000,
    seed: object = "boot",
) -> DataFrame:
    """Median of resampled means.

    Each row draws its Poisson(1) weight per replicate from a hash of seed, replicate and key.
    A task multiplies weights and scores as matrices and hands on one pair of sums per
    replicate, so rows are never spread out. A null score adds to the weights alone.
    """
    rows = scores.select(key_text(key).alias("key"), F.col(value).cast("double").alias("value"))
    sums = rows.mapInArrow(
        _replicate_sums(replicates, str(seed), poisson_cuts()), "replicate int, top double, bottom bigint"
    )
    means = sums.groupBy("replicate").agg(
        F.try_divide(F.sum("top"), F.sum("bottom").cast("double")).alias("mean")
    )
    return means.agg(
        F.count(F.lit(1)).alias("replicates"), F.percentile("mean", F.lit(0.5)).alias("mid")
    )
