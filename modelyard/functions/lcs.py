"""Longest-common-subsequence scores for one text pair, shipped in Arrow batches.

Spark has no expression for the quadratic alignment of two whole texts, so these
small helpers run per row inside pandas UDFs; rows are spread by Spark.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Executors get these helpers with the plan, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("precision", "recall", "f1")])


def _places(cand: list[str]) -> dict[str, int]:
    """For each token the candidate positions that hold it, as bits."""
    where: dict[str, int] = {}
    for j, token in enumerate(cand):
        where[token] = where.get(token, 0) | (1 << j)
    return where


def _growth(ref: list[str], cand: list[str]) -> Iterator[int]:
    """One bit row per reference token; a cleared bit j marks where the LCS
    length rises between the first j and the first j+1 candidate tokens."""
    where = _places(cand)
    full = (1 << len(cand)) - 1
    row = full
    for token in ref:
        match = row & where.get(token, 0)
        row = ((row + match) | (row - match)) & full
        yield row


def lcs_length(ref: list[str], cand: list[str]) -> int:
    row = (1 << len(cand)) - 1
    for row in _growth(ref, cand):  # only the last row counts
        pass
    return len(cand) - row.bit_count()


def lcs_positions(ref: list[str], cand: list[str]) -> set[int]:
    """Reference positions of one LCS, found by walking back from both ends."""
    if not ref or not cand:
        return set()
    rows = list(_growth(ref, cand))

    def length(i: int, j: int) -> int:
        return 0 if i == 0 else j - (rows[i - 1] & ((1 << j) - 1)).bit_count()

    found, i, j = set(), len(ref), len(cand)
    while i and j:
        if ref[i - 1] == cand[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return found


def _scores(hits: int, n_cand: int, n_ref: int) -> tuple[float, float, float]:
    if not n_cand or not n_ref:
        return 0.0, 0.0, 0.0
    p, r = hits / n_cand, hits / n_ref
    return p, r, 2 * p * r / (p + r) if hits else 0.0


def _as_frame(rows: list[tuple[float, float, float]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["precision", "recall", "f1"])


@F.pandas_udf(SCORE)
def rouge_l(cand: pd.Series, ref: pd.Series) -> pd.DataFrame:
    """Sequence-level score of two token arrays."""
    return _as_frame(
        [_scores(lcs_length(list(r), list(c)), len(c), len(r)) for c, r in zip(cand, ref)]
    )


def union_tokens(cand: list[list[str]], ref: list[list[str]]) -> list[str]:
    """Tokens of the reference sentences that the alignment with any candidate sentence matches."""
    out = []
    for sentence in ref:
        union = set().union(*(lcs_positions(sentence, c) for c in cand))
        out += [sentence[i] for i in sorted(union)]
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def matched_tokens(cand: pd.Series, ref: pd.Series) -> pd.Series:
    """Matched tokens of some reference sentences against all candidate sentences."""
    return pd.Series([union_tokens([list(s) for s in c], [list(s) for s in r]) for c, r in zip(cand, ref)])
