"""Periodic runs of words by an online diagonal program, sparse in two ways.

Words equal to the word d places before lie on the diagonal of lag d. The program goes
over a text once. At each word the match lengths of the active lags grow, a lag whose
word differs ends and gives its run at once, and earlier occurrences of the word open new
lags. A run of period q has at least max(24 - q, 2q) >= `GRAM` matches in a row, so an
earlier occurrence opens a lag only if the `GRAM` words from it on and from the word on are
the same, the words before them differ (else the lag is open or was refused already), and
the words at the end of the least length agree as well: chance repeats open nothing, and
a text without a repeat of `GRAM` words is never walked.

An open lag q that already reaches back to the earlier occurrence shuts out its multiples:
what repeats after a multiple of q there also repeats after q, so q is the smallest
period. A text of one repeated line thus has one active lag, however long it is.

Defined cases: null is an empty text, which has no words and no runs; each row is read by
itself, so repeated rows, ties, null keys and other columns change nothing; runs are
sorted by start, then period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
GRAM = 16  # the fewest matches in a row on the diagonal of a run
_FACTOR = 0x9E3779B97F4A7C15


def _grams(ids: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` words from each word on, by doubling."""
    out, width = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR), 1
    while width < GRAM:
        out ^= out >> np.uint64(29)
        out = out[:-width] * np.uint64(0xBF58476D1CE4E5B9 + 2 * width) + out[width:] * np.uint64(_FACTOR)
        width *= 2
    return out


def _openings(ids: np.ndarray) -> dict[int, list[int]]:
    """Lags that earlier occurrences open at a word, ascending, by the word's number."""
    grams, n = _grams(ids), len(ids)
    order = np.argsort(grams, kind="stable")
    turn = np.flatnonzero(np.diff(grams[order])) + 1
    if len(turn) + 1 == len(grams):
        return {}
    heads = np.append(0, turn)
    before = np.append(-1, ids[:-1])[order]
    mixed = np.minimum.reduceat(before, heads) != np.maximum.reduceat(before, heads)
    found = [np.empty((2, 0), np.int64)]
    ends = np.append(turn, len(order))

    def keep(at: np.ndarray, lag: np.ndarray) -> None:
        fits = lag * (TIMES - 1) <= n - at
        at, lag = at[fits], lag[fits]
        last = at + np.maximum(lag * (TIMES - 1), GRAM) - GRAM  # where the least length has its last gram
        same = grams[last] == grams[last - lag]
        found.append(np.stack([at[same], lag[same]]))

    for a, b in zip(heads[mixed].tolist(), ends[mixed].tolist()):
        places, left = order[a:b], before[a:b]
        kinds, counts = np.unique(left, return_counts=True)
        many = left == kinds[counts.argmax()]
        for place, word in zip(places[~many].tolist(), left[~many].tolist()):
            earlier = places[(left != word) & (places < place)]
            keep(np.full(len(earlier), place), place - earlier)
            later = places[many & (places > place)]
            keep(later, later - place)
    at, lag = np.concatenate(found, axis=1)
    by = np.lexsort([lag, at])
    opens: dict[int, list[int]] = {}
    for i, d in zip(at[by].tolist(), lag[by].tolist()):
        opens.setdefault(i, []).append(d)
    return opens


def _smallest(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has no smaller period, which would divide it."""
    one = ids[start:start + period]
    rest, p = period, 2
    while rest > 1:
        if rest % p == 0:
            q = period // p
            if np.array_equal(one, ids[start + q:start + q + period]):
                return False
            while rest % p == 0:
                rest //= p
        p = p + 1 if p * p <= rest else max(rest, p + 1)
    return True


def periodic_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbered words."""
    n = len(ids)
    if n < LEAST:
        return []
    opens = _openings(ids)
    if not opens:
        return []
    found: list[tuple[int, int, int]] = []
    word = ids.tolist()
    waiting = sorted(opens, reverse=True)
    active: dict[int, int] = {}  # where the stretch of a lag starts

    def ended(lag: int, end: int) -> None:
        start = active.pop(lag)
        if end - start >= max(LEAST, TIMES * lag) and _smallest(ids, start, lag):
            found.append((start, end - start, lag))

    i = 0
    while active or waiting:
        if not active:
            i = waiting[-1]
        for lag in [d for d in active if word[i] != word[i - d]]:
            ended(lag, i)
        if waiting and waiting[-1] == i:
            for lag in opens[waiting.pop()]:
                if not any(lag % d == 0 and s <= i - lag for d, s in active.items()):
                    active[lag] = i - lag
        i += 1
        if i == n:
            for lag in list(active):
                ended(lag, n)
            break
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapsed(text: Column | str) -> Column:
    """Struct (n_words, runs, kept): the runs of a whole text, and its words, joined by one
    space, without those that a run holds after its first period."""

    @F.arrow_udf("n_words long, runs array<struct<start: long, length: long, period: long>>, kept string")
    def of(texts: pa.Array) -> pa.Array:
        counts, runs, kept = [], [], []
        for value in texts.cast(pa.binary()):
            words = (value.as_py() or b"").split()
            counts.append(len(words))
            found = periodic_runs(_numbered(words))
            if found:
                stay = np.ones(len(words), bool)
                for start, length, period in found:
                    stay[start + period:start + length] = False
                words = [words[k] for k in np.flatnonzero(stay).tolist()]
            runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
            kept.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["n_words", "runs", "kept"],
        )

    return of(text)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, then the smallest start and period."""

    def weight(x: Column, y: Column) -> Column:
        return x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)")

    return F.aggregate(
        runs, F.get(runs, F.lit(0)), lambda best, r: F.when(weight(best, r) >= weight(r, best), best).otherwise(r)
    )
