from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import periods


def plain(ws):
    n, long = len(ws), []
    for q in range(1, n // 3 + 1):
        s = None
        for i in range(q, n + 1):
            if i < n and ws[i] == ws[i - q]:
                s = i - q if s is None else s
            elif s is not None:
                if i - s >= max(24, 3 * q):
                    long.append((s, i - s, q))
                s = None
    covers = lambda x, y: y[2] < x[2] and y[0] <= x[0] and y[0] + y[1] >= x[0] + x[1]
    return sorted((r for r in long if not any(covers(r, o) for o in long)), key=lambda r: (r[0], r[2]))


def numbered(ws):
    return periods._numbered([str(w).encode() for w in ws])


def woven(rng, letters, size):
    """Words with repeats inside repeats, broken here and there."""
    out = []
    while len(out) < size:
        part = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        part = part * rng.randint(1, 12)
        if rng.random() < 0.4:
            part = (part + [rng.randrange(letters)]) * rng.randint(1, 5)
        if out and rng.random() < 0.3:
            a = rng.randrange(len(out))
            part = out[a:a + rng.randint(1, 80)]
        out += part
        if rng.random() < 0.3:
            out[rng.randrange(len(out))] = rng.randrange(letters)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        ws = woven(rng, rng.choice([1, 2, 3, 8, 50]), rng.randint(10, 400))
        assert periods.periodic_runs(numbered(ws)) == plain(ws)


def test_bounds_of_length_and_period():
    for q in range(1, 14):
        unit = [f"u{i}" for i in range(q)]
        for length in (max(24, 3 * q) - 1, max(24, 3 * q), max(24, 3 * q) + 5):
            ws = ["x", "y", *(unit * 50)[:length], "z"]
            assert periods.periodic_runs(numbered(ws)) == plain(ws)


def test_long_texts_of_one_word_one_line_and_two_regions():
    began = time.time()
    assert periods.periodic_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    line = list(range(20))
    assert periods.periodic_runs(np.array(line * 15_000)) == [(0, 300_000, 20)]
    far = line * 3000 + list(range(100, 5000)) + line * 3000
    assert periods.periodic_runs(np.array(far)) == [(0, 60_000, 20), (64_900, 60_000, 20)]
    signed = [w for i in range(3000) for w in (10_000 + i, *range(18))]  # each line has a number of its own
    assert periods.periodic_runs(np.array(signed)) == []
    assert time.time() - began < 60


ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b " * 20), (4, "a b " * 20), (None, "x " + "line of words here " * 9 + "end"),
    (5, "one word only"), (6, "w " * 23), (7, "w " * 24), (8, "   " * 30), (9, "a " * 30 + "b " * 60 + "a b c " * 20),
    (10, "c d " * 15 + "e f " * 15),
]


def collapsed(ws):
    runs, gone = plain(ws), set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return runs, " ".join(w for i, w in enumerate(ws) if i not in gone)


def check(spark, rows):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, runs string, n_words int")
    of = df.repartition(2).select("doc_id", periods.collapsed("text").alias("of"))
    got = of.select("doc_id", "of.*", periods.strongest(F.col("of.runs")).alias("best")).collect()
    assert len(got) == len(rows)
    want = []
    for k, t in rows:
        ws = [w.decode() for w in (t or "").encode().split()]
        runs, kept = collapsed(ws)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((k, len(ws), runs, kept, best))
    have = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept, r.best and tuple(r.best)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_defined_cases(spark):
    check(spark, ROWS)
    check(spark, [])


def test_a_text_of_several_megabytes(spark):
    rng = random.Random(3)
    noise = " ".join(str(rng.randrange(10 ** 6)) for _ in range(400_000))
    line = "every line of this is the same as the last "
    df = spark.createDataFrame([(1, noise + " " + line * 20_000)], "doc_id long, text string")
    r = df.select(periods.collapsed("text").alias("of")).select("of.*").first()
    assert [tuple(x) for x in r.runs] == [(400_000, 200_000, 10)] and r.kept == noise + " " + line.strip()


def test_query_rewrites_every_tenth_document(spark):
    import zlib

    from modelyard.llm.queries import with_periods

    rows = [(k, " ".join(f"w{i}" for i in range(k % 90))) for k in range(300)] + [(None, "a b"), (-5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in df.select("doc_id", with_periods("text", "doc_id").alias("text")).collect()}
    changed = 0
    for k, t in rows:
        ws, h = (t or "").split(), zlib.crc32(str(k).encode())
        g = h // 10
        if k is not None and h % 10 == 0 and ws:
            n, a = len(ws), g % len(ws)
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
            assert got[k] == " ".join(ws)
            changed += got[k] != t
        else:
            assert got[k] == t
    assert changed > 5
