from __future__ import annotations

import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from modelyard.llm import superkmer as sk


def plain(rows, window):
    docs = [(k, re.findall("[^ \\t-\\r]+", t or "")) for k, t in rows]
    first = {}
    order = lambda k, s: (k is None, k or 0, s)
    for k, ws in docs:
        for s in range(len(ws) - window + 1):
            seq = tuple(ws[s:s + window])
            first[seq] = min(first.get(seq, order(k, s)), order(k, s))
    out = []
    for k, ws in docs:
        gone = set()
        for s in range(len(ws) - window + 1):
            if order(k, s) > first[tuple(ws[s:s + window])]:
                gone.update(range(s, s + window))
        out.append((k, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=repr)


def check(spark, rows, **named):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, mark string, doc int")
    got = sk.substring_dedup(df.repartition(3), **named).collect()
    assert sorted(((r.key, r.n_words, r.n_removed, r.kept) for r in got), key=repr) == plain(rows, named.get("window", 20))


def corpus(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    rows = []
    for k in range(docs):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if k % 3 == 0:
            at = rng.randint(0, len(words))
            a = rng.randint(0, 30)
            words[at:at] = passage[a:a + rng.randint(15, 40)]
        rows.append((rng.randint(0, 10 ** 6), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_many_buckets_short_windows_and_hot_minimisers(spark):
    rows = corpus(5) + [(2_000_000 + i, f"a b c d e f g {i} h i j k l m {i % 3} n o p q") for i in range(120)]
    check(spark, rows, window=6, run=2, bucket_bytes=500)


def test_defined_cases(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, passage), (5, passage), (5, passage), (None, passage), (6, f"x {passage} y"),
        (7, "r " * 60), (7, "q\x0b" + "r\x0c" * 30), (8, "nbsp stays " * 30), (9, passage.upper()),
        (10, " ".join(f"l{i % 700}" for i in range(5000))),
    ]
    check(spark, rows)


def test_texts_of_one_key_lose_what_another_batch_has(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(None, f"{passage} one"), (None, f"{passage} two"), (7, f"{passage} six"), (7, f"{passage} ten"), (1, passage)]
    one = spark.createDataFrame(rows[:4], "doc_id long, text string").coalesce(1)
    df = one.union(spark.createDataFrame(rows[4:], "doc_id long, text string").coalesce(1))
    got = sk.substring_dedup(df).collect()
    assert sorted((r.key or 0, r.kept) for r in got) == [(0, "one"), (0, "two"), (1, passage), (7, "six"), (7, "ten")]


def test_each_text_of_a_key_sends_its_windows():
    passage = " ".join(f"w{i}" for i in range(30))
    texts = [f"{passage} one", f"{passage} two"]
    rows = pa.RecordBatch.from_arrays(
        [pa.array([7, 7]), pa.array([1, 2]), pa.array(texts)], names=["doc", "mark", "text"]
    )
    sent = {1: set(), 2: set()}
    for parcels in sk._pack(1, 64, SimpleNamespace(value=[]), 20, 4)(iter([rows])):
        for p in parcels.to_pylist():
            for mark, start, n in zip(p["mark"], p["start"], p["n"]):
                sent[mark].update(range(start, start + n))
    assert sent == {1: set(range(12)), 2: set(range(12))}


def test_empty_table(spark):
    assert sk.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_documents_are_cut_into_parts(monkeypatch):
    monkeypatch.setattr(sk, "_SEGMENT", 37)
    monkeypatch.setattr(sk, "_BATCH", 100)
    text = " ".join(str(i % 90) for i in range(300)).encode()
    parts = list(sk._parts(text, 20))
    assert [s for s, _ in parts] == list(range(0, 281, 37))
    whole = sk._Batch([(1, 2, s, t) for s, t in parts], 20, 4)
    later, first = sk._later(whole.words, whole.at, whole.key, whole.hash, 20)
    assert len(whole.at) == 281 and later.sum() == 281 - 90 and first.sum() == 90


def test_words_are_told_apart_by_their_bytes():
    text = "a bb \t ccccccccc ccccccccd a bb\nÄÖÜäöüß x\x01y " + "z" * 40 + " " + "z" * 39 + "y"
    words = sk._Words(text.encode())
    plain = text.encode().split()
    assert [words.text[s:s + n] for s, n in zip(words.start, words.length)] == plain
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            assert bool(words.equal(np.array([i]), np.array([j]))[0]) == (a == b)
            assert (words.hash[i] == words.hash[j]) == (a == b)


def test_equal_hashes_of_unequal_words_are_told_apart():
    words = sk._Words(b"1 2 3 1 2 4 1 2 3")
    later, first = sk._later(words, np.array([0, 3, 6]), np.array([5, 6, 7]), np.zeros(3, np.uint64), 3)
    assert later.tolist() == [False, False, True] and first.tolist() == [True, True, False]


def test_a_hot_minimiser_is_found_from_the_reports_of_its_tasks():
    import pyarrow as pa

    hot = b" ".join([b"the same words over and over again %d" % i for i in range(400)])
    rows = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([1, 2]), pa.array([hot.decode(), " ".join(f"x{i}" for i in range(3000))])], names=["d", "m", "t"]
    )
    out = list(sk._heavy_bins(640, 10, 20, 4)(iter([rows])))
    total = dict(zip(out[0].column(0).to_pylist(), out[0].column(1).to_pylist()))
    whole = sk._Batch([(1, 1, 0, hot), (2, 2, 0, rows.column(2)[1].as_py().encode())], 20, 4)
    assert total.pop(-1) == len(whole.at)
    exact = np.unique(whole.minimiser % np.uint64(640), return_counts=True)
    assert total == {int(b): int(n) for b, n in zip(*exact) if n * 10 >= len(whole.at)}
