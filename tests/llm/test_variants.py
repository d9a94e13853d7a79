from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelyard.llm import queries, variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, least=7, count=2, ratio=10):
    known = {w: n for w, n in counts.items() if w is not None and len(w) >= least and n >= count}
    near = {w: [v for v in known if one_edit(w, v)] for w in known}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-known[v], v), default=None)
        form[w] = best if best is not None and known[best] >= ratio * known[w] else None
    out = []
    for w in known:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, known[w], len(near[w]), known.get(form[w])))
    return sorted(out)


def check(spark, rows, **named):
    df = spark.createDataFrame([(w, n, 1, "x") for w, n in rows], "word string, n long, size int, chunk string")
    got = variants.spelling_variants(df.repartition(3), **named).collect()
    counts = Counter()
    for w, n in rows:
        counts[w] += n or 0
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r[c] for c in columns) for r in got) == plain(counts, **named)


def edited(rng, word, letters):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(letters) + word[i + 1:], word[:i] + rng.choice(letters) + word[i:]])


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcé"), (3, "abcdefghijklmnopqrstuvwxyzß÷")])
def test_against_brute_force(spark, seed, letters):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 15))) for _ in range(60)]
    for _ in range(240):
        words.append(edited(rng, rng.choice(words), letters))
    check(spark, [(w, rng.choice([1, 2, 5, 30, 400, 9000])) for w in words])


def test_chains_ties_and_defined_cases(spark):
    chain = [("abcdefgh", 10 ** 9), ("abcdefg", 10 ** 7), ("abcdeg", 10 ** 8), ("bcdefgh", 10 ** 6), ("bcdefgha", 10 ** 5), ("cdefgha", 10 ** 4)]
    rows = chain + [
        (None, 9), ("", 9), ("short", 50), ("nothing", None), ("zzzzzzz", 2), ("zzzzzzy", 20), ("zzzzzzx", 20), ("zzzzzzx", 0),
        ("aaaaaaaa", 100), ("aaaaaaa", 10), ("aaaaaaaaa", 1000), ("aaaaaaaaa", 1000),
    ]
    check(spark, rows)
    check(spark, rows, least=3, count=1, ratio=2)
    check(spark, [])
    check(spark, [("alonealone", 3)])


def test_every_single_edit_of_one_word_is_found_once(spark):
    word, letters = "abcabcabc", "abcd"
    every = {word[:i] + word[i + 1:] for i in range(9)}
    every |= {word[:i] + x + word[i + d:] for i in range(10) for x in letters for d in (0, 1)}
    rows = [(w, 2) for w in every | {word}]
    check(spark, rows)
    df = spark.createDataFrame(rows, "word string, n long")
    pairs = variants.near_pairs(df)
    assert pairs.count() == pairs.distinct().count()


def test_a_long_list_of_one_word_start(spark):
    """Words that share their first half: lists of quarters stay short."""
    rows = [("prefixes" + "".join(chr(97 + i // 26 ** k % 26) for k in range(5)), 2 + i % 50) for i in range(2000)]
    df = spark.createDataFrame(rows, "word string, n long")
    size = F.char_length("word")
    lists = df.select(F.explode(F.array(*variants._keys(F.col("word"), size, 0))).alias("key")).groupBy("key").count()
    assert lists.where("key.half = 0").agg(F.max("count")).first()[0] < 800
    check(spark, rows)


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    """Chunks and grams are many times the stored words that the planner sizes them by."""
    plans, store = [], variants.stored

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(variants, "stored", seen)
    rows = [("prefixes" + chr(97 + i) * 3, 2 + i) for i in range(20)]
    got = variants.spelling_variants(spark.createDataFrame(rows, "word string, n long"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)


def test_words_of_documents(spark):
    import re

    texts = [(1, "Straße straße STRASSE x÷y"), (None, "Verylongword verylongword"), (3, None), (4, ""), (5, "a1b Ünïcödé-ünïcödé")]
    texts += [(i, "Someword otherword thirdword " * 3) for i in range(10, 60)]
    counts = Counter()
    for k, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{k}:{run}".encode())
            if k is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], "doc_id long, text string, word string, mark int")
    assert {r.word: r.n for r in queries.spelled_words(df).collect()} == counts
