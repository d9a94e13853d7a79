from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from brute import simhash as plain, union
from modelyard.llm import simhash as sh


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def neighbours(seed, base, members, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(base):
        centre = rng.getrandbits(64)
        out.add(centre)
        for _ in range(members):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))))
    return sorted(out)


@pytest.mark.parametrize("base, members, flips, block", [(40, 4, 6, 1024), (3, 60, 3, 16), (1, 150, 2, 7)])
def test_links_join_what_all_pairs_join(spark, base, members, flips, block):
    prints = neighbours(base, base, members, flips)
    near = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 3]
    want = {frozenset(map(signed, g)) for g in groups(union(near, prints))}
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    pairs = [(r.a, r.b) for r in sh.links(df, 3, block).collect()]
    assert all((a ^ b) & ((1 << 64) - 1) for a, b in pairs)
    got = {frozenset(g) for g in groups(union(pairs, [signed(p) for p in prints]))}
    assert got == want
    found = {r.fp: r.root for r in sh.classes(df).collect()}
    assert {frozenset(g) for g in groups(found)} == {g for g in want if len(g) > 1}


def groups(label):
    out = {}
    for node, root in label.items():
        out.setdefault(root, []).append(node)
    return out.values()


TEXTS = [
    (5, "One two three four five six."), (3, "one  TWO three\tfour five six."), (9, None), (8, ""), (7, " \n"),
    (1, "Äpfel ÄPFEL äpfel x"), (2, "word"), (None, "word"), (4, "a b"), (4, "a b"),
    (11, "x " * 70000), (12, "y" * 50000 + " z"),
]


def test_whole_rows_against_brute_force(spark):
    df = spark.createDataFrame([(k, t, "s", 1, True) for k, t in TEXTS],
                               "doc_id long, text string, fp string, component int, row boolean")
    got = [(r.doc.doc_id, r.fp, r.component) for r in sh.near_duplicates(df).collect()]
    prints = {t: plain(t) for _, t in TEXTS}
    near = [(a, b) for a in prints.values() for b in prints.values() if a != b and (a ^ b).bit_count() <= 3]
    root = union(near, set(prints.values()))
    low = {}
    for k, t in TEXTS:
        if k is not None:
            low[root[prints[t]]] = min(low.get(root[prints[t]], k), k)
    want = [(k, signed(prints[t]), low[root[prints[t]]]) for k, t in TEXTS]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = sh.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low.values()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sh.near_duplicates(df).count() == 0 and sh.one_of_each(df).count() == 0


def test_hash_is_the_engines_own(spark):
    text = "ab cd éf gh ij kl mn op qr st uv wx yz"
    engine = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    import xxhash
    assert engine == signed(xxhash.xxh64_intdigest(text.encode(), seed=42))
