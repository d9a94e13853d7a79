from __future__ import annotations

import hashlib
import random

from modelyard.llm import radix


def want(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault("".join((text or "").translate({ord(c): None for c in " \t\n\v\f\r"})), []).append((key, text))
    out = []
    for same in groups.values():
        best = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(key, best[0], len(same)) for key, _ in same]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 2, 3) for k, t in rows],
                                 "doc_id long, text string, row string, size int, same int")


def check(spark, rows):
    got = radix.exact_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc.doc_id, r.keep_key, r["size"]) for r in got), key=repr) == want(rows)
    assert sum(r.row == r.keep_row for r in got) == len({hashlib.md5(radix_text(t)).digest() for _, t in rows})
    left = radix.without_duplicates(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "row", "size", "same"]
    assert left.count() == sum(r.row == r.keep_row for r in got)


def radix_text(text):
    return "".join((text or "").split(" ")).translate(str.maketrans("", "", "\t\n\v\f\r")).encode()


def test_nulls_ties_and_repeats(spark):
    check(spark, [
        (1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "ab"), (5, "ab"), (None, "a  b"), (None, "ü"), (9, "ü"),
        (10, "no break space "), (11, "no break space"), (6, "abc"), (7, "ab" * 16), (8, "ab" * 16 + "c"),
    ])


def test_long_texts_and_one_hot_group(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abc ") for _ in range(150_000))
    rows = [(i, long + tail) for i, tail in enumerate(["", "x", "x", "y", " ", "xx"])]
    rows += [(100 + i, "copied line " * 20 + " " * (i % 7)) for i in range(300)]
    rows += [(1000 + i, "copied line " * 20 + str(i % 50)) for i in range(100)]
    check(spark, rows)


def test_every_prefix_is_its_own_text(spark):
    check(spark, [(i, "z" * i) for i in range(0, 140)] + [(1000 + i, "z " * i) for i in range(0, 140, 3)])


def test_empty_table(spark):
    assert radix.exact_duplicates(frame(spark, []).limit(0)).count() == 0
