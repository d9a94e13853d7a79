from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from modelyard.llm import contamination as c

DOCS = "doc_id long, text string, key string, mark int, term string, place int"
ITEMS = "item_id long, text string, phrase string, at int"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, window=10):
    wanted = []
    for i, t in items:
        ws = words(t)
        size = min(window, len(ws))
        wanted += [(i, tuple(ws[s:s + size])) for s in range(len(ws) - size + 1) if size]
    out = []
    for k, t in docs:
        ws, hit, ids = words(t), set(), set()
        for i, w in wanted:
            for s in range(len(ws) - len(w) + 1):
                if tuple(ws[s:s + len(w)]) == w:
                    hit.update(range(s, s + len(w)))
                    ids.add("" if i is None else str(i))
        out.append((k, len(ws), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(k, t, "x", 1, "y", 0) for k, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, "z", 2) for i, t in items], ITEMS),
    )


def check(spark, docs, items, window=10):
    got = c.contamination(*tables(spark, docs, items), window=window).collect()
    assert sorted(((r.key, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == plain(docs, items, window)


def corpus(seed, vocabulary=12, docs=40):
    """A common few words, so that terms repeat inside windows, and passages that overlap."""
    rng = random.Random(seed)
    some = [f"w{i}" for i in range(vocabulary)] + ["Ünï", "Zwei"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([1, 3, 9, 10, 11, 30])))) for i in range(12)]
    rows = []
    for k in range(docs):
        body = [rng.choice(some) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            ws = rng.choice(items)[1].split()
            a = rng.randint(0, max(0, len(ws) - 8))
            at = rng.randint(0, len(body))
            body[at:at] = ws[a:a + rng.randint(5, 25)]
        rows.append((k, rng.choice([" ", ", ", "\n"]).join(body)))
    return rows, items


@pytest.mark.parametrize("seed, window", [(1, 10), (2, 10), (3, 3), (4, 1)])
def test_against_brute_force(spark, seed, window):
    check(spark, *corpus(seed), window)


def test_defined_cases(spark):
    ten = "a b c d e f g h i j"
    docs = [
        (1, None), (2, ""), (3, " .,- "), (4, ten.upper()), (4, ten.upper()), (4, ten), (None, "x " + ten), (None, ten), (None, None),
        (5, "a b c d e f g h i"), (6, "the the the"), (7, ten.replace(" ", "--") + " " + ten), (8, "É é 12 z"),
    ]
    items = [(10, ten + " k"), (9, ten), (9, ten), (11, None), (12, ""), (None, "the the"), (13, "é"), (14, "12 z"), (2, "a b c d e f g h i j")]
    check(spark, docs, items)
    check(spark, docs, [])
    check(spark, [], items)
    check(spark, [], [])


def test_long_text_hot_passage_and_common_words(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    noise = [f"n{i}" for i in range(3000)]
    long = " ".join(rng.choice(noise) for _ in range(400_000))
    docs = [(i, f"{i} {passage} tail") for i in range(300)] + [(1000, f"{long} {passage}")]
    items = [(1, passage), (2, "q " + passage), (3, "tail"), (4, "nothing of it")]
    got = {r.key: r for r in c.contamination(*tables(spark, docs, items)).collect()}
    assert all((got[i].n_words, got[i].n_hit, got[i]["items"]) == (32, 31, ["1", "2", "3"]) for i in range(300))
    assert (got[1000].n_words, got[1000].n_hit, got[1000]["items"]) == (400_030, 30, ["1", "2"])


@pytest.mark.parametrize("slop", [0, 2])
def test_proximity_matches(spark, slop):
    docs, items = corpus(7, vocabulary=30, docs=25)
    frame, asked = tables(spark, docs, items)
    terms, _ = c.item_terms(asked)
    postings = c.index(frame, terms)
    got = c.proximity_matches(postings, c.rarest_pairs(postings, terms), slop).collect()
    count = Counter(w for _, t in docs for w in words(t))
    want = 0
    for ws in {tuple(words(t)) for _, t in items}:
        for s in range(max(1, len(ws) - 9)):
            by = sorted((count[w], s + k, w) for k, w in enumerate(ws[s:s + 10]))
            (_, i, first), (_, j, second) = by[0], by[min(1, len(by) - 1)]
            for _, t in docs:
                seen = words(t)
                for p, w in enumerate(seen):
                    for q in range(max(0, p + j - i - slop), min(len(seen), p + j - i + slop + 1)):
                        order = (q == p) == (j == i) and (q > p) == (j > i)
                        want += w == first and seen[q] == second and order
    assert len(got) == want and want > 0
