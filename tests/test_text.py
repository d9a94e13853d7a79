from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelyard.functions import lcs
from modelyard.functions import text as tx
from modelyard.operators import encoding as en
from modelyard.operators import rouge as rg


def table_lcs(a, b):
    """Textbook dynamic programming table."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
    return rows


def walk_back(a, b):
    rows, i, j, out = table_lcs(a, b), len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.add(i - 1)
            i, j = i - 1, j - 1
        elif rows[i][j - 1] > rows[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def test_lcs_against_the_table():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randrange(0, 25))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(0, 90))]
        assert lcs.lcs_length(a, b) == table_lcs(a, b)[-1][-1]
        assert lcs.lcs_positions(a, b) == walk_back(a, b)


PAIRS = [
    (1, "the cat sat on the mat", "the cat lay on a mat"),
    (2, "", "something here"),
    (3, "same words here", "same words here"),
    (4, "no overlap", "entirely different text"),
    (5, "a a a b", "a a c c c"),
    (6, None, "left out"),
]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame(PAIRS, "k int, c string, r string")


def grams(text, n):
    t = (text or "").lower().split()
    return Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))


def test_rouge_n_against_counters(pairs):
    got = {(r["k"], r["order"]): r for r in rg.rouge_n(pairs, ["k"], "c", "r").collect()}
    assert len(got) == 2 * len(PAIRS)
    for k, c, r in PAIRS:
        for n in (1, 2):
            a, b = grams(c, n), grams(r, n)
            both = sum((a & b).values())
            p = both / sum(a.values()) if a else 0.0
            q = both / sum(b.values()) if b else 0.0
            row = got[(k, n)]
            assert row["precision"] == pytest.approx(p) and row["recall"] == pytest.approx(q)
            assert row["f1"] == pytest.approx(2 * p * q / (p + q) if both else 0.0)


def test_rouge_l_against_the_table(pairs):
    got = {r["k"]: r for r in rg.rouge_l(pairs, ["k"], "c", "r").collect()}
    for k, c, r in PAIRS:
        a, b = (c or "").split(), r.split()
        hit = table_lcs(b, a)[-1][-1]
        assert got[k]["recall"] == pytest.approx(hit / len(b) if a else 0.0)
        assert got[k]["precision"] == pytest.approx(hit / len(a) if a else 0.0)


def test_rouge_lsum_uses_the_union_of_sentences(spark):
    df = spark.createDataFrame(
        [(1, "w1 w2 w6 w7 w8. w1 w3 w8 w9 w5.", "w1 w2 w3 w4 w5.")], "k int, c string, r string"
    )
    row = rg.rouge_lsum(df, ["k"], "c", "r").first()
    assert row["recall"] == pytest.approx(4 / 5) and row["precision"] == pytest.approx(4 / 10)


def plain_lsum(cand, ref):
    """Union alignment with clipping, sentence by sentence."""
    cs, rs = ([s.replace(".", "").split() for s in t.split(". ") if s] for t in (cand, ref))
    left_c, left_r = Counter(t for s in cs for t in s), Counter(t for s in rs for t in s)
    hits = 0
    for sentence in rs:
        for i in sorted(set().union(*(walk_back(sentence, c) for c in cs))):
            if left_c[sentence[i]] > 0 and left_r[sentence[i]] > 0:
                left_c[sentence[i]] -= 1
                left_r[sentence[i]] -= 1
                hits += 1
    return hits / max(1, sum(map(len, cs))), hits / max(1, sum(map(len, rs)))


@pytest.mark.parametrize("sentences", [1, 3, 16])
def test_rouge_lsum_against_clipped_unions(spark, sentences):
    rng = random.Random(sentences)
    rows = []
    for k in range(25):
        texts = [". ".join(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 8))) + "." for _ in range(2)]
        rows.append((k, *texts))
    df = spark.createDataFrame(rows, "k int, c string, r string")
    got = {r["k"]: (r["precision"], r["recall"]) for r in rg.rouge_lsum(df, ["k"], "c", "r", sentences).collect()}
    for k, c, r in rows:
        assert got[k] == pytest.approx(plain_lsum(c, r))


def test_corpus_report_has_all_four(pairs):
    report = {r["key"]: r["value"] for r in rg.corpus_report(pairs, ["k"], "c", "r").collect()}
    assert set(report) == {"rouge1", "rouge2", "rougeL", "rougeLsum"}
    assert all(0 <= v <= 100 for v in report.values())


def test_bootstrap_mid_is_near_the_mean(spark):
    df = spark.range(400).select("id", (F.col("id") % 10 / 10).alias("f1"))
    row = rg.bootstrap_mid(df, ["id"], replicates=200).first()
    assert row["replicates"] == 200 and abs(row["mid"] - 0.45) < 0.02


def test_bootstrap_weights_are_those_of_the_digests(spark):
    import hashlib

    values = {f"k{i}": i / 7 for i in range(150)}
    df = spark.createDataFrame([*values.items(), ("none", None)], "k string, f1 double").repartition(3)
    means = []
    for b in range(41):
        top = bottom = 0
        for k in [*values, "none"]:
            u = int(hashlib.md5(f"s|{b}|{k}".encode()).hexdigest()[:8], 16) / 2**32
            w = sum(u >= c for c in rg.poisson_cuts())
            top, bottom = top + w * values.get(k, 0.0), bottom + w
        means.append(top / bottom)
    row = rg.bootstrap_mid(df, ["k"], replicates=41, seed="s").first()
    assert row["mid"] == pytest.approx(sorted(means)[20])
    empty = rg.bootstrap_mid(df.limit(0), ["k"], replicates=5).first()
    assert (empty["replicates"], empty["mid"]) == (0, None)


def test_poisson_weights_have_mean_one():
    cuts = rg.poisson_cuts()
    assert abs(sum(1 - c for c in cuts) - 1.0) < 1e-6


def docs(spark):
    return spark.createDataFrame(
        [(1, "b b a", "a"), (2, "a b zzz", None), (3, "", "b a c"), (4, None, "a")],
        "k int, text string, summary string",
    )


@pytest.mark.parametrize("size", [None, 2])
def test_vocabulary_order(spark, size):
    got = {r["token"]: r["id"] for r in en.build_vocabulary(docs(spark), "text", size).collect()}
    assert got == ({"b": 3, "a": 4} if size else {"b": 3, "a": 4, "zzz": 5})


def test_encode_and_decode(spark):
    words = en.build_vocabulary(docs(spark), "text", 2)
    coded = en.token_ids(docs(spark), ["k"], {"ids": ("text", 3)}, words)
    got = {r["k"]: r["ids"] for r in coded.collect()}
    assert got == {1: [3, 3, 1], 2: [4, 3, 1], 3: [1], 4: [1]}
    padded = coded.select("k", tx.mask_padding(tx.pad(F.col("ids"), 5)).alias("ids"))
    back = {r["k"]: r["text"] for r in en.decode_ids(padded, ["k"], "ids", words).collect()}
    assert back == {1: "b b", 2: "a b", 3: "", 4: ""}
    whole = en.token_ids(docs(spark), ["k"], {"ids": ("text", None)}, words).collect()
    assert {r["k"]: r["ids"] for r in whole} == {1: [3, 3, 4, 1], 2: [4, 3, 2, 1], 3: [1], 4: [1]}


def test_encode_pairs_drops_both_sides_of_a_null_pair(spark):
    words = en.build_vocabulary(docs(spark), "text", 2)
    rows = en.encode_pairs(docs(spark), ["k"], "text", "summary", words, 6, 4, prefix="x ").collect()
    got = {r["k"]: r for r in rows}
    assert set(got) == {1, 3}
    assert got[1]["input_ids"] == [2, 3, 3, 4, 1, 0] and got[1]["attention_mask"] == [1, 1, 1, 1, 1, 0]
    assert got[1]["labels"] == [4, 1, -100, -100]
    assert got[3]["labels"] == [3, 4, 2, 1]
    bare = en.encode_pairs(
        docs(spark), ["k"], "text", "summary", words, 6, 4, pad_to_max=False
    ).where("k = 1").first()
    assert bare["labels"] == [4, 1] and bare["attention_mask"] == [1, 1, 1, 1]
