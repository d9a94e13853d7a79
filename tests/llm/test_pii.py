from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from modelyard.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def plain(text):
    spans = [
        (m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS) for m in re.finditer(PLAIN[kind], text or "")
        if passes(kind, m.group(0))
    ]
    return sorted(spans)


def spans(rows):
    return [(s.start, s.kind, s.end) for s in rows]


EDGES = [
    None, "", "a@b.c@d.e x@y", "a@b.c.d_e@f.g h", "..@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 0255.0.00.1 1.2.3", "é1.2.3.4é",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "4111111111111111\n4111111111111112",
    "x4465758382889437 4465758382889437", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+1 (484) 555-1610 +49 30 1234567",
    "+1+2 555 555 5555 ++1 2345678901", "+123456789012345678", "+1 (484) 555-1610.", "a@b.co c@d.co",
    "😀 a@b.co 😀 10.0.0.1", "9" * 40, "a" * 30000 + "@", "1" * 4000 + ".1.1.1", "a.b." * 3000 + "@x.y",
    "call (743) 555-3824 now", "12@mail5.example.com", "1-2-3-4-5-6-7-8-9-0-1-2-3-4 ",
]


def random_text(rng):
    parts = ["a", "Z", "0", "9", "255", "256", "4111", "1111", ".", "..", "@", "-", " ", "+", "(", ")", "_", "\n", "é", "x.y"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))


def test_strict_spans_equal_the_plain_patterns(spark):
    rng = random.Random(4)
    texts = EDGES + [random_text(rng) for _ in range(600)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, base int")
    got = pii.annotated(df).select(
        "doc.doc_id", "base", "spans", F.sha2(pii.spelled("base").cast("binary"), 256).alias("digest")
    ).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        assert spans(r.base) == want, texts[r.doc_id][:200]
        spelled = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.digest == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(want) <= set(spans(r.spans))
        extra = sorted(set(spans(r.spans)) - set(want))
        assert not any(a < e and s < b for a, _, b in extra for s, _, e in want)


def test_expectation_maximisation_finds_reliable_labelers():
    rng, cells = random.Random(1), {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        right = [0.95, 0.9, 0.85, 0.8, 0.6, 0.5]
        votes = tuple((1 if truth else -1) * (1 if rng.random() < p else -1) for p in right)
        cells[votes, truth] = cells.get((votes, truth), 0) + 1
    patterns = sorted({v for v, _ in cells})
    belief, table = pii.chances([(0, v, cells.get((v, True), 0) + cells.get((v, False), 0)) for v in patterns])
    hits = sum(cells.get((v, p > 0.5), 0) for v, p in zip(patterns, belief))
    assert hits / 4000 > 0.95
    assert table[2, 1, 1] > table[3, 1, 1] > table[4, 1, 1] > table[5, 1, 1] and abs(table[3, 1, 1] - 0.8) < 0.06


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows = random.Random(7), []
    for i in range(400):
        base = rng.choice(["mail bob{}@mail.org", "tel +1 ({}) 555-{}", "host 24.{}.7.9", "card 4111111111111111", "version 4.9", "id 77{}123"])
        rows.append((i, "some words " + base.format(rng.randint(200, 250), rng.randint(1000, 9999)) + " and more"))
    rows += [(1000 + i, f"please call: ({rng.randint(200, 900)}) 555-{rng.randint(1000, 9999)} today") for i in range(40)]
    rows += [(2000 + i, f"order {rng.randint(10 ** 6, 10 ** 7)} of part 12-{i} at 5.5") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_classifier_adds_spans_and_leaves_clean_texts(spark, corpus):
    model = pii.fitted(pii.candidates(corpus))
    got = {r.doc.doc_id: r for r in pii.annotated(corpus, model).collect()}
    assert model.weights and all(not got[2000 + i].spans for i in range(40))
    assert all(not got[1000 + i].base for i in range(40))
    assert sum(bool(got[1000 + i].spans) for i in range(40)) >= 36


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é a@b.co, 4111111111111111 end"), (2, None), (3, "clean"), (4, "+1 (484) 555-1610")],
                               "doc_id long, text string")
    rows = pii.annotated(df).select("doc.doc_id", pii.redacted(F.col("doc.text"), "base").alias("text")).collect()
    assert {r.doc_id: r.text for r in rows} == {1: "é <EMAIL>, <CARD> end", 2: None, 3: "clean", 4: "<PHONE>"}


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    done = pii.annotated(df)
    assert done.count() == 0
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
