from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import langid

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    train = spark.read.parquet(DOCS).where("doc_id % 2 = 0")
    return langid.text_model(train, sample=200)


def test_trigrams_are_counted_in_pieces(monkeypatch):
    text = b"Abcabc xyz" * 50
    whole = langid.trigrams(text)
    monkeypatch.setattr(langid, "_PIECE", 7)
    assert (langid.trigrams(text) == whole).all() and whole.sum() == len(text) - 2
    assert langid.trigrams(b"ab").sum() == 0


def test_held_out_accuracy(spark, model):
    held = spark.read.parquet(DOCS).where("doc_id % 2 = 1")
    got = langid.identified(held, model, declared=None, host=None)
    row = got.agg(F.avg((F.col("doc.lang") == F.col("language")).cast("double")), F.avg(F.col("accepted").cast("double"))).first()
    assert row[0] > 0.97 and row[1] > 0.97


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, probability double, host string")


ENGLISH = "the erthing and of thering inther that she erond with the anding "


def test_evidence_decides_where_the_text_is_silent(spark, model):
    rows = [(i, ENGLISH * 5, "en", "a.news.example.org") for i in range(60)]
    rows += [(100 + i, "de la que los ción mente para ado " * 5, "es", "b.diario.example.es") for i in range(60)]
    rows += [(200, "zz", "en", "a.news.example.org"), (201, "zz", None, "c.diario.example.es"), (202, None, "es", None),
             (203, "", None, "a.news.example.org"), (204, ENGLISH * 20, "es", "b.diario.example.es")]
    got = {r.doc.doc_id: r for r in langid.identified(frame(spark, rows), model).collect()}
    assert [got[k].language for k in (200, 201, 202, 203, 204)] == ["en", "es", "es", "en", "en"]
    assert got[0].doc.asDict().keys() == {"doc_id", "text", "lang", "source", "probability", "host"}


def test_texts_without_letters_count_for_no_language(spark, model):
    rows = [(i, ENGLISH * 5, "en", "a.news.example.org") for i in range(60)]
    rows += [(100 + i, ("", "12 34", None)[i % 3], "en", "b.empty.example.net") for i in range(300)]
    got = [r.language for r in langid.identified(frame(spark, rows), model).collect()]
    assert set(got) == {"en"}


def test_unknown_texts_are_rejected_and_clean_ones_stay(spark, model):
    rows = [(i, ENGLISH * 3, "en", "s") for i in range(20)] + [(30, "erthing 4111111111111111 10.2.3.4 x9@y.org " + ENGLISH[:20], "en", "s")] + [(90, "ЖЩЮЯ ыъэ " * 40, None, None), (91, "😀😁" * 200, None, None)]
    got = {r.doc.doc_id: r.accepted for r in langid.identified(frame(spark, rows), model).collect()}
    assert all(got[i] for i in [*range(20), 30]) and not got[90] and not got[91]


def plain(scores, hosts, declared, names, pull):
    """The same fusion over Python lists, for hosts without dots."""
    said = [int(np.argmax(s)) for s in scores]
    n = len(scores)
    totals = np.bincount(said, minlength=len(names)).astype(float)
    overall = (totals + 1) / (n + len(names))
    out = []
    for s, h, d in zip(scores, hosts, declared):
        logs = np.array(s)
        counts = lambda values, v: np.bincount([x for x, y in zip(said, values) if y == v], minlength=len(names))
        if h is not None:
            c = counts(hosts, h)
            domain = (c + overall * pull) / (c.sum() + pull)  # a host without a dot is its own domain
            logs = logs + np.log((c + domain * pull) / (c.sum() + pull))
        else:
            logs = logs + np.log(overall)
        if d is not None:
            logs = logs + np.log((counts(declared, d) + 1) / (totals + 2))
        p = np.exp(logs - logs.max())
        out.append((names[int(np.argmax(p))], float(p.max() / p.sum())))
    return out


def test_against_plain_fusion(spark, model):
    rows = [(r.doc_id, r.text[:40], r.lang if r.doc_id % 3 else None, r.source if r.doc_id % 7 else None)
            for r in spark.read.parquet(DOCS).where("doc_id < 200").collect()]
    df = frame(spark, rows)
    shared = spark.sparkContext.broadcast(model)
    scores = {r.doc_id: list(r.s) for r in df.select("doc_id", langid.text_scores("text", shared).alias("s")).collect()}
    want = plain([scores[r[0]] for r in rows], [r[3] for r in rows], [r[2] for r in rows], [*langid.LANGUAGES, "und"], langid.PULL)
    got = {r.doc.doc_id: (r.language, r.probability) for r in langid.identified(df, model).collect()}
    for r, (language, p) in zip(rows, want):
        assert got[r[0]][0] == language and got[r[0]][1] == pytest.approx(p, abs=1e-9)


def test_empty_table(spark, model):
    df = frame(spark, []).limit(0)
    assert langid.identified(df, model).count() == 0
    assert langid.text_model(df).shape == (4, 1 << 14)
