from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from modelyard.llm import lattice as la
from modelyard.llm.queries import sentencepiece_model

ODD = [
    None, "", " ", "  two  blanks ", "▁literal ▁ mark", "line\nbreaks\n\n here\t tab\r\n", "日本語 テキスト😀", "a\x00b\x01", "é" * 60,
    "x" * 3000, "word " * 2000, "▁", "\n", "Hello  world",
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece_model()


@pytest.fixture(scope="module")
def known(model):
    return la.Lattices(la.Vocabulary(model))


def test_round_trip_is_lossless(spark, model):
    shared = spark.sparkContext.broadcast(model)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, ids string, key int")
    ids = la.encode(F.col("text"), F.col("doc_id"), shared, seed=3)
    coded = df.select("doc_id", "text", ids.alias("coded"))
    rows = coded.select("*", la.decode("coded", shared).alias("back")).collect()
    assert len(rows) == len(ODD) and all(r.back == r.text for r in rows)
    assert [r for r in rows if r.doc_id == 1][0].coded == b""
    both = df.select("doc_id", la.round_trip(F.col("text"), F.col("doc_id"), shared, seed=3).alias("of")).collect()
    assert {r.doc_id: (r.of.ids, r.of.text) for r in both} == {r.doc_id: (r.coded, r.back) for r in rows}


def test_rows_do_not_depend_on_their_batch(known, monkeypatch):
    texts = [t for t in ODD if t] + ["the same words over and over again"] * 3
    keys = list(range(len(texts)))
    whole = la.encode_rows(known, texts, keys, 7)
    alone = [la.encode_rows(known, [t], [k], 7)[0] for t, k in zip(texts, keys)]
    monkeypatch.setattr(la, "_BATCH", 5)
    monkeypatch.setattr(la, "_KNOWN", 3)
    fresh = la.encode_rows(la.Lattices(known.vocabulary), texts, keys, 7)
    for a, b, c in zip(whole, alone, fresh):
        assert a.tolist() == b.tolist() == c.tolist()
    assert whole[-1].tolist() != whole[-2].tolist() or whole[-2].tolist() != whole[-3].tolist()
    assert la.encode_rows(known, ["some more words here"], [1], 1)[0].tolist() != \
        la.encode_rows(known, ["some more words here"], [1], 2)[0].tolist()


def paths(vocabulary, word):
    """All segmentations of a word with their weights, from the model's own list of pieces."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model())
    ranked = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    pieces = {sp.id_to_piece(i): (i, -la.SPREAD * math.log(k + 2)) for k, i in enumerate(ranked)}

    def go(end):
        if end == 0:
            yield (), 0.0
        for start in range(end):
            found = pieces.get(word[start:end])
            if found:
                arc = (found[0],), found[1]
            elif start == end - 1:
                raw = word[start].encode()
                arc = tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in raw), -la.SPREAD * math.log(len(ranked) + 2) * len(raw)
            else:
                continue
            for head, weight in go(start):
                yield head + arc[0], weight + arc[1]

    return dict(go(len(word)))


def test_words_are_cut_where_no_piece_goes_on(known):
    for text in ODD + ["don't (stop), m²_x a__b 3.5%... «é» x_{i}"]:
        words = known.words(text or "")
        assert "".join(words) == ("▁" + text.replace("▁", la._LITERAL).replace(" ", "▁") if text else "")
    assert known.words("ab, (cd) e_f") == ["▁ab", ",", "▁(cd", ")", "▁e", "_f"]


@pytest.mark.parametrize("word", ["▁there", "▁éa", "▁日x", "▁▁in"])
def test_segmentations_are_drawn_with_their_share(known, word):
    all_ = paths(known.vocabulary, word)
    total = sum(map(math.exp, all_.values()))
    n = 40_000
    codes = np.repeat(known.code([word, '▁other'])[:1], n)
    ids, counts = known.sampled(codes, la.streams(11, n, 5))
    ends = np.cumsum(counts)
    drawn = Counter(tuple(ids[e - c:e].tolist()) for e, c in zip(ends, counts))
    assert set(drawn) <= set(all_)
    for path, weight in all_.items():
        share = math.exp(weight) / total
        assert abs(drawn[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4


def test_draws_are_uniform():
    u = np.concatenate([la.uniform(la.streams(k, 2000, 1), s) for k in range(5) for s in range(3)])
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and abs(u.std() - math.sqrt(1 / 12)) < 0.01


def test_empty_table(spark, model):
    shared = spark.sparkContext.broadcast(model)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert df.select(la.encode(F.col("text"), F.col("doc_id"), shared)).count() == 0
