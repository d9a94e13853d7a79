from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from modelyard.llm import packing as pk
from modelyard.llm.common import stored
from modelyard.llm.queries import placed_pieces, tokenizer_definition


@pytest.fixture(scope="module")
def definition():
    return tokenizer_definition()


ODD = [
    "a <|endoftext|> b", "a<|endoftext|>b.", "<|ENDOFTEXT|> x<|startoftext|>", "J\u030C ẖ H\u0331. K\u030C,", "WORD. Word... 'S 's' 'Ll", "ΑΣ. ΣΑΣ",
    "\u1112\u1161\u11ab.", "it's. DON'T! x²y ½. Ⅷ ª. ǅ", "a\u00a0b.\u3000c", "É é ΑΣ. x y　z 's don't İstanbul 12 34 <|endoftext|>", "", " \n ", "á b́ ́c", " 日本語 テキスト", " ", "A" * 3000,
]


def test_words_have_the_ids_of_the_whole_text(definition):
    whole, words = Tokenizer.from_str(definition), pk.WordIds(definition)
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(["the", "tion", "ÉA", "x1y", "'s", "--", "ß"]) + rng.choice("ab é.") for _ in range(50)) for _ in range(50)]
    for text, ids in zip(texts, words.ids(pa.array(texts))):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_the_word_store_is_bounded(definition, monkeypatch):
    monkeypatch.setattr(pk, "_WORDS", 3)
    monkeypatch.setattr(pk, "_SLICE", 4)
    words, whole = pk.WordIds(definition), Tokenizer.from_str(definition)
    text = "one two three four five six one two seven eight nine ten"
    assert words.ids(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pricing_finds_the_best_multiset():
    rng = np.random.default_rng(1)
    for _ in range(20):
        prices = np.where(rng.random(31) < 0.4, rng.random(31), 0.0)
        prices[0] = 0
        best = np.zeros(31)
        for w in range(1, 31):
            best[w] = max([best[w - 1], *(best[w - l] + prices[l] for l in range(1, w + 1))])
        got = pk.best_pattern(prices, 30)
        assert sum(got) <= 30 and sum(prices[l] for l in got) == pytest.approx(best[30])


def least(lengths, size):
    """Fewest sequences, by search over small cases."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[i]}):
            rest = list(rooms)
            rest.remove(room)
            go(i + 1, [*rest, room - lengths[i]])
        go(i + 1, [*rooms, size - lengths[i]])

    go(0, [])
    return best[0]


def test_solutions_hold_the_histogram_and_are_near_the_least():
    rng = random.Random(5)
    extra = 0
    for _ in range(40):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(0, 9))), reverse=True)
        solution = pk.solve(Counter(lengths), 20, 30)
        assert sum((Counter({l: a * m for l, a in p.items()}) for p, m in solution), Counter()) == Counter(lengths)
        assert all(sum(l * a for l, a in p.items()) <= 20 for p, _ in solution)
        extra += sum(m for _, m in solution) - least(lengths, 20)
    assert extra <= 1


def test_many_pieces_are_packed_close_to_the_bound():
    rng = random.Random(6)
    histogram = Counter(min(256, int(rng.lognormvariate(3.5, 1)) + 1) for _ in range(50_000))
    solution = pk.solve(histogram, 256)
    total = sum(l * n for l, n in histogram.items())
    assert sum(m for _, m in solution) <= 1.002 * total / 256 + 1
    assert any(m > 1 for _, m in solution)


def test_the_program_covers_all_demand_of_many_lengths():
    rng = random.Random(7)
    histogram = Counter(min(600, int(rng.lognormvariate(5, 1)) + 1) for _ in range(20_000))
    assert len(histogram) > 500
    (found, bound), covered = pk.fractional(histogram, 600), Counter()
    for pattern, x in found:
        for l, a in pattern.items():
            covered[l] += a * x
    assert all(covered[l] < n + 1e-6 for l, n in histogram.items())
    volume = sum(l * n for l, n in histogram.items())
    assert sum(l * n for l, n in covered.items()) > 0.99 * volume and bound >= volume / 600
    assert sum(x for _, x in found) <= 1.002 * bound
    solution = pk.solve(histogram, 600)
    placed = sum(int(x) * sum(p.values()) for p, x in found)
    assert placed > 0.9 * sum(histogram.values())
    assert sum(m for _, m in solution) <= 1.002 * bound + 1


def test_few_lengths_come_to_the_optimum_of_the_program():
    """Prices 1/2, 1/4 and 3/4 prove that no solution is below 2,625."""
    solution = pk.solve({1366: 3000, 1365: 3000, 2731: 500})
    assert sum(m for _, m in solution) <= 2625 * 1.001
    found, bound = pk.fractional({1366: 3000, 1365: 3000, 2731: 500}, 4096)
    assert bound <= 2625 and bound >= 0.98 * sum(x for _, x in found)


def test_many_lengths_take_little_time():
    rng = random.Random(3)
    histogram = Counter(rng.randint(1, 4096) for _ in range(3000))
    assert len(histogram) > 1000
    began = time.process_time()
    solution = pk.solve(histogram)
    assert time.process_time() - began < 30
    assert sum(m for _, m in solution) <= 1.03 * sum(l * n for l, n in histogram.items()) / 4096


def check(rows, length):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


@pytest.mark.parametrize("bits", [16, 3])
def test_places_are_gapless(spark, bits, monkeypatch):
    monkeypatch.setattr(pk, "_CHUNK_BITS", bits)
    rng = random.Random(8)
    rows = [(i, rng.choice([5, 5, 5, 64, 63, rng.randint(1, 64)]), "x") for i in range(3000)]
    df = stored(spark.createDataFrame(rows, "k long, length long, row string").repartition(5), "test-lengths")
    got = pk.packed(df, 64).select("doc.*", "sequence_id", "offset").collect()
    assert sorted((r.k, r.length) for r in got) == [(k, n) for k, n, _ in rows]
    used = check(got, 64)
    assert used <= 1.02 * sum(n for _, n, _ in rows) / 64 + 2


def test_documents(spark, definition):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "the end"), (5, "word " * 9000), (6, "a b c " * 1365)]
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in rows], "doc_id long, text string, ids string, piece int")
    got = placed_pieces(df, definition, with_ids=True).collect()
    assert all(zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in got)
    assert "ids" not in placed_pieces(df, definition).columns
    with pytest.raises(ValueError):
        pk.pieces(df, definition, width=1)
    whole = Tokenizer.from_str(definition)
    want = []
    for k, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            want.append((k, i, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    check(got, 4096)


def test_empty_table_and_wrong_lengths(spark, definition):
    assert placed_pieces(spark.createDataFrame([], "doc_id long, text string"), definition).count() == 0
    with pytest.raises(ValueError):
        pk.packed(spark.range(3).select((F.col("id") + 5).alias("length")), 6)
