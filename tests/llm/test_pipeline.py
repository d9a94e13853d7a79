from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from brute import simhash, union
from modelyard.llm.common import stored
from modelyard.llm.queries import tokenizer_definition
from test_pii import plain as private_spans

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and thering anded tion erthe that with inthe onand ereding thand heron wases isto".split()


@pytest.fixture(scope="module")
def fixture(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(WORDS) + rng.choice("abcdefg") for _ in range(rng.randint(20, 300))) for _ in range(80)]
    texts += [t + " " for t in texts[:9]] + texts[:5] + [t.replace(" ", "\n", 1) for t in texts[20:30]]
    texts += [re.sub(r"\w+$", "end", t) for t in texts[30:60]]
    texts += ["mail bob@mail.org or +1 (484) 555-1610 " + " ".join(texts[61].split()[::-1]), "Ж" * 400, "", None, "host 10.1.2.3 " * 5 + " ".join(texts[62].split()[::-1]) + " 24.1.2.3"]
    rows = [(i, t, None if (t or "Ж").startswith("Ж") else "en", f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)] + [(3, texts[3], "en", None, 1), (None, texts[70], None, "s", None)]
    return spark.createDataFrame(rows, COLUMNS)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_stages_against_brute_force(spark, fixture):
    docs, out = fixture, {}
    for name, stage in cp.STAGES:
        result = stage(spark, docs, "")
        if name != "best_fit_packing":
            assert result.dtypes == docs.dtypes
        docs = out[name] = stored(result, f"test-{name}")

    before = rows_of(fixture)
    kept = rows_of(out["language_id"])
    gone = [r for r in before if r not in kept]
    assert gone and all(r[1] in ("Ж" * 400, "", None) for r in gone)

    groups = defaultdict(list)
    for r in kept:
        groups[re.sub("[ \t-\r]", "", r[1] or "")].append(r)
    exact = rows_of(out["exact_dedup"])
    assert len(exact) == len(groups)
    for same in groups.values():
        best = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        assert any((e[0], e[1]) == (best[0], best[1]) for e in exact)

    prints = [simhash(r[1]) for r in exact]
    near = [(i, j) for i in range(len(exact)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert near
    parts = defaultdict(list)
    for i, root in union(near, range(len(exact))).items():
        parts[root].append(exact[i])
    single = rows_of(out["simhash_near_dedup"])
    assert sorted(map(repr, single)) == sorted(repr(min(p, key=lambda r: (r[0] is None, r[0] or 0))) for p in parts.values())

    def clean(text):
        done, at = "", 0
        for start, kind, end in private_spans(text):
            if start >= at:
                done += text[at:start] + ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>")[kind]
            at = max(at, end)
        return done + text[at:]

    masked = rows_of(out["pii"])
    assert sorted((r[0] or -1, r[1]) for r in masked) == sorted((r[0] or -1, clean(r[1])) for r in single)
    assert sum(r[1] != s[1] for r, s in zip(sorted(masked, key=repr), sorted(single, key=repr))) >= 2

    whole = Tokenizer.from_str(tokenizer_definition())
    tokens = defaultdict(int)
    room = defaultdict(int)
    for r in out["best_fit_packing"].collect():
        tokens[r.doc_id] += r.length
        room[r.sequence_id] += r.length
    assert tokens == {r[0]: len(whole.encode(r[1], add_special_tokens=False).ids) + 1 for r in masked}
    assert max(room.values()) <= 4096 and len(room) == -(-sum(tokens.values()) // 4096)


def test_run_reads_the_table(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0.7 * documents < out.select("doc_id").distinct().count() <= documents


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), f"test-empty-{name}")
        assert docs.count() == 0


def test_names_and_stages():
    assert 4 <= len(cp.STAGES) <= 5 and cp.ORACLE_SQL is None
