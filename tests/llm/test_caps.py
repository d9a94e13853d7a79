from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from brute import union
from modelyard.llm import caps


def plain(rows, least=0.93):
    good = []
    for i, (key, vector, label) in enumerate(rows):
        ok = label is not None and vector is not None and all(v is not None and math.isfinite(v) for v in vector)
        good.append(ok and any(vector))
    pairs = []
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v, np.float32).astype(np.float64) for v in (a[1], b[1]))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    pairs.append((i, j))
    links = Counter(x for p in pairs for x in p)
    root = union(pairs, range(len(rows)))
    low = {}
    for i, r in root.items():
        if rows[i][0] is not None:
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], low.get(root[i])) for i in range(len(rows))), key=repr)


def run(spark, rows, **named):
    df = spark.createDataFrame([(k, v, lab, 1, "x") for k, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, n_links int, vector string")
    return sorted(((r.key, r.n_links, r.component) for r in caps.near_vectors(df, **named).collect()), key=repr)


def cloud(seed, centres, near, noise, dimension=64):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(centres):
        centre = rng.standard_normal(dimension)
        centre /= np.linalg.norm(centre)
        for _ in range(1 + near):
            v = centre + noise * rng.standard_normal(dimension) / math.sqrt(dimension)
            rows.append((len(rows) * 3, [float(x) for x in v.astype(np.float32)], c % 4))
    return rows


@pytest.mark.parametrize("centres, near, noise, block", [(150, 2, 0.25, 512), (2, 120, 0.22, 512), (3, 60, 0.25, 16)])
def test_against_all_pairs(spark, centres, near, noise, block):
    rows = cloud(centres, centres, near, noise)
    got, want = run(spark, rows, block=block), plain(rows)
    missed = sum(b[1] - a[1] for a, b in zip(got, want))
    assert all(a[1] <= b[1] for a, b in zip(got, want))
    assert missed <= 0.01 * sum(b[1] for b in want)
    assert sum(a[2] == b[2] for a, b in zip(got, want)) >= 0.99 * len(rows)


def test_defined_cases(spark):
    v = [1.0, 2.0, -1.0, 0.5]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, [2 * x for x in v], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0),
        (8, [0.0] * 4, 0), (9, [1.0, None, 1.0, 1.0], 0), (10, [math.nan, 1.0, 1.0, 1.0], 0), (11, [math.inf, 1.0, 1.0, 1.0], 0),
        (12, [1.0, 2.0, -1.0], 0), (13, [-x for x in v], 0), (None, v, 1), (None, [5.0, 1.0, 1.0, 1.0], 3),
        (14, [1e-30, 2e-30, -1e-30, 5e-31], 0), (15, [1e30, 2e30, -1e30, 5e29], 0), (16, [0.0, -0.0, 1.0, 0.0], 2), (17, [0.0, 0.0, 1.0, 0.0], 2),
    ]
    assert run(spark, rows) == plain(rows)


def test_a_vector_lists_exactly_the_filters_it_passes():
    rng = np.random.default_rng(3)
    for dimension, vectors in ((64, 100), (7, 5), (1, 3), (48, 3_000_000)):
        f = caps.filters(dimension, vectors, 16.0)
        if np.prod([len(w) for w in f.words]) > 2_000_000:
            f = caps.Filters(f.rotation, [w[:60] for w in f.words], 2.0)
        x = rng.standard_normal(dimension)
        x /= np.linalg.norm(x)
        turned, at, total = f.rotation @ x, 0, np.zeros(1)
        for words in f.words:
            s = words @ turned[at:at + words.shape[1]]
            at += words.shape[1]
            total = (total[:, None] + s[None, :]).ravel()
        assert sorted(f.passed(x).tolist()) == np.flatnonzero(total >= f.threshold).tolist()


def test_empty_table(spark):
    assert run(spark, []) == []
