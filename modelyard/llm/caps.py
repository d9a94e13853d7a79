"""Near-duplicate embeddings by spherical-cap filters of random product codes.

A filter is a direction; a vector passes it if their product reaches a threshold, that
is if it lies in the filter's cap. Directions are structured: a rotated vector is cut
into blocks, every block has its own random code words, and a filter is one word of each
block, whose products add up. All filters that a vector passes are listed without
touching the others: words of a block are sorted by their product, and a partial choice is
extended only while the best of the remaining blocks can still reach the threshold.

Vectors of a label that share a filter are compared exactly, in double precision. How
many filters there are follows from the number of vectors, so caps stay about equally
full at every size; a vector passes `PASSED` of them or more, which sets the recall.

Equal vectors are one class. A pair of classes counts in the smallest filter they share,
so nothing has to be made distinct; caps give back sums of links and spanning forests, not
pairs, and full caps are dealt out in pairs of blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a label, link with nothing; vectors of different lengths never link;
repeated rows are copies; a null key is never smallest unless a component has no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import blocks_of, components, stored
from .simhash import _forest

LEAST = 0.93  # cosine from which two vectors link
PASSED = 48.0  # filters that a vector passes, more or less by its place among the code words
FILL = 4.0  # filters for each filter that all vectors of the table pass
WORDS = 4096  # code words of a block at most; more filters take more blocks
BLOCK = 512
SEED = 20240607
STEP = 0.1  # by which the threshold falls for vectors that pass too few filters
_SMALL = 48  # caps up to this size are compared by shifts, larger ones by a product
_CHUNK = 8192  # members compared at a time


@dataclass(frozen=True)
class Filters:
    rotation: np.ndarray
    words: list[np.ndarray]
    threshold: float

    def passed(self, unit: np.ndarray, floor: int = 0) -> np.ndarray:
        """Numbers of all filters that a unit vector passes.

        The threshold is lowered in steps for a vector that passes fewer than `floor`: it
        lies far from all code words, and so do its neighbours, whose caps widen alike.
        """
        turned, at, scores = self.rotation @ unit, 0, []
        for words in self.words:
            scores.append(words @ turned[at:at + words.shape[1]])
            at += words.shape[1]
        orders = [np.argsort(-s) for s in scores]
        threshold = self.threshold
        while True:
            number = self._reaching(scores, orders, threshold)
            if len(number) >= min(floor, np.prod([float(len(s)) for s in scores])):
                return number
            threshold -= STEP

    @staticmethod
    def _reaching(scores: list[np.ndarray], orders: list[np.ndarray], threshold: float) -> np.ndarray:
        """Choices of one word per block whose scores add up to the threshold or more."""
        best = np.array([s[o[0]] for s, o in zip(scores, orders)])
        sums, number = np.zeros(1), np.zeros(1, np.int64)
        for k, (s, order) in enumerate(zip(scores, orders)):
            ranked = -s[order]  # ascending
            n = np.searchsorted(ranked, sums + best[k + 1:].sum() - threshold, side="right")
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            sums = np.repeat(sums, n) - ranked[at]
            number = np.repeat(number, n) * len(s) + order[at]
        return number


def filters(dimension: int, vectors: int, passed: float = PASSED, seed: int = SEED) -> Filters:
    """Filters for a table of so many vectors of one dimension."""
    wanted = max(256.0, FILL * passed * max(1, vectors))
    blocks = min(dimension, max(1, math.ceil(math.log(wanted) / math.log(WORDS))))
    each = math.ceil(wanted ** (1 / blocks))
    rng = np.random.default_rng([seed, dimension])
    rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    cuts = [len(x) for x in np.array_split(np.arange(dimension), blocks)]
    threshold = NormalDist().inv_cdf(1 - min(0.5, passed / each ** blocks))
    return Filters(rotation, [rng.standard_normal((each, n)) for n in cuts], threshold)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _decode(vectors: int, passed: float, seed: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Filters] = {}
        for batch in batches:
            lists = []
            for value in batch.column(1):
                x = value.values.to_numpy().astype(np.float64)
                if len(x) not in known:
                    known[len(x)] = filters(len(x), vectors, passed, seed)
                lists.append(known[len(x)].passed(_unit(x), round(passed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int64()))], names=["class", "filters"]
            )

    return of


def _linked(unit: np.ndarray, group: np.ndarray, half: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs within the runs of `group` whose cosine reaches `least`.

    A run that joins two blocks (half 1 and 2) has pairs across them only.
    """
    left, right = [], []
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(heads, len(group)))
    for head, size in zip(heads[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        part = slice(head, head + size)
        i, j = np.nonzero(np.triu(unit[part] @ unit[part].T >= least, 1))
        left.append(i + head)
        right.append(j + head)
    at = np.flatnonzero(np.repeat(sizes <= _SMALL, sizes))
    for step in range(1, _SMALL):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        near = at[np.einsum("ij,ij->i", unit[at], unit[at + step]) >= least]
        left.append(near)
        right.append(near + step)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    counts = (half[left] == 0) | (half[left] != half[right])
    return left[counts], right[counts]


def _first_shared(filter_: np.ndarray, lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a pair shares no smaller filter than the one it is found in."""
    keep = np.ones(len(left), bool)
    order = np.argsort(filter_[left], kind="stable")
    ends = np.append(np.flatnonzero(np.diff(filter_[left[order]])) + 1, len(order))
    begin = 0
    for end in ends.tolist():
        mine = order[begin:end]
        begin = end
        if not len(mine):
            continue
        f = filter_[left[mine[0]]]
        if len(mine) <= 64:
            for p in mine.tolist():
                a, b = lists[left[p]], lists[right[p]]
                keep[p] = not np.intersect1d(a[a < f], b[b < f], assume_unique=True).size
            continue
        members = np.unique(np.concatenate([left[mine], right[mine]]))
        smaller = [lists[m][lists[m] < f] for m in members.tolist()]
        used = np.unique(np.concatenate(smaller))
        has = np.zeros((len(members), max(1, len(used))), np.float32)
        for row, values in enumerate(smaller):
            has[row, np.searchsorted(used, values)] = 1
        a, b = np.searchsorted(members, left[mine]), np.searchsorted(members, right[mine])
        for part in range(0, len(mine), 1 << 16):
            s = slice(part, part + (1 << 16))
            keep[mine[s]] = ~np.einsum("ij,ij->i", has[a[s]], has[b[s]]).astype(bool)
    return keep


def _compare(least: float):
    """Links inside sorted caps: for a class, copies of the classes it links with, and the
    smallest class of its local component."""

    def batch(table: pa.Table) -> pa.RecordBatch:
        place = [table.column(k).to_numpy() for k in range(4)]
        change = np.zeros(table.num_rows, bool)
        for c in place:
            change[1:] |= c[1:] != c[:-1]
        group = np.cumsum(change)
        across = place[2] != place[3]
        half = np.where(across, 1 + (table.column(4).to_numpy() == place[3]), 0)
        ids, copies = table.column(5).to_numpy(), table.column(6).to_numpy()
        vectors = table.column(7).combine_chunks()
        unit = np.stack([v.values.to_numpy().astype(np.float64) for v in vectors])
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
        left, right = _linked(unit, group, half, least)
        lists = [v.values.to_numpy() for v in table.column(8).combine_chunks()] if len(left) else []
        keep = _first_shared(place[1], lists, left, right)
        left, right = left[keep], right[keep]
        links = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
        label = _forest(len(ids), left, right)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, label, ids)
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(low[label[at]])],
            names=["class", "links", "root"],
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole runs of one place go together, several at a time."""
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for rows in batches:
            if not rows.num_rows:
                continue
            place = [rows.column(k).to_numpy() for k in range(4)]
            new = np.zeros(rows.num_rows, bool)
            for p in place:
                new[1:] |= p[1:] != p[:-1]
            new[0] = last != [p[0] for p in place]
            last, begin = [p[-1] for p in place], 0
            for cut in np.flatnonzero(new).tolist():
                if size + cut - begin >= _CHUNK:
                    yield batch(pa.Table.from_batches([*held, rows.slice(begin, cut - begin)]))
                    held, size, begin = [], 0, cut
            held.append(rows.slice(begin))
            size += rows.num_rows - begin
        if held:
            yield batch(pa.Table.from_batches(held))

    return of


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST,
    passed: float = PASSED, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """(key, n_links, component): links and smallest reachable key of every row."""
    x = F.col(f"`{vector}`")
    good = (
        F.col(f"`{label}`").isNotNull() & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    )
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.when(good, F.col(f"`{label}`").cast("string")).alias("label"),
        F.when(good, x).alias("vector"),
    )
    found = stored(
        rows.where("vector is not null").groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("low"))
        .withColumn("class", F.monotonically_increasing_id()).withColumn("size", F.size("vector")),
        "vector-classes",
    )
    kinds = stored(found.groupBy("label", "size").agg(F.min("class").alias("within")), "vector-kinds")
    classes = stored(found.join(kinds, ["label", "size"]).drop("size"), "vector-classes")
    n = classes.count()
    listed = stored(
        classes.select("class", "vector").mapInArrow(_decode(n, passed, seed), "class long, filters array<long>"),
        "vector-filters",
    )
    flat = listed.join(classes.select("class", "within"), "class").select("class", "within", F.explode("filters").alias("filter"))
    caps = stored(flat.groupBy("within", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "caps")
    shared = flat.join(caps, ["within", "filter"]).groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("filter", "n"))).alias("caps")  # at most what one vector passes
    )
    members = stored(shared.join(classes, "class"), "cap-members").select(
        "class", "copies", "vector", "within", F.col("caps.filter").alias("filters"), F.explode("caps").alias("cap")
    )
    dealt = blocks_of(members, F.col("cap.n"), F.col("class"), block).select(
        "within", F.col("cap.filter").alias("filter"), "_i", "_j", "_mine", "class", "copies", "vector", "filters"
    )
    place = ["within", "filter", "_i", "_j"]
    found = stored(
        dealt.repartition(*place).sortWithinPartitions(*place)
        .mapInArrow(_compare(least), "class long, links long, root long"),
        "vector-links",
    )
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    whole = stored(
        classes.select("class", "label", "vector", "copies", "low").join(links, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class")),
        "vector-components",
    )
    lowest = whole.groupBy("root").agg(F.min("low").alias("component"))
    answers = stored(
        whole.join(lowest, "root").select(
            "label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component"
        ),
        "vector-answers",
    )
    return rows.join(answers, ["label", "vector"], "left").select(
        "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component")).alias("component"),
    )
