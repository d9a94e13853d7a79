"""Near-duplicate documents by SimHash and a byte-position inverted index.

Equal fingerprints are one entry. Two fingerprints that differ in at most `distance`
bits differ in at most that many of their 8 bytes, so they share at least
`8 - distance` positional bytes. Each entry is indexed under every choice of
`8 - distance - 1` of its first 7 bytes: a pair with the guaranteed number of matches
meets under one of them at least. In a posting list the shared positional bytes of a
pair are counted, pairs below the guarantee go, and the bit distance is verified.

Posting lists give back a spanning forest of their links, not all pairs, and long lists
are dealt out in pairs of blocks: no list is gathered whole and no link is lost.

Defined cases: a null or blank text has fingerprint zero and links like any other; a
text with fewer words than a shingle is one shingle; repeated rows get equal answers;
null keys are never smallest unless a group has no other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import blocks_of, components, first_of, stored, whole_row

SEED = 42
BLOCK = 1024  # members of one block of a long posting list
_PART = 1 << 16  # shingles counted at a time


def simhash(text: bytes, shingle: int) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _PART):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _PART], ends[at:at + _PART])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """The fingerprint of a whole text as a long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = [simhash(x or b"", shingle) for x in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return of(text)


def _postings(distance: int) -> tuple[list[int], int]:
    """Byte masks that a posting key keeps, and the shared bytes a pair must reach."""
    least = 8 - distance
    masks = [sum(0xFF << (8 * p) for p in c) for c in combinations(range(7), least - 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks], least


def shared_bytes(x: Column) -> Column:
    """How many of the 8 positional bytes are equal, from the exclusive or of two entries."""
    return sum(
        (F.when(F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for p in range(8)),
        F.lit(0),
    )


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n indices."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        keep = label[left] != label[right]
        left, right = left[keep], right[keep]
    return label


def _links(entries: np.ndarray, lists: np.ndarray, least: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs of entries that stand in the same list; lists are runs."""
    found = [], []
    at = np.arange(len(entries))
    for step in range(1, len(entries)):
        at = at[at + step < len(entries)]
        at = at[lists[at] == lists[at + step]]
        if not len(at):
            break
        x = entries[at] ^ entries[at + step]
        shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = at[(shared >= least) & (np.bitwise_count(x) <= distance)]
        found[0].append(near)
        found[1].append(near + step)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in found)


def _list_links(least: int, distance: int):
    """Links inside sorted posting lists, as forest edges, a few lists at a time."""

    def edges(entries: np.ndarray, lists: np.ndarray) -> pa.RecordBatch:
        left, right = _links(entries, lists, least, distance)
        label = _forest(len(entries), left, right)
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = entries.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def key(batch, row):
            return tuple(batch.column(k)[row].as_py() for k in range(4))

        def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(rows).combine_chunks()
            if not table.num_rows:
                return
            cols = [table.column(k).to_numpy() for k in range(4)]
            change = np.zeros(table.num_rows, bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            yield edges(table.column(4).to_numpy().view(np.uint64).copy(), np.cumsum(change))

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and key(batch, 0) != key(held[-1], held[-1].num_rows - 1):
                yield from flush(held)
                held = []
            last, start = key(batch, batch.num_rows - 1), batch.num_rows
            same = np.ones(batch.num_rows, bool)
            for k in range(4):
                same &= batch.column(k).to_numpy() == last[k]
            start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if start:
                yield from flush([*held, batch.slice(0, start)])
                held = []
            held.append(batch.slice(start))
        if held:
            yield from flush(held)

    return run


def links(entries: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join the same fingerprints as all pairs within the distance.

    `entries` has distinct fingerprints in `fp`.
    """
    masks, least = _postings(distance)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])
    index = entries.select("fp", F.posexplode(keys).alias("position", "key"))
    lists = stored(
        index.groupBy("position", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"),
        "postings",
    )
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = lists.where("n = 2").where((shared_bytes(x) >= least) & (F.bit_count(x) <= distance)).select("a", "b")
    longer = lists.where("n > 2").select("position", "key", "n").hint("merge")  # one shape at every size
    long = index.join(longer, ["position", "key"])
    dealt = blocks_of(long, F.col("n"), F.col("fp"), block).select("position", "key", "_i", "_j", "fp")
    place = ["position", "key", "_i", "_j"]
    inside = (
        dealt.repartition(*place).sortWithinPartitions(*place)
        .mapInArrow(_list_links(least, distance), "a long, b long")
    )
    return pairs.union(inside).distinct()


def classes(rows: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each that has a link."""
    entries = stored(rows.select("fp").distinct(), "fingerprints")
    found = components(links(entries, distance))
    return found.select(F.col("node").alias("fp"), "root")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """(doc, fp, component): the carried columns of every row (all of them unless named,
    the key always) as a struct, its fingerprint and the smallest key of its component."""
    kept = df.columns if carry is None else [key, *(c for c in carry if c != key)]
    rows = stored(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), fingerprint(F.col(f"`{text}`"), shingle).alias("fp")
        ),
        "fingerprinted",
    )
    roots = stored(classes(rows, distance), "roots")
    smallest = rows.groupBy("fp").agg(F.min(f"doc.{key}").alias("low"))
    rooted = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    by_print = stored(rooted.join(lowest, "root").select("fp", "component"), "components")
    return rows.join(by_print, "fp")


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of `df` with one row of each component: the smallest key, then any one."""
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("row"), whole_row(df).alias("doc"),
            fingerprint(F.col(f"`{text}`"), shingle).alias("fp"),
        ),
        "fingerprinted",
    )
    roots = stored(classes(rows, distance), "roots")
    best = rows.groupBy("fp").agg(F.min(first_of(f"doc.{key}", "row")).alias("best"))
    rooted = best.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stay = rooted.groupBy("root").agg(F.min("best").alias("best"))
    drop = rows.select("row", "fp").join(
        stored(stay.select(F.col("best.v1").alias("row")), "stay"), "row", "left_anti"
    ).select("row")
    return rows.join(stored(drop, "drop"), "row", "left_anti").select("doc.*")
