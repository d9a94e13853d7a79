"""Repeated word windows by super-k-mer partitioning, and their removal.

A window is `WINDOW` consecutive words. Its minimiser is the smallest hash among its runs
of `RUN` words. Consecutive windows with one minimiser form a super-k-mer, which travels
as one packed string of its words to the bucket of the minimiser, so that equal windows
always meet. A bucket unpacks its strings, sorts the window hashes, compares the words
themselves inside each run of equal hashes, and marks every window whose words also
start earlier, in the order of key and start.

Before anything travels, each batch of documents sorts its own windows the same way: a
repeat inside the batch is marked at once and does not travel, so a passage that a third
of all documents share leaves each batch once. A minimiser with more windows than two
buckets should hold is split: its windows travel one by one to the bucket of their own
hash. A first pass finds these: a bin of minimisers with twice a bucket's share of all
windows has at least half of them in tasks where it has one bucket's share, so tasks
report such bins only. Buckets follow the size of the input, and a task holds one
bucket at a time.

Defined cases: null is an empty text; rows that share a key are read as one document, in
which only a smaller start is earlier, so repeated rows get equal answers; a null key
comes after all others; a text with fewer words than a window keeps all its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

WINDOW = 20
RUN = 4  # words hashed together for a minimiser
BUCKET_BYTES = 4 << 20  # source text whose windows one bucket holds on average
BINS = 64  # bins of minimisers counted for each bucket
HOT_BINS = 1_000_000  # at most so many bins are split, which bounds what is broadcast
_BATCH = 4 << 20  # bytes of text whose windows are sorted together before they travel
_SEGMENT = 100_000  # windows of a long document taken at a time
_LAST = (1 << 63) - 1  # stands for a null key

_MULTIPLIER = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """Places, lengths and hashes of the words of a byte string, without an object per word."""

    def __init__(self, text: bytes) -> None:
        self.text = text
        data = np.frombuffer(text + bytes(8), np.uint8)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        space[len(text):] = True
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            turn = np.concatenate([[0], turn])
        self.start, self.length = turn[0::2], turn[1::2] - turn[0::2]
        # eight bytes from every place on, read where they lie
        self.eight = np.ndarray((len(text) + 1,), "<u8", data, 0, (1,))
        self.hash = self._hashes()

    def _part(self, words: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 8 of some words longer than 8k, zeros after their end."""
        left = np.minimum(self.length[words] - 8 * k, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8))
        return self.eight[self.start[words] + 8 * k] & mask

    def _hashes(self) -> np.ndarray:
        out, words, k = self.length.astype(np.uint64), np.arange(len(self.start)), 0
        while len(words):
            out[words] = _mixed((out[words] ^ self._part(words, k)) * np.uint64(_MULTIPLIER))
            k += 1
            words = words[self.length[words] > 8 * k]
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a[i] and b[i] are the same bytes."""
        same = self.length[a] == self.length[b]
        at, k = np.flatnonzero(same), 0
        while len(at):
            same[at] = self._part(a[at], k) == self._part(b[at], k)
            k += 1
            at = at[same[at] & (self.length[a[at]] > 8 * k)]
        return same


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, by Horner's rule."""
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    for t in range(size):
        out = out * np.uint64(_MULTIPLIER) + hashes[t:t + n]
    return _mixed(out)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _later(
    words: _Words, at: np.ndarray, key: np.ndarray, hashes: np.ndarray, window: int, mark: np.ndarray | None = None
) -> tuple:
    """Marks among the windows that begin at the words `at`.

    Returns (later, first): a window is later if equal words have a smaller key, and
    first marks one window of each distinct word sequence, with the smallest key; given
    the text marks, one of each text that has it at that key.
    """
    later, first = np.zeros(len(at), bool), np.zeros(len(at), bool)
    todo = np.argsort(hashes)
    while len(todo):
        h = hashes[todo]
        new = np.ones(len(todo), bool)
        new[1:] = h[1:] != h[:-1]
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        low = np.minimum.reduceat(key[todo], heads)
        lowest = np.flatnonzero(key[todo] == low[group])
        head = np.full(len(heads), -1)
        head[group[lowest][::-1]] = todo[lowest][::-1]
        other = np.flatnonzero(todo != head[group])
        mine, theirs = at[todo[other]], at[head[group[other]]]
        same = np.ones(len(other), bool)
        for t in range(window):
            still = np.flatnonzero(same)
            same[still] = words.equal(mine[still] + t, theirs[still] + t)
        later[todo[other[same]]] = key[todo[other[same]]] > low[group[other[same]]]
        first[head] = True
        if mark is not None:
            tied = other[same][key[todo[other[same]]] == low[group[other[same]]]]
            tied = tied[mark[todo[tied]] != mark[head[group[tied]]]]
            texts = np.stack([group[tied], mark[todo[tied]]])
            first[todo[tied[np.unique(texts, axis=1, return_index=True)[1]]]] = True
        todo = todo[other[~same]]  # equal hashes of unequal words: sort these again
    return later, first


def _ranges(marked: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of marked consecutive windows: positions of their first window, and lengths."""
    at = np.flatnonzero(marked)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]]) | (start[at[1:]] != start[at[:-1]] + 1)
    heads = np.flatnonzero(new)
    return at[heads], np.diff(np.append(heads, len(at)))


class _Batch:
    """Windows of some texts, given as (doc, mark, first word, bytes)."""

    def __init__(self, texts: list[tuple], window: int, run: int) -> None:
        self.words = words = _Words(b"\n".join([t[3] for t in texts]))
        sizes = np.fromiter((len(t[3]) for t in texts), np.int64, len(texts))
        bounds = np.searchsorted(words.start, np.append(0, np.cumsum(sizes + 1)))
        counts = np.maximum(np.diff(bounds) - window + 1, 0)
        self.segment = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.at = within + bounds[self.segment]
        self.doc = np.array([t[0] for t in texts], np.int64)[self.segment]
        self.text = np.array([t[1] for t in texts], np.int64)[self.segment]
        self.start = within + np.array([t[2] for t in texts], np.int64)[self.segment]
        if len(self.at):
            self.hash = _runs(words.hash, window)[self.at]
            self.minimiser = _mixed(_sliding_min(_runs(words.hash, run), window - run + 1)[self.at] ^ np.uint64(run))
        else:
            self.hash = self.minimiser = np.empty(0, np.uint64)
        rank = np.unique(self.doc, return_inverse=True)[1]
        self.key = (rank.astype(np.int64) << 32) | self.start


def _batches(rows: Iterator[pa.RecordBatch], window: int, run: int) -> Iterator[_Batch]:
    """Rows of (key, text hash, text) as batches of about equally many bytes."""
    held, size = [], 0
    for batch in rows:
        docs, marks, texts = (batch.column(i) for i in range(3))
        for doc, mark, text in zip(docs.to_pylist(), marks.to_pylist(), texts.cast(pa.binary()).to_pylist()):
            for start, part in _parts(text or b"", window):
                held.append((doc, mark, start, part))
                size += len(part)
                if size >= _BATCH:
                    yield _Batch(held, window, run)
                    held, size = [], 0
    if held:
        yield _Batch(held, window, run)


def _parts(text: bytes, window: int) -> Iterator[tuple[int, bytes]]:
    """A long text in parts that share a window less one word, each with its first word."""
    if len(text) <= _BATCH:
        yield 0, text
        return
    words = text.split()
    for start in range(0, max(1, len(words) - window + 1), _SEGMENT):
        yield start, b" ".join(words[start:start + _SEGMENT + window - 1])


def _heavy_bins(bins: int, buckets: int, window: int, run: int):
    """Of a task, the bins that hold at least one bucket's share of its windows, and in bin
    -1 all its windows; no more rows than buckets, mostly none but the last."""

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in _batches(rows, window, run):
            found, where = np.unique(
                np.concatenate([found, (b.minimiser % np.uint64(bins)).astype(np.int64)]), return_inverse=True
            )
            n = np.bincount(where, np.concatenate([n, np.ones(len(b.at), np.int64)])).astype(np.int64)
        heavy = n * buckets >= n.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found[heavy], -1)), pa.array(np.append(n[heavy], n.sum()))], names=["bin", "n"]
        )

    return of


_PARCEL = pa.schema([
    ("bucket", pa.int64()), ("doc", pa.list_(pa.int64())), ("mark", pa.list_(pa.int64())),
    ("start", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("packed", pa.binary()),
])


def _pack(buckets: int, bins: int, hot, window: int, run: int):
    """Parcels of super-k-mers by bucket; a parcel without a string brings marks along."""

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        split = np.array(sorted(hot.value), np.uint64)
        for b in _batches(rows, window, run):
            later, first = _later(b.words, b.at, b.key, b.hash, window, b.text)
            parcels: list[tuple] = []
            at, n = _ranges(later, b.doc, b.start)
            if len(at):
                home = zlib.crc32(b.doc[at[:1]].tobytes()) % buckets
                parcels.append((home, b.doc[at], b.text[at], b.start[at], n, None))
            alone = np.isin(b.minimiser % np.uint64(bins), split)
            bucket = (np.where(alone, b.hash, b.minimiser) % np.uint64(buckets)).astype(np.int64)
            go = np.flatnonzero(first)
            new = np.ones(len(go), bool)
            if len(go):
                here, before = go[1:], go[:-1]
                new[1:] = (
                    (here != before + 1) | (b.segment[here] != b.segment[before])
                    | (b.minimiser[here] != b.minimiser[before]) | alone[here]
                )
            heads = np.flatnonzero(new)
            size = np.diff(np.append(heads, len(go)))
            lead = go[heads]
            order = np.argsort(bucket[lead], kind="stable")
            lead, size = lead[order], size[order]
            ends = np.append(np.flatnonzero(np.diff(bucket[lead])) + 1, len(lead)) if len(lead) else []
            begin, words, text = 0, b.words, b.words.text
            last = words.start + words.length
            for end in ends:
                mine, many = lead[begin:end], size[begin:end]
                first_byte, last_byte = words.start[b.at[mine]], last[b.at[mine] + many + window - 2]
                strings = b" ".join([text[i:j] for i, j in zip(first_byte.tolist(), last_byte.tolist())])
                parcels.append((
                    int(bucket[mine[0]]), b.doc[mine], b.text[mine], b.start[mine], many, squeeze.compress(strings)
                ))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in parcels], f.type) for k, f in enumerate(_PARCEL)], schema=_PARCEL
            )

    return of


_MARKS = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def _bucket_marks(parcels: list[dict], window: int) -> pa.RecordBatch:
    """Runs of later windows of one bucket."""
    loose = zstandard.ZstdDecompressor()
    words = _Words(b" ".join([loose.decompress(p["packed"]) for p in parcels]))
    doc, mark, start, n = (np.concatenate([p[c] for p in parcels]) for c in ("doc", "mark", "start", "n"))
    strings = n + window - 1
    counts, offsets = strings - window + 1, np.cumsum(strings) - strings
    string = np.repeat(np.arange(len(strings)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = within + offsets[string]
    rank = np.unique(doc, return_inverse=True)[1].astype(np.int64)
    key = (rank[string] << 32) | (start[string] + within)
    later, _ = _later(words, at, key, _runs(words.hash, window)[at], window)
    lead, many = _ranges(later, string, within)
    of = string[lead]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (doc[of], mark[of], start[of] + within[lead], many)], schema=_MARKS
    )


def _unpack(window: int):
    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in rows:
            buckets, packed = batch.column(0).to_pylist(), batch.column(5)
            for i in range(batch.num_rows):
                lists = {f.name: batch.column(k)[i].values for k, f in enumerate(_PARCEL) if k in (1, 2, 3, 4)}
                if not packed[i].is_valid:
                    yield pa.RecordBatch.from_arrays([lists[f.name] for f in _MARKS], schema=_MARKS)
                    continue
                if held and held[-1]["bucket"] != buckets[i]:
                    yield _bucket_marks(held, window)
                    held = []
                held.append({"bucket": buckets[i], "packed": packed[i].as_py()} | {k: v.to_numpy() for k, v in lists.items()})
        if held:
            yield _bucket_marks(held, window)

    return of


def later_windows(
    df: DataFrame, window: int = WINDOW, run: int = RUN, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(doc, mark, start, n): runs of n windows from `start` on whose words start earlier elsewhere.

    `df` has the long `doc`, the long `mark` that tells texts of one key apart, and `text`.
    """
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    bins = BINS * buckets
    counts = stored(
        df.mapInArrow(_heavy_bins(bins, buckets, window, run), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")),
        "minimiser-bins",
    )
    total = counts.where("bin = -1").agg(F.sum("n")).first()[0] or 0
    limit = max(total / buckets, total / HOT_BINS)
    found = counts.where((F.col("bin") >= 0) & (F.col("n") >= limit)).select("bin").collect()
    hot = spark.sparkContext.broadcast([r.bin for r in found])
    parcels = df.mapInArrow(
        _pack(buckets, bins, hot, window, run),
        "bucket long, doc array<long>, mark array<long>, start array<long>, n array<long>, packed binary",
    )
    return (
        parcels.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_unpack(window), "doc long, mark long, start long, n long")
    )


def without_later_windows(text: Column, ranges: Column, window: int = WINDOW) -> Column:
    """Struct (n_words, n_removed, kept): the words that no later window covers."""

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def of(texts: pa.Array, marks: pa.Array) -> pa.Array:
        found = []
        for value, runs in zip(texts.cast(pa.binary()), marks.to_pylist()):
            words = (value.as_py() or b"").split()
            n, gone = len(words), 0
            if runs:
                stay = np.ones(n, bool)
                for r in runs:
                    stay[r["start"]:r["start"] + r["n"] + window - 1] = False
                gone = n - int(stay.sum())
                words = [words[i] for i in np.flatnonzero(stay).tolist()]
            found.append((n, gone, b" ".join(words)))
        kept = pa.array([x[2] for x in found], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), kept],
            names=["n_words", "n_removed", "kept"],
        )

    return of(text, ranges)


def substring_dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES, run: int = RUN,
) -> DataFrame:
    """(key, n_words, n_removed, kept): every row with its text after the removal."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"),
    )
    marks = later_windows(rows.select("doc", "mark", "text"), window, run, bucket_bytes)
    ranges = stored(
        marks.distinct().groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "n")).alias("ranges")),
        "later-windows",
    )
    return rows.join(ranges, ["doc", "mark"], "left").select(
        "key", without_later_windows(F.col("text"), F.col("ranges"), window).alias("of")
    ).select("key", "of.*")
