"""Packing of tokenised documents into fixed-length sequences by a configuration program.

Documents become token ids in batches; longer ones are cut into full pieces and a rest.
How many pieces have which length is a histogram of at most as many entries as a sequence
has tokens, whatever the size of the corpus. On it the configuration linear program
(fewest sequences, each a multiset of lengths that fits, covering the histogram) is solved
by multiplicative weights: a dynamic program over the knapsack finds the multisets of the
highest total price, they are given as much weight as their share and the open demand
allow, and the prices of what they cover fall, until the weights cover all but a hundredth
of the demand. Prices of few lengths move fast and in small steps, which decides between
patterns that are worth the same; those of many lengths move slowly, as there the volume
is close to the optimum. Any prices give a bound from below: what the demand costs by
them, over the best pattern's price. Rounding takes the whole part of every weight and
places the remaining counts best-fit, longest first, into groups of equal sequences.

The solution is a list of patterns with multiplicities; a pattern covers a share of some
length's demand, so there are some for each length, however large the data. A piece finds
its place from its rank among pieces of its length by binary search in that list. Ranks
come from counts per chunk of rows, so a length that a third of all pieces share is never
ranked in one task.

Defined cases: null is an empty text, which is its end id alone; repeated rows are packed
as often as they stand; an empty table has no pieces.
"""

from __future__ import annotations

import bisect
import itertools
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from tokenizers import Tokenizer

from .common import stored, whole_row

LENGTH = 4096
END = 1
RATE = (0.25, 50.0)  # least and greatest fall of prices with the share of demand that is covered
PACE = 1000  # the rate times the number of lengths, between these
STEP = 0.25  # the rate times the share of a length's demand that a pattern covers at a time
TAIL = 0.01  # share of the tokens that is left to best fit
SLACK = 0.05  # how much less than the best a pattern may be worth
LONG_FIRST = 1.05  # first prices are lengths to this power, so long pieces are served first
_BLOCK = 64  # rooms of the knapsack found together
_CHUNK_BITS = 16  # rows of a partition ranked together, as a power of two
_WORDS = 1_000_000  # words whose ids a task keeps; more are looked up anew
_SLICE = 500_000  # words coded at a time
_BYTES = 8 << 20  # text whose words are looked up together
_PUNCTUATION = string.punctuation.encode()


class WordIds:
    """Token ids of words between ASCII white space, from the ids of their parts.

    The tokenizer's own splitter joins no characters across white space, and no letters with
    what follows them, so the ids of a text are those of its words one after the other, and
    those of letters with ASCII punctuation behind them are the letters' and the
    punctuation's. Letters are stored in the lower case that the tokenizer gives them; a
    word of any other form is stored as it is.
    """

    def __init__(self, definition: str) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {b"": 0}
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.empty(8192, np.uint32), 0

    def _add(self, parts: list[bytes]) -> None:
        """Store new parts; lower-case ASCII letters are the model's own symbols already."""
        model = self.tokenizer.model
        plain = [x.isalpha() and x.islower() for x in parts]
        others = iter(self.tokenizer.encode_batch_fast(
            [x.decode("utf-8", "replace") for x, p in zip(parts, plain) if not p], add_special_tokens=False
        ))
        ids = [
            [t.id for t in model.tokenize(x.decode())] if p else next(others).ids for x, p in zip(parts, plain)
        ]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        n, total = len(self.known), self.used + int(counts.sum())
        if n + len(parts) > len(self.first):
            self.first, self.count = (np.resize(x, 2 * (n + len(parts))) for x in (self.first, self.count))
        if total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * total)
        self.flat[self.used:total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total - self.used)
        self.count[n:n + len(parts)] = counts
        self.first[n:n + len(parts)] = self.used + np.cumsum(counts) - counts
        self.used = total
        self.known.update(zip(parts, range(n, n + len(parts))))

    def _parts(self, words: list[bytes]) -> np.ndarray:
        """Entries of two parts for each word; the second may be the empty one."""
        if len(self.known) > _WORDS:
            self.clear()
        parts: list[bytes] = []
        for word in words:
            core = word.rstrip(_PUNCTUATION)
            if core.isalpha() or (not core.isascii() and core.decode("utf-8", "replace").isalpha()):
                parts += core.lower(), word[len(core):]
            else:
                parts += word, b""
        known = self.known
        new = [x for x in dict.fromkeys(parts) if x not in known]
        if new:
            self._add(new)
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)).reshape(-1, 2)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; words that texts share are looked up once, long texts go in slices."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        parts = self._parts(words.dictionary.cast(pa.binary()).to_pylist())
        flat = _gathered(self.flat, self.first[parts.ravel()], self.count[parts.ravel()])
        count = self.count[parts].sum(axis=1)
        first = np.cumsum(count) - count
        at, found, ends = words.indices.to_numpy(), [], [np.zeros(1, np.int64)]
        for begin in range(0, len(at), _SLICE):
            of = at[begin:begin + _SLICE]
            many = count[of]
            found.append(_gathered(flat, first[of], many))
            ends.append(ends[-1][-1] + np.cumsum(many))
        out = np.concatenate(found) if found else np.empty(0, np.uint32)
        offsets = split.offsets.to_numpy()
        bounds = np.concatenate(ends)[offsets - offsets[0]]
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `first` and have `count` entries, one after the other."""
    upto = np.cumsum(count)
    shift = (first - upto + count).astype(np.int32)
    return flat[np.repeat(shift, count) + np.arange(upto[-1] if len(upto) else 0, dtype=np.int32)]


_LOADED: dict[str, WordIds] = {}


def word_ids(definition: str) -> WordIds:
    """One per worker process, with the words it knows already."""
    if definition not in _LOADED:
        _LOADED.clear()
        _LOADED[definition] = WordIds(definition)
    return _LOADED[definition]


def _cut(definition, length: int, end: int, width: int):
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        docs = pa.concat_arrays([r[0] for r in rows])
        return pa.RecordBatch.from_arrays(
            [docs, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds, 1))],
            names=["doc", "piece", "start", "length", "ids_crc32", "ids"],
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size = word_ids(definition.value), [], 0
        for docs, texts in _joined(batches):
            for i, ids in enumerate(coder.ids(texts)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), length)):
                    part = ids[start:start + length]
                    kept = part.astype(f"<u{width}").tobytes() if width else None
                    held.append((docs.slice(i, 1), k, start, len(part), zlib.crc32(part.tobytes()), kept))
                    size += len(part)
                if size >= 500_000 or len(held) >= 2000:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    return of


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of as many batches as hold `_BYTES` together."""
    held, size = [], 0
    for rows in batches:
        held.append(rows)
        size += rows.nbytes
        if size >= _BYTES:
            yield pa.concat_arrays([r.column(0) for r in held]), pa.concat_arrays([r.column(1).fill_null("") for r in held])
            held, size = [], 0
    if held:
        yield pa.concat_arrays([r.column(0) for r in held]), pa.concat_arrays([r.column(1).fill_null("") for r in held])


def pieces(
    df: DataFrame, definition: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
    width: int = 4,
) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, ids): pieces of at most `length` tokens. The
    checksum is of the ids as little-endian unsigned 32-bit numbers; `ids` holds them as
    numbers of `width` bytes, 2 of which are enough for a vocabulary below 65,536, or is
    null if `width` is 0."""
    if width not in (0, 4) and not (width == 2 and Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16):
        raise ValueError(f"ids do not fit into {width} bytes")
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(definition)
    return df.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text")).mapInArrow(
        _cut(shared, length, end, width), f"doc {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    )


# --- the program over the histogram ------------------------------------------


def _values(prices: np.ndarray, length: int) -> np.ndarray:
    """Highest total price of a multiset of lengths, for every room up to `length`.

    Rooms are taken in blocks. The piece that crosses into a block is found for the whole
    block at once; what follows it inside the block are lengths below the block's width.
    """
    value, few = np.zeros(length + 1 + _BLOCK), min(_BLOCK, length + 1)
    for w in range(1, few):
        value[w] = max(value[w - 1], (prices[1:w + 1] + value[w - 1::-1][:w]).max())
    inside = np.full((_BLOCK, _BLOCK), -np.inf)
    for w in range(few):
        inside[w:few, w] = value[:few - w]
    turned = np.concatenate([np.zeros(_BLOCK), prices[::-1]])  # the price of l is at the end less l
    step, sums = turned.itemsize, np.empty(_BLOCK * (length // 2 + 1))
    for s in range(_BLOCK, length + 1, _BLOCK):
        half = s // 2  # longest first, a piece is no longer than what is before it, if anything is
        n = s - half
        crossing = np.lib.stride_tricks.as_strided(turned[len(turned) - 1 - n:], (_BLOCK, n), (-step, step))
        added = np.add(crossing, value[half:s], out=sums[:_BLOCK * n].reshape(_BLOCK, n)).max(axis=1)
        alone = prices[s:s + _BLOCK]
        np.maximum(added[:len(alone)], alone, out=added[:len(alone)])
        value[s:s + _BLOCK] = (inside + added).max(axis=1)
    return value[:length + 1]


class _Pricing:
    """The knapsack table of some prices, and the multisets that attain it."""

    def __init__(self, prices: np.ndarray, length: int) -> None:
        self.prices, self.value = prices, _values(prices, length)
        self.taken: dict[int, int] = {}

    def pattern(self, room: int) -> list[int]:
        out = []
        while room > 0 and self.value[room] > 0:
            if room not in self.taken:
                self.taken[room] = int(np.argmax(self.prices[1:room + 1] + self.value[room - 1::-1][:room])) + 1
            l = self.taken[room]
            if self.prices[l] > 0:
                out.append(l)
            room -= l
        return out


def best_pattern(prices: np.ndarray, length: int) -> list[int]:
    """The lengths of the most valuable multiset that fits; prices[l] is of length l."""
    return _Pricing(prices, length).pattern(length)


def fractional(
    demand: dict[int, int], length: int, turns: int | None = None
) -> tuple[list[tuple[Counter, float]], float]:
    """Patterns with weights of the configuration program, by multiplicative weights, and the
    best bound from below that its prices give.

    A turn solves the knapsack once and takes, for the open lengths in the order of what a
    sequence with them is worth, the best pattern with that length while its total price is
    within `SLACK` of the turn's best. Prices only fall, so all of these are nearly best
    when they are taken. Turns go on until the weights cover all but `TAIL` of the tokens,
    unless the caller states a number of them.
    """
    open_ = np.zeros(length + 1)
    for l, n in demand.items():
        open_[l] = n
    total, tokens = open_.copy(), np.arange(length + 1)
    volume = float(tokens @ total)
    prices = (tokens / length) ** LONG_FIRST * (open_ > 0)
    rate = float(np.clip(PACE / max(1, len(demand)), *RATE))
    share, bound = min(1.0, STEP / rate), volume / length
    found: dict[tuple, float] = {}
    for _ in itertools.count() if turns is None else range(turns):
        pricing = _Pricing(prices.copy(), length)
        best = float(pricing.value[length])
        if best <= 0 or tokens @ open_ < TAIL * volume:
            break
        bound = max(bound, float(prices @ total) / best)
        least = (1 - SLACK) * best
        lengths = np.flatnonzero(prices)
        worth = prices[lengths] + pricing.value[length - lengths]
        lengths, worth = lengths[worth >= least], worth[worth >= least]
        for l in lengths[np.argsort(-worth, kind="stable")].tolist():
            pattern = Counter([l, *pricing.pattern(length - l)])
            if sum(prices[x] * a for x, a in pattern.items()) < least:
                continue
            step = min(
                min(open_[x] / a for x, a in pattern.items()), max(1.0, share * min(total[x] / a for x, a in pattern.items()))
            )
            if step > 1:
                step = float(int(step))  # whole sequences lose nothing in rounding
            key = tuple(sorted(pattern.items()))
            found[key] = found.get(key, 0.0) + step
            for x, a in pattern.items():
                open_[x] -= a * step
                prices[x] *= np.exp(-rate * a * step / total[x])
                if open_[x] < 1e-9:
                    open_[x] = prices[x] = 0.0
    return [(Counter(dict(k)), x) for k, x in found.items()], bound


def best_fit(demand: dict[int, int], length: int) -> list[tuple[Counter, int]]:
    """Longest first, each into the fullest sequence that has room; equal sequences are one group."""
    groups: dict[int, list[tuple[Counter, int]]] = {}  # by free room
    rooms: list[int] = []

    def put(pattern: Counter, count: int, room: int) -> None:
        if count:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((pattern, count))

    for l in sorted((l for l, n in demand.items() if n), reverse=True):
        n = demand[l]
        while n:
            at = bisect.bisect_left(rooms, l)
            if at < len(rooms):
                room = rooms[at]
                pattern, count = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room, pattern, count = length, Counter(), n
            each = room // l
            full, rest = min(count, n // each), 0
            put(pattern + Counter({l: each}), full, room - each * l)
            n -= full * each
            if full < count and n:
                rest = 1
                put(pattern + Counter({l: n}), 1, room - n * l)
                n = 0
            if pattern:
                put(pattern, count - full - rest, room)
    return [g for held in groups.values() for g in held]


def solve(histogram: dict[int, int], length: int = LENGTH, turns: int | None = None) -> list[tuple[Counter, int]]:
    """Patterns with whole multiplicities that hold exactly the histogram."""
    left = Counter({l: n for l, n in histogram.items() if n})
    planned, rest = rounded(left, length, turns)
    return planned + best_fit(rest, length)


def rounded(
    demand: dict[int, int], length: int = LENGTH, turns: int | None = None
) -> tuple[list[tuple[Counter, int]], Counter]:
    """The program's patterns with whole multiplicities, and the demand that rounding leaves."""
    left, done = Counter(demand), []
    for pattern, x in sorted(fractional(left, length, turns)[0], key=lambda p: -p[1]):
        whole = min([int(x + 1e-9), *(left[l] // a for l, a in pattern.items())])
        if whole:
            done.append((pattern, whole))
            for l, a in pattern.items():
                left[l] -= a * whole
    return done, left


def slots(solution: list[tuple[Counter, int]], length: int) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, as sorted runs of ranks.

    The run that begins at rank `start` of length l belongs to `many` equal sequences from
    `sequence` on; its pieces lie at `offset` and every l tokens after.
    """
    taken: Counter = Counter()
    rows, sequence = [], 0
    for pattern, many in solution:
        offset = 0
        for l, a in sorted(pattern.items(), reverse=True):
            rows.append((l, taken[l], many, sequence, offset))
            taken[l] += a * many
            offset += a * l
        sequence += many
    rows.sort()
    names = ("length", "start", "many", "sequence", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def _place(where):
    names = ["sequence_id", "offset"]

    def of(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        w = where.value
        l, r = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lengths, ranks))
        at = np.searchsorted((w["length"] << 48) + w["start"], (l << 48) + r, side="right") - 1
        copy, which = np.divmod(r - w["start"][at], w["many"][at])
        return pa.StructArray.from_arrays(
            [pa.array(w["sequence"][at] + which), pa.array(w["offset"][at] + copy * l)], names=names
        )

    return F.arrow_udf(of, "sequence_id long, offset long")


def packed(df: DataFrame, length: int = LENGTH, size: str = "length", turns: int | None = None) -> DataFrame:
    """(doc, sequence_id, offset): every row as a struct with its place; `df` is a stored
    table whose column `size` holds lengths from 1 to `length`."""
    spark = df.sparkSession
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{size}`").cast("long").alias("length"),
            whole_row(df).alias("doc"),
        ),
        "lengths",
    )
    chunk = F.shiftright("row", _CHUNK_BITS).alias("chunk")
    counts = stored(rows.groupBy(chunk, "length").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if not histogram:
        empty = rows.select("doc", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
        return empty.where("false")
    if max(histogram) > length or min(histogram) < 1:
        raise ValueError(f"lengths must lie between 1 and {length}")
    where = spark.sparkContext.broadcast(slots(solve(histogram, length, turns), length))
    upto = W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    before = stored(
        counts.select("chunk", "length", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")), "length-ranks"
    )
    inside = F.row_number().over(W.partitionBy("chunk", "length").orderBy("row")) - 1
    ranked = rows.select("*", chunk).join(before.hint("merge"), ["chunk", "length"]).withColumn("rank", F.col("before") + inside)
    return ranked.select("doc", _place(where)("length", "rank").alias("at")).select("doc", "at.*")


