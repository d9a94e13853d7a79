"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

The lattice of a text has a node between any two characters and an arc for every piece of
the vocabulary that fits, with a weight that falls with the piece's rank; a character
that no piece covers has one arc, its bytes. Forward filtering sums the weights of all
paths to each node; backward sampling walks from the end and draws the arc that enters
each node in proportion to what reaches it, so a segmentation is drawn with exactly its
share of the total weight.

No piece holds a line break, a blank mark after another character, or a symbol after a
letter or digit (verified when a vocabulary is loaded), so every path passes the nodes in
between. The lattice of a text is therefore a chain of word lattices: each word's forward sums are computed once per task, and the backward walks of
all words of a batch take their steps together.

Draws are a counter-based hash of seed, row key, word and step: the same row gets the
same segmentation in any batch, partition or run. Decoding joins the pieces and bytes and
returns the text unchanged, whatever characters it holds.

Defined cases: null stays null; an empty text has no ids; a literal blank mark is encoded
as bytes; rows with a null key share one stream of draws; repeated rows are equal.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, functions as F

BLANK = "▁"
_LITERAL = "\ud800"  # stands for a literal blank mark; no valid text holds it
SPREAD = 0.3  # exponent of piece weights: 0 draws all paths alike, large ones prefer merges
_DEL = 127
_KNOWN = 400_000  # words whose lattices a task keeps
# A word is blanks, then symbols, then letters and digits; no piece goes on from a letter
# or digit to a symbol or a blank.
_SYMBOL = f"(?:[^\\w{BLANK}\n]|[_²])"
_WORD = re.compile(f"\n|{BLANK}*{_SYMBOL}*[^\\W_²]+|{BLANK}*{_SYMBOL}+|{BLANK}+")
_CROSSES = re.compile(f"\n|[^\\W_²](?:\\W|[_²])|[^{BLANK}]{BLANK}")
_BATCH = 40_000  # words whose walks step together


class Vocabulary:
    """Pieces of a SentencePiece model as a trie in arrays, and the ids of single bytes."""

    def __init__(self, model: bytes, spread: float = SPREAD) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte_ids, self.bytes_of = np.zeros(256, np.uint32), [b""] * sp.get_piece_size()
        self.letters: dict[str, int] = {}
        steps: dict[int, int] = {}
        ids, rank = [-1], 0
        weights = [0.0]
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if _CROSSES.search(piece):
                    raise ValueError(f"piece {i} crosses a word boundary")
                rank += 1
                self.bytes_of[i] = piece.replace(BLANK, " ").encode()
                state = 0
                for letter in piece:
                    step = state << 21 | self.letters.setdefault(letter, ord(letter))
                    if step not in steps:
                        steps[step] = len(ids)
                        ids.append(-1)
                        weights.append(0.0)
                    state = steps[step]
                ids[state], weights[state] = i, -spread * math.log(rank + 1)
        order = sorted(steps)
        self.steps = np.array(order, np.int64)
        self.next = np.array([steps[k] for k in order], np.int32)
        # Steps by ASCII letters and the blank mark (in the place of DEL) are a plain table.
        self.table = np.zeros((len(ids), 128), np.int32)
        letter = self.steps & ((1 << 21) - 1)
        small = np.where(letter == ord(BLANK), _DEL, np.where(letter == _DEL, 1 << 20, letter))
        plain = small < 128
        self.table[(self.steps >> 21)[plain], small[plain]] = self.next[plain]
        self.piece, self.weight = np.array(ids, np.int32), np.array(weights)
        self.per_byte = -spread * math.log(rank + 2)

    def walk(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The state after a letter, 0 where no piece goes on."""
        small = np.where(letters == ord(BLANK), _DEL, letters)
        plain = (small < 128) & (letters != _DEL)
        out = self.table[states, np.where(plain, small, 0)]
        rare = np.flatnonzero(~plain)
        if len(rare):
            want = states[rare].astype(np.int64) << 21 | letters[rare].astype(np.int64)
            at = np.minimum(np.searchsorted(self.steps, want), len(self.steps) - 1)
            out[rare] = np.where(self.steps[at] == want, self.next[at], 0)
        return out

    def arcs(self, letters: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """All arcs over some words, given as their letters and where each letter's word ends.

        (first letter, letters, log weight, piece); the piece is -1 for a letter in bytes.
        """
        at, state, n = np.arange(len(letters), dtype=np.int32), np.zeros(len(letters), np.int32), 0
        found, single = [], np.zeros(len(letters), bool)
        while len(at):
            state = self.walk(state, letters[at + n])
            n += 1
            at, state = at[state > 0], state[state > 0]
            whole = self.piece[state] >= 0
            good = state[whole]
            found.append((at[whole], np.full(len(good), n, np.int32), self.weight[good], self.piece[good]))
            if n == 1:
                single[at[whole]] = True
            on = at + n < ends[at]
            at, state = at[on], state[on]
        bare = np.flatnonzero(~single).astype(np.int32)
        size = 1 + (letters[bare] > 0x7F) + (letters[bare] > 0x7FF) + (letters[bare] > 0xFFFF)
        found.append((bare, np.ones(len(bare), np.int32), size * self.per_byte, np.full(len(bare), -1, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found))


class _Rows:
    """A numeric array that grows."""

    def __init__(self, kind) -> None:
        self.data, self.n = np.empty(4096, kind), 0

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(n - len(self.data), len(self.data) // 2), self.data.dtype)])
        self.data[self.n:n] = values
        self.n = n


class Lattices:
    """Forward-filtered lattices of the words met, as flat arrays for joint walks."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.base, self.end = _Rows(np.int64), _Rows(np.int64)  # of words: first and last node
        self.first = _Rows(np.int64)  # of nodes: the first arc that enters
        self.upto = _Rows(np.float64)  # of arcs: summed share of the arcs of the node
        self.back, self.emit, self.many = _Rows(np.uint8), _Rows(np.int32), _Rows(np.uint8)
        self.ids = _Rows(np.uint32)

    def _add(self, words: list[str]) -> None:
        """Build and filter the lattices of new words together."""
        v = self.vocabulary
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), size)
        stop = np.cumsum(size)
        start, n, weight, piece = v.arcs(letters, stop[word])
        base = np.cumsum(size + 1) - size - 1  # a word has a node before each letter and a last one
        node = (np.arange(len(letters)) + word).astype(np.int32)  # the node before a letter
        begin, end = node[start], node[start] + n
        depth = end - base.astype(np.int32)[word[start]]
        # arcs of a node by length, in every batch alike
        order = np.argsort(depth.astype(np.int64) << 40 | end.astype(np.int64) << 6 | n)
        start, n, weight, piece, begin, end, depth = (x[order] for x in (start, n, weight, piece, begin, end, depth))
        sums, upto = np.zeros(len(letters) + len(words)), np.empty(len(end))
        levels = np.flatnonzero(np.append(True, depth[1:] != depth[:-1]))
        for a, b in zip(levels.tolist(), [*levels[1:].tolist(), len(end)]):
            logs, to = sums[begin[a:b]] + weight[a:b], end[a:b]
            head = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            many = np.diff(np.append(head, b - a))
            top = np.repeat(np.maximum.reduceat(logs, head), many)
            share = np.exp(logs - top)
            total = np.add.reduceat(share, head)
            sums[to[head]] = top[head] + np.log(total)
            run = np.cumsum(share)
            run -= np.repeat(run[head] - share[head], many)
            upto[a:b] = run / np.repeat(total, many)
            upto[a + head + many - 1] = 1.0
        first = np.zeros(len(sums), np.int64)
        head = np.flatnonzero(np.append(True, end[1:] != end[:-1])) if len(end) else np.empty(0, np.int64)
        first[end[head]] = self.upto.n + head
        bare = np.flatnonzero(piece < 0)
        raw = [BLANK.encode() if c == ord(_LITERAL) else chr(c).encode() for c in letters[start[bare]].tolist()]
        many = np.ones(len(end), np.int64)
        many[bare] = [len(r) for r in raw]
        emit = np.cumsum(many) - many
        ids = np.empty(int(many.sum()), np.uint32)
        ids[emit[piece >= 0]] = piece[piece >= 0]
        if raw:
            inside = np.repeat(emit[bare], many[bare]) + np.arange(many[bare].sum()) \
                - np.repeat(np.cumsum(many[bare]) - many[bare], many[bare])
            ids[inside] = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        nodes = self.first.n
        for rows, values in (
            (self.base, base + nodes), (self.end, base + size + nodes), (self.first, first), (self.upto, upto),
            (self.back, n), (self.emit, emit + self.ids.n), (self.many, many), (self.ids, ids),
        ):
            rows.add(values)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return _WORD.findall(BLANK + text.replace(BLANK, _LITERAL).replace(" ", BLANK))

    def code(self, words: list[str]) -> np.ndarray:
        if len(self.known) > _KNOWN:
            self.clear()
        at = list(map(self.known.get, words))
        if None in at:
            self._add(list(dict.fromkeys(w for w, a in zip(words, at) if a is None)))
            known = self.known
            at = [known[w] if a is None else a for w, a in zip(words, at)]
        return np.array(at, np.int64)

    def sampled(self, words: np.ndarray, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        first, upto, back = self.first.data, self.upto.data, self.back.data
        node, base = self.end.data[words], self.base.data[words]
        walking, steps, taken = np.flatnonzero(node > base), 0, []
        while len(walking):
            u = uniform(streams[walking], steps)
            arc = first[node[walking]]
            short = np.flatnonzero(upto[arc] <= u)
            while len(short):
                arc[short] += 1
                short = short[upto[arc[short]] <= u[short]]
            taken.append((walking, arc))
            node[walking] -= back[arc]
            walking = walking[node[walking] > base[walking]]
            steps += 1
        if not taken:
            return np.empty(0, np.uint32), np.zeros(len(words), np.int64)
        counts = np.zeros(len(words), np.int64)
        for at, _ in taken:
            counts[at] += 1
        ends = np.cumsum(counts)
        arcs = np.empty(ends[-1], np.int64)
        for step, (at, arc) in enumerate(taken):
            arcs[ends[at] - 1 - step] = arc  # the walk goes backward
        many = self.many.data[arcs].astype(np.int64)
        before = np.cumsum(many) - many
        ids = self.ids.data[np.repeat(self.emit.data[arcs] - before, many) + np.arange(many.sum())]
        summed = np.concatenate([[0], np.cumsum(many)])
        return ids, summed[ends] - summed[ends - counts]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def streams(row: int, words: int, seed: int, first: int = 0) -> np.ndarray:
    """A stream of draws for each word of a row, by its place in the row."""
    key = _mixed(np.array([(row ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF], np.uint64))
    return _mixed(key + np.arange(first, first + words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def uniform(stream: np.ndarray, step: int) -> np.ndarray:
    """A draw from 0 to below 1 for each stream at a step of its walk."""
    mixed = _mixed(stream + np.uint64((step + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    return (mixed >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


_LOADED: dict[tuple, Lattices] = {}


def lattices(model: bytes, spread: float) -> Lattices:
    """One per worker process, with the words it knows already."""
    if (model, spread) not in _LOADED:
        _LOADED.clear()
        _LOADED[model, spread] = Lattices(Vocabulary(model, spread))
    return _LOADED[model, spread]


def encode_rows(known: Lattices, texts: list[str | None], keys: list[int], seed: int) -> list[np.ndarray | None]:
    """Sampled ids of some rows; long rows and many rows are walked in batches of words."""
    out: list = [None if t is None else [] for t in texts]
    held: list[tuple[int, int, np.ndarray]] = []
    words: list[str] = []

    def walk() -> None:
        ids, counts = known.sampled(known.code(words), np.concatenate([h[2] for h in held]))
        ends = np.append(0, np.cumsum(counts))
        at = 0
        for row, n, _ in held:
            out[row].append(ids[ends[at]:ends[at + n]])
            at += n

    for row, (text, key) in enumerate(zip(texts, keys)):
        mine = known.words(text or "")
        for first in range(0, len(mine), _BATCH):
            part = mine[first:first + _BATCH]
            if words and len(words) + len(part) > _BATCH:
                walk()
                held, words = [], []
            held.append((row, len(part), streams(key, len(part), seed, first)))
            words.extend(part)
    if held:
        walk()
    return [None if x is None else np.concatenate(x) if x else np.empty(0, np.uint32) for x in out]


def encode(text: Column | str, key: Column, model: Broadcast, seed: int = 0, spread: float = SPREAD) -> Column:
    """Sampled ids as little-endian unsigned 32-bit numbers; `key` is the row's long key."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array, keys: pa.Array) -> pa.Array:
        found = encode_rows(lattices(model.value, spread), texts.to_pylist(), keys.to_pylist(), seed)
        return pa.array([None if x is None else x.astype("<u4").tobytes() for x in found], pa.binary())

    return of(text, key)


def round_trip(text: Column | str, key: Column, model: Broadcast, seed: int = 0, spread: float = SPREAD) -> Column:
    """Struct (ids, text): sampled ids and the text decoded from them, in one pass."""

    @F.arrow_udf("ids binary, text string")
    def of(texts: pa.Array, keys: pa.Array) -> pa.Array:
        known = lattices(model.value, spread)
        found = encode_rows(known, texts.to_pylist(), keys.to_pylist(), seed)
        ids = [None if x is None else x.astype("<u4").tobytes() for x in found]
        back = [None if x is None else decode_row(known.vocabulary, x) for x in ids]
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(back, pa.string())], names=["ids", "text"])

    return of(text, key)


def decode_row(vocabulary: Vocabulary, ids: bytes) -> str:
    table = vocabulary.bytes_of
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode()


def decode(ids: Column | str, model: Broadcast, spread: float = SPREAD) -> Column:
    """The text of encoded ids."""

    @F.arrow_udf("string")
    def of(rows: pa.Array) -> pa.Array:
        vocabulary = lattices(model.value, spread).vocabulary
        return pa.array([None if x is None else decode_row(vocabulary, x) for x in rows.to_pylist()], pa.string())

    return of(ids)
