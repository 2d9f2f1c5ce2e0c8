"""Byte-level BPE: texts to token ids with offsets, and back.

Pre-tokenisation looks at no pattern at run time. Every code point of a batch has a class (letter, number, white space,
other); with what stands behind it, the class is a symbol, and every symbol is a function between the states
of a small automaton that says which kind of piece is open. Functions are composed associatively: there are only a few dozen
of them, so composing two is one look-up in a table. A block-wise prefix scan gives each code point the state
before it, and a piece starts where that state and the symbol say so. The automaton has the meaning of this
pattern, whose parts are tried in this order:

    's | 't | 're | 've | 'm | 'll | 'd | space? letters+ | space? numbers+ | space? others+
    | white space not before a visible character | white space

Pieces are slices of the text's bytes. What a piece becomes is kept in a cache bounded by its bytes. New
pieces are merged pair by pair, lowest rank first and leftmost among equals: those of similar length side by side, a pair of each
per round, and long ones on their own with a heap, so that a word of a megabyte takes no quadratic time. A token's end offset in the text's bytes is kept, so any run of tokens can be decoded on
its own; decoding gathers the bytes of all tokens of a batch at once.

Texts are encoded whole, in slices of bounded size, each on its own row: there is no shuffle, and a lost task is
encoded again. The vocabulary is read from a path that every machine has; it is not copied.

Odd input: a null text is empty, and an empty text has no tokens; rows are independent, so ties and repeated
rows give equal results and an empty table gives none. Other columns, whatever their name, are passed on in the struct ``row``.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import byte_slices, runs_of

CACHE_BYTES = 48 << 20
SLICE_BYTES = 2 << 20
PIECES = 200_000
LONG = 64
#: New pieces that are merged side by side.
TOGETHER = 20_000

# Classes of code points.
LETTER, NUMBER, SPACE, OTHER = range(4)
# Symbols: a code point's class and what stands behind it. An apostrophe before s, t, m, d or re, ve, ll
# opens a contraction if a piece starts there. Of white space before a visible character the last one is told
# apart, a plain space from others. FIRST[s] is a text's first code point, whatever came before.
_LETTER, _NUMBER, _OTHER, _SHORT, _LONGER, _WHITE, _LAST_SPACE, _LAST_WHITE = range(8)
_SYMBOLS = 8
# States: the open piece is letters, numbers, others, white space, a space that joins what follows,
# a contraction that lacks two or one letters, or none.
_IN_L, _IN_N, _IN_O, _IN_W, _JOINS, _LACKS2, _LACKS1, _NONE = range(8)
_STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state behind a code point, and whether a piece starts with it."""
    if symbol == _LETTER:
        if state == _LACKS2:
            return _LACKS1, False
        if state == _LACKS1:
            return _NONE, False
        return _IN_L, state not in (_IN_L, _JOINS)
    if symbol == _NUMBER:
        return _IN_N, state not in (_IN_N, _JOINS)
    if symbol in (_OTHER, _SHORT, _LONGER):
        if symbol == _OTHER or state in (_IN_O, _JOINS):
            return _IN_O, state not in (_IN_O, _JOINS)
        return (_LACKS1 if symbol == _SHORT else _LACKS2), True
    if symbol == _WHITE:
        return _IN_W, state != _IN_W
    return (_JOINS if symbol == _LAST_SPACE else _NONE), True


@functools.lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Composition table of all functions that symbols can make, their values, symbols' starts, the neutral one."""
    neutral = tuple(range(_STATES))
    symbols = [tuple(_step(state, symbol)[0] for state in range(_STATES)) for symbol in range(_SYMBOLS)]
    # A text's first code point: the same from state "none", whatever the state before it was.
    firsts = [(function[_NONE],) * _STATES for function in symbols]
    known = {function: i for i, function in enumerate(dict.fromkeys([*symbols, *firsts, neutral]))}
    queue = list(known)
    while queue:
        one = queue.pop()
        for other in list(known):
            for a, b in ((one, other), (other, one)):
                made = tuple(b[state] for state in a)
                if made not in known:
                    known[made] = len(known)
                    queue.append(made)
    values = np.array(list(known), np.uint8)
    composed = np.array([[known[tuple(b[s] for s in a)] for b in known] for a in known], np.uint8)
    numbers = np.array([known[f] for f in (*symbols, *firsts)], np.uint8)
    starts = np.array([[_step(state, symbol)[1] for symbol in range(_SYMBOLS)] for state in range(_STATES)])
    return composed, values, numbers, starts


def _scan(functions: np.ndarray, width: int = 128) -> np.ndarray:
    """Inclusive prefix composition: blocks side by side first, then the blocks' totals, then both together."""
    composed = _automaton()[0]
    n = len(functions)
    if n <= width:
        out = functions.copy()
        for i in range(1, n):
            out[i] = composed[out[i - 1], out[i]]
        return out
    rows = -(-n // width)
    padded = np.zeros(rows * width, np.uint8)
    padded[:n] = functions
    table = np.ascontiguousarray(padded.reshape(rows, width).T)
    for i in range(1, width):
        table[i] = composed[table[i - 1], table[i]]
    before = _scan(table[-1], width)
    table[:, 1:] = composed[before[:-1], table[:, 1:]]
    return np.ascontiguousarray(table.T).reshape(-1)[:n]


def class_table() -> np.ndarray:
    """The class of every code point, as the tokenizer library's Unicode version has it."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, category in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        members = tiktoken.Encoding(category, pat_str=category, mergeable_ranks=single, special_tokens={})
        found = members.decode(members.encode_ordinary(everything))
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return classes


def piece_starts(points: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pieces start among the code points of several texts, one behind the other.

    ``firsts`` marks each text's first code point.
    """
    if not len(points):
        return np.zeros(0, bool)
    _, values, numbers, starts = _automaton()
    kinds = classes[points]
    ends = np.append(firsts[1:], True)  # the text's last code point
    after = np.append(points[1:], 0)
    after[ends] = 0
    symbols = np.array([_LETTER, _NUMBER, _WHITE, _OTHER], np.uint8)[kinds]
    visible = ~ends
    visible[:-1] &= kinds[1:] != SPACE
    last = (kinds == SPACE) & visible
    symbols[last] = np.where(points[last] == 32, _LAST_SPACE, _LAST_WHITE)
    # Few code points are apostrophes; what follows them is looked at one by one, all at once.
    marks = np.flatnonzero((points == 39) & ~ends)
    one = after[marks]
    inner = ~ends[np.minimum(marks + 1, len(points) - 1)]
    two = np.where(inner, after[np.minimum(marks + 1, len(points) - 1)], 0)
    letters = lambda text: np.array(list(map(ord, text)), points.dtype)
    symbols[marks[np.isin(one, letters("stmd"))]] = _SHORT
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    symbols[marks[pairs]] = _LONGER
    functions = numbers[symbols + np.where(firsts, _SYMBOLS, 0).astype(np.uint8)]
    states = values[_scan(functions), _NONE]
    before = np.empty(len(states), np.uint8)
    before[0] = _NONE
    before[1:] = states[:-1]
    before[firsts] = _NONE
    return starts[before, symbols] | firsts


class Pairs:
    """Which two ids merge into which: a table of all splits of all tokens, looked up for many pairs at once."""

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        self.base = max(ranks.values()) + 1
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    values.append(rank)
        self.bits = max(8, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, self.NONE, np.int32)
        key, value = np.array(keys, np.int64), np.array(values, np.int32)
        place = self._place(key)
        while len(key):
            free = self.keys[place] == -1
            self.keys[place[free]] = key[free]  # of several keys for one place the last stays
            self.values[place[free]] = value[free]
            left = self.keys[place] != key
            key, value, place = key[left], value[left], (place[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of each merged pair, ``NONE`` where two ids do not merge."""
        key = left.astype(np.int64) * self.base + right
        place = self._place(key)
        there = self.keys[place]
        out = np.where(there == key, self.values[place], self.NONE)
        open_ = np.flatnonzero((there != key) & (there != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[place[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.values[place[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


class Merger:
    """Turns pieces into ids, keeping what they became."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = Pairs(self.ranks)
        self.cache: dict[bytes, tuple[int, ...]] = {}
        self.cached = 0

    def _short(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Pieces of similar length side by side: every round merges each one's best pair."""
        none = Pairs.NONE
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        parts = np.zeros((len(pieces), width), np.int32)
        parts[inside] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        costs = np.full((len(pieces), width), none, np.int32)
        joint = inside[:, 1:]
        costs[:, :-1][joint] = self.pairs(parts[:, :-1][joint], parts[:, 1:][joint])
        rows = np.arange(len(pieces))
        column = np.arange(width)
        while True:
            # Only rows that still merge are looked at; the others lie finished behind them.
            best = costs[rows].argmin(axis=1)
            merged = costs[rows, best]
            going = merged != none
            rows, best, merged = rows[going], best[going], merged[going]
            if not len(rows):
                break
            shift = column[:-1] > best[:, None]
            for table in (parts, costs):
                part = table[rows]
                part[:, :-1] = np.where(shift, part[:, 1:], part[:, :-1])
                table[rows] = part
            parts[rows, best] = merged
            sizes[rows] -= 1
            costs[rows, sizes[rows]] = none
            for at, valid in ((best - 1, best > 0), (best, best + 1 < sizes[rows])):
                r, c = rows[valid], at[valid]
                costs[r, c] = self.pairs(parts[r, c], parts[r, c + 1])
            last = ~(best + 1 < sizes[rows])
            costs[rows[last], best[last]] = none
        flat = parts[column < sizes[:, None]].tolist()
        ends = np.cumsum(sizes).tolist()
        return [tuple(flat[end - size : end]) for end, size in zip(ends, sizes.tolist())]

    def _long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap of pairs and links between neighbours; a part is named by its start."""
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        heap = []

        def offer(left: int) -> None:
            middle = ends[left]
            if middle < n and (rank := ranks.get(piece[left : ends[middle]])) is not None:
                heapq.heappush(heap, (rank, left, middle, ends[middle]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, middle, end = heapq.heappop(heap)
            if ends[left] != middle or middle >= n or ends[middle] != end:
                continue  # one of the two has been merged since
            ends[left], ends[middle] = end, -1
            if end < n:
                previous[end] = left
            offer(left)
            if previous[left] >= 0:
                offer(previous[left])
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : ends[at]]])
            at = ends[at]
        return tuple(out)

    def _new(self, pieces: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """The ids of pieces that the cache lacks."""
        found = {}
        widths: dict[int, list[bytes]] = {}
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                found[piece] = (whole,)
            elif len(piece) > LONG:
                found[piece] = self._long(piece)
            else:
                widths.setdefault(max(8, 1 << (len(piece) - 1).bit_length()), []).append(piece)
        for similar in widths.values():
            for low in range(0, len(similar), TOGETHER):
                part = similar[low : low + TOGETHER]
                found.update(zip(part, self._short(part)))
        return found

    def _keep(self, found: dict[bytes, tuple[int, ...]]) -> None:
        for piece, ids in found.items():
            size = 200 + len(piece) + 8 * len(ids)  # about what the entry takes
            if size >= CACHE_BYTES // 100:
                continue
            if self.cached + size > CACHE_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cache[piece] = ids
            self.cached += size

    def ids(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each piece."""
        found = list(map(self.cache.get, pieces))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            new = self._new(list(dict.fromkeys(pieces[i] for i in lacking)))
            for i in lacking:
                found[i] = new[pieces[i]]
            self._keep(new)
        return found


@functools.lru_cache(maxsize=2)
def merger_of(path: str) -> Merger:
    """One vocabulary and cache per Python worker, kept over its tasks."""
    return Merger(path)


@functools.lru_cache(maxsize=2)
def vocabulary_of(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes, one behind the other by id, and where each starts."""
    tokens = {rank: token for token, rank in merger_of(path).ranks.items()}
    ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    starts = np.zeros(len(ordered) + 1, np.int64)
    np.cumsum([len(t) for t in ordered], out=starts[1:])
    return np.frombuffer(b"".join(ordered), np.uint8), starts


def encode_texts(texts: list[bytes], merger: Merger, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one behind the other, and the number of each text's ids."""
    data = b"".join(texts)
    points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    octets = np.frombuffer(data, np.uint8)
    places = np.flatnonzero((octets & 0xC0) != 0x80)  # where code points start
    text_starts = np.cumsum([0, *map(len, texts)])
    firsts = np.zeros(len(points), bool)
    firsts[np.searchsorted(places, text_starts[:-1][np.diff(text_starts) > 0])] = True
    begins = places[piece_starts(points, firsts, classes)]
    del points, places, firsts
    cuts = np.append(begins, len(data))
    ids, counts = [], []
    for low in range(0, len(begins), PIECES):
        part = cuts[low : low + PIECES + 1].tolist()
        found = merger.ids([data[a:b] for a, b in itertools.pairwise(part)])
        counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32))
    if not ids:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    per_piece = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    bounds = per_piece[np.searchsorted(begins, text_starts)]
    return np.concatenate(ids), np.diff(bounds)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def encode(rows: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Every row as the struct ``row``, with ``ids`` and ``ends``: behind which byte of its text each token ends."""
    classes = rows.sparkSession.sparkContext.broadcast(class_table())  # a byte per code point

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, starts = merger_of(path), vocabulary_of(path)[1]
        for batch in batches:
            for part, texts in byte_slices(batch, text_col, SLICE_BYTES):
                ids, counts = encode_texts([t or b"" for t in texts], merger, classes.value)
                sizes = starts[ids + 1] - starts[ids]
                total = np.concatenate(([0], np.cumsum(sizes)))
                base = np.concatenate(([0], np.cumsum(counts)))[:-1]
                ends = total[1:] - np.repeat(total[base], counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), _lists(ids, counts, pa.int32()), _lists(ends, counts, pa.int64())],
                    ["row", "ids", "ends"],
                )

    packed = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))
    found = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.LongType()))]
    return packed.mapInArrow(encoded, T.StructType([*packed.schema.fields, *found]))


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the bytes of their ids as ``decoded``."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts = vocabulary_of(path)
        for batch in batches:
            lists = batch.column(ids_col)
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            for low, high in runs_of(counts, SLICE_BYTES // 8):
                ids = np.asarray(lists.slice(low, high - low).flatten(), np.int64)
                sizes = starts[ids + 1] - starts[ids]
                total = np.concatenate(([0], np.cumsum(sizes)))
                octets = data[np.arange(total[-1]) + np.repeat(starts[ids] - total[:-1], sizes)]
                bounds = total[np.concatenate(([0], np.cumsum(counts[low:high])))].astype(np.int32)
                texts = pa.BinaryArray.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(bounds), pa.py_buffer(octets)]
                )
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "decoded"])

    return rows.mapInArrow(decoded, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def joined_hash(ids: Column) -> Column:
    """SHA-256 of the ids in decimal, joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
