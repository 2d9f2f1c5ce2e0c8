"""Benchmark decontamination with an FM-index per shard of documents.

The benchmark is cut into windows of ``WINDOW`` words (a shorter item is one window). Each task
turns its documents, a shard of bounded size at a time, into an FM-index over words and searches
all windows at once, last word first, through ranks on a wavelet matrix. Occurrences are located by
walking back to sampled suffix positions, mapped to their documents and merged into spans.

Only words that occur in the benchmark get a symbol; any other word ends a run, as no window
reaches across it. Runs shorter than the shortest window hold no occurrence and are left out. This
loses nothing and keeps the index small.

Documents are read once and never shuffled. The benchmark does not grow with the corpus; it is sent
to the tasks in blocks of at most ``BLOCK_WORDS`` words, and each further block is one more pass.

Odd input: null or wordless text has no words and no spans; a null or wordless item has no windows;
a null item id marks words but is not listed; repeated rows get equal results, repeated item ids
count once; an empty benchmark hits nothing. Long texts form a shard of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import row_field

WINDOW = 10
BLOCK_WORDS = 500_000
SHARD_WORDS = 1_000_000
SAMPLE_STEP = 8
_ROWS = 2000

# A-Z become a-z; digits, a-z and bytes of non-ASCII characters form words; the rest separates.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of symbols in which every 0 is an end mark of its own, earlier marks first."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    width = 63 // bits
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(width):
        symbol = padded[i : i + n]
        key = (key << bits) | np.where(open_, symbol, 0)
        open_ &= symbol != 0
    order = np.argsort(key, kind="stable")
    key, open_ = key[order], open_[order]
    rank = np.empty(n, np.int64)
    # Suffixes that met an end mark are final; equal ones that did not share their group's rank.
    first = np.concatenate([[True], (key[1:] != key[:-1]) | ~open_[1:]])
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = group
    size = np.bincount(group, minlength=n)
    pending = np.flatnonzero(size[group] > 1)
    while len(pending):
        at = order[pending]
        own, following = rank[at], rank[np.minimum(at + width, n - 1)]
        sort = np.lexsort((following, own))
        order[pending] = at[sort]
        own, following = own[sort], following[sort]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (following[1:] != following[:-1])])
        group = np.maximum.accumulate(np.where(new, pending, 0))
        rank[order[pending]] = group
        size = np.bincount(group, minlength=n)
        pending = pending[size[group] > 1]
        width *= 2
    return order


class WaveletMatrix:
    """Counts of a symbol before a place, for many symbols and places at once."""

    def __init__(self, symbols: np.ndarray):
        self.ones, self.zeros = [], []
        self.levels = max(1, int(symbols.max()).bit_length())
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(places), places
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros):
            one = ((symbols >> level) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low


class FMIndex:
    """Searches words in a text of symbols from 1 up whose runs each end with a 0."""

    def __init__(self, text: np.ndarray, step: int = SAMPLE_STEP):
        order = suffix_array(text)
        self.size = len(text)
        self.last = text[order - 1]
        self.ranks = WaveletMatrix(self.last)
        counts = np.bincount(text)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # Every step-th position is kept, and every start of a run, so a walk never passes a mark.
        self.sampled = (order % step == 0) | (self.last == 0)
        self.nth = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def step_back(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.before[symbols] + self.ranks.rank(symbols, rows)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of windows given as right-aligned symbols, zeros in front."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.size, np.int64)
        known = windows.max(1, initial=0) < len(self.before) - 1
        high[~known] = 0
        for back in range(1, windows.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbols = windows[live, -back]
            low[live] = self.step_back(symbols, low[live])
            high[live] = self.step_back(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(walk := np.flatnonzero(~self.sampled[rows])):
            rows[walk] = self.step_back(self.last[rows[walk]], rows[walk])
            steps[walk] += 1
        return self.positions[self.nth[rows]] + steps


@dataclass
class Windows:
    """Distinct windows of a block of items: symbols, lengths, and the items of each window."""

    symbols: dict[bytes, int]
    table: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def windows_of(items: list[tuple[str | None, list[bytes]]], size: int = WINDOW) -> Windows:
    symbols: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str | None]] = {}
    for item, words in items:
        ids = [symbols.setdefault(w, len(symbols) + 1) for w in words]
        for i in range(max(1, len(ids) - size + 1) if ids else 0):
            owners.setdefault(tuple(ids[i : i + size]), set()).add(item)
    table = np.zeros((len(owners), size), np.int64)
    for row, ids in zip(table, owners):
        row[size - len(ids) :] = ids
    lengths = np.array([len(ids) for ids in owners], np.int64)
    return Windows(symbols, table, lengths, [sorted(x for x in o if x is not None) for o in owners.values()])


def find(windows: Windows, docs: list[list[bytes]]) -> tuple[list[list[list[int]]], list[list[str]]]:
    """Merged spans of hit words and the sorted items with an occurrence, for each document of a shard."""
    spans, items = [[] for _ in docs], [[] for _ in docs]
    get = windows.symbols.get
    coded = [np.fromiter((get(w, 0) for w in words), np.int64, len(words)) for words in docs]
    mark = np.zeros(1, np.int64)
    words = np.concatenate([x for ids in coded for x in (ids, mark)]) if docs else mark
    doc_ends = np.cumsum([len(ids) + 1 for ids in coded])

    edge = np.diff(np.concatenate([[0], (words != 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= windows.lengths.min(initial=1 << 60)
    if not long.any():
        return spans, items
    cover = np.zeros(len(words) + 1, np.int64)
    cover[starts[long]] += 1
    cover[ends[long] + 1] -= 1  # the mark behind the run belongs to it
    place = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    index = FMIndex(words[place])
    low, high = index.search(windows.table, windows.lengths)
    found = np.repeat(np.arange(len(low)), high - low)
    if not len(found):
        return spans, items
    offset = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = place[index.locate(low[found] + offset)]

    hit = np.zeros(len(words) + 1, np.int64)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + windows.lengths[found], -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(hit[:-1]) > 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for doc, start, end in zip(np.searchsorted(doc_ends, starts, side="right"), starts, ends):
        base = doc_ends[doc] - len(coded[doc]) - 1
        spans[doc].append([int(start - base), int(end - base)])
    owner = np.searchsorted(doc_ends, at, side="right")
    for doc, window in np.unique(np.stack([owner, found]), axis=1).T:
        items[doc].extend(windows.items[window])
    return spans, [sorted(set(x)) for x in items]


def merge(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping or touching spans as one."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def shards(words: list[list[bytes]], limit: int = SHARD_WORDS) -> Iterator[slice]:
    """Slices of documents with about ``limit`` words each."""
    start, size = 0, 0
    for i, doc in enumerate(words):
        if size and size + len(doc) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(doc) + 1
    if start < len(words):
        yield slice(start, len(words))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list]:
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    block, size = [], 0
    for item, text in rows.toLocalIterator():
        words = words_of(text.encode() if text else None)
        if block and size + len(words) > limit:
            yield block
            block, size = [], 0
        block.append((item, words))
        size += len(words)
    yield block


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(row, n_words, spans, items): hit word spans and item ids per document; ``row`` is its input row."""
    out = documents.select(
        F.struct("*").alias("row"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = T.StructType(out.schema.fields)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for block in item_blocks(benchmark, item_col, item_text_col, block_words):
        shared = documents.sparkSession.sparkContext.broadcast(windows_of(block, window))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, _ROWS):
                    batch = whole.slice(i, _ROWS)
                    words = [words_of(t) for t in row_field(whole, text_col, i, _ROWS)]
                    spans = [[[s["start"], s["end"]] for s in x] for x in batch.column("spans").to_pylist()]
                    items = batch.column("items").to_pylist()
                    for shard in shards(words):
                        found = find(shared.value, words[shard])
                        spans[shard] = [merge(a + b) for a, b in zip(spans[shard], found[0])]
                        items[shard] = [sorted({*a, *b}) for a, b in zip(items[shard], found[1])]
                    spans = [[{"start": a, "end": b} for a, b in x] for x in spans]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row"),
                            pa.array([len(w) for w in words], pa.int64()),
                            pa.array(spans, span_type),
                            pa.array(items, pa.list_(pa.string())),
                        ],
                        ["row", "n_words", "spans", "items"],
                    )

        out = out.mapInArrow(search, schema)
    return out


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per document and a digest of its items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col(f"row.`{id_col}`").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
