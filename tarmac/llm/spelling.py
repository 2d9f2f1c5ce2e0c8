"""Spelling variants: words one edit apart, each grouped under its most frequent neighbour.

Two words are near if they differ by exactly one inserted, deleted or replaced code point: common prefix plus
common suffix reach the longer length minus one. Padded matrices of code points, flush left and flush right, are
compared block against block, which gives both lengths for every pair of a tile.

Tiles. Words are compared per longer length m, so a word is looked at among those of its own length and, as the
shorter one, of the next. The edit lies at the end of the common prefix, somewhere in ``[0, m)``. A tile holds the words
that agree before a window of that range and behind it, and reports the pairs whose edit lies in its window; the
windows of a length cut the range, so every pair is reported by exactly one tile. A tile starts with half the range, and
while it has more than ``TILE_WORDS`` words its window is halved, down to a single place. There words
agree everywhere else, so there are no more of them than there are letters, and no tile is ever larger: a
prefix shared by a third of all words costs more halvings, not more pairs. Nothing is capped or left out.

Only counts leave a tile, per word how many neighbours and which is the best, so a word with very many neighbours makes no
more rows than it has tiles. Words are counted per task before they are shuffled, documents by slices of bytes.

``form``: a word's most frequent neighbour (ties: smallest in code-point order) if at least ``RATIO`` times as
frequent. Along forms the count doubles at least, so there are no cycles, and ``root``, the last form, is found
by following twice as far in each round.

Odd input: null, empty and letterless texts have no words; texts are read whole; equal rows count as often as they
come; the words of a document without id are never damaged; an empty table has no words. Only the columns
named are read. A pattern is a class of characters; words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, byte_slices, stored

WORD = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
TILE_WORDS = 512
#: Words compared with each other at once.
BLOCK = 128
SLICE_BYTES = 8 << 20
#: Distinct words that a task counts before it hands them on.
TASK_WORDS = 200_000
NOISE = 97


def _damaged(counts: Counter, start: int, noise: int, into: Counter) -> None:
    """Add a document's words; those its checksum names lose a code point."""
    for word, n in counts.items():
        code = zlib.crc32(word.encode(), start)
        if code % noise == 0:
            at = code % len(word)
            word = word[:at] + word[at + 1 :]
        into[word] += n


def word_counts(
    documents: DataFrame,
    noise: int = NOISE,
    pattern: str = WORD,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of ``documents`` (doc_id, text): lower-cased runs of the pattern that are long and frequent enough.

    Where ``noise`` divides the checksum of ``<doc_id>:<word>``, the word lacks one code point; 0 damages none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(pattern)
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            kept = [(w, n) for w, n in total.items() if len(w) >= min_length]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for part, texts in byte_slices(batch, "text", SLICE_BYTES):
                for doc_id, text in zip(pc.struct_field(part.column("row"), "doc_id").to_pylist(), texts):
                    if not text:
                        continue
                    counts = Counter(runs.findall(text.translate(LOWER).decode()))
                    if noise and doc_id is not None:
                        _damaged(counts, zlib.crc32(b"%d:" % doc_id), noise, total)
                    else:
                        total.update(counts)
                    if len(total) > TASK_WORDS:
                        yield handed_on()
        yield handed_on()

    packed = documents.select(F.struct("doc_id", "text").alias("row"))
    counted = packed.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _windowed(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """``rows`` (word, n, m) with a window and the key of its tile: what stands before and behind the window."""
    size = F.char_length("word").cast("int")
    before = F.substr(F.col("word"), F.lit(1), F.col("start"))
    behind = F.substr(F.col("word"), size - F.col("m") + F.col("end") + 1, F.col("m") - F.col("end"))
    placed = rows.withColumns({"start": start, "end": end})
    return placed.withColumn("tile", F.xxhash64("m", "start", "end", before, F.lit("\x00"), behind))


def _halved(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every row twice: for the first and the second half of its window."""
    middle = start + F.floor((end - start + 1) / 2).cast("int")
    halves = F.explode(F.array(F.struct(start.alias("s"), middle.alias("e")), F.struct(middle.alias("s"), end.alias("e"))))
    cut = rows.withColumn("half", halves)
    return _windowed(cut, F.col("half.s"), F.col("half.e")).drop("half")


def _tiles(words: DataFrame, tile_words: int) -> DataFrame:
    """(tile, m, start, end, word, n) so that no tile has more than ``tile_words`` words, or a window of one place."""
    size = F.char_length("word").cast("int")
    looked_at = words.withColumn("m", F.explode(F.array(size, size + 1)))
    open_rows = _halved(looked_at, F.lit(0), F.col("m"))
    done = None
    while True:
        open_rows = stored(open_rows, "spelling-tiles")
        large = (
            open_rows.where(F.col("end") - F.col("start") > 1)
            .groupBy("tile")
            .agg(F.count("*").alias("words"))
            .where(F.col("words") > tile_words)
            .select("tile")
        )
        large = stored(large, "spelling-large")
        ready = open_rows.join(large, "tile", "left_anti")
        done = ready if done is None else done.unionByName(ready)
        if large.isEmpty():
            return done
        open_rows = _halved(open_rows.join(large, "tile", "left_semi"), F.col("start"), F.col("end"))


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points flush left and flush right, padded with 0, and lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and points.max() < 256:
        points = points.astype(np.uint8)
    width = int(sizes.max())
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = (np.zeros((len(words), width), points.dtype) for _ in range(2))
    left[row, place] = points
    right[row, width - 1 - np.repeat(sizes, sizes) + 1 + place] = points
    return left, right[:, ::-1], sizes


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal code points at the front, for every pair of rows."""
    differ = a[:, None, :] != b[None, :, :]
    first = differ.argmax(axis=2)
    first[~np.take_along_axis(differ, first[:, :, None], 2)[:, :, 0]] = a.shape[1]
    return first


def _near(words: list[str], tiles: np.ndarray, m: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places of near words, each once; ``tiles`` is in order."""
    left, right, sizes = _matrices(words)
    # Long words are compared in smaller blocks, so that a block's pairs take bounded memory.
    block = max(8, int(BLOCK / max(1, left.shape[1] / 32) ** 0.5))
    ones, others = [], []
    for low in range(0, len(words), block):
        a = slice(low, low + block)
        last = tiles[a][-1]
        for other in range(low, len(words), block):
            if other > low and tiles[other] != last:
                break
            b = slice(other, other + block)
            fits = (tiles[a, None] == tiles[None, b]) & (np.maximum(sizes[a, None], sizes[None, b]) == m[a, None])
            if other == low:
                fits &= np.triu(np.ones(fits.shape, bool), 1)
            if not fits.any():
                continue
            width = int(min(left.shape[1], max(sizes[a].max(), sizes[b].max())))
            prefix = _common(left[a, :width], left[b, :width])
            suffix = _common(right[a, :width], right[b, :width])
            fits &= (prefix + suffix >= m[a, None] - 1) & (prefix >= start[a, None]) & (prefix < end[a, None])
            x, y = np.nonzero(fits)
            ones.append(x + low)
            others.append(y + other)
    if not ones:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ones), np.concatenate(others)


_FOUND = "word string, near long, best_n long, best string"
_COLUMNS = ["tile", "m", "start", "end", "word", "n"]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and run of whole tiles its neighbours in number and the best of them; rows come in order of tile."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("word").to_pylist()
        tile, m, start, end, n = (rows.column(c).to_numpy() for c in ("tile", "m", "start", "end", "n"))
        one, other = _near(words, tile, m, start, end)
        word, near = np.concatenate([one, other]), np.concatenate([other, one])
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[near], -n[near], word))
        word, near = word[order], near[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
        counts = np.diff(np.append(first, len(word)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in word[first]], pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(n[near[first]], pa.int64()),
                pa.array([words[i] for i in near[first]], pa.string()),
            ],
            ["word", "near", "best_n", "best"],
        )

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tiles = batch.column("tile").to_numpy()
        # The last tile of a batch may go on in the next one.
        cut = int(np.flatnonzero(tiles != tiles[-1])[-1]) + 1 if (tiles != tiles[-1]).any() else 0
        if cut:
            yield found(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
            waiting = [batch.slice(cut)]
        elif waiting and waiting[-1].column("tile")[-1].as_py() != tiles[0]:
            yield found(pa.Table.from_batches(waiting))
            waiting = [batch]
        else:
            waiting.append(batch)
    if waiting:
        yield found(pa.Table.from_batches(waiting))


def neighbours(words: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, near, best_n, best) of every word of ``words`` (word, n) that has a near word."""
    tiles = _tiles(words, tile_words).select(*_COLUMNS)
    dealt = tiles.repartition("tile").sortWithinPartitions("tile")
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))
    return (
        dealt.mapInArrow(_compared, _FOUND)
        .groupBy("word")
        .agg(F.sum("near").alias("near"), F.min(best).alias("best"))
        .select("word", "near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))
    )


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): each round follows twice as many forms."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went_on")
        )
        reached = stored(reached, "spelling-roots")
        at = reached.select("word", "root")
        if reached.where("went_on").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = RATIO, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n; stored, as it is read often)."""
    near = neighbours(words, tile_words)
    taken = F.col("best_n") >= ratio * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("best")).alias("form"),
            F.when(taken, F.col("best_n")).alias("form_n"),
        ),
        "spelling-found",
    )
    roots = _rooted(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
