"""Removal of passages that repeat, by matching statistics on suffix automata.

A window is ``WINDOW`` consecutive words. A word goes if it lies in a window that also starts
anywhere else in the corpus.

One automaton of the whole corpus would not fit anywhere, and sending many to every task would cost
tasks times corpus. So the corpus is cut such that equal windows meet in one reference shard: every
window belongs to its smallest fingerprint of ``GRAM`` words, which equal windows share. Consecutive
windows with the same smallest place form a segment (at most ``2 * WINDOW`` words).

1. A fingerprint that is the smallest of a single segment has no repeated window. Only segments of
   the others go on, with their text. While the others are at most ``FILTER_VALUES``, a filter of
   ``FILTER_BITS`` bits tells the tasks which ones those are (it lets few too many pass, never too
   few); beyond that, segments are joined with them, and documents with their segments.
2. Equal segments become one with a weight, whatever their number.
3. Segments are dealt to reference shards of bounded size by fingerprint. A shard's automaton is built
   from its segments, each state knowing the weight of its occurrences; the segments then
   stream through it, and a word place whose matched suffix of ``WINDOW`` words has weight two or more ends
   a repeated window. A fingerprint whose segments alone exceed ``SHARD_WORDS`` (a phrase in very
   many contexts) is not gathered: its windows are counted by 128-bit fingerprints instead.
4. Spans return to the documents by joins, and the words outside them are kept.

Odd input: null text has no words; texts under ``WINDOW`` words keep all; repeated rows repeat each
other, so all their windows go; a null id is an id. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import documents_of, mix, shingle_hashes, stored, word_hashes

WINDOW = 35
GRAM = 8
SHARD_WORDS = 50_000
FILTER_BITS = 1 << 27
FILTER_VALUES = 16_000_000
_ROWS = 500


def smallest_places(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the minimum of each run of ``width`` values."""
    best, least, reach = np.arange(len(values)), values, 1
    while reach < width:
        step = min(reach, width - reach)
        left = least[:-step] <= least[step:]
        best = np.where(left, best[:-step], best[step:])
        least = np.where(left, least[:-step], least[step:])
        reach += step
    return best


def segments(texts: list[bytes | None], window: int = WINDOW, gram: int = GRAM):
    """Document number, first window, number of windows and fingerprint of each segment."""
    words, lengths = word_hashes(texts)
    empty = np.empty(0, np.int64)
    if not (lengths >= window).any():
        return empty, empty, empty, np.empty(0, np.uint64)
    values = shingle_hashes(words, gram)
    place = smallest_places(values, window - gram + 1)
    starts = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(texts)), lengths)
    window_at = np.arange(len(place))
    doc = doc[: len(place)]
    inside = window_at + window <= (starts + lengths)[doc]
    window_at, place, doc = window_at[inside], place[inside], doc[inside]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.append(first, len(place)))
    return doc[first], window_at[first] - starts[doc[first]], count, values[place[first]]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few documents at a time, so that their words never fill a worker's memory."""
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            yield batch.slice(i, _ROWS)


def _split(texts) -> list[list[bytes]]:
    return [t.split() if t else [] for t in texts]


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        doc, start, count, value = segments(part.column("text").to_pylist())
        take = pa.array(doc)
        yield pa.record_batch(
            {
                "doc_id": part.column("doc_id").take(take),
                "text_hash": part.column("text_hash").take(take),
                "start": pa.array(start, pa.int32()),
                "windows": pa.array(count, pa.int32()),
                "value": pa.array(value.view(np.int64)),
            }
        )


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        value = segments(part.column("text").to_pylist())[3]
        yield pa.record_batch({"value": pa.array(value.view(np.int64))})


def _filter_bits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each value."""
    mixed = mix(values)
    return mixed % np.uint64(FILTER_BITS), (mixed >> np.uint64(32)) % np.uint64(FILTER_BITS)


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = np.concatenate(_filter_bits(batch.column("value").to_numpy().view(np.uint64)))
        words = (bits >> np.uint64(6)).astype(np.int64)
        masks = (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)
        yield pa.record_batch({"word": pa.array(words), "mask": pa.array(masks)})


def value_filter(values: DataFrame) -> np.ndarray:
    """A filter of fixed size that all values pass."""
    masks = values.mapInArrow(_set_bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    rows = masks.toArrow()  # at most FILTER_BITS / 64 of them
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows["word"].to_numpy()] = rows["mask"].to_numpy()
    return bits.view(np.uint64)


def _passing(shared):
    """Documents with segments whose fingerprint passes the filter, and these segments."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        types = pa.list_(pa.struct([("start", pa.int32()), ("windows", pa.int32()), ("value", pa.int64())]))
        for part in _slices(batches):
            doc, start, count, value = segments(part.column("text").to_pylist())
            passes = np.ones(len(doc), bool)
            for bit in _filter_bits(value):
                passes &= (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            doc, start, count, value = doc[passes], start[passes], count[passes], value[passes]
            docs, first = np.unique(doc, return_index=True)
            flat = pa.StructArray.from_arrays(
                [pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array(value.view(np.int64))],
                fields=list(types.value_type),
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)), pa.int32()), flat, type=types)
            take = pa.array(docs)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c).take(take) for c in ("doc_id", "text_hash", "text")], lists],
                ["doc_id", "text_hash", "text", "segments"],
            )

    return pick


def _pieces(window: int):
    """Digest and words of each segment of a document, one after the other."""

    def pieces(text: bytes, parts) -> Iterator[tuple]:
        words = text.split()
        for part in parts:
            size = part["windows"] + window - 1
            piece = b" ".join(words[part["start"] : part["start"] + size])
            yield part, size, piece, xxhash.xxh3_128_digest(piece)

    return pieces


def _segment_texts(window: int):
    """A row per segment with its words and their digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("segments").to_pylist()):
                rows += [(p["value"], key, piece, size) for p, size, piece, key in _pieces(window)(text, parts)]
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64(), pa.binary(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["value", "key", "words", "size"]
            )

    return cut


def _segment_keys(window: int):
    """A row per segment with its place and the digest of its words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            owner, rows = [], []
            for i, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("segments").to_pylist())):
                rows += [(p["start"], key) for p, _, _, key in _pieces(window)(text, parts)]
                owner += [i] * len(parts)
            columns = list(zip(*rows)) or [()] * 2
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(take) for c in ("doc_id", "text_hash")],
                    pa.array(columns[0], pa.int32()),
                    pa.array(columns[1], pa.binary()),
                ],
                ["doc_id", "text_hash", "start", "key"],
            )

    return cut


class SuffixAutomaton:
    """Automaton of word sequences, each with a weight; a state's weight is that of its occurrences."""

    def __init__(self, texts: list[list[bytes]], weights: list[int]):
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.weight: list[int] = [0]
        last = 0
        for number, (words, weight) in enumerate(zip(texts, weights)):
            for word in words:
                last = self._append(last, word, weight)
            last = self._append(last, number, 0)  # a mark no other text has
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.weight[self.link[state]] += self.weight[state]

    def _append(self, last: int, symbol, weight: int) -> int:
        following, link, length = self.next, self.link, self.length
        state = len(length)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.weight.append(weight)
        p = last
        while p >= 0 and symbol not in following[p]:
            following[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = following[p][symbol]
            if length[q] != length[p] + 1:
                copy = len(length)
                following.append(following[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                self.weight.append(0)
                while p >= 0 and following[p].get(symbol) == q:
                    following[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
            else:
                link[state] = q
        return state

    def repeated(self, words: list[bytes], window: int) -> list[list[int]]:
        """Word spans covered by windows whose weight is at least two, from the matching statistics."""
        following, link, length, weight = self.next, self.link, self.length, self.weight
        spans: list[list[int]] = []
        state = matched = 0
        for end, word in enumerate(words, 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if matched >= window and weight[state] > 1:
                if spans and spans[-1][1] >= end - window:
                    spans[-1][1] = end
                else:
                    spans.append([end - window, end])
        return spans


def _search_shard(window: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        # Segments that are all there is of their fingerprint need no search.
        alone = rows["value"].map(rows["value"].value_counts()) == 1
        out = [(key, [{"from": 0, "to": size}]) for key, size, n in rows.loc[alone, ["key", "size", "n"]].values if n > 1]
        rows = rows[~alone]
        texts = [w.split(b" ") for w in rows["words"]]
        automaton = SuffixAutomaton(texts, rows["n"].tolist())
        for key, words in zip(rows["key"], texts):
            if spans := automaton.repeated(words, window):
                out.append((key, [{"from": a, "to": b} for a, b in spans]))
        return pd.DataFrame(out, columns=["key", "spans"])

    return search


def _windows(window: int):
    """Fingerprint of each window of a segment."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for key, text, n in zip(rows["key"], rows["words"], rows["n"]):
                words = text.split(b" ")
                for i in range(len(words) - window + 1):
                    out.append((key, i, xxhash.xxh3_128_digest(b" ".join(words[i : i + window])), n))
            yield pd.DataFrame(out, columns=["key", "at", "print", "n"])

    return cut


_SPANS = "array<struct<`from`:int,`to`:int>>"


def repeated_segments(texts: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(key, spans) of the segments with repeated windows. ``texts``: see ``_segment_texts``."""
    distinct = stored(
        texts.groupBy("value", "key").agg(
            F.first("words").alias("words"), F.first("size").alias("size"), F.count("*").alias("n")
        ),
        "segments",
    )
    total = distinct.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sizes = distinct.groupBy("value").agg(F.sum("size").alias("all"))
    wide = stored(sizes.where(F.col("all") > shard_words).select("value"), "wide")

    shard = F.pmod(F.xxhash64("value"), F.lit(total // shard_words + 1))
    searched = (
        distinct.join(wide, "value", "left_anti")
        .withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(_search_shard(window), f"key binary, spans {_SPANS}")
    )

    rows = distinct.join(wide, "value", "left_semi").select("key", "words", "n")
    windows = rows.mapInPandas(_windows(window), "key binary, at int, print binary, n long")
    often = windows.groupBy("print").agg(F.sum("n").alias("weight")).where("weight > 1")
    span = F.struct(F.col("at").alias("from"), (F.col("at") + window).alias("to"))
    counted = (
        windows.join(often, "print", "left_semi")
        .groupBy("key")
        .agg(F.collect_list(span).cast(_SPANS).alias("spans"))
    )
    return searched.union(counted)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words outside the spans, joined by spaces."""
    for batch in _slices(batches):
        total, removed, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.split()
            hit = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                hit[s["from"]] += 1
                hit[s["to"]] -= 1
            stay = np.cumsum(hit[:-1]) == 0
            total.append(len(words))
            removed.append(int(len(words) - stay.sum()))
            kept.append(b" ".join([w for w, s in zip(words, stay) if s]).decode())
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("doc_id", "text_hash")],
                *[pa.array(c, pa.int64()) for c in (total, removed)],
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "text_hash", "n_words", "n_removed", "kept"],
        )


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        words = _split(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words]),
            ],
            ["doc_id", "text_hash", "n_words", "kept_sha256"],
        )


def with_hash(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return documents_of(documents, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def repeated_passages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, text, spans): the documents with repeated passages, and their word spans.

    Spans may overlap. A row stands for each row of the documents.
    """
    docs = with_hash(documents, id_col, text_col)
    suspects = stored(suspect_documents(docs), "suspects")
    places = suspects.mapInArrow(
        _segment_keys(WINDOW), "doc_id long, text_hash long, start int, key binary"
    )
    texts = suspects.select("text", "segments").mapInArrow(
        _segment_texts(WINDOW), "value long, key binary, words binary, size int"
    )
    moved = F.transform(
        "spans",
        lambda s: F.struct((s["from"] + F.col("start")).alias("from"), (s["to"] + F.col("start")).alias("to")),
    )
    spans = (
        places.join(repeated_segments(texts), "key")
        .groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_set(moved)).alias("spans"))
    )
    rows = suspects.select("doc_id", "text_hash", "text")
    return rows.join(spans, _same(rows, spans)).select(rows["doc_id"], rows["text_hash"], "text", "spans")


def suspect_documents(docs: DataFrame, filter_values: int = FILTER_VALUES) -> DataFrame:
    """(doc_id, text_hash, text, segments) with the segments whose fingerprint another segment has."""
    values = docs.select("text").mapInArrow(_values, "value long").groupBy("value").agg(F.count("*").alias("n"))
    values = stored(values.where("n > 1").select("value"), "values")
    if values.count() <= filter_values:
        bits = docs.sparkSession.sparkContext.broadcast(value_filter(values))
        listed = "array<struct<start:int,windows:int,value:bigint>>"
        return docs.mapInArrow(
            _passing(bits), f"doc_id long, text_hash long, text binary, segments {listed}"
        )
    found = docs.mapInArrow(
        _segment_rows, "doc_id long, text_hash long, start int, windows int, value long"
    ).join(values, "value")
    listed = found.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "windows", "value")).alias("segments")
    )
    return docs.join(listed, _same(docs, listed)).select(docs["doc_id"], docs["text_hash"], "text", "segments")


def without_repeats(repeats: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_removed, kept) of the documents with repeated passages."""
    return repeats.mapInArrow(
        _kept, "doc_id long, text_hash long, n_words long, n_removed long, kept string"
    )


def digest(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    changed = without_repeats(repeated_passages(documents)).withColumn("kept_sha256", F.sha2("kept", 256))
    changed = stored(changed.drop("kept"), "changed")
    every = with_hash(documents).mapInArrow(
        _untouched, "doc_id long, text_hash long, n_words long, kept_sha256 string"
    )
    known = changed.select("doc_id", "text_hash")
    rest = every.join(known, _same(every, known), "left_anti")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return changed.select(columns).union(rest.withColumn("n_removed", F.lit(0).cast("long")).select(columns))
