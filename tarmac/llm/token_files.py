"""Token ids as binary files with a shared compression dictionary.

A file holds a run of documents in ascending id order. Each document's ids are compressed on
their own with a zstandard dictionary that all files share, so one short document can be read
without its neighbours. Layout, little-endian:

    magic 8 | dictionary sha256 32 | bytes per id 4 | frames ... | index | documents 8 | index at 8

with one index entry per document: id 8 (null: the least value), offset 8, length 8, tokens 8.

The dictionary is trained on the serialized ids of a bounded sample (``SAMPLE_DOCS`` documents, by
a hash, and at most ``SAMPLE_BYTES``, a hundredth of that from one document). Files are cut at quantiles of the ids alone, before texts
are read; texts are encoded where they lie, and only compressed frames are shuffled to their file.
A task that runs again writes a new file; readers follow the stored list of files, which names
one file per range, so nothing half-written is ever read.

Ids are those of the library's ``encode`` without special tokens; an added token's string in a text is that token.

Odd input: a null text is empty and has the end id alone; null ids come first; rows with equal ids
keep an order by their text's hash; an empty table gives no files. Only id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm.common import documents_of, open_folder, runs_of, scratch, stored

MAGIC = b"TOKFILE1"
END_ID = 2
FILE_DOCS = 8192
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Bytes of texts that are encoded at a time.
SLICE_BYTES = 4 << 20
_ROWS = 1000
_NULL_ID = -(2**63)
_INDEX = np.dtype([("id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("tokens", "<i8")])

# Behind a letter or digit, these always start a piece of their own.
_PUNCTUATION = ".,;:!?"


class Encoder:
    """Encodes texts by parts between spaces, keeping what they became.

    A space between two other characters always starts a new piece of the tokenizer; beside another
    white space it may not, and a text with such a place is encoded as it is. New parts are encoded
    many at a time, as one text: each starts with a token that begins with a space.
    """

    LIMIT = 300_000
    TOGETHER = 200

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # An added token is found anywhere in a text, also within and across parts.
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")  # a space, as byte-level vocabularies write it
        # Parts, which stand behind a space; false for one that begins or ends with white space.
        self.known: dict[str, bytes | bool] = {}
        self.tails: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _part_ids(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each part with its serialized ids behind a space."""
        groups = [parts[i : i + self.TOGETHER] for i in range(0, len(parts), self.TOGETHER)]
        texts = [" " + " ".join(g) for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.dtype)
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(group):
                yield from zip(group, self._ids([" " + p for p in group]))
                continue
            data, ends = ids.tobytes(), np.append(cuts, len(ids)) * self.dtype.itemsize
            yield from zip(group, [data[a:b] for a, b in itertools.pairwise(ends.tolist())])

    def _learn(self, parts: set[str]) -> None:
        known, tails, bare, split = self.known, self.tails, [], []
        for part in parts:
            core = part.rstrip(_PUNCTUATION)
            if not part or part != part.strip():
                known[part] = False
            elif core and core != part and core[-1].isalnum():
                split.append((part, core, part[len(core) :]))
            else:
                bare.append(part)
        cores = {core for _, core, _ in split}.difference(known, bare)
        known.update(self._part_ids([*bare, *cores]))
        new = list({tail for _, _, tail in split}.difference(tails))
        tails.update(zip(new, self._ids(new)))
        known.update((part, known[core] + tails[tail]) for part, core, tail in split)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of each text."""
        whole = [i for i, text in enumerate(texts) if self.added and self.added.search(text)]
        parts = [text.split(" ") for text in texts]
        for i in whole:
            parts[i] = [""]
        heads = [p.pop(0) for p in parts]
        if len(self.known) > self.LIMIT:
            self.known.clear()
            self.tails.clear()
        self._learn(set(itertools.chain.from_iterable(parts)).difference(self.known))
        out, odd, ids_of = [], list(whole), self.known.__getitem__
        for i, p in enumerate(parts):
            try:
                out.append(b"".join(map(ids_of, p)))
            except TypeError:  # a false among them
                out.append(b"")
                odd.append(i)
                continue
            if heads[i][-1:].isspace():
                odd.append(i)
        out = [head + rest for head, rest in zip(self._ids(heads), out)]
        for i, ids in zip(odd, self._ids([texts[i] for i in odd])):
            out[i] = ids
        return out


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One tokenizer per Python worker, as it takes long to load."""
    return Encoder(path)


def _encoded(path: str, end_id: int, dictionary, bounds=None):
    """(doc_id, file, text_hash, tokens, frame); without a dictionary the ids as they are.

    ``bounds``: the greatest id of each file but the last one.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        pack = (lambda data: data) if dictionary is None else compressor(dictionary.value).compress
        cuts = np.zeros(0, np.int64) if bounds is None else bounds.value
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column("text")).fill_null(0), np.int64)
            for low, high in runs_of(sizes, SLICE_BYTES):
                part = batch.slice(low, high - low)
                ids = [x + end for x in encoder.encode([t or "" for t in part.column("text").to_pylist()])]
                file = np.searchsorted(cuts, np.asarray(part.column("doc_id").fill_null(_NULL_ID)), "left")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(file, pa.int32()),
                        part.column("text_hash"),
                        pa.array([len(x) // encoder.dtype.itemsize for x in ids], pa.int64()),
                        pa.array([pack(x) for x in ids], pa.binary()),
                    ],
                    ["doc_id", "file", "text_hash", "tokens", "frame"],
                )
        encoder.known.clear()  # the worker goes on to other tasks

    return encode


_ENCODED = "doc_id long, file int, text_hash long, tokens long, frame binary"


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def train_dictionary(documents: DataFrame, path: str, rows: int, end_id: int = END_ID) -> bytes:
    """A dictionary from a bounded sample of serialized ids."""
    draw = F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(1 << 30))
    sample = documents.where(draw < min(1.0, SAMPLE_DOCS / max(rows, 1)) * (1 << 30))
    samples, size = [], 0
    for (frame,) in sample.mapInArrow(_encoded(path, end_id, None), _ENCODED).select("frame").toLocalIterator():
        samples.append(bytes(frame[: SAMPLE_BYTES // 100]))
        size += len(samples[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples: their content itself serves
        return b"".join(samples)[:DICTIONARY_BYTES] or MAGIC


def _write(folder: str, dictionary, width: int):
    """Writes each file's documents, which arrive in order, and lists the files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        digest = hashlib.sha256(dictionary.value).digest()
        out, current, entries, at, name = None, None, [], 0, ""

        def finish() -> pa.RecordBatch:
            index = np.array(entries, _INDEX)
            out.write(index.tobytes() + struct.pack("<qq", len(index), at))
            out.close()
            return pa.record_batch(
                {
                    "file": pa.array([current], pa.int32()),
                    "path": [name],
                    "docs": pa.array([len(index)], pa.int64()),
                    "tokens": pa.array([int(index["tokens"].sum())], pa.int64()),
                }
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "doc_id", "tokens", "frame")]
            for file, doc, tokens, frame in zip(*columns):
                if file != current:
                    if out:
                        yield finish()
                    current, entries, name = file, [], f"{file:08d}-{uuid.uuid4().hex}.tok"
                    out = system.open_output_stream(f"{root}/{name}")
                    out.write(MAGIC + digest + struct.pack("<i", width))
                    at = len(MAGIC) + 36
                out.write(frame)
                entries.append((_NULL_ID if doc is None else doc, at, len(frame), tokens))
                at += len(frame)
        if out:
            yield finish()

    return write


def write(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, str, bytes]:
    """Write all documents; returns the list of files (file, path, docs, tokens), the folder and the dictionary."""
    spark = documents.sparkSession
    docs = documents_of(documents, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    rows = docs.count()
    shares = max(1, -(-rows // FILE_DOCS))
    points = F.array(*[F.lit(i / shares) for i in range(1, shares)]) if shares > 1 else F.array(F.lit(0.5))
    bounds = docs.agg(F.percentile_approx("doc_id", points, F.lit(10 * shares))).first()[0] or []
    bounds = sorted(set(bounds)) if shares > 1 else []

    dictionary = train_dictionary(docs, tokenizer_path, rows, end_id)
    folder = folder or scratch(spark, "tokens")
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/dictionary-{hashlib.sha256(dictionary).hexdigest()}") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    cuts = spark.sparkContext.broadcast(np.array(bounds, np.int64))  # one number per file
    width = encoder_of(tokenizer_path).dtype.itemsize
    frames = docs.mapInArrow(_encoded(tokenizer_path, end_id, shared, cuts), _ENCODED)
    # Every file has a task of its own.
    files = (
        frames.repartitionById(len(bounds) + 1, F.col("file"))
        .sortWithinPartitions("file", F.asc_nulls_first("doc_id"), "text_hash")
        .mapInArrow(_write(folder, shared, width), "file int, path string, docs long, tokens long")
    )
    return stored(files, "files"), folder, dictionary


def read_index(file) -> np.ndarray:
    """Index of an open file."""
    file.seek(file.size() - 16)
    docs, at = struct.unpack("<qq", file.read(16))
    file.seek(at)
    return np.frombuffer(file.read(docs * _INDEX.itemsize), _INDEX)


def read_document(file, dictionary: bytes, entry) -> np.ndarray:
    """Ids of one document of an open file, given its index entry; nothing else is read."""
    file.seek(0)
    head = file.read(len(MAGIC) + 36)
    if head[:8] != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
        raise ValueError("not a token file of this dictionary")
    file.seek(int(entry["offset"]))
    width = struct.unpack("<i", head[40:])[0]
    return np.frombuffer(decompressor(dictionary).decompress(file.read(int(entry["length"]))), f"<u{width}")


def _read(folder: str, dictionary, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        unpack = decompressor(dictionary.value).decompress
        digest = hashlib.sha256(dictionary.value).digest()
        for batch in batches:
            for number, path in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist()):
                with system.open_input_file(f"{root}/{path}") as file:
                    index = read_index(file)
                    file.seek(0)
                    head = file.read(len(MAGIC) + 36)
                    if head[:8] != MAGIC or head[8:40] != digest:
                        raise ValueError(f"{path}: not a token file of this dictionary")
                    width = struct.unpack("<i", head[40:])[0]
                    starts = np.cumsum(index["tokens"]) - index["tokens"]
                    for i in range(0, len(index), _ROWS):
                        part = index[i : i + _ROWS]
                        ids = [np.frombuffer(unpack(file.read(int(n))), f"<u{width}") for n in part["length"]]
                        columns = {
                            "file": pa.array([number] * len(part), pa.int32()),
                            "doc_id": pa.array(part["id"], mask=part["id"] == _NULL_ID),
                            "start_in_file": pa.array(starts[i : i + _ROWS]),
                            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                        }
                        if with_ids:
                            columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                        yield pa.record_batch(columns)

    return read


def read(files: DataFrame, folder: str, dictionary: bytes, with_ids: bool = True) -> DataFrame:
    """(file, doc_id, start_in_file, n_tokens, ids_crc32[, ids]) of every document in the files."""
    shared = files.sparkSession.sparkContext.broadcast(dictionary)
    schema = "file int, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    count = max(1, files.count())
    return files.select("file", "path").repartition(count, "file").mapInArrow(
        _read(folder, shared, with_ids), schema
    )


def digest(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    files, folder, dictionary = write(documents, tokenizer_path, end_id)
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select(F.col("file").alias("of"), F.coalesce(before, F.lit(0)).alias("before"))
    rows = read(files, folder, dictionary, with_ids=False)
    return rows.join(starts, F.col("file") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32"
    )
