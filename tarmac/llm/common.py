"""Shared folder, stored intermediate tables and byte-level word handling."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z on UTF-8 bytes; other letters stay as they are.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that every executor reaches.

    It lies under ``spark.checkpoint.dir``; where that is unset, under the
    warehouse, which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again.

    Whatever is built on it starts from those files, also after executors were
    lost, and nothing before them runs twice.
    """
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def open_folder(uri: str):
    """File system and path of a folder, for tasks that write their own file formats."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application.

    Not needed, but harmless, where it is installed on every machine.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = f"tarmac-{context.applicationId}.zip"
    if any(os.path.basename(f) == name for f in context.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(os.path.join(root, "tarmac")):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, root))
    context.addPyFile(path)


def documents_of(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names, so that no other column can clash."""
    return frame.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def row_field(batch: pa.RecordBatch, name: str, start: int, rows: int) -> list[bytes | None]:
    """Some rows' values of a text field of the struct ``row``, as UTF-8 bytes.

    Reading it there spares a second copy of the texts beside the rows that are passed on.
    """
    part = pc.struct_field(batch.column("row").slice(start, rows), name)
    return pc.cast(pc.cast(part, pa.string()), pa.binary()).to_pylist()


def runs_of(sizes: np.ndarray, most: int):
    """Runs (start, end) of rows with about ``most`` in sum; a larger row is a run of its own."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield low, high
        low = high


def byte_slices(batch: pa.RecordBatch, name: str, most: int):
    """Runs of a batch's rows with their texts (field ``name`` of the struct ``row``, UTF-8 bytes or null).

    A run has about ``most`` bytes of text; a longer text is a run of its own.
    """
    sizes = pc.binary_length(pc.cast(pc.struct_field(batch.column("row"), name), pa.string()))
    for low, high in runs_of(np.asarray(sizes.fill_null(0), np.int64), most):
        yield batch.slice(low, high - low), row_field(batch, name, low, high - low)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs stay equal, others spread evenly."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


# ASCII white space separates words, as bytes.split() has it.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_CHUNK_WORDS = 100_000


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(size, base, np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tables[0], tables[1]


def word_hashes(texts: list[bytes | None], fold: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all texts, one text after the other, and each text's number of words.

    A word's fingerprint is a polynomial of its bytes: the difference of two prefix sums.
    """
    data = b" ".join([t or b"" for t in texts]) + b" "
    data = np.frombuffer(data.translate(fold) if fold else data, np.uint8)
    edge = np.diff(_SPACE[data].astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    text_ends = np.cumsum([len(t or b"") + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    hashes = np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), _CHUNK_WORDS):
        part = slice(low, low + _CHUNK_WORDS)
        first, start, end = starts[part][0], starts[part], ends[part]
        size = int(end[-1] - first)
        power, inverse = _powers(1 << max(20, size.bit_length()))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[first : first + size] + np.uint64(1)) * power[:size], out=sums[1:])
        hashes[part] = (sums[end - first] - sums[start - first]) * inverse[start - first]
        hashes[part] = mix(hashes[part] + (end - start).astype(np.uint64))
    return hashes, counts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of ``size`` words; none if there are fewer words.

    Runs are put together from runs of half their length.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    runs, length = words, 1
    total, covered = None, 0
    while True:
        if size & length:
            part = runs[covered : covered + n]
            total = part if total is None else mix(total * np.uint64(_BASE) + part)
            covered += length
        if covered == size:
            return total
        runs = mix(runs[:-length] * np.uint64(_BASE) + runs[length:])
        length *= 2
