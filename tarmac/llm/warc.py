"""Web archive files, and one globally ordered capture history merged from their indexes.

Every task writes its pages as gzipped WARC records into archives of bounded size. A payload that
an earlier page holds already becomes a revisit record without payload. Beside each archive the
task leaves its captures as a sorted run: lines of URL key, time, page, kind, place in the archive.
Runs are cut into blocks whose first keys are listed.

The history is an external merge of these runs. Ranges of keys are set from a bounded sample of
block keys (this decides balance only); each range is one group that opens, of each run, the
blocks that reach into it, and merges them with a loser tree: one comparison per level for every capture, whatever the
number of runs. More than ``FAN_IN`` runs are merged in groups to longer runs first. The key includes
time and page, so a URL with very many captures is cut into ranges like any other.

Pages are shuffled only where many payloads repeat: the groups of equal payloads are stored, and Spark
broadcasts them to the pages while they are small.

Files are named anew by every attempt of a task and count only once they are in the stored
list, so lost executors leave at most unlisted files.

Odd input: null html is an empty payload; a null url has an empty key; a null page id is written as
such and comes first; rows that share the smallest page id of a payload are all responses; an
empty table gives no archives. Only page id, url and html (and the time, if named) are read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import open_folder, runs_of, scratch, stored

ARCHIVE_BYTES = 128 << 20
BLOCK_LINES = 512
RANGE_LINES = 20_000
KEY_SAMPLE = 10_000
FAN_IN = 64
LEVEL = 3
_CHUNK = 1 << 20
#: Bytes of payloads that are Python objects at a time.
SLICE_BYTES = 8 << 20
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Years 1 and 9999.
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799


def url_key(url: Column) -> Column:
    """Host labels in reverse, then path and query without fragment, lower case: the sort key of a URL."""
    url = F.lower(F.coalesce(url, F.lit("")))
    rest = F.regexp_replace(F.regexp_replace(url, r"^[a-z][a-z0-9+.-]*://", ""), r"#[\s\S]*$", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    path = F.regexp_replace(rest, r"^[^/?]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    return F.when(url == "", "").otherwise(F.regexp_replace(key, r"[\x00-\x1f]", " "))


def captures(
    pages: DataFrame,
    min_payload: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    time_col: str | None = None,
) -> DataFrame:
    """(page_id, url, key, captured, payload, digest, refers_to): pages and what they repeat.

    Without a time column the capture time is the page id in seconds.
    """
    seconds = F.coalesce(F.col(time_col or id_col).cast("long"), F.lit(0))
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        url_key(F.col(url_col).cast("string")).alias("key"),
        seconds.alias("captured"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= min_payload)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    )
    groups = stored(groups.where("n > 1 and first is not null").select("of", "first"), "payloads")
    revisit = (F.octet_length("payload") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(groups, F.col("digest") == F.col("of"), "left").select(
        *rows.columns, F.when(revisit, F.col("first")).alias("refers_to")
    )


def _line(text: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", text or "")


def _date(captured: int) -> str:
    """The time as WARC writes it. Its years have four digits; times before or after them count as the first or last."""
    moment = _EPOCH + timedelta(seconds=min(max(captured, _FIRST_SECOND), _LAST_SECOND))
    return moment.replace(tzinfo=None).isoformat() + "Z"


def record(page, url: str | None, captured: int, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, not yet compressed."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Date: {_date(captured)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _sort_key(key: str, captured: int, page) -> str:
    """Key, time and page as one string whose byte order is the order of captures."""
    number = 0 if page is None else page + (1 << 63) + 1
    return f"{key}\t{captured + (1 << 63):020d}\t{number:020d}"


class RunWriter:
    """Writes sorted lines as a run, in blocks, and lists the blocks."""

    def __init__(self, system, root: str):
        self.name = f"{uuid.uuid4().hex}.run"
        self.out = system.open_output_stream(f"{root}/{self.name}")
        self.at, self.blocks, self.lines = 0, [], []

    def add(self, line: str) -> None:
        self.lines.append(line)
        if len(self.lines) == BLOCK_LINES:
            self._flush()

    def _flush(self) -> None:
        data = ("\n".join(self.lines) + "\n").encode()
        first = self.lines[0].rsplit("\t", 2)[0]
        self.blocks.append((self.name, len(self.blocks), first, self.at, len(data), len(self.lines)))
        self.out.write(data)
        self.at, self.lines = self.at + len(data), []

    def close(self) -> list[tuple]:
        if self.lines:
            self._flush()
        self.out.close()
        return self.blocks


_BLOCKS = "archive string, run string, block int, first string, at long, size long, lines long"
_BLOCK_TYPES = pa.schema(
    [("archive", pa.string()), ("run", pa.string()), ("block", pa.int32()), ("first", pa.string())]
    + [(c, pa.int64()) for c in ("at", "size", "lines")]
)


def _block_batch(archive: str | None, blocks: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*[(archive, *b) for b in blocks])) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_TYPES)], schema=_BLOCK_TYPES)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, of which only a few are Python objects at a time."""
    sizes = np.asarray(pc.binary_length(batch.column("payload")).fill_null(0), np.int64)
    for low, high in runs_of(sizes, SLICE_BYTES):
        yield from batch.slice(low, high - low).to_pylist()


def _write(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        out, name, at, lines = None, "", 0, []

        def finish() -> pa.RecordBatch:
            out.close()
            run = RunWriter(system, root)
            for line in sorted(lines):
                run.add(line)
            return _block_batch(name, run.close())

        for batch in batches:
            for row in _rows(batch):
                if out is None:
                    name, at, lines = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                page, refers_to = row["page_id"], row["refers_to"]
                raw = record(page, row["url"], row["captured"], row["payload"], digest, refers_to)
                packer = zlib.compressobj(LEVEL, wbits=31)
                data = packer.compress(raw) + packer.flush()
                out.write(data)
                lines.append(f"{_sort_key(row['key'], row['captured'], page)}\t{name}\t{at}")
                at += len(data)
                if at >= archive_bytes:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    return write


def write(rows: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, str]:
    """Write ``captures`` rows as archives and runs; returns the list of run blocks and the folder."""
    folder = folder or scratch(rows.sparkSession, "warc")
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    return stored(rows.mapInArrow(_write(folder, archive_bytes), _BLOCKS), "blocks"), folder


class LoserTree:
    """Merges sorted iterators; inner nodes keep the loser of the match below them."""

    def __init__(self, sources: list[Iterator[str]]):
        self.sources, self.size = sources, len(sources)
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * self.size
        winners = [-1] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def __iter__(self) -> Iterator[str]:
        while self.size and (head := self.heads[self.winner]) is not None:
            yield head
            best = self.winner
            self.heads[best] = next(self.sources[best], None)
            node = (best + self.size) // 2
            while node:
                if not self._before(best, self.losers[node]):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def _lines(system, path: str, blocks: list[tuple[int, int]], low: str, high: str | None) -> Iterator[str]:
    """A run's lines from ``low`` up to, not including, ``high``."""
    with system.open_input_file(path) as file:
        for at, size in blocks:
            file.seek(at)
            for line in file.read(size).decode().split("\n")[:-1]:
                if line >= low and (high is None or line < high):
                    yield line


def _merge_runs(folder: str):
    """All of some runs into one longer run."""

    def merge(rows):
        system, root = open_folder(folder)
        rows = rows.sort_values(["run", "block"])
        sources = [
            _lines(system, f"{root}/{run}", list(zip(part["at"], part["size"])), "", None)
            for run, part in rows.groupby("run")
        ]
        out = RunWriter(system, root)
        for line in LoserTree(sources):
            out.add(line)
        return _block_batch(None, out.close()).to_pandas()

    return merge


_HISTORY = "range int, number long, key string, captured long, page_id long, archive string, offset long"


def _merge_range(folder: str, bounds: list[str]):
    def merge(key, rows):
        number = int(key[0])
        system, root = open_folder(folder)
        low = bounds[number - 1] if number else ""
        high = bounds[number] if number < len(bounds) else None
        rows = rows.sort_values(["run", "block"])
        sources = [
            _lines(system, f"{root}/{run}", list(zip(part["at"], part["size"])), low, high)
            for run, part in rows.groupby("run")
        ]
        out = []
        for i, line in enumerate(LoserTree(sources)):
            url, captured, page, archive, offset = line.rsplit("\t", 4)
            page = None if int(page) == 0 else int(page) - (1 << 63) - 1
            out.append((number, i, url, int(captured) - (1 << 63), page, archive, int(offset)))
        names = [c.split()[0] for c in _HISTORY.split(", ")]
        # Page ids as they are: beside a null, pandas would take them for floating-point numbers.
        pages = pd.array([row[4] for row in out], "Int64")
        return pd.DataFrame([(*row[:4], 0, *row[5:]) for row in out], columns=names).assign(page_id=pages)

    return merge


def history(blocks: DataFrame, folder: str, fan_in: int = FAN_IN, range_lines: int = RANGE_LINES) -> DataFrame:
    """(history_no, key, captured, page_id, archive, offset) of all captures, numbered in global order."""
    runs = blocks.select("run").distinct().count()
    while runs > fan_in:
        groups = -(-runs // fan_in)
        numbered = blocks.select("run").distinct().select(
            F.col("run").alias("of"), F.pmod(F.xxhash64("run"), F.lit(groups)).alias("group")
        )
        blocks = stored(
            blocks.join(numbered, F.col("run") == F.col("of"))
            .groupBy("group")
            .applyInPandas(_merge_runs(folder), _BLOCKS),
            "blocks",
        )
        runs = blocks.select("run").distinct().count()

    lines = blocks.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    ranges = max(1, lines // range_lines)
    sample = blocks.select("first").orderBy(F.xxhash64("run", "block")).limit(KEY_SAMPLE).collect()
    keys = sorted(r["first"] for r in sample)
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The ranges that each block reaches into, up to the next block's first line."""
        for rows in batches:
            low = [bisect.bisect_right(bounds, x) for x in rows["first"]]
            high = [len(bounds) if x is None else bisect.bisect_right(bounds, x) for x in rows["after"]]
            yield pd.DataFrame(
                [(r, *row) for a, b, *row in zip(low, high, rows["run"], rows["block"], rows["at"], rows["size"]) for r in range(a, b + 1)],
                columns=["range", "run", "block", "at", "size"],
            )

    after = F.lead("first").over(Window.partitionBy("run").orderBy("block"))
    parts = blocks.withColumn("after", after).mapInPandas(reached, "range int, run string, block int, at long, size long")
    merged = stored(parts.groupBy("range").applyInPandas(_merge_range(folder, bounds), _HISTORY), "history")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = merged.groupBy("range").agg(F.count("*").alias("n"))
    counts = counts.select(F.col("range").alias("of"), F.coalesce(before, F.lit(0)).alias("before"))
    return merged.join(counts, F.col("range") == F.col("of")).select(
        (F.col("before") + F.col("number")).alias("history_no"), "key", "captured", "page_id", "archive", "offset"
    )


def _records(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a stream, one at a time."""
    data, at = b"", 0
    while True:
        if not data and not (data := stream.read(_CHUNK)):
            return
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while True:
            parts.append(unpack.decompress(data))
            if unpack.eof:
                used += len(data) - len(unpack.unused_data)
                data = unpack.unused_data
                break
            used += len(data)
            if not (data := stream.read(_CHUNK)):
                raise EOFError("archive ends within a record")
        yield at, b"".join(parts)
        at += used


def parse(raw: bytes) -> dict:
    """Fields of a record and, for a response, length and digest of its payload as found."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    else:
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").rstrip(">")) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
    }


def _read(folder: str):
    types = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for at, raw in _records(stream):
                        rows.append({"archive": name, "offset": at, **parse(raw)})
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, types)

    return read


def read(blocks: DataFrame, folder: str) -> DataFrame:
    """(archive, offset, page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    names = blocks.where("archive is not null").select("archive").distinct()
    return names.repartition("archive").mapInArrow(
        _read(folder),
        "archive string, offset long, page_id long, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


def digest(pages: DataFrame) -> DataFrame:
    """Each page as read back from the archives, with its place in the capture history."""
    blocks, folder = write(captures(pages))
    order = history(blocks, folder).select("history_no", "key", F.col("archive").alias("in"), F.col("offset").alias("at"))
    rows = read(blocks, folder)
    return rows.join(order, (F.col("archive") == F.col("in")) & (F.col("offset") == F.col("at"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("key").alias("url_key"), "history_no"
    )
