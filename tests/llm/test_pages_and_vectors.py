"""Archives with their capture history, nearest neighbours, and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import ann, warc
from tests.llm import brute


@pytest.fixture(scope="module")
def odd_pages(spark):
    data = [
        (3, "http://B.example.com/x?y=1#top", "<p>same</p>"),
        (1, "https://a.example.com/", "<p>same</p>"),
        (1, "https://a.example.com/", "<p>same</p>"),
        (2, None, None),
        (4, "http://a.example.com/", ""),
        (None, "weird\r\nurl", "é\r\n\r\n😀"),
        (5, "", "x" * 300_000),
        (6, "http://a.example.com", "é\r\n\r\n😀"),
    ]
    return spark.createDataFrame([(*r, 7, "z") for r in data], "page_id long, url string, html string, n long, digest string")


def test_archives(odd_pages):
    got = sorted(
        (tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc.digest(odd_pages).collect()),
        key=str,
    )
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in odd_pages.collect()]
    want = []
    for page, payload in pages:
        ids = [p for p, x in pages if x == payload and p is not None]
        first = min(ids) if ids else None
        repeats = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((page, len(payload), digest, "revisit" if repeats else "response", first if repeats else None))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("fan_in, range_lines, archive_bytes", [(64, 20_000, 1 << 27), (2, 7, 600)])
def test_history_is_in_global_order(spark, monkeypatch, fan_in, range_lines, archive_bytes):
    """Also in several passes, over many ranges and blocks, with a very frequent URL."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rng = random.Random(1)
    data = [(i, "http://hot.example.com/" if i % 3 else f"http://h{rng.randint(0, 9)}.example.org/{rng.randint(0, 5)}", str(i % 50)) for i in range(200)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(4)
    blocks, folder = warc.write(warc.captures(pages), archive_bytes=archive_bytes)
    found = warc.history(blocks, folder, fan_in=fan_in, range_lines=range_lines).orderBy("history_no").collect()
    assert [r["history_no"] for r in found] == list(range(200))
    order = [(r["key"], r["captured"], r["page_id"]) for r in found]
    assert order == sorted(order) and len(set(order)) == 200


def test_archives_without_rows(odd_pages):
    assert warc.digest(odd_pages.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [[], [0], [3], [1, 0, 4], [5] * 7, [2, 9, 1, 0, 6]])
def test_loser_tree(sizes):
    rng = random.Random(len(sizes))
    sources = [sorted(rng.choices("abcdefg", k=n)) for n in sizes]
    assert list(warc.LoserTree([iter(s) for s in sources])) == sorted(x for s in sources for x in s)


def brute_nearest(data, k):
    good = {}
    for i, v in data:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault((i, tuple(v)), None)
    good = list(good)
    out = []
    for q, v in good:
        if q % 5 == 0:
            scores = sorted((-float(np.dot(v, w)), i) for i, w in good if i != q)
            out += [(q, n, i) for n, (_, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_nearest_of_odd_rows(spark):
    rng = random.Random(0)
    data = [(i, [float(rng.randint(-3, 3)) for _ in range(8)]) for i in range(60)]
    data += [(100 + i, list(data[7][1])) for i in range(40)]
    data += [(200, None), (201, [0.0] * 8), (202, [1.0] * 7 + [None]), (203, [float("nan")] * 8)]
    data += [(204, [float("inf")] * 8), (205, [1.0] * 3), (None, [1.0] * 8), (206, [])]
    data += [data[5]]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<double>, id int, leaf int")
    found = ann.nearest(frame, F.col("vec_id") % 5 == 0, k=6).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == brute_nearest(data, 6)
    few = ann.nearest(frame.where("vec_id < 4"), F.col("vec_id") == 0, k=6).collect()
    assert len(few) == 3
    assert ann.nearest(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("part_rows, part_queries", [(20_000, 2000), (250, 30)])
def test_recall(spark, monkeypatch, part_rows, part_queries):
    """Vectors of unequal length in clusters, searched in a part of the leaves only."""
    monkeypatch.setattr(ann, "PART_ROWS", part_rows)
    monkeypatch.setattr(ann, "PART_QUERIES", part_queries)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    vectors = centres[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = ann.nearest(frame, F.col("vec_id") % 20 == 0, k=10, leaf_rows=30, search_rows=3000).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 3000, 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        assert len(got[q]) == 10
        hits += len(got[q] & set(np.argsort(-scores)[:10].tolist()))
    assert hits / 1500 >= 0.9


def test_search_grows_with_the_table(spark):
    """Vectors without structure and a small least budget: the share of the table keeps recall up."""
    vectors = np.random.default_rng(4).normal(size=(8000, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = ann.nearest(frame, F.col("vec_id") % 80 == 0, k=10, search_rows=1000).collect()
    hits = 0
    for q in range(0, 8000, 80):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len({r["vec_id"] for r in found if r["query_id"] == q} & set(np.argsort(-scores)[:10].tolist()))
    assert hits / 1000 >= 0.9


def test_search_sees_every_tree():
    """Also where one leaf alone has enough rows."""
    points = np.random.default_rng(5).normal(size=(300, 6))
    forest = ann.Forest([], 9.0)
    forest.trees = [ann.grow(forest.points(points), 50, np.random.default_rng(i)) for i in range(4)]
    sizes = np.full(int(forest.first_leaves()[-1]), 10_000)
    found = np.array(forest.search(points[0], sizes, 500))
    assert set(np.searchsorted(forest.first_leaves(), found, "right") - 1) == {0, 1, 2, 3}


def test_page_ids_of_any_size(spark):
    """Ids as seconds run past the years that a date can have; the order of captures does not suffer."""
    ids = [-(2**63), -(10**15), -1, 0, 253_402_300_799, 253_402_300_800, 2**62, 2**63 - 1, None]
    rows = [(i, "http://a.b/c", f"page {n}") for n, i in enumerate(ids)]
    found = warc.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("history_no").collect()
    captured = [0 if i is None else i for i in ids]
    want = [i for _, _, i in sorted(zip(captured, [i is not None for i in ids], ids), key=lambda x: (x[0], x[1]))]
    assert [r.page_id for r in found] == want
    assert warc._date(2**63 - 1) == "9999-12-31T23:59:59Z" and warc._date(-(2**63)) == "0001-01-01T00:00:00Z"


def test_rows_are_taken_in_slices(monkeypatch):
    monkeypatch.setattr(warc, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pylist([{"payload": p} for p in (b"x" * 30, b"", None, b"yy", b"z" * 9)])
    assert [r["payload"] for r in warc._rows(batch)] == [b"x" * 30, b"", None, b"yy", b"z" * 9]


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    item = text(25)
    docs = [(i, text(60), "en" if i % 2 else "fr", "big" if i % 4 else "small", 1) for i in range(60)]
    docs += [(100, docs[3][1], "en", "big", 1), (101, docs[4][1] + " z", "en", "big", 1)]
    docs += [(102, "a b " + item + " c", "en", "big", 1), (103, None, "en", "big", None), (104, "123", "en", "big", 3)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    frame, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        if name != "tokens":
            assert out.columns == frame.columns
            out.write.parquet(str(tmp_path / name))
            frame = spark.read.parquet(str(tmp_path / name))
            ids.append({r["doc_id"] for r in frame.select("doc_id").collect()})
    every = {d[0] for d in docs}
    assert ids[0] == every - {103, 104}
    kept = [(d[0], d[1]) for d in docs if d[0] in ids[0]]
    assert ids[1] == {c for _, _, c in brute.jaccard_components(kept)} == ids[0] - {100, 101}
    assert ids[2] == ids[1] - {102} == ids[3]
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in ran} == ids[3] and len(ran) == frame.count()
