"""Byte-level BPE against the tokenizer library, piece by piece and over tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import bpe, queries


@pytest.fixture(scope="module")
def merger():
    return bpe.merger_of(queries.RANKS)


@pytest.fixture(scope="module")
def library(merger):
    return tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merger.ranks, special_tokens={}
    )


CLASSES = bpe.class_table()
ODD = [
    *"'strevmlldaBé日1½Ⅷ-!😀\n\t\r\x1c\x85\xa0　́",
    "'s", "'re", "'ll", "'LL", "’s", " ", "  ", "   ", " '", "a'", "\U0001e5f0", "\x00", "\U0010ffff",
]


def encoded(texts, merger):
    ids, counts = bpe.encode_texts([t.encode() for t in texts], merger, CLASSES)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_composition_is_associative():
    composed = bpe._automaton()[0]
    n = range(len(composed))
    assert len(composed) < 64
    assert all(composed[composed[a, b], c] == composed[a, composed[b, c]] for a in n for b in n for c in n)


def test_scan_equals_one_by_one():
    composed, _, numbers, _ = bpe._automaton()
    rng = np.random.default_rng(2)
    for n in (1, 2, 127, 128, 129, 128 * 128 + 5):
        functions = rng.choice(numbers, n)
        state, want = functions[0], [functions[0]]
        for function in functions[1:]:
            state = composed[state, function]
            want.append(state)
        assert bpe._scan(functions).tolist() == want


def test_odd_texts(merger, library):
    rng = random.Random(4)
    for _ in range(1500):
        texts = ["".join(rng.choices(ODD, k=rng.randint(0, 20))) for _ in range(rng.randint(1, 7))]
        assert encoded(texts, merger) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(merger, library, texts):
    assert encoded(texts, merger) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(merger, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(a + "x" for a in points[:: 7]) + " ".join(points[3::11])
    assert encoded([text], merger)[0] == library.encode_ordinary(text)


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz", "aé日", "  \n"])
def test_long_pieces(merger, library, letters):
    rng = random.Random(7)
    for size in (1, 2, 63, 64, 65, 3000):
        piece = "".join(rng.choices(letters, k=size)).encode()
        assert merger._long(piece) == merger._short([piece, piece[:1]])[0]
    text = "".join(rng.choices(letters, k=20_000))
    assert encoded([text], merger)[0] == library.encode_ordinary(text)


def test_cache_is_bounded_and_changes_nothing(merger, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 30_000)
    small = bpe.Merger(queries.RANKS)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdef", k=rng.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    assert encoded(texts, small) == [library.encode_ordinary(t) for t in texts]
    assert small.cached <= 30_000


def test_offsets_decode_any_run_of_tokens(spark, merger):
    text = "It's 12 été\n\n 日本語 😀 we'll  see"
    row = bpe.encode(spark.createDataFrame([(1, text)], "ids int, text string"), queries.RANKS).first()
    assert row.row.ids == 1 and row.ends[-1] == len(text.encode())
    tokens = {rank: token for token, rank in merger.ranks.items()}
    starts = [0, *row.ends[:-1]]
    assert all(text.encode()[a:b] == tokens[i] for a, b, i in zip(starts, row.ends, row.ids))


def test_odd_rows(spark, odd_documents, library, monkeypatch):
    """Null, empty and very long texts, repeated rows, clashing columns; slices of any size."""
    monkeypatch.setattr(bpe, "SLICE_BYTES", 500)
    named = odd_documents.withColumns({"ids": F.lit("x"), "ends": F.lit("y")})
    rows = bpe.encode(named, queries.RANKS)
    found = sorted((str(r.row.doc_id), r.row.text or "", r.ids) for r in rows.collect())
    want = [(str(r.doc_id), r.text or "", library.encode_ordinary(r.text or "")) for r in odd_documents.collect()]
    assert found == sorted(want)
    back = bpe.decode(rows.select("row.doc_id", "row.text", "ids"), queries.RANKS).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)


def test_empty_table(spark):
    rows = bpe.encode(spark.createDataFrame([], "doc_id long, text string"), queries.RANKS)
    assert bpe.decode(rows.select("ids"), queries.RANKS).count() == 0


def test_null_ids_decode_to_nothing(spark):
    frame = spark.createDataFrame([(None,), ([],), ([65, 66],)], "ids array<int>")
    assert sorted(bytes(r.decoded) for r in bpe.decode(frame, queries.RANKS).collect())[:2] == [b"", b""]


def test_query_over_its_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op12_byte_bpe(spark, folder).collect()}
    assert len(found) == len(rows)
    for row in rows:
        ids, got = library.encode_ordinary(row.text or ""), found[row.doc_id]
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        plain = hashlib.sha256((row.text or "").encode()).hexdigest()
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (len(ids), joined, plain)
