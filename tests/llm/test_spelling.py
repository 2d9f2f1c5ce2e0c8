"""Spelling variants against a plain version, with tiles of every size."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.llm import queries, spelling
from tarmac.llm.common import documents_of, stored


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(documents, noise=97, least=3):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            code = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and noise and code % noise == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= least}


def plain(words):
    """(word, form, root, n, n_near, form_n) of each word."""
    forms, near = {}, {}
    for word, n in words.items():
        others = sorted((-words[o], o) for o in words if one_edit(word, o))
        near[word] = len(others)
        forms[word] = others[0][1] if others and -others[0][0] >= 2 * n else None

    def root(word):
        return word if forms[word] is None else root(forms[word])

    return sorted((w, forms[w], root(w), n, near[w], words.get(forms[w])) for w, n in words.items())


def as_tuples(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def frame_of(spark, words):
    return stored(spark.createDataFrame(list(words.items()), "word string, n long"), "words")


@pytest.mark.parametrize("tile_words", [1, 7, 512])
def test_random_words(spark, tile_words):
    rng = random.Random(tile_words)
    words = {}
    while len(words) < 500:
        word = "".join(rng.choices("abé", k=rng.randint(5, 9)))
        words[word] = rng.choice([3, 3, 4, 6, 10, 30, 200])
    assert as_tuples(spelling.variants(frame_of(spark, words), tile_words=tile_words)) == plain(words)


def test_shared_prefixes_and_repeated_letters(spark):
    """A prefix that most words share, insertions into runs of one letter, and words of several lengths."""
    words = {"a" * k: 3 * k for k in range(5, 14)}
    words |= {"unreasonabl" + a + b: 3 + i for i, (a, b) in enumerate((x, y) for x in "abcdefgh" for y in "abcdefgh")}
    words |= {"x" + w: 5 for w in list(words)[:20]}
    for tile_words in (3, 40):
        assert as_tuples(spelling.variants(frame_of(spark, words), tile_words=tile_words)) == plain(words)


def test_very_long_words(spark):
    base = "ab" * 1500
    words = {base: 50, base[:2000] + "x" + base[2000:]: 4, base[:-1] + "é": 3, "ab" * 1499: 7, "y" + base: 9}
    assert as_tuples(spelling.variants(frame_of(spark, words), tile_words=1)) == plain(words)


def test_roots_at_the_end_of_long_chains(spark):
    words = {"a" * 5 + "b" * k: 3 << k for k in range(18)}
    found = as_tuples(spelling.variants(frame_of(spark, words)))
    assert found == plain(words) and {r[2] for r in found} == {"a" * 5 + "b" * 17}


def test_ties_go_to_the_smaller_word(spark):
    words = {"stone": 3, "stoné": 6, "stong": 6, "Zzzzz": 3}
    found = {r[0]: r for r in as_tuples(spelling.variants(frame_of(spark, words)))}
    assert found["stone"][1:3] == ("stong", "stong") and found["Zzzzz"][1:5] == (None, "Zzzzz", 3, 0)


def test_counts_of_odd_rows(odd_documents, odd_pairs):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    named = odd_documents.withColumns({"word": F.lit("x"), "tile": F.lit(1)})
    for noise in (2, 97, 0):
        found = spelling.word_counts(documents_of(named), noise=noise, min_count=1)
        assert {r.word: r.n for r in found.collect()} == counted(odd_pairs, noise, 1)


def test_counts_do_not_depend_on_slices(odd_documents, odd_pairs, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE_BYTES", 100)
    monkeypatch.setattr(spelling, "TASK_WORDS", 10)
    found = spelling.word_counts(documents_of(odd_documents), noise=5, min_count=1)
    assert {r.word: r.n for r in found.collect()} == counted(odd_pairs, 5, 1)


def test_empty_tables(spark):
    none = spelling.word_counts(spark.createDataFrame([], "doc_id long, text string"))
    assert spelling.variants(stored(none, "words")).count() == 0


def test_no_tile_is_large_and_every_word_is_in_one_per_half(spark):
    words = {"commonprefix" + "".join(c): 3 for c in itertools.product("abcdefghij", repeat=3)}
    tiles = spelling._tiles(frame_of(spark, words), 50)
    sizes = tiles.groupBy("tile", "start", "end").count()
    assert sizes.where("end - start > 1").agg(F.max("count")).first()[0] <= 50
    assert sizes.agg(F.max("count")).first()[0] <= 50  # one place: no more words than letters
    assert as_tuples(spelling.variants(frame_of(spark, words), tile_words=50)) == plain(words)


def test_query_against_plain_version(spark, tmp_path):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdé", k=rng.randint(4, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=80)) + ". Señor, ÀÉ×÷ señor señor") for i in range(40)] + [(None, words[0]), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = as_tuples(queries.op13_spelling_variants(spark, str(tmp_path)))
    assert found == plain(counted(rows)) and any(r[1] for r in found)
