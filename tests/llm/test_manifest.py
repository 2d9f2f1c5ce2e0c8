"""Merkle manifests against a plain version, and on odd rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n", "text"]
SCHEMA = "doc_id long, source string, lang string, n long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """(root, per node the list of (left, right)) of a list of hashes."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for proof, at in zip(proofs, places):
            run, slot = runs[at // fanout], at % fanout
            proof.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        nodes, places = [digest("".join(run)) for run in runs], [at // fanout for at in places]
    return nodes[0], proofs


def plain(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof) of each row."""
    low = lambda x: (x is not None, x)
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((low(row[0]), leaf_of(row), row[0]))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    below = {}
    for group in order:
        trees[group].sort(key=lambda x: x[:2])
        below[group] = climb([leaf for _, leaf, _ in trees[group]], fanout)
    root, above = climb([below[g][0] for g in order], fanout)
    return [
        (doc_id, leaf, below[g][0], root, tuple(proof + up))
        for g, up in zip(order, above)
        for (_, leaf, doc_id), proof in zip(trees[g], below[g][1])
    ]


def got(frame):
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, tuple((x.left, x.right) for x in r.proof)) for r in frame.collect()), key=str
    )


def rows_of(count, groups):
    return [(i, f"s{i % 3}", f"g{i % groups}", i, f"Text {i}" if i % 5 else None) for i in range(count)]


@pytest.mark.parametrize("count, groups, fanout", [(1, 1, 8), (2, 2, 8), (9, 1, 8), (65, 2, 8), (40, 30, 3), (27, 1, 3)])
def test_trees_of_every_height(spark, count, groups, fanout):
    rows = rows_of(count, groups)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(merkle.manifest(frame, "lang", "doc_id", FIELDS, fanout=fanout)) == sorted(plain(rows, fanout), key=str)


def test_trees_of_different_height_beside_each_other(spark):
    rows = [(i, "s", "big" if i < 70 else "mid" if i < 79 else None if i == 79 else f"é{i}", 1, "x") for i in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.manifest(frame, "lang", "doc_id", FIELDS)) == sorted(plain(rows), key=str)


def test_odd_rows(odd_documents):
    """Nulls in every column, repeated rows and ids, empty and very long texts, and clashing columns."""
    named = odd_documents.withColumns({"tree": F.lit(1), "pos": F.lit(2), "node": F.lit(3), "leaf": F.lit("x")})
    found = merkle.manifest(named, "lang", "doc_id", ["doc_id", "source", "lang", "n", "text"], {"held": F.col("leaf")})
    assert found.columns == ["doc_id", "leaf", "held", "subroot", "root", "proof"]
    rows = [tuple(r[c] for c in ("doc_id", "source", "lang", "n", "text")) for r in odd_documents.collect()]
    assert got(found) == sorted(plain(rows), key=str)
    # Repeated rows have one leaf and as many proofs as rows, each of which proves.
    folds = found.select(merkle.folded(F.col("leaf"), F.col("proof")).alias("top"), "root").collect()
    assert len(folds) == len(rows) and all(r.top == r.root for r in folds)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), "lang", "doc_id", FIELDS).count() == 0


def test_many_equal_rows_are_split_over_ranges(spark):
    frame = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("en").alias("lang"))
    placed = merkle._placed(
        frame.select(F.lit("=en").alias("tree"), "doc_id", F.struct("lang").alias("node")).repartition(4), ["doc_id"]
    )
    assert sorted(r.pos for r in placed.collect()) == list(range(4000))
    assert placed.select("nodes").distinct().collect()[0][0] == 4000
    proven = merkle.manifest(frame, "lang", "doc_id", ["doc_id", "lang"])
    assert proven.select("root").distinct().count() == 1 and proven.count() == 4000


def test_changed_field_does_not_prove(spark):
    rows = rows_of(20, 2)
    frame = spark.createDataFrame(rows, SCHEMA)
    held = merkle.leaf_hash([F.col(c) for c in FIELDS[:-1]] + [F.concat("text", F.lit("!"))])
    found = merkle.manifest(frame, "lang", "doc_id", FIELDS, {"held": held})
    proves = found.select("doc_id", (merkle.folded(F.col("held"), F.col("proof")) == F.col("root")).alias("ok"))
    assert {r.doc_id for r in proves.collect() if r.ok} == {i for i, *_, text in rows if text is None}


def test_query_against_plain_version(spark, tmp_path):
    rows = [(i, "S", ["en", "de", None][i % 3], 3, f"ABC{i}" if i % 4 else "abc") for i in range(60)] + [(None, None, None, None, None)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for doc_id, leaf, subroot, root, proof in plain(rows):
        row = next(r for r in rows if r[0] == doc_id)
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[4]:
            row = (*row[:4], row[4].lower())
        node = leaf_of(row)
        for left, right in proof:
            node = digest(left + node + right)
        joined = digest("".join(a + b for a, b in proof))
        want[doc_id] = (leaf, subroot, root, joined, node, node == root)
    result = queries.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(result) == len(rows)
    for r in result:
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) == want[r.doc_id]
    assert 0 < sum(r.verified for r in result) < len(rows)
