"""A Merkle manifest of a dataset: leaves of rows, a tree per group, and a tree over the groups' roots.

A leaf is the hash H (lowercase hexadecimal SHA-256) of its row's fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value. In every group the leaves ascend; while several nodes remain, each
run of ``FANOUT`` consecutive ones (the last may be shorter, also one node) becomes the H of their
concatenation. What remains is the group's subroot. The subroots, ordered by group (null first, then by
UTF-8 bytes), are put together the same way into the root.

Each level is one slot pivot: conditional aggregates spread a parent's children into ``FANOUT`` columns, the
concatenation of which is hashed. Read the other way, the columns but a node's own are its siblings, so a
proof is put together from the levels on the way down, without a join of rows to each other.

Scale: leaves are dealt by ranges of (group, order, leaf), and a place is a row's place in its range
plus the rows of the ranges before; no group is ever in one task, and the list of ranges is all that is summed
in one. A parent has at most ``FANOUT`` children, which the partial aggregation combines before the
shuffle, as they lie beside each other. The number of levels grows as the logarithm of the largest group. Every
level is written to the shared folder, so a lost executor costs at most one level.

Odd input: any field may be null; rows without order key come first in their group; rows with equal keys
are ordered by their leaf, and equal rows have equal leaves, whose places are interchangeable; texts are hashed
whole; an empty table gives an empty manifest, and its root is not defined. Only the columns
named are read, and columns of any other name are left alone.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored

FANOUT = 8
_ABOVE = "struct<subroot: string, root: string, path: array<struct<left: string, right: string>>>"


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """(tree, nodes, pos, node) of ``rows`` (tree, order, node): how many its tree has, and its place from 0.

    Equal rows may hold a large share of a tree: where a row was read splits them over ranges.
    """
    dealt = rows.withColumn("read_no", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("tree", *order, "read_no").sortWithinPartitions("tree", *order, "read_no")
    numbered = dealt.drop("read_no").select(
        "*", F.spark_partition_id().alias("range_no"), F.monotonically_increasing_id().alias("row_no")
    )
    numbered = stored(numbered, "merkle-order")
    ranges = numbered.groupBy("tree", "range_no").agg(F.min("row_no").alias("first_no"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "tree",
        "range_no",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_no")).alias("shift"),
        F.sum("n").over(tree).alias("nodes"),
    )
    return numbered.join(ranges, ["tree", "range_no"]).select(
        "tree", "nodes", (F.col("row_no") + F.col("shift")).alias("pos"), "node"
    )


def _slots(fanout: int) -> list[str]:
    return [f"slot{i}" for i in range(fanout)]


def _pivoted(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per parent of ``nodes`` (tree, pos, node): its children in columns and its own hash.

    ``node`` is a struct whose field ``hash`` counts; what else it has is carried along.
    """
    slot = F.col("pos") % fanout
    children = [F.max(F.when(slot == i, F.col("node"))).alias(name) for i, name in enumerate(_slots(fanout))]
    parents = nodes.groupBy(
        "tree", F.ceil(F.col("nodes") / fanout).alias("nodes"), F.floor(F.col("pos") / fanout).alias("pos")
    ).agg(*children)
    joined = F.concat(*(F.coalesce(F.col(f"{name}.hash"), F.lit("")) for name in _slots(fanout)))
    return parents.withColumn("node", F.struct(F.sha2(joined, 256).alias("hash")))


def _levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """Per level of inner nodes, lowest first, the pivoted parents. A tree of one leaf has none."""
    most = leaves.agg(F.max("nodes")).first()[0] or 0  # one number
    levels, nodes = [], leaves
    while most > 1:
        levels.append(stored(_pivoted(nodes.where("nodes > 1"), fanout), f"merkle-level{len(levels) + 1}"))
        nodes = levels[-1].select("tree", "nodes", "pos", "node")
        most = -(-most // fanout)
    return levels


def _siblings(i: int, fanout: int) -> Column:
    """The hashes beside slot ``i``, left and right of it: every slot column but its own."""
    text = lambda names: F.concat(F.lit(""), *(F.coalesce(F.col(f"{n}.hash"), F.lit("")) for n in names))
    names = _slots(fanout)
    return F.struct(text(names[:i]).alias("left"), text(names[i + 1 :]).alias("right"))


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """A row (tree, pos, node, above) per child; a parent's own ``above`` is put behind the siblings."""
    children = [
        F.struct(
            (F.col("pos") * fanout + i).alias("pos"),
            F.col(name).alias("node"),
            F.struct(
                F.col("above.subroot"),
                F.col("above.root"),
                F.concat(F.array(_siblings(i, fanout)), F.col("above.path")).alias("path"),
            ).alias("above"),
        )
        for i, name in enumerate(_slots(fanout))
    ]
    return parents.select("tree", F.inline(F.array(*children))).where(F.col("node").isNotNull())


def _proven(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """All leaves as (tree, pos, node, above); ``tops`` has (tree, height, above) of each tree's highest node."""
    down = None
    for height in range(len(levels), 0, -1):
        known = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("pos"), "above")
        if down is not None:
            known = known.unionByName(down.select("tree", "pos", "above"))
        down = _children(levels[height - 1].join(known, ["tree", "pos"]), fanout)
    alone = tops.where(F.col("height") == 0).select("tree", "above")
    single = leaves.where("nodes = 1").join(alone, "tree").select("tree", "pos", "node", "above")
    return single if down is None else down.unionByName(single)


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, height, hash) of every tree's highest node: the only one of its level."""
    lone = [
        nodes.where("nodes = 1").select("tree", F.lit(height).alias("height"), F.col("node.hash").alias("hash"))
        for height, nodes in enumerate([leaves, *levels])
    ]
    return functools.reduce(DataFrame.unionByName, lone)


def manifest(
    rows: DataFrame,
    group: str,
    order: str,
    fields: list[str],
    carry: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """(order, leaf, carried columns, subroot, root, proof) of each row.

    ``proof`` lists, from the leaf's level to the root's, the joined hashes ``left`` and ``right`` of the node
    on the way; fold it with ``folded``. ``carry`` names further columns, built from the row, to take along.
    """
    carry = carry or {}
    leaf = leaf_hash([F.col(name) for name in fields])
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.struct(
            leaf.alias("hash"), F.col(order).alias("key"), *(value.alias(f"carried_{name}") for name, value in carry.items())
        ).alias("node"),
    )
    # Stored, as dealing by ranges first samples its input: texts are read and hashed once.
    leaves = stored(leaves, "merkle-leaves")
    leaves = leaves.select("tree", F.col("node.key").alias("key"), F.col("node.hash").alias("leaf"), "node")
    leaves = _placed(leaves, ["key", "leaf"])
    levels = _levels(leaves, fanout)
    subroots = stored(_tops(leaves, levels), "merkle-subroots")

    # The subroots are the leaves of one more tree, in order of their group.
    upper = subroots.select(
        F.lit("").alias("tree"),
        F.col("tree").alias("key"),
        F.struct("hash", F.col("tree").alias("group"), "height").alias("node"),
    )
    upper = _placed(upper, ["key"])
    upper_levels = _levels(upper, fanout)
    top = _tops(upper, upper_levels).select(
        "tree",
        "height",
        F.struct(F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"), F.array().cast(
            "array<struct<left: string, right: string>>").alias("path")).alias("above"),
    )
    proven = _proven(upper, upper_levels, top, fanout).select(
        F.col("node.group").alias("tree"),
        F.col("node.height").alias("height"),
        F.struct(F.col("node.hash").alias("subroot"), F.col("above.root"), F.col("above.path")).cast(_ABOVE).alias("above"),
    )
    found = _proven(leaves, levels, stored(proven, "merkle-groups"), fanout)
    return found.select(
        F.col("node.key").alias(order),
        F.col("node.hash").alias("leaf"),
        *(F.col(f"node.carried_{name}").alias(name) for name in carry),
        F.col("above.subroot").alias("subroot"),
        F.col("above.root").alias("root"),
        F.col("above.path").alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """H of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)
