"""Nearest neighbours by inner product: a forest of random-projection trees, then exact reranking.

Each tree splits space by hyperplanes between two random centres until a leaf stands for about
``LEAF_ROWS`` rows. The splits are fitted on a bounded sample (``SAMPLE_ROWS``); all rows are then sent down every tree.
A query searches all trees through one priority queue: the side of a split it lies on first, the
other side by the sum of squared distances to the planes it lies beyond, so that the closest
missed leaf of any tree comes next. It stops after leaves with ``SEARCH_SHARE`` of the rows of all trees,
at least ``SEARCH_ROWS`` and ``trees * (k + 1)``, so that k other rows are found, and not before it has
seen a leaf of every tree. So the work of a query grows with the table: vectors without structure
need a share of it, whatever its size. Leaves that get more than ``LEAF_ROWS`` in a table far larger than the
sample only make the share coarser: a tree has about ten thousand leaves then.

Points, each with its leaf in every tree, are dealt by a hash of their id into parts of ``PART_ROWS``, queries into shares
of ``PART_QUERIES``; a part meets a share in one task, so all tasks are of one size. There a query's
candidates are the points that lie in any leaf it chose. Each is scored once, exactly, in double precision, however
many trees led to it, and points in other leaves not at all. The best of every part are merged per query.

Inner products are not distances, so all vectors get one more component that makes them equally
long (queries get zero); then the largest inner product is the smallest angle.

Equal vectors are one point with its ``k + 1`` smallest ids. No more can be among anyone's nearest
k, as ties go to smaller ids. So any number of copies costs one point.

Odd input: vectors that are null, zero, hold null or non-finite components, or differ in length from
the most frequent one, take no part, neither do rows without id; rows with equal id and vector count once; with
fewer than k candidates all are returned; without any, no rows are. Only the id and vector columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored

K = 20
TREES = 10
LEAF_ROWS = 100
SEARCH_ROWS = 4000
#: Of the rows of all trees. Recall measured for it, and the share of all points that it scores, are in the README.
SEARCH_SHARE = 0.07
SAMPLE_ROWS = 20_000
PART_ROWS = 20_000
PART_QUERIES = 2000
#: Queries that one task searches for.
TASK_QUERIES = 100
_SEED = 20


def valid(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


@dataclass
class Tree:
    """Splits in arrays: normals and offsets per node; children below zero are leaves (-1 - number)."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64) if len(self.children) else np.full(len(points), -1)
        while len(go := np.flatnonzero(node >= 0)):
            at = node[go]
            side = np.einsum("ij,ij->i", points[go], self.normals[at]) > self.offsets[at]
            node[go] = self.children[at, side.astype(int)]
        return -1 - node


def grow(points: np.ndarray, leaf_size: int, rng: np.random.Generator) -> Tree:
    normals, offsets, children, leaves = [], [], [], 0
    # Rows of a node, and where its number is to be put.
    todo = [(np.arange(len(points)), None)]
    while todo:
        rows, slot = todo.pop()
        split = two_sides(points[rows], rng) if len(rows) > leaf_size else None
        if split is None:
            number, leaves = -1 - leaves, leaves + 1
        else:
            normal, offset, side = split
            number = len(children)
            normals.append(normal)
            offsets.append(offset)
            children.append([0, 0])
            todo += [(rows[~side], (number, 0)), (rows[side], (number, 1))]
        if slot:
            children[slot[0]][slot[1]] = number
    size = points.shape[1]
    return Tree(np.array(normals).reshape(-1, size), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


def two_sides(points: np.ndarray, rng: np.random.Generator):
    """A plane halfway between two centres, moved a few times; None if points don't separate."""
    for _ in range(3):
        centres = points[rng.choice(len(points), 2, replace=False)].copy()
        for _ in range(4):
            near = ((points[:, None, :] - centres) ** 2).sum(2).argmin(1) if len(points) < 2000 else (
                points @ (centres[1] - centres[0]) > (centres**2).sum(1) @ [-0.5, 0.5]
            ).astype(int)
            if near.min() == near.max():
                break
            centres = np.stack([points[near == i].mean(0) for i in (0, 1)])
        normal = centres[1] - centres[0]
        if not (length := np.linalg.norm(normal)):
            continue
        normal /= length
        offset = normal @ centres.mean(0)
        side = points @ normal > offset
        if 0.05 < side.mean() < 0.95:
            return normal, offset, side
    return None


@dataclass
class Forest:
    trees: list[Tree]
    longest: float  # length to which vectors are brought

    def first_leaves(self) -> np.ndarray:
        """First leaf number of each tree, and the number of all leaves."""
        return np.concatenate([[0], np.cumsum([t.leaves for t in self.trees])])

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree, numbered over the whole forest."""
        points = self.points(vectors)
        return np.stack([t.leaf_of(points) + n for t, n in zip(self.trees, self.first_leaves())], 1)

    def search(self, vector: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
        """Leaves in the order of the shared queue until they hold enough rows, one of each tree at least."""
        query = np.append(vector / np.linalg.norm(vector), 0.0)
        margins = [t.normals @ query - t.offsets / self.longest for t in self.trees]
        first, found, rows, seen = self.first_leaves(), [], 0, 0
        queue = [(0.0, i, 0 if len(t.children) else -1) for i, t in enumerate(self.trees)]
        while queue and (rows < enough or seen < len(self.trees)):  # roots come first
            missed, i, node = heapq.heappop(queue)
            seen += 1
            children = self.trees[i].children
            while node >= 0:
                margin = margins[i][node]
                near, far = (1, 0) if margin > 0 else (0, 1)
                heapq.heappush(queue, (missed + margin * margin, i, children[node, far]))
                node = children[node, near]
            leaf = int(first[i] - 1 - node)
            if sizes[leaf]:
                found.append(leaf)
                rows += sizes[leaf]
        return found


def budget(points: int, trees: int, k: int, search_rows: int, search_share: float) -> int:
    """Leaf rows that a query looks at, over all trees."""
    return max(search_rows, trees * (k + 1), math.ceil(search_share * trees * points))


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """Lists of equal length without nulls as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), kind).reshape(len(column), -1)


def fit(points: DataFrame, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> tuple[Forest, int]:
    """A forest from a bounded sample of (id, vector), and the number of points."""
    count, longest = points.agg(
        F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    ).first()
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    sample = points.where(draw < min(1.0, SAMPLE_ROWS / max(count, 1)) * (1 << 30)).orderBy("id")
    rows = sample.limit(2 * SAMPLE_ROWS).select("vector").toArrow()
    if not rows.num_rows:
        return Forest([Tree(np.zeros((0, 1)), np.zeros(0), np.zeros((0, 2), np.int64), 1)] * trees, 1.0), count
    forest = Forest([], float(np.sqrt(longest)))
    known = forest.points(_matrix(rows.column("vector")))
    leaf = max(2, int(leaf_rows * len(known) / count))
    forest.trees = [grow(known, leaf, np.random.default_rng(_SEED + i)) for i in range(trees)]
    return forest, count


def _index(forest):
    """Every point with its leaf in each tree."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                batch = whole.slice(i, 2000)
                leaves = forest.value.leaves_of(_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(leaves)], ["id", "vector", "leaves"])

    return index


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), pa.int32()))


def _search(forest, sizes, enough: int):
    """Every query with the leaves to look into."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, TASK_QUERIES):
                batch = whole.slice(i, TASK_QUERIES)
                found = [forest.value.search(v, sizes.value, enough) for v in _matrix(batch.column("vector"))]
                leaves = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaves], ["id", "vector", "leaves"])

    return search


def _score(k: int):
    """For each query of a share the best k points of a part, and those that tie with the last."""

    def score(points: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if points.num_rows and queries.num_rows:
            vectors, ids = _matrix(points.column("vector")), points.column("id").to_numpy()
            leaves = _matrix(points.column("leaves"), np.int32)
            asked, names = _matrix(queries.column("vector")), queries.column("id").to_numpy()
            wanted = np.zeros(int(leaves.max()) + 1, bool)
            for row, chosen in enumerate(queries.column("leaves")):
                chosen = np.asarray(chosen.values, np.int32)
                chosen = chosen[chosen < len(wanted)]
                wanted[chosen] = True
                candidates = np.flatnonzero(wanted[leaves].any(axis=1))
                wanted[chosen] = False
                if not len(candidates):
                    continue
                near = vectors[candidates]
                scores = near @ asked[row]
                least = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
                best = np.flatnonzero(scores >= least - 1e-9 * max(1.0, abs(least)) if len(scores) > k else scores == scores)
                # One sum per pair, which does not depend on what else is in the part.
                exact = (near[best] * asked[row]).sum(axis=1)
                found.append((np.full(len(best), names[row]), ids[candidates[best]], exact))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 3
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "id", "score"])

    return score


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    search_rows: int = SEARCH_ROWS,
    search_share: float = SEARCH_SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows found for each row with ``is_query``."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("vector"),
        is_query.alias("is_query"),
    ).where(valid(F.col("vector")) & F.col("id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (lengths["n"] if lengths else 0))

    # Equal vectors as one point with the ids that can still matter.
    order = Window.partitionBy("vector").orderBy("id")
    kept = rows.select("id", "vector").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    points = stored(
        kept.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")), "points"
    )
    asked = rows.where("is_query").select(F.col("id").alias("query_id"), "vector").distinct()
    groups = asked.groupBy("vector").agg(F.min("query_id").alias("id"))
    groups = stored(groups, "queries")

    forest, count = fit(points, trees, leaf_rows)
    shared = spark.sparkContext.broadcast(forest)
    vector_type = dict(points.dtypes)["vector"]
    with_leaves = f"id long, vector {vector_type}, leaves array<int>"
    indexed = stored(points.select("id", "vector").mapInArrow(_index(shared), with_leaves), "indexed")
    # One number per leaf of the fitted forest.
    sizes = np.zeros(int(forest.first_leaves()[-1]), np.int64)
    for leaf, n in indexed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[leaf] = n

    asking = groups.count()
    enough = budget(count, trees, k, search_rows, search_share)
    probes = (
        groups.select("id", "vector")
        .repartition(max(1, -(-asking // TASK_QUERIES)))
        .mapInArrow(_search(shared, spark.sparkContext.broadcast(sizes), enough), with_leaves)
    )
    parts, shares = max(1, -(-count // PART_ROWS)), max(1, -(-asking // PART_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    one_of = lambda n: F.pmod(F.xxhash64("id", F.lit("dealt")), F.lit(n)).cast("int")
    rows = indexed.withColumn("part", one_of(parts)).withColumn("share", every(shares))
    probes = probes.withColumn("share", one_of(shares)).withColumn("part", every(parts))
    found = (
        rows.groupBy("part", "share")
        .cogroup(probes.groupBy("part", "share"))
        .applyInArrow(_score(k + 1), "query long, id long, score double")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    copies = points.select("id", "ids")
    listed = best.join(copies, "id").select("query", "score", F.explode("ids").alias("vec_id"))
    members = asked.join(groups, "vector").select("query_id", F.col("id").alias("query"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(listed, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
