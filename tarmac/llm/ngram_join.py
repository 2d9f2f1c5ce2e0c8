"""Similarity join of documents on their word n-grams, by prefix trees.

A document's set holds the fingerprints of its runs of five words. Two documents link when their
sets' Jaccard similarity reaches the threshold. All links count; the result is the connected
components they make, not the list of pairs.

1. Equal sets are one class, whatever its size; a task passes a class on once.
2. N-grams are counted over all classes, by ranges of fingerprints. An n-gram of one class
   only can be in no intersection; a class with too few others can link with nothing and is done.
3. N-grams get one global order, rare first. Two linked sets share an n-gram among the first
   ``n - need + 1`` of each (prefix filter), so classes meet at the n-grams of their prefixes.
4. All n-grams whose most central class is the same form one block. A class's set travels once to
   each of its blocks. The block's sets form a prefix tree in the global order. Each set walks down the tree
   beside it, shares the overlap that sets with a common beginning have, and leaves a subtree once
   the overlap plus what remains on either side cannot reach the threshold. Subtrees in which all
   sets are in the same component already are not entered, so a large group costs a star, not all pairs.
   Blocks over ``BLOCK_SETS`` sets are cut into parts. Each part is joined in itself and with the block's
   most central set first. Sets that come to that one's component need no further comparison with each other;
   only those that stay apart meet the sets of other parts. So a large group of near copies travels
   twice, and what grows with the square is the number of sets apart, not of the group.
5. Links spread the smallest id until nothing changes.

N-grams that very many documents share are found first, by adding up counts of those that
repeat within a task. They need no counting by range, so a passage in a third of all documents does
not gather there. This list is bounded (``HOT_GRAMS``) and only decides the route, not the result.

Odd input: null text or text without words has an empty set and links with nothing; with fewer words
than five the whole sequence is the set; repeated rows are copies; rows with a null id take part and
a component of such rows alone has a null id. Only id and text are read. Fingerprints of n-grams
and of sets have 64 bits.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, documents_of, mix, shingle_hashes, stored, word_hashes

GRAM = 5
#: The threshold as a fraction: 75 / 100.
SHARE, WHOLE = 75, 100
RANGE_GRAMS = 1_000_000
BLOCK_SETS = 1000
HOT_GRAMS = 1_000_000
HOT_LEAST = 200
_ROWS = 1500


def gram_sets(texts: list[bytes | None], size: int = GRAM) -> list[np.ndarray]:
    """Of each text, the sorted distinct fingerprints of its runs of ``size`` words.

    Fewer words are one run; no words are none.
    """
    words, counts = word_hashes(texts, LOWER)
    runs = shingle_hashes(words, size)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= size:
            sets.append(np.unique(runs[at : at + n - size + 1]))
        else:
            sets.append(mix(shingle_hashes(words[at : at + n], n) + np.uint64(n)) if n else words[:0])
        at += n
    return sets


def _sets(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            part = batch.slice(i, _ROWS)
            yield part, gram_sets(part.column(column).to_pylist())


def _class_id(grams: np.ndarray) -> int:
    """Fingerprint of a whole set as a signed long."""
    value = xxhash.xxh3_64_intdigest(grams.tobytes(), seed=len(grams))
    return value - (1 << 64) if value >> 63 else value


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with the class of its set, and one per n-gram that repeats in a batch."""
    for part, sets in _sets(batches, "text"):
        ids = [_class_id(s) for s in sets]
        yield pa.record_batch(
            {
                "doc_id": part.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "class": pa.array(ids, pa.int64()),
                "gram": pa.nulls(len(sets), pa.int64()),
            }
        )
        every = np.concatenate(list(dict(zip(ids, sets)).values()))
        grams, counts = np.unique(every, return_counts=True)
        often = counts >= 4
        nulls = pa.nulls(int(often.sum()), pa.int64())
        yield pa.record_batch(
            {
                "doc_id": nulls,
                "n": pa.array(counts[often], pa.int64()),
                "class": nulls,
                "gram": pa.array(grams[often].view(np.int64)),
            }
        )


_PACK = "range long, class long, grams binary, classes binary, owners binary, df binary"


def _packed(values: np.ndarray) -> bytes:
    """Sorted values as differences, one byte plane after the other: the upper ones are mostly zero."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _by_range(ranges: int, hot):
    """Packs of (fingerprint, class) by range of fingerprints; the hot ones of a class go past that.

    Those are in ranges of their own, behind the others, which pass them on as they are.
    """
    shift = np.uint64(65 - ranges.bit_length())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_df = hot.value
        for _, sets in _sets(batches, "text"):
            by_class = {_class_id(s): s for s in sets}
            ids, sets = np.array(list(by_class), np.int64), list(by_class.values())
            rows = []
            for i, grams in enumerate(sets):
                place = np.searchsorted(known, grams)
                place[place == len(known)] = 0
                is_hot = known[place] == grams if len(known) else np.zeros(len(grams), bool)
                if is_hot.any():
                    number, df = ranges + int(ids[i] % ranges), known_df[place[is_hot]]
                    rows.append((number, int(ids[i]), grams[is_hot].tobytes(), b"", b"", df.tobytes()))
                sets[i] = grams[~is_hot]
            grams = np.concatenate(sets)
            order = np.argsort(grams)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
            grams = grams[order]
            number = (grams >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(grams), np.int64)
            cuts = np.flatnonzero(np.diff(number, prepend=-1))
            for low, high in zip(cuts, np.append(cuts[1:], len(grams))):
                present, mine = np.unique(owner[low:high], return_inverse=True)
                parts = ids[present].tobytes(), mine.astype(np.uint16).tobytes()
                rows.append((int(number[low]), None, _packed(grams[low:high]), *parts, b""))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["range", "class", "grams", "classes", "owners", "df"],
            )

    return pack


def _shared_grams(packs: pd.DataFrame) -> pd.DataFrame:
    """From the packs of one range: for each class, its fingerprints that others have too."""
    if packs["class"].notna().any():
        return packs[["class", "grams", "df"]].drop_duplicates("class")
    grams = np.concatenate([_unpacked(g) for g in packs["grams"]])
    docs = np.concatenate(
        [
            np.frombuffer(ids, np.int64)[np.frombuffer(mine, np.uint16)]
            for ids, mine in zip(packs["classes"], packs["owners"])
        ]
    )
    order = np.lexsort((docs, grams))
    grams, docs = grams[order], docs[order]
    # Copies in several tasks bring the same pair more than once.
    fresh = np.concatenate([[True], (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])])[: len(grams)]
    grams, docs = grams[fresh], docs[fresh]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    counts = np.diff(np.append(starts, len(grams)))
    df = np.repeat(counts, counts)
    shared = df > 1
    grams, docs, df = grams[shared], docs[shared], df[shared]
    order = np.argsort(docs, kind="stable")
    grams, docs, df = grams[order], docs[order], df[order]
    cuts = np.flatnonzero(np.diff(docs, prepend=docs[:1] - 1)) if len(docs) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(docs))
    return pd.DataFrame(
        {
            "class": docs[cuts],
            "grams": [grams[a:b].tobytes() for a, b in zip(cuts, ends)],
            "df": [df[a:b].tobytes() for a, b in zip(cuts, ends)],
        }
    )


def _prefixes(share: int, whole: int):
    """Each class's shared fingerprints in the global order, those of its prefix, and its centrality."""

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets, prefix, weight = [], [], []
            for n, grams, df in zip(rows["n"], rows["grams"], rows["df"]):
                grams, first = np.unique(np.frombuffer(b"".join(grams), np.uint64), return_index=True)
                df = np.frombuffer(b"".join(df), np.int64)[first]
                sort = np.lexsort((grams, df))
                need = -(-share * n // whole)
                # The class's own n-grams come first in the order and take up part of the prefix.
                length = max(0, len(grams) - need + 1)
                sets.append(grams[sort].tobytes())
                prefix.append(grams[sort][:length].view(np.int64))
                weight.append(float(df.sum() / n))
            out = {"class": rows["class"], "n": rows["n"], "set": sets, "prefix": prefix, "weight": weight}
            yield pd.DataFrame(out)

    return order


class Components:
    """Union by smallest member."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


class PrefixTree:
    """Sets as paths of fingerprints in the global order; nodes know what lies below them.

    Most nodes have one child, so a node's first child is kept in arrays and only others in a dict.
    """

    def __init__(self) -> None:
        self.first_gram, self.first_child = array("Q"), array("q")
        self.others: dict[int, dict[int, int]] = {}
        self.below = array("q")  # most fingerprints on a path below
        self.least = array("q")  # smallest set below, by full size
        self.ends: dict[int, list[int]] = {}  # sets that end here
        self._add()

    def _add(self) -> int:
        self.first_gram.append(0)
        self.first_child.append(-1)
        self.below.append(0)
        self.least.append(1 << 60)
        return len(self.below) - 1

    def children(self, node: int) -> list[tuple[int, int]]:
        if (child := self.first_child[node]) < 0:
            return []
        first = [(self.first_gram[node], child)]
        return first + list(self.others[node].items()) if node in self.others else first

    def _child(self, node: int, gram: int) -> int:
        if self.first_child[node] < 0:
            self.first_gram[node], self.first_child[node] = gram, self._add()
            return self.first_child[node]
        if self.first_gram[node] == gram:
            return self.first_child[node]
        more = self.others.setdefault(node, {})
        if gram not in more:
            more[gram] = self._add()
        return more[gram]

    def insert(self, path: np.ndarray, n: int, member: int) -> None:
        node = 0
        for left, gram in zip(range(len(path), 0, -1), path.tolist()):
            self.below[node] = max(self.below[node], left)
            self.least[node] = min(self.least[node], n)
            node = self._child(node, gram)
        self.least[node] = min(self.least[node], n)
        self.ends.setdefault(node, []).append(member)

    def uniform(self, parts: Components) -> array:
        """For each node the one component of all sets below it, or -1."""
        same = array("q", bytes(8 * len(self.below)))
        for node in range(len(self.below) - 1, -1, -1):
            found = -2
            for root in [parts.find(m) for m in self.ends.get(node, ())] + [same[c] for _, c in self.children(node)]:
                found = root if found in (-2, root) else -1
            same[node] = found
        return same


def join_block(
    sets: list[np.ndarray], sizes: list[int], known: int, share: int = SHARE, whole: int = WHOLE, joined: bool = False
) -> list[tuple[int, int]]:
    """Links that make the components of a block's sets.

    With ``known``, the first so many sets make the tree and only the others walk it, besides the
    first set of all; without, all make it and all walk it. ``joined`` says that the known sets are of one component.
    """
    parts, links = Components(len(sets)), []
    for i in range(known if joined else 0):
        parts.link(0, i)
    tree = PrefixTree()
    for i, path in enumerate(sets[: known or len(sets)]):
        tree.insert(path, sizes[i], i)
    below, least, ends = tree.below, tree.least, tree.ends
    both = share + whole
    same, stale = tree.uniform(parts), 0
    for q in [0, *range(known, len(sets))] if known else range(len(sets)):
        if stale > 32 + len(sets) // 16:
            same, stale = tree.uniform(parts), 0
        place = {gram: k for k, gram in enumerate(sets[q].tolist())}
        length, size, mine = len(sets[q]), sizes[q], parts.find(q)
        # A node, the overlap so far, and the place in q up to which its fingerprints are used.
        stack = [(0, 0, 0)]
        while stack:
            node, overlap, used = stack.pop()
            if same[node] >= 0 and parts.find(same[node]) == mine:
                continue
            for other in ends.get(node, ()):
                if other != q and both * overlap >= share * (size + sizes[other]) and parts.find(other) != mine:
                    parts.link(other, q)
                    links.append((other, q))
                    mine = parts.find(q)
                    stale += 1
            for gram, child in tree.children(node):
                at = place.get(gram)
                if at is None:
                    more, next_used = overlap, used
                else:
                    more, next_used = overlap + 1, at + 1
                left = min(below[child], length - next_used)
                if both * (more + left) >= share * (size + least[child]):
                    stack.append((child, more, next_used))
    return links


def _by_centrality(rows: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """Classes, sets and sizes: the tree's before those that walk it, the most central ones first."""
    rows = rows.sort_values(["side", "weight", "class"], ascending=[True, False, True])
    return rows["class"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["set"]], rows["n"].tolist()


def _join_part(share: int, whole: int):
    """Links within a part and with the block's lead; a row without ``b`` for each class that is apart from the lead."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        ids, sets, sizes = _by_centrality(rows)
        links = join_block(sets, sizes, 0, share, whole)
        found = [(ids[a], ids[b], None) for a, b in links]
        if rows["parts"].iat[0] > 1:
            parts = Components(len(sets))
            for a, b in links:
                parts.link(a, b)
            block = rows["block"].iat[0]
            found += [(ids[i], None, block) for i in range(1, len(sets)) if parts.find(i) != parts.find(0)]
        columns = zip(*found) if found else ((), (), ())
        return pd.DataFrame({c: pd.array(list(v), dtype="Int64") for c, v in zip(("a", "b", "block"), columns)})

    return join


def _join_cell(share: int, whole: int):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        ids, sets, sizes = _by_centrality(rows)
        known = int((rows["side"] == 0).sum()) if (rows["side"] == 1).any() else 0
        links = join_block(sets, sizes, known, share, whole, bool(rows["star"].iat[0]))
        return pd.DataFrame({"a": [ids[a] for a, _ in links], "b": [ids[b] for _, b in links]}, dtype="int64")

    return join


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(doc, component): the smallest id reachable over links (a, b), for every doc in a link.

    Alternates between linking larger neighbours and smaller neighbours to the smallest
    one, which keeps the number of links and reaches stars in a few rounds. No group is gathered:
    each step is a minimum per id and a join.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        # Large step: every larger neighbour of a node links to the node's smallest neighbour.
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small step: every smaller neighbour, and the node itself, links to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        new = stored(small, "links")
        done = new.count() == edges.count() and new.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = new
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("a").alias("doc"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b"), F.col("b")).distinct())


def _cut(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, class, part) of (block, class), and (of, parts): parts of about ``BLOCK_SETS`` classes of each block."""
    sizes = members.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_SETS).alias("parts"))
    sizes = sizes.select(F.col("block").alias("of"), "parts")
    part = F.pmod(F.xxhash64("class"), F.col("parts")).alias("part")
    return members.join(sizes, F.col("block") == F.col("of")).select("block", "class", part, "parts"), sizes


def cells_apart(star: DataFrame, apart: DataFrame) -> DataFrame:
    """(block, class, star, i, j, side): what is left to compare, for classes (block, class) of large blocks.

    ``star`` are those in the component of their block's lead, ``apart`` the others. Every part of the latter
    meets every part of either; two classes of the star need not meet.
    """
    star, star_parts = _cut(star)
    apart, apart_parts = _cut(apart)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    among = apart.select("*", every(F.col("parts")).alias("other")).select(
        "block",
        "class",
        F.lit(False).alias("star"),
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )
    same = F.col("block") == F.col("of")
    tree = star.drop("parts").join(apart_parts, same).select("*", every(F.col("parts")).alias("i"))
    walk = apart.drop("parts").join(star_parts, same).select("*", every(F.col("parts")).alias("j"))
    return among.union(
        tree.select("block", "class", F.lit(True), "i", F.col("part"), F.lit(0))
    ).union(walk.select("block", "class", F.lit(True), F.col("part"), "j", F.lit(1)))


def linked_classes(sets: DataFrame, share: int, whole: int) -> DataFrame:
    """Links (a, b) between classes, enough to make all components. ``sets``: see ``_prefixes``."""
    postings = sets.select("class", "weight", F.explode("prefix").alias("gram"))
    leads = (
        postings.groupBy("gram")
        .agg(F.max(F.struct("weight", "class")).alias("lead"), F.count("*").alias("n"))
        .where("n > 1")
        .select("gram", F.col("lead.class").alias("block"))
    )
    blocks = stored(postings.join(leads, "gram").select("block", "class").distinct(), "blocks")
    others = blocks.where("block <> class")
    member, parts = _cut(others)
    # The most central class is in every part of its block, so that each starts with its star.
    lead = parts.select(
        F.col("of").alias("block"),
        F.col("of").alias("class"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        "parts",
        F.lit(0).alias("side"),
    )
    contents = sets.select("class", "n", "set", "weight")
    first = stored(
        member.withColumn("side", F.lit(1))
        .union(lead)
        .join(contents, "class")
        .groupBy("block", "part")
        .applyInPandas(_join_part(share, whole), "a long, b long, block long"),
        "links",
    )
    apart = first.where("b is null").select("block", F.col("a").alias("class"))
    large = others.join(apart.select("block").distinct(), "block", "left_semi")
    star = large.join(apart, ["block", "class"], "left_anti")
    later = (
        cells_apart(star, apart)
        .join(contents, "class")
        .groupBy("block", "star", "i", "j")
        .applyInPandas(_join_cell(share, whole), "a long, b long")
    )
    return first.where("b is not null").select("a", "b").union(later)


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: int = SHARE,
    whole: int = WHOLE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document; links at ``share / whole`` similarity or more."""
    docs = documents_of(documents, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    spark = documents.sparkSession
    read = stored(docs.mapInArrow(_classes, "doc_id long, n long, class long, gram long"), "sets")
    members = read.where("class is not null").select("doc_id", "n", "class")
    classes = stored(members.where("n > 0").groupBy("class", "n").agg(F.min("doc_id").alias("doc")), "classes")

    # Frequent n-grams: sums of the counts of those that repeat within a task's batch.
    heavy = read.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("df"))
    heavy = heavy.where(F.col("df") >= HOT_LEAST).orderBy(F.desc("df")).limit(HOT_GRAMS).toArrow()
    grams, df = heavy["gram"].to_numpy().astype(np.int64).view(np.uint64), heavy["df"].to_numpy()
    order = np.argsort(grams)
    hot = spark.sparkContext.broadcast((grams[order], df[order]))

    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = 1 << int(total // RANGE_GRAMS).bit_length()
    shared = (
        docs.select("text")
        .mapInArrow(_by_range(ranges, hot), _PACK)
        .groupBy("range")
        .applyInPandas(_shared_grams, "class long, grams binary, df binary")
    )
    enough = whole * F.col("m") >= share * F.col("n")
    sets = (
        shared.groupBy("class")
        .agg(
            F.collect_list("grams").alias("grams"),
            F.collect_list("df").alias("df"),
            F.floor(F.sum(F.octet_length("grams")) / 8).alias("m"),
        )
        .join(classes.select("class", "n"), "class")
        .where(enough)
        .select("class", "n", "grams", "df")
        .mapInPandas(
            _prefixes(share, whole),
            "class long, n long, set binary, prefix array<long>, weight double",
        )
    )
    links = linked_classes(stored(sets, "prefixes"), share, whole)

    roots = classes.select("class", "doc").join(
        components(links).withColumnRenamed("doc", "of"), F.col("class") == F.col("of"), "left"
    ).select("class", "doc", F.coalesce("component", "class").alias("root"))
    least = roots.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = roots.join(least, "root").select(F.col("class").alias("of"), "component_id")
    same = (F.col("class") == F.col("of")) & (F.col("n") > 0)
    return members.join(named, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
