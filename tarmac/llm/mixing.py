"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

A source's documents are cut into blocks of equal size in the order of their ids. With weight w (a
share of all), its block j = 1, 2, ... is released at slot ``floor((j-1)/w)`` and due at slot
``ceil(j/w)``. Every slot goes to the released block with the earliest deadline, ties to the source
that comes first by name (sources of equal weight stand together under their first name). One block a slot and weights that sum to one are a feasible Pfair system,
so every deadline is met and each source is at any time less than one block off its share.

Weights are whole parts of a period (their sum). Such a schedule repeats after each period, when
all sources are exactly on target. So one period is computed, or its part before the mix ends, and every
block finds its slot from its number alone: slot = period number * period + slot in the period. The
period grows with the number of sources, so that the one part that every source has at least is no
more than a hundredth of the mean share. Sources of equal weight have equal windows and are scheduled as one.

The schedule runs until each source was read to its end once. A source that ends earlier starts
again (a new epoch), as that is how a scarce source reaches its weight. No document is dropped.

A null source is a source of its own that comes first. A null id is an id like any other, and rows
that share source and id stay together in one block. Texts are not looked at. An empty table gives
an empty result; a source of the weights without documents gets no slots and its weight goes to
the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored

BLOCK_ROWS = 64
#: Least parts of a period, in all and a source.
PERIOD = 1000
SOURCE_PARTS = 100
#: Ids in one numbering range, about, while there are no more than ``MAX_RANGES``; beyond, ranges grow instead.
RANGE_IDS = 1 << 12
MAX_RANGES = 20_000
#: Epochs of a block in one list.
EPOCHS = 1 << 12
#: Slots in one list while a period is scheduled, as a list is copied for every slot put to it.
STRETCH = 256


def tempered_parts(counts: DataFrame, power: float, period: int | None = None) -> DataFrame:
    """(source, n, parts): shares of ``n ** power`` as whole parts of the period, each at least one.

    Parts are rounded down and the rest goes to the largest remainders, then names.
    Without a period, there are ``SOURCE_PARTS`` times as many parts as sources, at least ``PERIOD``.
    A given period must have a part for each source; the query fails otherwise.
    """
    everything = Window.partitionBy()
    share = F.pow("n", F.lit(power))
    sources = F.count("*").over(everything)
    if period is None:
        spare = F.greatest(F.lit(PERIOD).cast("long"), SOURCE_PARTS * sources) - sources
    else:
        too_many = F.raise_error(F.lit(f"more sources than the {period} parts of a period"))
        spare = F.when(sources <= period, F.lit(period) - sources).otherwise(too_many.cast("long"))
    exact = spare * F.round(share / F.sum(share).over(everything), 12)
    order = Window.orderBy(F.desc("rest"), F.asc_nulls_first("source"))
    return (
        counts.withColumn("exact", exact)
        .withColumn("floor", F.floor("exact"))
        .withColumn("rest", F.round(F.col("exact") - F.col("floor"), 9))
        .withColumn("left", spare - F.sum("floor").over(everything))
        .withColumn("parts", 1 + F.col("floor") + (F.row_number().over(order) <= F.col("left")).cast("long"))
        .select("source", "n", "parts")
    )


def released(j: Column, parts: Column, period: Column) -> Column:
    """First slot (from 0) of block j (from 1) in its period."""
    return F.floor((j - 1) * period / parts)


def due(j: Column, parts: Column, period: Column) -> Column:
    """Slot before which block j (from 1) must have run."""
    return F.ceil(j * period / parts)


def period_schedule(parts: DataFrame) -> DataFrame:
    """(source, j, slot) of one period: earliest deadline first among the released blocks.

    One row per slot; its size is the sum of the parts, whatever the number of documents. A column
    ``slots`` of the sources, if there is one, ends it earlier.

    Sources with equal parts are one class: its blocks are the first blocks of its members by name,
    then their second ones, and so on. So a slot costs a step per class. Classes have different
    parts, so there are fewer than the root of twice the period.
    """
    by_name = Window.partitionBy("parts").orderBy(F.asc_nulls_first("source"))
    members = parts.select(
        "source", F.col("parts").alias("of_parts"), (F.row_number().over(by_name) - 1).alias("member")
    )
    horizon = F.max("slots") if "slots" in parts.columns else F.max(F.lit(None).cast("long"))
    classes = parts.groupBy("parts").agg(
        F.min(F.struct("source")).alias("first"), F.count("*").alias("m"), horizon.alias("slots")
    )
    listed = (
        classes.agg(
            F.sort_array(F.collect_list(F.struct("first", "parts", "m"))).alias("classes"),
            F.sum(F.col("parts") * F.col("m")).alias("period"),
            F.max("slots").alias("slots"),
        )
        .where("period > 0")
        .withColumn("last", F.least(F.col("period"), F.col("slots")) - 1)
    )
    # Of every class the release of its next block, its deadline with the class's place, and the number of blocks done.
    size = F.size("classes").cast("long")

    def window(place: Column, d: Column) -> Column:
        c = F.get("classes", place)
        j = F.floor(d / c["m"]) + 1
        return F.struct(
            released(j, c["parts"], F.col("period")).alias("from"),
            (due(j, c["parts"], F.col("period")) * size + place).alias("due"),
            d.alias("done"),
        )

    state = F.transform("classes", lambda c, place: window(place, F.lit(0).cast("long")))
    none = F.array().cast("array<int>")

    def slot(acc: Column, t: Column) -> Column:
        ready = F.transform(acc["state"], lambda s: F.when(s["from"] <= t, s["due"]))
        pick = (F.array_min(ready) % size).cast("int")
        # The step after finding the class, so that it is found once and not for every class.
        return F.get(
            F.transform(
                F.array(pick),
                lambda found: F.struct(
                    F.concat(
                        F.slice(acc["state"], F.lit(1), found),
                        F.array(window(found, F.get(acc["state"], found)["done"] + 1)),
                        F.slice(acc["state"], found + 2, F.size("classes")),
                    ).alias("state"),
                    F.array_append(acc["picked"], found).alias("picked"),
                ),
            ),
            0,
        )

    def stretch(acc: Column, start: Column) -> Column:
        end = F.least(start + STRETCH - 1, F.col("last"))
        ran = F.aggregate(F.sequence(start, end), F.struct(acc["state"].alias("state"), none.alias("picked")), slot)
        return F.get(
            F.transform(
                F.array(ran),
                lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["picked"], r["picked"]).alias("picked")),
            ),
            0,
        )

    picked = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.col("last"), F.lit(STRETCH).cast("long")),
        F.struct(state.alias("state"), F.array().cast("array<array<int>>").alias("picked")),
        stretch,
        lambda acc: F.flatten(acc["picked"]),
    )
    mine = Window.partitionBy("class_parts").orderBy("slot")
    taken = (
        listed.select("classes", F.posexplode(picked).alias("slot", "pick"))
        .select(F.get("classes", F.col("pick")).alias("class"), F.col("slot").cast("long"))
        .select(F.col("class.parts").alias("class_parts"), F.col("class.m").alias("m"), "slot")
        .withColumn("done", F.row_number().over(mine) - 1)
    )
    same = (F.col("class_parts") == F.col("of_parts")) & (F.col("done") % F.col("m") == F.col("member"))
    return taken.join(members, same).select(
        "source", "slot", (F.floor(F.col("done") / F.col("m")) + 1).cast("long").alias("j")
    )


def in_blocks(documents: DataFrame, id_col: str, source_col: str, block_rows: int) -> DataFrame:
    """(source, id, block, opens): the distinct ids of each source, numbered in order and cut into blocks.

    ``opens`` marks the first id of a block. Ids are dealt by ranges of (source, id), cut at quantiles, so that
    neither a source that holds most rows nor ids far apart make a range large or ranges many. Rows are
    numbered where they were sorted, and the ranges' counts are summed up.
    """
    ranges = min(MAX_RANGES, -(-documents.count() // RANGE_IDS)) or 1
    ids = documents.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("id")
    ).distinct()
    sorted_ids = ids.repartitionByRange(ranges, "source", "id").sortWithinPartitions("source", "id")
    # Ranges are cut at sampled ids: stored, so that counts and numbers are of the same ranges.
    dealt = stored(
        sorted_ids.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("row_no")), "mix-ids"
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        dealt.groupBy("source", "range")
        .agg(F.count("*").alias("n"), F.min("row_no").alias("first_no"))
        .select(
            F.col("source").alias("of_source"),
            F.col("range").alias("of_range"),
            (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_no")).alias("shift"),
        )
    )
    number = F.col("row_no") + F.col("shift")
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range"))
    return dealt.join(counts, same).select(
        "source", "id", F.floor(number / block_rows).alias("block"), (number % block_rows == 0).alias("opens")
    )


def mix(
    documents: DataFrame,
    parts: DataFrame,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """(slot, source, block, epoch, released, due, row) for every row and every epoch of its block.

    ``parts`` has (source, n, parts), n being the source's distinct ids. Sorting by slot gives the mix.
    The documents are counted and their ids stored when this is called.
    """
    parts = parts.where("n > 0 and parts > 0")
    total = Window.partitionBy()
    plan = (
        parts.withColumn("period", F.sum("parts").over(total))
        .withColumn("blocks", F.ceil(F.col("n") / block_rows))
        # The last slot of a source's first epoch; the mix ends with the latest of them.
        .withColumn("ends", F.ceil(F.col("blocks") * F.col("period") / F.col("parts")))
        .withColumn("slots", F.max("ends").over(total))
        .select(F.col("source").alias("of"), "parts", "period", "blocks", "slots")
    )
    slots = period_schedule(plan.withColumnRenamed("of", "source")).select(F.col("source").alias("slot_of"), "j", F.col("slot").alias("at"))

    # Number of every run of a block: its first, and again each time its source starts anew.
    most = F.ceil(F.col("slots") * F.col("parts") / F.col("period"))
    last = F.greatest(F.floor((most - F.col("block") - 1) / F.col("blocks")), F.lit(0))
    ids = in_blocks(documents, id_col, source_col, block_rows)
    blocks = (
        ids.where("opens")
        .select("source", "block")
        .join(plan, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("last", last)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"), F.lit(EPOCHS).cast("long"))).alias("start"))
        .select("*", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + EPOCHS - 1, F.col("last")))).alias("epoch"))
        .withColumn("run", F.col("epoch") * F.col("blocks") + F.col("block"))
        .withColumn("turn", F.floor(F.col("run") / F.col("parts")))
        .withColumn("k", F.col("run") % F.col("parts") + 1)
    )
    when = (
        blocks.join(slots, F.col("of").eqNullSafe(F.col("slot_of")) & (F.col("k") == F.col("j")))
        .withColumn("slot", F.col("turn") * F.col("period") + F.col("at"))
        .where("epoch = 0 or slot < slots")
        .select(
            "of",
            F.col("block").alias("of_block"),
            "epoch",
            "slot",
            (F.col("turn") * F.col("period") + released(F.col("k"), F.col("parts"), F.col("period"))).alias("released"),
            (F.col("turn") * F.col("period") + due(F.col("k"), F.col("parts"), F.col("period"))).alias("due"),
        )
    )
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    placed = ids.join(when, same)
    rows = documents.select(
        F.col(source_col).cast("string").alias("row_source"),
        F.col(id_col).cast("long").alias("row_id"),
        F.struct("*").alias("row"),
    )
    same = F.col("row_source").eqNullSafe(F.col("source")) & F.col("row_id").eqNullSafe(F.col("id"))
    return rows.join(placed, same).select("slot", "source", "block", "epoch", "released", "due", "row")


def source_counts(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(source, n): distinct ids of each source."""
    ids = documents.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("id"))
    return ids.distinct().groupBy("source").agg(F.count("*").alias("n"))
