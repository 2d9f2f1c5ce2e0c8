"""Find what never landed: missing pages, missing time slots, rows lost between pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.keyed import latest_per_key
from tarmac.settings import FLIGHT_TYPES, TIME_SLOTS

PAGES_PER_CHUNK = 1000
#: Fetches further apart belong to two runs. A request's last retry waits a little over an hour.
RUN_GAP_MINUTES = 90


def with_fetch_run(pages: DataFrame, by: list[str], gap_minutes: int = RUN_GAP_MINUTES) -> DataFrame:
    """Add ``fetch_run``: when the run began that fetched a page.

    A run is a chain of fetches of the same ``by`` (a hub, an endpoint) with no more than ``gap_minutes`` between two
    of them, whatever the hour. Fetches are first put into slices of that length, of which only the first and the last one
    matter, so a hub that has been fetched for years is a few rows a day when they are put in order.
    """
    since_epoch = F.col("fetched_at") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    slice_no = F.floor(since_epoch.cast("interval second").cast("bigint") / (60 * gap_minutes))
    sliced = pages.withColumn("slice_no", slice_no)
    ends = sliced.groupBy(*by, "slice_no").agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last"))
    order = Window.partitionBy(*by).orderBy("slice_no")
    # Two fetches of one slice are never too far apart.
    before = F.lag("last").over(order)
    opens = before.isNull() | (F.col("first") - before > F.make_dt_interval(mins=F.lit(gap_minutes)))
    runs = ends.withColumn("opened", F.when(opens, F.col("first")))
    begun = F.last("opened", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = runs.select(*(F.col(name).alias(f"run_{name}") for name in (*by, "slice_no")), begun.alias("fetch_run"))
    # The keys are those of the grouping, so that null compares equal to null.
    same = [F.col(name).eqNullSafe(F.col(f"run_{name}")) for name in (*by, "slice_no")]
    return sliced.join(runs, same, "left").select(*pages.columns, "fetch_run")


def run_spans(runs: DataFrame, days: int) -> DataFrame:
    """What each run (columns ``fetch_run``, ``hub``) had to fetch: the last ``days`` days up to its own."""
    last = F.to_date("fetch_run")
    return runs.select(
        "fetch_run", "hub", F.date_sub(last, days - 1).alias("first_day"), last.alias("last_day")
    ).distinct()


def latest_totals(pages: DataFrame, group: list[str]) -> DataFrame:
    """The record count each request group last reported."""
    stated = pages.filter(F.col("total_count").isNotNull())
    newest = latest_per_key(stated.select(*group, "fetched_at", "total_count"), group, ["fetched_at"])
    return newest.select(*group, "total_count")


def expected_pages(totals: DataFrame, group: list[str], limit: int) -> DataFrame:
    """One row per page a full fetch of each group would have made.

    Offsets are listed in two steps with a shuffle between them, so a group
    with very many pages becomes neither one long array nor one long task.
    """
    span = limit * PAGES_PER_CHUNK
    chunk_starts = F.sequence(F.lit(0).cast("bigint"), F.col("total_count") - 1, F.lit(span).cast("bigint"))
    chunks = totals.filter(F.col("total_count") > 0).select(
        *group, "total_count", F.explode(chunk_starts).alias("chunk_start")
    )
    chunk_end = F.least(F.col("chunk_start") + span, F.col("total_count")) - 1
    offsets = F.sequence(F.col("chunk_start"), chunk_end, F.lit(limit).cast("bigint"))
    pages = chunks.repartition(*group, "chunk_start").select(
        *group, "total_count", F.explode(offsets).alias("page_offset")
    )
    size = F.least(F.lit(limit).cast("bigint"), F.col("total_count") - F.col("page_offset"))
    return pages.select(*group, "page_offset", size.alias("expected_records"))


def page_coverage(pages: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Records landed per full-size page, counting overlapping pieces once.

    Pages with a larger limit than ``limit`` do not count, see ``odd_limits``.
    A page that failed may have landed in pieces of smaller limits. The pieces
    of one page are few once repeats are gone, so the window over them is small
    however often a page was fetched again.
    """
    piece_end = F.col("page_offset") + F.col("page_limit")
    pieces = (
        pages.filter((F.col("page_limit") > 0) & (F.col("page_limit") <= limit))
        .select(*group, "page_offset", piece_end.alias("piece_end"))
        .distinct()
    )
    size = F.lit(limit).cast("bigint")
    last = F.col("piece_end") - 1
    first_home = F.col("page_offset") - F.col("page_offset") % size
    homes = F.sequence(first_home, last - last % size, size)
    placed = pieces.withColumn("home_offset", F.explode(homes))
    before = (
        Window.partitionBy(*group, "home_offset")
        .orderBy("page_offset", "piece_end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.coalesce(F.max("piece_end").over(before), F.col("page_offset"))
    start = F.greatest(F.col("page_offset"), F.col("home_offset"), reached)
    stop = F.least(F.col("piece_end"), F.col("home_offset") + size)
    added = F.greatest(stop - start, F.lit(0).cast("bigint"))
    # Same keys as the window, so the sum needs no shuffle of its own.
    return (
        placed.withColumn("added", added)
        .groupBy(*group, "home_offset")
        .agg(F.sum("added").alias("landed_records"))
        .withColumnRenamed("home_offset", "page_offset")
    )


def odd_limits(pages: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Pages whose name states a limit that no request has."""
    odd = (F.col("page_limit") <= 0) | (F.col("page_limit") > limit)
    return pages.filter(odd).select(*group, "page_offset", "page_limit").distinct()


def page_gaps(pages: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Expected pages that landed in part or not at all."""
    expected = expected_pages(latest_totals(pages, group), group, limit)
    landed = page_coverage(pages, group, limit)
    audited = expected.join(landed, [*group, "page_offset"], "left").withColumn(
        "landed_records", F.coalesce("landed_records", F.lit(0).cast("bigint"))
    )
    return audited.filter(F.col("landed_records") < F.col("expected_records"))


def expected_slots(
    spans: DataFrame, slots: list[str] = TIME_SLOTS, by: list[str] = ("hub",)
) -> DataFrame:
    """Every request a hub's days call for: each day, each slot, each flight type.

    ``spans`` has ``by``, ``first_day`` and ``last_day``.
    """
    days = F.explode(F.sequence("first_day", "last_day")).alias("day")
    clock = F.explode(F.array(*(F.lit(slot) for slot in slots))).alias("slot")
    kind = F.explode(F.array(*(F.lit(name) for name in FLIGHT_TYPES))).alias("flight_type")
    return spans.select(*by, days).select(*by, "day", clock).select("*", kind)


def coverage_gaps(
    landed: DataFrame, spans: DataFrame, slots: list[str] = TIME_SLOTS, by: list[str] = ("hub",)
) -> DataFrame:
    """Expected requests of which no page landed. ``landed`` has ``by``, day, slot, flight_type.

    With a run among ``by`` every run is held to its own requests: another run's page does not fill its hole.
    """
    keys = [*by, "day", "slot", "flight_type"]
    return expected_slots(spans, slots, by).join(landed.select(*keys).distinct(), keys, "left_anti")


def lookback_spans(hubs: DataFrame, last_day: Column, days: int) -> DataFrame:
    """The last ``days`` days up to ``last_day`` for each row of ``hubs`` (column ``hub``)."""
    return hubs.select(
        "hub", F.date_sub(last_day, days - 1).alias("first_day"), last_day.alias("last_day")
    )


def page_duplicates(
    items: DataFrame, totals: DataFrame, group: list[str], keys: list[str], limit: int
) -> DataFrame:
    """Per request group: keys seen on more than one page, and records that never came.

    ``items`` has the group, ``page_offset`` and the keys of every landed item.
    A first page served twice shifts the rest, and where the total is a multiple
    of the limit the last record then has no page left to appear on.
    """
    per_key = items.groupBy(*group, *keys).agg(
        F.count("*").alias("copies"),
        (F.min("page_offset") < F.max("page_offset")).alias("on_several_pages"),
    )
    per_group = per_key.groupBy(*group).agg(
        F.count("*").alias("distinct_keys"),
        F.count_if("on_several_pages").alias("repeated_keys"),
        F.sum("copies").alias("landed_rows"),
    )
    zero = F.lit(0).cast("bigint")
    counted = totals.join(per_group, group, "full").withColumns(
        {
            name: F.coalesce(name, zero)
            for name in ("landed_rows", "distinct_keys", "repeated_keys")
        }
    )
    return counted.select(
        *group,
        "total_count",
        "landed_rows",
        "distinct_keys",
        "repeated_keys",
        F.greatest(F.col("total_count") - F.col("distinct_keys"), zero).alias("missing_records"),
        (F.col("total_count") % limit == 0).alias("last_page_full"),
    )
