"""The audits over a lake's bronze tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators import audits
from tarmac.operators.flatten import flight_items
from tarmac.operators.quality import valid_rows
from tarmac.plans.lake import Lake
from tarmac.settings import (
    FLIGHT_KEYS,
    FLIGHT_PAGE_LIMIT,
    LOOKBACK_DAYS,
    REFERENCE_PAGE_LIMIT,
    Hub,
)
from tarmac.sources.landing import good_pages
from tarmac.sources.tables import StreamTable

# Every fetch run is audited on its own: a page that an earlier run brought does not fill a
# later run's hole, and a flight that moves to another page between runs is no repeat.
FLIGHT_REQUEST = ["fetch_run", "hub", "flight_type", "slot_start"]
REFERENCE_REQUEST = ["fetch_run", "endpoint"]
#: How long a run may last. So far before the time asked for, pages are read, to see where runs begin.
LONGEST_RUN = dt.timedelta(days=1)


def _pages(bronze: StreamTable, request: list[str], since: dt.datetime | None) -> DataFrame:
    """Good pages whose name tells their request, of the runs that began at ``since`` or later.

    Bronze is stored by day of fetch, so earlier days are not read.
    """
    pages = good_pages(bronze.read())
    if since is not None:
        first = since - LONGEST_RUN
        pages = pages.filter(F.col("fetch_day") >= F.lit(first.date())).filter(F.col("fetched_at") >= _at(first))
    named = [name for name in request if name != "fetch_run"]
    traced = valid_rows(pages, [*named, "fetched_at", "page_offset", "page_limit"])
    by = [name for name in named if name in ("hub", "endpoint")]
    runs = audits.with_fetch_run(traced, by)
    return runs if since is None else runs.filter(F.col("fetch_run") >= _at(since))


def _at(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def missing_flight_pages(lake: Lake, since: dt.datetime | None = None) -> DataFrame:
    pages = _pages(lake.bronze_flights, FLIGHT_REQUEST, since)
    return audits.page_gaps(pages, FLIGHT_REQUEST, FLIGHT_PAGE_LIMIT)


def missing_reference_pages(
    lake: Lake, endpoint: str, since: dt.datetime | None = None
) -> DataFrame:
    pages = _pages(lake.bronze_reference(endpoint), REFERENCE_REQUEST, since)
    return audits.page_gaps(pages, REFERENCE_REQUEST, REFERENCE_PAGE_LIMIT)


def odd_flight_limits(lake: Lake, since: dt.datetime | None = None) -> DataFrame:
    """Flight pages whose name states a limit that no request has; the other audits leave them out."""
    pages = _pages(lake.bronze_flights, FLIGHT_REQUEST, since)
    return audits.odd_limits(pages, FLIGHT_REQUEST, FLIGHT_PAGE_LIMIT)


def _slots(pages: DataFrame) -> DataFrame:
    """Which requests flight pages answer, by run."""
    clock = F.col("slot_start").cast("string")
    return pages.select(
        "fetch_run",
        "hub",
        F.to_date("slot_start").alias("day"),
        F.substring(clock, 12, 5).alias("slot"),
        "flight_type",
    )


def missing_slots(
    lake: Lake, last_day: dt.date, days: int = LOOKBACK_DAYS, hub: Hub = Hub()
) -> DataFrame:
    """Requests of the last days that no page of any run answers."""
    pages = _pages(lake.bronze_flights, FLIGHT_REQUEST, None)
    # Plain comparisons on the stored column, so that the scan can skip other days.
    first, after = last_day - dt.timedelta(days - 1), last_day + dt.timedelta(1)
    midnight = lambda day: F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    pages = pages.filter((F.col("slot_start") >= midnight(first)) & (F.col("slot_start") < midnight(after)))
    hubs = lake.spark.range(1).select(F.lit(hub.airport).alias("hub"))
    return audits.coverage_gaps(_slots(pages), audits.lookback_spans(hubs, F.lit(last_day), days))


def missing_slots_by_run(lake: Lake, since: dt.datetime | None = None, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Requests that a run should have made of its hub's last days and of which it brought no page."""
    landed = _slots(_pages(lake.bronze_flights, FLIGHT_REQUEST, since))
    by = ["fetch_run", "hub"]
    return audits.coverage_gaps(landed, audits.run_spans(landed, days), by=by)


def flight_page_duplicates(lake: Lake, since: dt.datetime | None = None) -> DataFrame:
    pages = _pages(lake.bronze_flights, FLIGHT_REQUEST, since)
    items = flight_items(pages, [*FLIGHT_REQUEST, "page_offset"])
    return audits.page_duplicates(
        valid_rows(items, FLIGHT_KEYS),
        audits.latest_totals(pages, FLIGHT_REQUEST),
        FLIGHT_REQUEST,
        FLIGHT_KEYS,
        FLIGHT_PAGE_LIMIT,
    )
