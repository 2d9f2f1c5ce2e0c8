"""Gold tables, in full from the fact or day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators import metrics
from tarmac.operators.features import business_features
from tarmac.plans.lake import Lake
from tarmac.settings import HOURLY_KEYS, PERFORMANCE_KEYS, Hub
from tarmac.sources.tables import part_name


def airport_hourly(fact: DataFrame, hub: Hub = Hub()) -> DataFrame:
    return _stamped(metrics.airport_hourly(business_features(fact, hub)))


def flight_performance(fact: DataFrame, hub: Hub = Hub()) -> DataFrame:
    return _stamped(metrics.flight_performance(business_features(fact, hub)))


def day_measures(fact: DataFrame, hub: Hub = Hub()) -> DataFrame:
    """Measures of both reports per fact day, in one pass.

    The keys are those of both reports together: a flight number flies about once a day, so keeping its hour
    as well makes hardly more rows than the punctuality report needs alone.
    """
    day = F.to_date("scheduled_departure_utc")
    featured = business_features(fact, hub).withColumn("flight_day", day)
    return metrics.measure(featured, ["flight_day", *dict.fromkeys([*HOURLY_KEYS, *PERFORMANCE_KEYS])])


def refresh_days(lake: Lake, days: list[str], hub: Hub = Hub()) -> list[str]:
    """Measure the given fact days again, swap the result in and return the hub dates whose report is not right any more.

    A flight that moved to another hour or aircraft takes its old counts with it, because a day is replaced and
    not added to; so the dates are those of the old measures and of the new ones. The old ones are
    marked before the measures that tell them are replaced, and stay marked until the report is written: a run that
    dies in between, at any place, is made good by the next one.
    """
    lake.day_dates.upsert(_dates(lake, days).withColumns({"current": F.lit(False), "pending": F.lit(True)}))
    lake.day_measures.replace(day_measures(lake.fact.read(days), hub), days)
    found = lake.day_measures.read(days).select("flight_day", part_name(F.col("scheduled_date")).alias("hub_date"))
    lake.day_dates.upsert(found.distinct().withColumns({"current": F.lit(True), "pending": F.lit(True)}))
    return pending_dates(lake)


def _dates(lake: Lake, days: list[str]) -> DataFrame:
    return lake.day_dates.read().filter(part_name(F.col("flight_day")).isin(days))


def pending_dates(lake: Lake) -> list[str]:
    """Hub dates of which the report waits to be written: a few per changed day."""
    rows = lake.day_dates.read().filter("pending").select("hub_date").distinct().collect()
    return sorted(row.hub_date for row in rows)


def publish_hourly(lake: Lake, dates: list[str] | None = None) -> None:
    """Write the hourly report anew for the given hub dates, or for all. Reads no flights.

    The ripple column looks back within a date, so a date stands on its own. Only the measures of fact days
    that have flights on those dates are read.
    """
    known = lake.day_dates.read()
    if dates is None:
        rows = known.select("hub_date").distinct().collect()
        dates = sorted({row.hub_date for row in rows} | set(lake.airport_hourly.parts()))
    if not dates:
        return
    on_dates = known.filter(F.col("current") & F.col("hub_date").isin(dates))
    days = on_dates.select(part_name(F.col("flight_day"))).distinct().collect()
    measures = lake.day_measures.read([row[0] for row in days])
    measures = measures.filter(part_name(F.col("scheduled_date")).isin(dates))
    hourly = metrics.hourly_report(metrics.roll_up(measures, HOURLY_KEYS))
    lake.airport_hourly.replace(_stamped(metrics.with_ripple(hourly)), dates)
    lake.day_dates.upsert(known.filter(F.col("hub_date").isin(dates)).withColumn("pending", F.lit(False)))


def publish_performance(lake: Lake) -> None:
    """Roll the stored day measures up into the punctuality report. Reads no flights."""
    flights = metrics.roll_up(lake.day_measures.read(), PERFORMANCE_KEYS)
    lake.flight_performance.replace(_stamped(metrics.performance_report(flights)))


def publish(lake: Lake) -> None:
    """Both gold tables in full from the stored day measures."""
    publish_hourly(lake)
    publish_performance(lake)


def rebuild(lake: Lake, hub: Hub = Hub()) -> None:
    """Both gold tables from the whole fact, after the hub or a rule has changed."""
    refresh_days(lake, sorted(lake.fact.parts()), hub)
    publish(lake)


def _stamped(report: DataFrame) -> DataFrame:
    return report.withColumn("gold_processed_at", F.current_timestamp())
