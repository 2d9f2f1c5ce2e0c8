"""Grouped metrics.

Both reports are built from the same additive measures, so a stored part of the
measures can be rolled up again without touching the flights behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.times import is_morning_wave, is_weekend
from tarmac.settings import CANCELLED, HOURLY_KEYS, ON_TIME, PERFORMANCE_KEYS, RIPPLE_HOURS

SUMMED = [
    "total_flights",
    "on_time_flights",
    "cancelled_flights",
    "total_delay_minutes",
    "measured_flights",
]


def measure(features: DataFrame, keys: list[str]) -> DataFrame:
    """One row of additive measures per key; combined map-side, so a hot key stays cheap."""
    status = F.col("status_category")
    return features.groupBy(*keys).agg(
        F.count("flight_number").alias("total_flights"),
        F.count_if(status == ON_TIME).alias("on_time_flights"),
        F.count_if(status == CANCELLED).alias("cancelled_flights"),
        F.sum("delay_minutes").alias("total_delay_minutes"),
        F.count("delay_minutes").alias("measured_flights"),
        F.max("delay_minutes").alias("max_delay_minutes"),
    )


def roll_up(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Merge measures of several parts of the data into one row per key."""
    return measures.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in SUMMED),
        F.max("max_delay_minutes").alias("max_delay_minutes"),
    )


def _average_delay():
    return F.round(F.try_divide("total_delay_minutes", "measured_flights"), 2)


def hourly_report(measures: DataFrame) -> DataFrame:
    """Airport-hour rows. The flags follow from date and hour, so they need not be group keys."""
    return measures.select(
        "scheduled_date",
        "scheduled_hour",
        "direction",
        is_weekend(F.col("scheduled_date")).alias("is_weekend"),
        is_morning_wave(F.col("scheduled_hour")).alias("is_morning_wave"),
        "total_flights",
        "on_time_flights",
        "cancelled_flights",
        "total_delay_minutes",
        _average_delay().alias("avg_delay_minutes"),
    )


def with_ripple(hourly: DataFrame, hours: int = RIPPLE_HOURS) -> DataFrame:
    """Add the delay of the preceding hours of the same day and direction.

    The frame is by hour value: a missing hour counts as missing, it does not
    pull an older one in.
    """
    earlier = (
        Window.partitionBy("scheduled_date", "direction")
        .orderBy("scheduled_hour")
        .rangeBetween(-hours, -1)
    )
    ripple = F.sum("total_delay_minutes").over(earlier)
    return hourly.withColumn("past_3_hours_delay", F.coalesce(ripple, F.lit(0).cast("bigint")))


def airport_hourly(features: DataFrame) -> DataFrame:
    """Airport operations per date, hour and direction, with the ripple column."""
    return with_ripple(hourly_report(measure(features, HOURLY_KEYS)))


def performance_report(measures: DataFrame) -> DataFrame:
    share = F.try_divide("on_time_flights", "total_flights")
    return measures.select(
        *PERFORMANCE_KEYS,
        "total_flights",
        F.col("cancelled_flights").alias("cancelled_times"),
        _average_delay().alias("avg_delay_minutes"),
        "max_delay_minutes",
        F.col("on_time_flights").alias("on_time_times"),
        F.round(share * 100, 2).alias("on_time_rate"),
    )


def flight_performance(features: DataFrame) -> DataFrame:
    """Punctuality per flight number, direction, airline and aircraft type; null keys kept."""
    return performance_report(measure(features, PERFORMANCE_KEYS))
