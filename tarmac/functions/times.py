"""Time expressions on TIMESTAMP_NTZ columns that hold UTC.

Nothing here passes through TIMESTAMP, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.settings import MORNING_WAVE_HOURS, UTC_MINUTE_PATTERN, WEEKEND_DAYS


def parse_utc_minute(text: Column) -> Column:
    """``2024-01-31T23:05Z`` as TIMESTAMP_NTZ; null for any other shape or an impossible date."""
    clock = F.concat(F.substring(text, 1, 16), F.lit(":00"))
    return F.when(text.rlike(UTC_MINUTE_PATTERN), clock.try_cast("timestamp_ntz"))


def to_zone(utc: Column, timezone: str) -> Column:
    """Wall-clock time in ``timezone`` of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc)


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed whole minutes, halves away from zero; null when either end is null."""
    seconds = (end - start).cast("interval second").cast("bigint")
    return F.round(seconds / 60).cast("bigint")


def as_instant(utc: Column) -> Column:
    """UTC kept as TIMESTAMP_NTZ as the TIMESTAMP of that instant, for watermarks.

    A plain cast would read the clock in the session zone instead.
    """
    since_epoch = utc - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(since_epoch.cast("interval second").cast("decimal(20, 6)"))


def as_utc(instant: Column) -> Column:
    """The UTC clock of a TIMESTAMP as TIMESTAMP_NTZ, whatever the session zone."""
    seconds = F.unix_micros(instant).cast("decimal(18, 0)") / F.lit(1_000_000)
    since_epoch = F.make_dt_interval(secs=seconds.cast("decimal(18, 6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch


def is_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit(False))


def is_morning_wave(hour: Column) -> Column:
    return F.coalesce(hour.between(*MORNING_WAVE_HOURS), F.lit(False))
