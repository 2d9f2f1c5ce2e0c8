from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.functions.times import as_instant, minutes_between, parse_utc_minute, to_zone
from tarmac.operators import features
from tarmac.settings import Hub

NTZ = "%Y-%m-%d %H:%M"


def clock(text):
    return dt.datetime.strptime(text, NTZ) if text else None


@pytest.mark.parametrize(
    "scheduled, actual, expected",
    [
        ("2025-03-30 00:50", "2025-03-30 01:10", 20),  # clocks go forward at the hub
        ("2025-10-26 00:50", "2025-10-26 01:10", 20),  # and back
        ("2025-03-09 01:50", "2025-03-09 02:30", 40),  # gap in the session's zone
        ("2025-01-01 10:00", "2025-01-01 09:50", -10),
        ("2024-12-31 23:59", "2025-01-02 00:00", 1441),
        ("2025-01-01 10:00", None, None),
    ],
)
def test_minutes_between(spark, any_zone, scheduled, actual, expected):
    rows = spark.createDataFrame([(clock(scheduled), clock(actual))], "a timestamp_ntz, b timestamp_ntz")
    assert rows.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == expected


def test_minutes_are_rounded_away_from_zero(spark):
    rows = spark.sql(
        "select timestamp_ntz'2025-01-01 10:00:00' a, explode(array("
        "timestamp_ntz'2025-01-01 10:00:29', timestamp_ntz'2025-01-01 10:00:30',"
        "timestamp_ntz'2025-01-01 09:59:30', timestamp_ntz'2025-01-01 09:59:31')) b"
    )
    got = [r[0] for r in rows.select(minutes_between(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 1, -1, 0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-03-09T02:30Z", "2025-03-09 02:30"),
        ("2025-03-30T01:10Z", "2025-03-30 01:10"),
        ("2025-03-09T02:30:00Z", None),
        ("2025-03-09T02:30", None),
        ("2025-3-9T02:30Z", None),
        ("2025-13-09T02:30Z", None),
        ("2025-02-30T02:30Z", None),
        ("2025-02-20T24:30Z", None),
        (" 2025-03-09T02:30Z", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_utc_minute(spark, any_zone, text, expected):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(parse_utc_minute(F.col("t"))).first()[0] == clock(expected)


def test_to_zone_across_daylight_saving(spark, any_zone):
    rows = spark.createDataFrame(
        [(clock("2025-03-30 00:59"),), (clock("2025-03-30 01:00"),), (None,)], "t timestamp_ntz"
    )
    got = [r[0] for r in rows.select(to_zone(F.col("t"), "Europe/Berlin")).collect()]
    assert got == [clock("2025-03-30 01:59"), clock("2025-03-30 03:00"), None]


def test_as_instant_ignores_the_session_zone(spark, any_zone):
    rows = spark.createDataFrame([(clock("2025-03-09 02:30"),)], "t timestamp_ntz")
    seconds = rows.select(F.unix_timestamp(as_instant(F.col("t")))).first()[0]
    assert seconds == int(dt.datetime(2025, 3, 9, 2, 30, tzinfo=dt.UTC).timestamp())


def test_local_columns_follow_the_hub(spark, any_zone):
    rows = spark.createDataFrame(
        [(clock("2025-07-01 22:30"), None, clock("2025-07-02 06:00"), None)],
        "scheduled_departure_utc timestamp_ntz, actual_departure_utc timestamp_ntz,"
        " scheduled_arrival_utc timestamp_ntz, actual_arrival_utc timestamp_ntz",
    )
    row = features.localise(rows, Hub("JFK", "America/New_York")).first()
    assert row.local_scheduled_dep == clock("2025-07-01 18:30")
    assert row.local_scheduled_arr == clock("2025-07-02 02:00")
    assert row.local_actual_dep is None
