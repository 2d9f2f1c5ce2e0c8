"""Every branch of the flight rules on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest

from tarmac.operators import features, metrics
from tarmac.settings import Hub

SCHEMA = (
    "flight_number string, airline_id string, aircraft_code string,"
    " dep_airport_code string, arr_airport_code string,"
    " scheduled_departure_utc timestamp_ntz, actual_departure_utc timestamp_ntz,"
    " scheduled_arrival_utc timestamp_ntz, actual_arrival_utc timestamp_ntz,"
    " flight_status_desc string"
)
DAY = dt.datetime(2025, 3, 10, 8, 0)


def minutes(n):
    return dt.timedelta(minutes=n)


def row(dep="FRA", arr="JFK", dep_late=None, arr_late=None, status="Landed", number="1", **changes):
    values = {
        "flight_number": number,
        "airline_id": "X1",
        "aircraft_code": "74H",
        "dep_airport_code": dep,
        "arr_airport_code": arr,
        "scheduled_departure_utc": DAY,
        "actual_departure_utc": None if dep_late is None else DAY + minutes(dep_late),
        "scheduled_arrival_utc": DAY + minutes(480),
        "actual_arrival_utc": None if arr_late is None else DAY + minutes(480 + arr_late),
        "flight_status_desc": status,
    } | changes
    return tuple(values.values())


CASES = [
    # row, direction, delay, category, kept
    (row(dep_late=20, arr_late=0), "Departure", 20, "Major_Delay", True),
    (row(dep_late=15), "Departure", 15, "Major_Delay", True),
    (row(dep_late=14), "Departure", 14, "Minor_Delay", True),
    (row(dep_late=1), "Departure", 1, "Minor_Delay", True),
    (row(dep_late=0), "Departure", 0, "On_time", True),
    (row(dep_late=-5), "Departure", -5, "On_time", True),
    (row(), "Departure", 0, "On_time", False),
    (row(arr_late=7), "Departure", 0, "On_time", False),
    (row(status="Cancelled"), "Departure", 0, "Cancelled", True),
    (row(status="cancelled"), "Departure", 0, "On_time", False),
    (row(status=None, dep_late=3), "Departure", 3, "Minor_Delay", True),
    (row("JFK", "FRA", 10, 30), "Arrival", 20, "Major_Delay", True),
    (row("JFK", "FRA", 30, 10), "Arrival", 0, "On_time", True),
    (row("JFK", "FRA", -10, 5), "Arrival", 15, "Major_Delay", True),
    (row("JFK", "FRA", None, 5), "Arrival", 5, "Minor_Delay", True),
    (row("JFK", "FRA", 10), "Arrival", 0, "On_time", False),
    (row("JFK", "FRA", status="Cancelled"), "Arrival", 0, "Cancelled", True),
    (row(None, "FRA", 0, 5), "Arrival", 5, "Minor_Delay", True),
    (row("FRA", "FRA", 5, 50), "Departure", 5, "Minor_Delay", True),
    (row("FRA", "FRA", None, 50), "Departure", 0, "On_time", False),
    (row("JFK", "LHR", 30, 30), "Unknown", 0, "On_time", False),
    (row("JFK", "LHR", 30, 30, "Cancelled"), "Unknown", 0, "Cancelled", True),
    (row(None, None, 30, 30), "Unknown", 0, "On_time", False),
    # Arrived, but nobody knows when it should have: the delay is no number, greatest() skips it.
    (row("JFK", "FRA", 0, 5, scheduled_arrival_utc=None), "Arrival", 0, "On_time", True),
    # Left, but nobody knows when it should have: no delay at all counts as the worst.
    (row(dep_late=5, scheduled_departure_utc=None), "Departure", None, "Major_Delay", True),
]


@pytest.fixture(scope="module")
def judged(spark):
    numbered = [(str(i), *case[0][1:]) for i, case in enumerate(CASES)]
    rows = features.with_direction(spark.createDataFrame(numbered, SCHEMA))
    rows = features.with_status(features.with_delays(rows))
    kept = {r.flight_number for r in features.completed_flights(rows).collect()}
    return {int(r.flight_number): (r, r.flight_number in kept) for r in rows.collect()}


@pytest.mark.parametrize("index", range(len(CASES)))
def test_rules(judged, index):
    _, direction, delay, category, kept = CASES[index]
    got, was_kept = judged[index]
    assert (got.direction, got.delay_minutes, got.status_category, was_kept) == (
        direction,
        delay,
        category,
        kept,
    )


def test_features_keep_what_the_filter_keeps_and_add_the_same_columns(spark, judged):
    numbered = [(str(i), *case[0][1:]) for i, case in enumerate(CASES)]
    rows = features.business_features(spark.createDataFrame(numbered, SCHEMA)).collect()
    assert {int(r.flight_number) for r in rows} == {i for i, c in enumerate(CASES) if c[4]}
    for r in rows:
        expected, _ = judged[int(r.flight_number)]
        assert r.delay_minutes == expected.delay_minutes
        assert r.status_category == expected.status_category


@pytest.mark.parametrize(
    "scheduled, day, hour, wave, weekend",
    [
        ("2025-03-08 04:59", "2025-03-08", 5, False, True),  # Saturday
        ("2025-03-08 05:00", "2025-03-08", 6, True, True),
        ("2025-03-09 08:59", "2025-03-09", 9, True, True),  # Sunday
        ("2025-03-10 09:00", "2025-03-10", 10, False, False),
        ("2025-03-07 23:30", "2025-03-08", 0, False, True),  # Saturday only at the hub
        ("2025-03-30 01:30", "2025-03-30", 3, False, True),
    ],
)
def test_calendar(spark, any_zone, scheduled, day, hour, wave, weekend):
    at = dt.datetime.strptime(scheduled, "%Y-%m-%d %H:%M")
    rows = spark.createDataFrame([row(scheduled_departure_utc=at)], SCHEMA)
    got = features.with_calendar(features.with_direction(rows)).first()
    assert (str(got.scheduled_date), got.scheduled_hour) == (day, hour)
    assert (got.is_morning_wave, got.is_weekend) == (wave, weekend)


def test_arrival_without_schedule_forms_a_group_without_date(spark):
    rows = spark.createDataFrame([row("JFK", "FRA", 0, 5, scheduled_arrival_utc=None)], SCHEMA)
    got = metrics.airport_hourly(features.business_features(rows)).first()
    assert (got.scheduled_date, got.scheduled_hour, got.direction) == (None, None, "Arrival")
    assert (got.is_weekend, got.is_morning_wave, got.total_flights) == (False, False, 1)


def test_another_hub(spark):
    rows = spark.createDataFrame([row("FRA", "JFK", 0, 30)], SCHEMA)
    got = features.business_features(rows, Hub("JFK", "America/New_York")).first()
    assert (got.direction, got.delay_minutes, got.scheduled_hour) == ("Arrival", 30, 12)


def test_performance_keeps_null_keys_and_counts_cancelled_in_the_rate(spark):
    rows = spark.createDataFrame(
        [
            row(dep_late=0, aircraft_code=None),
            row(dep_late=20, aircraft_code=None),
            row(status="Cancelled", aircraft_code=None),
        ],
        SCHEMA,
    )
    got = metrics.flight_performance(features.business_features(rows)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.aircraft_code, r.total_flights, r.cancelled_times, r.on_time_times) == (None, 3, 1, 1)
    assert (r.avg_delay_minutes, r.max_delay_minutes, r.on_time_rate) == (6.67, 20, 33.33)


def test_rates_and_means_round_halves_up(spark):
    rows = [row(dep_late=0 if i else 20) for i in range(32)]
    got = metrics.flight_performance(
        features.business_features(spark.createDataFrame(rows, SCHEMA))
    ).first()
    assert (got.on_time_rate, got.avg_delay_minutes) == (96.88, 0.63)


def test_ripple_matches_a_plain_sum(spark):
    import random

    rng = random.Random(7)
    hours = [
        (dt.date(2025, 3, day), hour, direction, rng.randint(-30, 300))
        for day in (1, 2, 3)
        for hour in range(24)
        for direction in ("Arrival", "Departure")
        if rng.random() < 0.6
    ]
    schema = "scheduled_date date, scheduled_hour int, direction string, total_delay_minutes bigint"
    got = metrics.with_ripple(spark.createDataFrame(hours, schema)).collect()
    assert len(got) == len(hours)
    for r in got:
        expected = sum(
            delay
            for day, hour, direction, delay in hours
            if (day, direction) == (r.scheduled_date, r.direction)
            and r.scheduled_hour - 3 <= hour < r.scheduled_hour
        )
        assert r.past_3_hours_delay == expected


def test_rolled_up_days_equal_one_pass(spark):
    rows = [
        row("FRA" if i % 3 else "JFK", "JFK" if i % 3 else "FRA", i % 40 - 5, i % 60 - 9,
            number=str(i % 4), scheduled_departure_utc=DAY + minutes(97 * i))
        for i in range(300)
    ]
    from pyspark.sql import functions as F

    featured = features.business_features(spark.createDataFrame(rows, SCHEMA)).withColumn(
        "flight_day", F.to_date("scheduled_departure_utc")
    )
    for keys in (metrics.HOURLY_KEYS, metrics.PERFORMANCE_KEYS):
        whole = metrics.measure(featured, keys)
        parts = metrics.roll_up(metrics.measure(featured, ["flight_day", *keys]), keys)
        assert sorted(map(tuple, whole.collect()), key=str) == sorted(
            map(tuple, parts.select(*whole.columns).collect()), key=str
        )


def test_outcome_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame([row(dep_late=5)], SCHEMA).write.parquet(path)
    report = metrics.airport_hourly(features.business_features(spark.read.parquet(path)))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert "aircraft_code" not in plan and "airline_id" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
