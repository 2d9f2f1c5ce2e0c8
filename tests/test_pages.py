from __future__ import annotations

import json

import pytest
from pages import flight, flight_page, land, named, reference_page
from pyspark.sql import functions as F

from tarmac.functions.lineage import lineage_columns
from tarmac.operators import flatten, quality
from tarmac.schemas import FACT_COLUMNS
from tarmac.settings import FLIGHT_KEYS, PROXY_ERROR_KEYS
from tarmac.sources import landing


def classified(spark, *pages):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(pages)]
    return landing.classify(spark.createDataFrame(texts, "i int, page_text string"))


STATUSES = [
    (flight_page([flight()]), "ok"),
    ({}, "ok"),
    ({"anything": 1}, "ok"),
    ({"ProcessingErrors": {"ProcessingError": {"Type": "A"}}}, "api_error"),
    ({"ProcessingErrors": None}, "api_error"),
    ({"ProcessingErrors": [], "message": "x", "Meta": 1}, "api_error"),
    ({"Meta": {}, "message": "x"}, "ok"),
    ({"Meta": None, "message": "x"}, "ok"),
    ({"MESSAGE": "x"}, "ok"),
    ({"nested": {"message": "x"}}, "ok"),
    *[({key: "gateway timeout"}, "proxy_error") for key in PROXY_ERROR_KEYS],
    ({"message": "0"}, "proxy_error"),
    ({"message": "false"}, "proxy_error"),
    ({"message": "null"}, "proxy_error"),
    ({"message": " "}, "proxy_error"),
    ({"message": 12.5}, "proxy_error"),
    ({"message": True}, "proxy_error"),
    ({"message": ["x"]}, "proxy_error"),
    ({"message": {"a": None}}, "proxy_error"),
    ({"message": "", "detail": "x"}, "proxy_error"),
    ({"message": ""}, "ok"),
    ({"message": None}, "ok"),
    ({"message": False}, "ok"),
    ({"message": 0}, "ok"),
    ({"message": 0.0}, "ok"),
    ({"message": []}, "ok"),
    ({"message": {}}, "ok"),
    ([1, 2], "malformed"),
    ("", "malformed"),
    ("null", "malformed"),
    ('"text"', "malformed"),
    ('{"cut": ', "malformed"),
    ("<html></html>", "malformed"),
    ('\n  {"indented": 1}\n', "ok"),
]


def test_page_status(spark):
    got = {r.i: r.page_status for r in classified(spark, *[p for p, _ in STATUSES]).collect()}
    assert got == {i: status for i, (_, status) in enumerate(STATUSES)}


def test_every_page_keeps_its_text(spark):
    pages = classified(spark, {"message": "x"}, {"a": "b"}, "oops").orderBy("i")
    assert [(r.page_text, r.page_status) for r in pages.collect()] == [
        ('{"message": "x"}', "proxy_error"),
        ('{"a": "b"}', "ok"),
        ("oops", "malformed"),
    ]


@pytest.mark.parametrize(
    "errors, kind, description",
    [
        ({"ProcessingError": {"Type": "T", "Description": "D"}}, "T", "D"),
        ({"ProcessingError": [{"Type": "T"}, {"Type": "U"}]}, "T", "No description"),
        ([{"Description": "D"}, {"Type": "U"}], "Unknown", "D"),
        ({"Type": "T", "Description": "D"}, "T", "D"),
        ({}, "Unknown", "No description"),
        (None, "Unknown", "No description"),
    ],
)
def test_error_details(spark, errors, kind, description):
    row = classified(spark, {"ProcessingErrors": errors}).first()
    assert (row.error_type, row.error_description) == (kind, description)


def test_total_count_of_any_resource(spark):
    city_page = reference_page("CityResource", "Cities", "City", [named("CityCode", "A", "B")])
    rows = classified(spark, flight_page([], total=120), city_page, {}).orderBy("i").collect()
    assert [r.total_count for r in rows] == [120, 1, None]


def test_flight_columns(spark):
    arrival = {
        "Arrival__ActualTimeUTC": {"DateTime": "2025-03-10T16:35Z"},
        "Arrival__Terminal": {"Name": "4", "Gate": 12},
        "Arrival__TimeStatus": {"Code": "DL", "Definition": "Delayed"},
    }
    pages = classified(spark, flight_page([flight("0400", actual="2025-03-10T08:05Z", **arrival)]))
    row = flatten.flight_items(pages).first()
    assert row.__fields__ == FACT_COLUMNS
    assert tuple(str(v) for v in row) == (
        "X1", "0400", "2025-03-10 08:00:00", "FRA", "2025-03-10 08:05:00", "1", "B22",
        "OT", "Flight On Time", "JFK", "2025-03-10 16:30:00", "2025-03-10 16:35:00", "4", "12",
        "DL", "Delayed", "74H", "DABYA", "NA", "Scheduled",
    )


@pytest.mark.parametrize(
    "items, count",
    [([flight()], 1), (flight(), 1), ([flight(), flight()], 2), ([], 1), (None, 1)],
)
def test_items_of_a_page(spark, items, count):
    page = {"FlightStatusResource": {"Flights": {"Flight": items}, "Meta": {"TotalCount": 9}}}
    rows = flatten.flight_items(classified(spark, page), ["i"]).collect()
    assert len(rows) == count
    assert all((r.airline_id is None) == (not items) for r in rows)


def test_page_without_a_collection_gives_an_empty_row(spark):
    rows = flatten.flight_items(classified(spark, {})).collect()
    assert [set(r) for r in rows] == [{None}]


def test_reference_columns(spark):
    position = {"Coordinate": {"Latitude": 50.0331, "Longitude": "east"}}
    airport = named(
        "AirportCode", "FRA", "Main", CityCode="FRA", CountryCode="DE", Position=position,
        UtcOffset="+01:00",
    )
    plural = {"AirportCode": "MUC", "Names": {"Name": [{"$": "Munich"}, {"$": "München"}]}}
    nameless = {"AirportCode": "YYY"}
    page = reference_page("AirportResource", "Airports", "Airport", [airport, plural, nameless])
    rows = {
        r.airport_code: tuple(r)[1:]
        for r in flatten.reference_items(classified(spark, page), "airports").collect()
    }
    assert rows == {
        "FRA": ("Main", "FRA", "DE", 50.0331, None, "+01:00"),
        "MUC": ("Munich", None, None, None, None, None),
        "YYY": (None,) * 6,
    }


@pytest.mark.parametrize(
    "name, expected",
    [
        (
            "20250310040506_FRA_departures_2025-03-10T2000_off50_lim25.json",
            ("2025-03-10 04:05:06", None, "FRA", "departures", "2025-03-10 20:00:00", 50, 25),
        ),
        (
            "20250309023000_ref_aircraft_off0_lim100.json",
            ("2025-03-09 02:30:00", "aircraft", None, None, None, 0, 100),
        ),
        (
            "20251309023000_ref_aircraft_off0_lim100.json",
            (None, "aircraft", None, None, None, 0, 100),
        ),
        ("notes.json", (None,) * 7),
        ("20250310040506_FRA_departures_2025-03-10T2000_off50.json", (None,) * 7),
    ],
)
def test_lineage(spark, any_zone, name, expected):
    frame = spark.createDataFrame([(name,)], "n string")
    columns = lineage_columns(F.col("n"))
    row = frame.select(*(value.alias(key) for key, value in columns.items())).first()
    assert tuple(str(v) if hasattr(v, "year") else v for v in row) == expected


def test_files_are_read_whole_with_their_names(spark, tmp_path):
    path = land(str(tmp_path), flight_page([flight(), flight("2")]), "20250310040506")
    bronze = landing.bronze_pages(landing.read_pages(spark, str(tmp_path)))
    row = bronze.first()
    assert path.endswith(row.file_name)
    assert (row.page_status, row.total_count, row.page_limit) == ("ok", 2, 50)
    assert flatten.flight_items(bronze).count() == 2


def test_split_is_a_partition_of_the_rows(spark):
    rows = spark.createDataFrame(
        [(a, b, c) for a in ("X", None) for b in ("1", None) for c in ("t", None)],
        "airline_id string, flight_number string, scheduled_departure_utc string",
    )
    valid, quarantined = (
        split(rows, FLIGHT_KEYS).collect()
        for split in (quality.valid_rows, quality.quarantined_rows)
    )
    assert (len(valid), len(quarantined)) == (1, 7)
    routes = quality.with_route(rows, FLIGHT_KEYS).groupBy("route").count().collect()
    assert {r.route: r["count"] for r in routes} == {"valid": 1, "quarantine": 7}


def test_schema_discovery_sees_through_types(spark):
    ddl = landing.discover_schema(spark, json.dumps({"a": "0400", "b": 1, "c": [{"d": 1.5}]}))
    assert ddl == "STRUCT<a: STRING, b: BIGINT, c: ARRAY<STRUCT<d: DOUBLE>>>"


def test_page_keys_are_listed_once_even_under_a_filter(spark):
    pages = landing.good_pages(classified(spark, flight_page([flight()])))
    plan = flatten.flight_items(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_object_keys") + plan.count("jsonObjectKeys") == 1


def test_an_item_of_a_wrong_kind_costs_only_itself(spark):
    odd = flight("3", Departure__Terminal="none")
    rows = flatten.flight_items(classified(spark, flight_page([flight("1"), 7, odd]))).collect()
    assert [r.flight_number for r in rows] == ["1", None, "3"]
    assert [r.dep_gate for r in rows] == ["B22", None, None]
    assert rows[2].dep_time_status_code == "OT"
