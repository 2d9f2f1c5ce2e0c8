"""The runs end to end, in several batches."""

from __future__ import annotations

import datetime as dt

import pytest
from pages import flight, flight_page, land, named, reference_page
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tarmac.plans import audit, gold, runs
from tarmac.plans.lake import Lake
from tarmac.schemas import DAY_MEASURES, FACT_COLUMNS, FACT_STORED
from tarmac.settings import REFERENCE_RESOURCES, Hub
from tarmac.sources import landing
from tarmac.streaming import flows


def as_rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def gold_without_stamp(table):
    return as_rows(table.read().drop("gold_processed_at"))


def test_daily_run_in_three_batches(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight(), flight("0401", status="Scheduled")]), "20250310040000")
    runs.daily(lake, folder)
    assert [r.flight_number for r in lake.fact.read().orderBy("flight_number").collect()] == [
        "0401",
        "400",
    ]
    assert lake.airport_hourly.read().count() == 0  # nothing has happened yet

    # A lone flight comes as a bare object; it has departed 20 minutes late.
    done = flight(actual="2025-03-10T08:20Z", status="Flight Departed")
    land(folder, flight_page(done), "20250310120000")
    # One page never was data, and two rows lack a usable key.
    land(folder, {"message": "busy"}, "20250310120001")
    bad = [flight(Departure__ScheduledTimeUTC__DateTime="2025-03-10T08:00:00Z"), flight(None)]
    land(folder, flight_page(bad), "20250310120002")
    runs.daily(lake, folder)
    row = lake.fact.read().filter("flight_number = '400'").first()
    assert (row.flight_status_desc, row.actual_departure_utc.minute) == ("Flight Departed", 20)
    hourly = lake.airport_hourly.read().first()
    assert (hourly.scheduled_hour, hourly.total_flights, hourly.total_delay_minutes) == (9, 1, 20)
    assert flows.quarantine(lake.parsed_flights.read()).count() == 2
    bronze = lake.bronze_flights.read()
    assert [r.page_status for r in landing.rejected_pages(bronze).collect()] == ["proxy_error"]

    # An older page that lands late changes nothing; another day leaves this one alone.
    land(folder, flight_page(flight(status="Boarding")), "20250310060000")
    next_day = flight(scheduled="2025-03-11T08:00Z", actual="2025-03-11T08:00Z", status="Landed")
    land(folder, flight_page([next_day]), "20250311120000")
    runs.daily(lake, folder)
    fact = lake.fact.read()
    assert fact.filter("flight_number = '400'").count() == 2
    assert fact.filter("flight_status_desc = 'Boarding'").count() == 0
    assert set(lake.fact.parts()) == {"2025-03-10", "2025-03-11"}
    assert lake.airport_hourly.read().count() == 2

    # Day by day and all at once agree.
    full = gold.airport_hourly(fact).drop("gold_processed_at")
    assert as_rows(full) == gold_without_stamp(lake.airport_hourly)
    full = gold.flight_performance(fact).drop("gold_processed_at")
    assert as_rows(full) == gold_without_stamp(lake.flight_performance)

    # SQL users see the same tables.
    lake.register_views()
    query = "select sum(total_flights) from gold_airport_hourly_operations"
    assert spark.sql(query).first()[0] == 2
    assert spark.sql("select count(*) from fact_flights").first()[0] == fact.count()

    # Nothing new: nothing changes.
    before = as_rows(lake.fact.read())
    runs.daily(lake, folder)
    assert as_rows(lake.fact.read()) == before


def test_split_into_batches_does_not_matter(spark, tmp_path):
    folder = str(tmp_path / "landing")
    for hour in range(3):
        page = [
            flight(str(n), actual=f"2025-03-10T{8 + hour:02d}:0{n}Z", status=f"S{hour}")
            for n in range(hour, 6)
        ]
        land(folder, flight_page(page), f"202503101{hour}0000")
    results = []
    for max_files in (None, 1):
        lake = Lake(spark, str(tmp_path / f"lake{max_files}"))
        runs.daily(lake, folder, max_files=max_files)
        rows = as_rows(lake.fact.read().select(*FACT_COLUMNS))
        results.append((rows, gold_without_stamp(lake.airport_hourly)))
    assert results[0] == results[1]
    assert len(results[0][0]) == 6


def test_valid_and_quarantined_rows_make_up_the_input(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    items = [
        flight(),
        flight(OperatingCarrier__AirlineID=None),
        flight(None),
        flight(scheduled=""),
        flight(scheduled="2025-13-10T08:00Z"),
    ]
    land(folder, flight_page(items), "20250310040000")
    land(folder, flight_page([]), "20250310040001")  # an empty page is one empty row
    runs.daily(lake, folder)
    assert lake.fact.read().count() == 1
    assert flows.quarantine(lake.parsed_flights.read()).count() == 5


def test_repeating_a_batch_is_a_no_op(spark, lake):
    rows = spark.createDataFrame(
        [("X1", "1", dt.datetime(2025, 3, day, 8), f"G{day}") for day in (1, 2, 3)],
        "airline_id string, flight_number string, scheduled_departure_utc timestamp_ntz,"
        " dep_gate string",
    ).withColumn("fetched_at", F.expr("timestamp_ntz'2025-03-04 00:00:00'"))
    lake.fact.upsert(rows)
    gold.refresh_days(lake, ["2025-03-01", "2025-03-02", "2025-03-03"])
    before = as_rows(lake.fact.read())
    lake.fact.upsert(rows)
    assert as_rows(lake.fact.read()) == before and len(before) == 3


def test_a_status_that_vanishes_takes_its_gold_row_along(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    first = flight(actual="2025-03-10T08:20Z", status="Landed")
    land(folder, flight_page([first]), "20250310100000")
    runs.daily(lake, folder)
    assert lake.flight_performance.read().first().aircraft_code == "74H"
    swapped = flight(
        actual="2025-03-10T08:20Z", status="Landed", Equipment__AircraftCode="32N"
    )
    land(folder, flight_page([swapped]), "20250310110000")
    runs.daily(lake, folder)
    assert [r.aircraft_code for r in lake.flight_performance.read().collect()] == ["32N"]
    undone = flight(status="Delayed", Equipment__AircraftCode="32N")
    land(folder, flight_page([undone]), "20250310120000")
    runs.daily(lake, folder)
    assert lake.flight_performance.read().count() == 0
    assert lake.airport_hourly.read().count() == 0


def land_reference(folder, fetched, airports, cities, countries):
    pages = {
        "airports": reference_page("AirportResource", "Airports", "Airport", airports),
        "cities": reference_page("CityResource", "Cities", "City", cities),
        "countries": reference_page("CountryResource", "Countries", "Country", countries),
        "airlines": reference_page(
            "AirlineResource", "Airlines", "Airline", named("AirlineID", "X1", "Airline one")
        ),
        "aircraft": reference_page(
            "AircraftResource",
            "AircraftSummaries",
            "AircraftSummary",
            [named("AircraftCode", "74H", "Jumbo"), named("AircraftCode", None, "nameless")],
        ),
    }
    for endpoint, page in pages.items():
        land(f"{folder}/{endpoint}", page, fetched, f"ref_{endpoint}", 0, 100)


def airport(code, name, city, country):
    place = {"Coordinate": {"Latitude": "50.03", "Longitude": 8.57}}
    return named(
        "AirportCode", code, name, CityCode=city, CountryCode=country, Position=place, UtcOffset="+1"
    )


def test_monthly_run(spark, lake, tmp_path):
    folder = str(tmp_path / "reference")
    land_reference(
        folder,
        "20250301020000",
        [airport("FRA", "Main", "FRA", "DE"), airport("XXX", "Lost", "NOC", "ZZ")],
        [named("CityCode", "FRA", "Frankfurt")],
        [named("CountryCode", "DE", "Germany")],
    )
    runs.monthly(lake, folder)
    table = {row.airport_code: row for row in lake.dim_airports.read().collect()}
    assert (table["FRA"].city_name, table["FRA"].country_name) == ("Frankfurt", "Germany")
    assert (table["FRA"].latitude, table["FRA"].longitude) == (50.03, 8.57)
    assert (table["XXX"].city_name, table["XXX"].country_name) == (None, None)
    assert [r.aircraft_code for r in lake.reference("aircraft").read().collect()] == ["74H"]

    # A renamed airport and a late city name, next month.
    names = {"Name": [{"$": "Main Airport"}, {"$": "Flughafen"}]}
    renamed = airport("FRA", "", "FRA", "DE") | {"Names": names}
    land_reference(
        folder,
        "20250401020000",
        renamed,
        [named("CityCode", "NOC", "Nowhere")],
        [named("CountryCode", "DE", "Germany")],
    )
    runs.monthly(lake, folder)
    table = {row.airport_code: row for row in lake.dim_airports.read().collect()}
    assert len(table) == 2
    assert table["FRA"].airport_name == "Main Airport"
    assert table["XXX"].city_name == "Nowhere"


def test_stream_joined_with_static_lookups(spark, tmp_path):
    from tarmac.operators.dimensions import join_airports

    source = str(tmp_path / "airports")
    schema = (
        "airport_code string, airport_name string, city_code string, country_code string,"
        " latitude double, longitude double, time_zone_offset string"
    )
    spark.createDataFrame(
        [("FRA", "Main", "FRA", "DE", 1.0, 2.0, "+1"), ("XXX", "Lost", None, "DE", 1.0, 2.0, "+1")],
        schema,
    ).write.parquet(source)
    cities = spark.createDataFrame([("FRA", "Frankfurt")], "city_code string, city_name string")
    countries = spark.createDataFrame([("DE", "Germany")], "country_code string, country_name string")
    stream = join_airports(flows.read_table(spark, source, schema), cities, countries)
    out = str(tmp_path / "out")
    flows.append_table(stream, out, str(tmp_path / "chk"), "joined").awaitTermination()
    rows = {r.airport_code: (r.city_name, r.country_name) for r in spark.read.parquet(out).collect()}
    assert rows == {"FRA": ("Frankfurt", "Germany"), "XXX": (None, "Germany")}


@pytest.mark.parametrize("bounded", [False, True])
def test_stream_deduplication(spark, tmp_path, bounded):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, status string, at timestamp_ntz"
    for batch, status in enumerate(["Scheduled", "Landed"]):
        rows = [("400", status, dt.datetime(2025, 3, 10, 8, batch))]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = flows.read_table(spark, source, schema)
        unique = (
            flows.first_seen_within(stream, ["id"], "at", "1 hour")
            if bounded
            else flows.first_seen(stream, ["id"])
        )
        flows.append_table(unique, out, str(tmp_path / "chk"), "unique").awaitTermination()
    assert [r.status for r in spark.read.parquet(out).collect()] == ["Scheduled"]


FACT_ROW = "airline_id string, flight_number string, scheduled_departure_utc timestamp_ntz"


def fact_rows(spark, *days, number="1"):
    return spark.createDataFrame([("X1", number, dt.datetime(2025, 3, day, 8)) for day in days], FACT_ROW)


def test_only_touched_parts_are_rewritten(spark, lake):
    fact = lake.fact
    assert not fact.exists()
    assert sorted(fact.upsert(fact_rows(spark, 1, 2))) == ["2025-03-01", "2025-03-02"]
    assert fact.exists()
    before = {day: fact.read([day]).inputFiles() for day in fact.parts()}
    assert fact.upsert(fact_rows(spark, 2, number="2")) == ["2025-03-02"]
    after = {day: fact.read([day]).inputFiles() for day in fact.parts()}
    assert after["2025-03-01"] == before["2025-03-01"] and after["2025-03-02"] != before["2025-03-02"]
    assert fact.read(["2025-03-02"]).count() == 2 and fact.read().count() == 3
    assert fact.upsert(fact_rows(spark)) == []


def test_only_wanted_parts_are_read(spark, lake):
    lake.fact.upsert(fact_rows(spark, 1, 2, 3))
    assert len(lake.fact.read(["2025-03-02"]).inputFiles()) < len(lake.fact.read().inputFiles())


def test_merge_that_dies_while_partitions_are_exchanged_is_finished(spark, lake, monkeypatch):
    fact = lake.fact
    fact.upsert(fact_rows(spark, 1, 2))

    def die_half_way(self, rows, counts=()):
        # What an exchange that was cut off leaves: a day that is gone.
        fact._no_rows().createOrReplaceTempView("tarmac_no_rows")
        spark.sql(f"insert overwrite table {fact.name} partition (part = '2025-03-01') select * from tarmac_no_rows")
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(type(fact), "_overwrite", die_half_way)
        with pytest.raises(RuntimeError, match="lost the driver"):
            fact.upsert(fact_rows(spark, 1, 2, number="2"))
    assert fact.read(["2025-03-01"]).count() == 0
    fact.upsert(fact_rows(spark, 3))
    assert as_rows(fact.read().groupBy("flight_number").count()) == [("1", 3), ("2", 2)]


def test_table_is_found_again_by_a_catalog_that_forgot_it(spark, lake):
    lake.fact.upsert(fact_rows(spark, 1, 2))
    spark.sql(f"drop table {lake.fact.name}")
    assert lake.fact.read(["2025-03-01"]).count() == 1 and lake.fact.read().count() == 2


def test_tables_have_names(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "airline_test")
    land(str(tmp_path / "landing"), flight_page([flight(actual="2025-03-10T08:20Z")]), "20250310100000")
    runs.daily(lake, str(tmp_path / "landing"))
    for name, rows in (("bronze_flight_status", 1), ("parsed_flights", 1), ("fact_flights", 1)):
        assert spark.read.table(f"airline_test.{name}").count() == rows
    assert spark.sql("select total_flights from airline_test.gold_airport_hourly_operations").first()[0] == 1
    stream = spark.readStream.table("airline_test.bronze_flight_status")
    assert stream.isStreaming and "page_text" in stream.columns


def test_dynamic_overwrite_leaves_the_session_alone(spark, lake):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    lake.fact.upsert(fact_rows(spark, 1))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_part_without_rows_becomes_empty(spark, lake):
    fact = lake.fact
    fact.upsert(fact_rows(spark, 1, 2))
    fact.replace(spark.createDataFrame([], FACT_STORED), ["2025-03-01"])
    assert fact.read().count() == 1 and fact.read(["2025-03-01"]).count() == 0


def test_audits_over_bronze(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    numbers = [str(n) for n in range(120)]

    def page(start, stop):
        return flight_page([flight(n) for n in numbers[start:stop]], total=120)

    # The first page comes twice under different offsets, the last one only in part.
    land(folder, page(0, 50), "20250310040000", offset=0, limit=50)
    land(folder, page(0, 50), "20250310040001", offset=50, limit=50)
    land(folder, page(100, 112), "20250310040002", offset=100, limit=12)
    land(folder, page(0, 50), "20250310040003", "X_Y_arrivals_2025-03-10T0800")
    land(folder, {"message": "busy"}, "20250310040004", "FRA_departures_2025-03-10T0800")
    runs.ingest_flights(lake, folder)

    gaps = sorted(tuple(r)[1:] for r in audit.missing_flight_pages(lake).collect())
    slot, other = dt.datetime(2025, 3, 10, 4), dt.datetime(2025, 3, 10, 8)
    assert gaps == [
        ("FRA", "departures", slot, 100, 20, 12),
        ("X_Y", "arrivals", other, 50, 50, 0),
        ("X_Y", "arrivals", other, 100, 20, 0),
    ]
    later = audit.missing_flight_pages(lake, since=dt.datetime(2025, 3, 10, 4, 0, 3))
    assert {r.hub for r in later.collect()} == {"X_Y"}

    dupes = {r.hub: r for r in audit.flight_page_duplicates(lake).collect()}
    assert (dupes["FRA"].repeated_keys, dupes["FRA"].missing_records) == (50, 58)
    assert (dupes["X_Y"].repeated_keys, dupes["X_Y"].missing_records) == (0, 70)

    missing = audit.missing_slots(lake, dt.date(2025, 3, 10))
    assert missing.count() == 83
    assert missing.filter("day = '2025-03-10' and slot = '04:00'").count() == 1


def test_reference_audit(spark, lake, tmp_path):
    folder = str(tmp_path / "reference")
    page = reference_page("CityResource", "Cities", "City", [named("CityCode", "A", "B")])
    page["CityResource"]["Meta"]["TotalCount"] = 250
    for endpoint in REFERENCE_RESOURCES:
        land(f"{folder}/{endpoint}", page, "20250301020000", f"ref_{endpoint}", 100, 100)
    runs.ingest_reference(lake, folder)
    gaps = sorted(tuple(r)[1:] for r in audit.missing_reference_pages(lake, "cities").collect())
    assert gaps == [("cities", 0, 100, 0), ("cities", 200, 50, 0)]


def test_run_that_dies_between_fact_and_gold_is_made_good(spark, lake, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    done = flight(actual="2025-03-10T08:20Z", status="Landed")
    land(folder, flight_page([done, flight("2", actual="2025-03-10T08:01Z")]), "20250310100000")

    def die(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(gold, "refresh_days", die)
        with pytest.raises(StreamingQueryException):
            runs.daily(lake, folder)
    assert lake.fact.read().count() == 2 and not lake.airport_hourly.exists()

    runs.daily(lake, folder)
    assert lake.fact.read().count() == 2
    full = gold.airport_hourly(lake.fact.read()).drop("gold_processed_at")
    assert as_rows(full) == gold_without_stamp(lake.airport_hourly)
    assert lake.airport_hourly.read().first().total_flights == 2


def test_rebuild_for_another_hub(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    arrived = {"Arrival__ActualTimeUTC": {"DateTime": "2025-03-10T16:40Z"}}
    land(folder, flight_page(flight(actual="2025-03-10T08:00Z", **arrived)), "20250310200000")
    runs.daily(lake, folder)
    assert lake.airport_hourly.read().first().direction == "Departure"
    gold.rebuild(lake, Hub("JFK", "America/New_York"))
    row = lake.airport_hourly.read().first()
    assert (row.direction, row.scheduled_hour, row.total_delay_minutes) == ("Arrival", 12, 10)


def test_replacing_parts_takes_only_their_rows(spark, lake):
    names = [field.split()[0] for field in DAY_MEASURES.split(", ")]
    row = spark.range(1).select(F.lit(dt.date(2025, 3, 1)).alias("flight_day"))
    row = row.select("*", *(F.lit(None).alias(name) for name in names if name != "flight_day"))
    with pytest.raises(Exception, match="outside the replaced parts: 2025-03-01"):
        lake.day_measures.replace(row, ["2025-03-02"])
    assert lake.day_measures.parts() == []


@pytest.mark.parametrize("place", ["first_mark", "measures", "second_mark", "report", "last_mark"])
def test_flight_that_moves_while_the_driver_dies_leaves_no_old_date(spark, lake, tmp_path, monkeypatch, place):
    """A flight moves from hub date 10 to 11 and the batch dies anywhere between fact and report, and is repeated."""
    folder = str(tmp_path / "landing")
    keys = {"scheduled": "2025-03-10T22:30Z", "Departure__AirportCode": "JFK", "Arrival__AirportCode": "FRA"}

    def arrival(day, status):
        clock = {"Arrival__ScheduledTimeUTC": {"DateTime": f"2025-03-{day}T11:00Z"}, "Arrival__ActualTimeUTC": {"DateTime": f"2025-03-{day}T11:05Z"}}
        return flight(actual="2025-03-10T22:30Z", status=status, **keys, **clock)

    land(folder, flight_page([arrival(10, "Landed")]), "20250310230000")
    runs.daily(lake, folder)
    dates = lambda: sorted(str(r.scheduled_date) for r in lake.airport_hourly.read().collect())
    assert dates() == ["2025-03-10"]

    def die(*_, **__):
        raise RuntimeError("lost the driver")

    land(folder, flight_page([arrival(11, "Landed")]), "20250311230000")
    with monkeypatch.context() as broken:
        if place == "report":
            broken.setattr(gold.metrics, "hourly_report", die)
        elif place == "measures":
            broken.setattr(gold, "day_measures", die)
        else:
            calls, upsert = [], type(lake.day_dates).upsert

            def mark(table, *arguments):
                if table.name.endswith("day_dates"):
                    calls.append(1)
                    if len(calls) == 1 + ["first_mark", "second_mark", "last_mark"].index(place):
                        die()
                return upsert(table, *arguments)

            broken.setattr(type(lake.day_dates), "upsert", mark)
        with pytest.raises(StreamingQueryException):
            runs.daily(lake, folder)
    assert lake.fact.read().first().scheduled_arrival_utc.day == 11
    runs.daily(lake, folder)
    assert dates() == ["2025-03-11"]
    assert gold.pending_dates(lake) == []
    full = gold.airport_hourly(lake.fact.read()).drop("gold_processed_at")
    assert as_rows(full) == gold_without_stamp(lake.airport_hourly)


def test_measures_of_other_days_are_not_read_for_a_date(spark, lake, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    days = [flight(scheduled=f"2025-03-{d}T08:00Z", actual=f"2025-03-{d}T08:05Z", status="Landed") for d in range(10, 20)]
    land(folder, flight_page(days), "20250320120000")
    runs.daily(lake, folder)
    read, asked = type(lake.day_measures).read, []

    def noted(table, parts=None):
        if table.name.endswith("day_measures"):
            asked.append(parts)
        return read(table, parts)

    monkeypatch.setattr(type(lake.day_measures), "read", noted)
    gold.publish_hourly(lake, ["2025-03-12"])
    assert asked == [["2025-03-12"]]


def test_counts_of_parsed_rows_are_kept_and_compared(spark, lake, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight(), flight(None), flight("3")]), "20250310040000")
    runs.ingest_flights(lake, folder)
    query = flows.bronze_to_parsed(lake.bronze_flights, lake.parsed_flights, lake.checkpoint("parsed_flights"))
    query.awaitTermination()
    assert [(c.parsed, c.valid, c.quarantined) for c in flows.route_counts(query)] == [(3, 2, 1)]

    # A route of its own kind is neither valid nor in quarantine.
    monkeypatch.setattr(flows, "with_route", lambda rows, keys: rows.withColumn("route", F.lit("elsewhere")))
    land(folder, flight_page([flight("4")]), "20250310050000")
    runs.ingest_flights(lake, folder)
    with pytest.raises(flows.RoutesDiffer, match="parsed=1"):
        runs.parse_flights(lake)


def test_reference_pages_of_one_second_are_decided_by_name(spark, lake, tmp_path):
    folder = str(tmp_path / "reference")
    for offset, name in ((0, "Zulu"), (100, "Alpha")):
        page = reference_page("CityResource", "Cities", "City", [named("CityCode", "A", name)])
        land(f"{folder}/cities", page, "20250301020000", "ref_cities", offset, 100)
    for endpoint in REFERENCE_RESOURCES:
        land(f"{folder}/{endpoint}", {"message": "busy"}, "20250301010000", f"ref_{endpoint}", 0, 100)
    runs.ingest_reference(lake, folder)
    runs.refine_reference(lake, "cities")
    # By their values alone, Zulu would be the greater row.
    assert [r.city_name for r in lake.reference("cities").read().collect()] == ["Alpha"]


def test_flight_pages_of_one_small_file_are_made_by_several_tasks(spark, tmp_path):
    from checks import views

    events = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(i, dt.datetime(2024, 1, 1, 0, i % 60), i % 7, "click", 2.5, '{"k": 1}') for i in range(200)]
    spark.createDataFrame([*rows, (None,) * 6], events).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    out = tmp_path / "out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = views.single_pages(views.versions_of_flights(spark, str(tmp_path), 0))
        assert pages.count() == 201
        assert pages.select(F.spark_partition_id()).distinct().count() == 4
        stream = views.streamed_flight_pages(spark, str(tmp_path)).select("page_text")
        flows.append_table(stream, str(out), str(tmp_path / "chk"), "pages").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(out)).count() == 201
    assert len(list(out.glob("*.parquet"))) == 4


def test_flights_are_dealt_by_page_before_they_grow(spark, tmp_path):
    """The only exchange carries events, not items, and every page is whole."""
    from checks import views

    events = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(i, dt.datetime(2024, 1, 1, 0, i % 60), i % 7, "click", 2.5, '{"k": 1}') for i in range(125)]
    spark.createDataFrame([*rows, (None,) * 6], events).write.parquet(str(tmp_path / "events.parquet"))
    pages = views.flight_pages(spark, str(tmp_path))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning((event_id") == plan.count("Exchange ") == 1
    items = pages.select(F.regexp_extract("page_text", r'TotalCount":(\d+)', 1).cast("int").alias("n"))
    assert sorted(row.n for row in items.collect()) == [1, 25, 50, 50]
