"""Late files, unclear fetch times, odd pages, audits per run, and reports written by date."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pages import flight, flight_page, land, named, reference_page
from pyspark.sql import functions as F

from tarmac.functions.pages import english_name
from tarmac.functions.times import as_utc
from tarmac.operators import audits
from tarmac.plans import audit, gold, runs
from tarmac.plans.lake import Lake
from tarmac.settings import REFERENCE_RESOURCES
from tarmac.sources import landing
from tarmac.streaming import flows


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def age(path, days):
    then = time.time() - days * 86400
    os.utime(path, (then, then))


def test_old_files_are_taken_in_both_layers(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight()]), "20250310040000")
    runs.ingest_flights(lake, folder)
    age(land(folder, flight_page([flight("401")]), "20250310050000"), 30)
    runs.ingest_flights(lake, folder)
    assert lake.bronze_flights.read().count() == 2

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in range(2):
        before = set(os.listdir(source)) if batch else set()
        spark.createDataFrame([(batch,)], "n int").coalesce(1).write.mode("append").parquet(source)
        if batch:
            for name in set(os.listdir(source)) - before:
                age(f"{source}/{name}", 30)
        stream = flows.read_table(spark, source, "n int")
        flows.append_table(stream, out, str(tmp_path / "chk"), "old").awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_taken_files_move_to_the_archive(spark, lake, tmp_path):
    folder, archive = str(tmp_path / "landing"), str(tmp_path / "archive")
    land(folder, flight_page([flight()]), "20250310040000")
    for fetched in ("20250310050000", "20250310060000"):
        runs.ingest_flights(lake, folder, archive=archive)
        land(folder, flight_page([flight()]), fetched)
    runs.ingest_flights(lake, folder, archive=archive)
    assert lake.bronze_flights.read().count() == 3


def test_update_without_a_fetch_time_counts_from_its_landing(spark, lake, tmp_path, any_zone):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight()]), "20250310040000")
    runs.daily(lake, folder)
    path = land(folder, flight_page([flight(status="Landed")]), "20250310050000")
    os.rename(path, os.path.join(folder, "unnamed.json"))
    runs.daily(lake, folder)
    row = lake.fact.read().first()
    assert (row.flight_status_desc, row.file_name) == ("Landed", "unnamed.json")
    assert abs(row.fetched_at - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(hours=0.9)


def test_file_name_decides_between_pages_of_one_second(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight(status="Zulu", Departure__AirportCode="ZZZ")]), "20250310040000", offset=0)
    land(folder, flight_page([flight(status="Alpha", Departure__AirportCode="AAA")]), "20250310040000", offset=50)
    runs.daily(lake, folder)
    assert [r.flight_status_desc for r in lake.fact.read().collect()] == ["Alpha"]


def test_utc_clock_keeps_fractions(spark, any_zone):
    frame = spark.range(1).select(as_utc(F.timestamp_micros(F.lit(1741600800123456))).alias("t"))
    assert frame.first().t == dt.datetime(2025, 3, 10, 10, 0, 0, 123456)


@pytest.mark.parametrize(
    "text, name",
    [
        ('[{"@LanguageCode":"DE","$":"Muenchen"},{"@LanguageCode":"EN","$":"Munich"}]', "Munich"),
        ('[{"@LanguageCode":"DE","$":"Muenchen"},{"@LanguageCode":"FR","$":"Munich"}]', "Muenchen"),
        ('{"@LanguageCode":"DE","$":"Muenchen"}', "Muenchen"),
        ('[{"$":"x"}]', "x"),
        ("[]", None),
        (None, None),
    ],
)
def test_english_name_wherever_it_stands(spark, text, name):
    assert spark.createDataFrame([(text,)], "t string").select(english_name(F.col("t"))).first()[0] == name


def test_page_with_trailing_text_is_malformed(spark):
    texts = ['{"Meta":{}}', ' {"Meta":{}}\n', '{"Meta":{}} <html>cut</html>', '{"Meta":{}}{}', '{"a":1']
    pages = spark.createDataFrame([(t,) for t in texts], "page_text string")
    found = {r.page_text: r.page_status for r in landing.classify(pages).collect()}
    assert [found[t] for t in texts] == ["ok", "ok", "malformed", "malformed", "malformed"]


def test_quarantined_rows_say_what_is_missing(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight(None), flight()]), "20250310040000")
    runs.daily(lake, folder)
    assert "quarantine_flights" in lake.register_views()
    row = spark.sql("select quarantine_reason, quarantined_at from quarantine_flights").first()
    assert row.quarantine_reason == "no flight_number" and row.quarantined_at is not None


def test_hole_of_one_run_is_not_filled_by_another(spark, lake, tmp_path):
    folder = str(tmp_path / "reference")
    page = reference_page("CityResource", "Cities", "City", [named("CityCode", "A", "B")])
    page["CityResource"]["Meta"]["TotalCount"] = 150
    for endpoint in REFERENCE_RESOURCES:
        land(f"{folder}/{endpoint}", page, "20250301010000", f"ref_{endpoint}", 0, 100)
        land(f"{folder}/{endpoint}", page, "20250301010001", f"ref_{endpoint}", 100, 100)
        land(f"{folder}/{endpoint}", page, "20250401010000", f"ref_{endpoint}", 0, 100)
    runs.ingest_reference(lake, folder)
    gaps = [tuple(r) for r in audit.missing_reference_pages(lake, "cities").collect()]
    assert gaps == [(dt.datetime(2025, 4, 1, 1), "cities", 100, 50, 0)]


def test_moved_flight_is_no_repeat_and_odd_limits_are_findings(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    for fetched, offset in (("20250310230000", 0), ("20250311001000", 50), ("20250311220000", 50)):
        land(folder, flight_page([flight()], total=60), fetched, offset=offset)
    land(folder, flight_page([flight("9")], total=60), "20250311220001", limit=1000000000000)
    runs.ingest_flights(lake, folder)
    dupes = {r.fetch_run: r.repeated_keys for r in audit.flight_page_duplicates(lake).collect()}
    # The first run goes on past midnight and does repeat the flight; the next one only moved it.
    assert dupes == {dt.datetime(2025, 3, 10, 23): 1, dt.datetime(2025, 3, 11, 22): 0}
    assert audit.missing_flight_pages(lake).count() == 1
    assert [r.page_limit for r in audit.odd_flight_limits(lake).collect()] == [1000000000000]


def test_slot_audit_reads_only_its_days(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, flight_page([flight()]), "20250310040000")
    runs.ingest_flights(lake, folder)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = audit.missing_slots(lake, dt.date(2025, 3, 10))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(slot_start" in plan and "LessThan(slot_start" in plan


def test_report_is_written_for_changed_dates_only(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    first = [flight(scheduled=f"2025-03-{d}T08:00Z", actual=f"2025-03-{d}T08:05Z", status="Landed") for d in (10, 11, 12)]
    land(folder, flight_page(first), "20250312120000")
    runs.daily(lake, folder)
    stamps = lambda: {str(r.scheduled_date): r.gold_processed_at for r in lake.airport_hourly.read().collect()}
    before = stamps()
    assert sorted(before) == ["2025-03-10", "2025-03-11", "2025-03-12"]
    changed = flight(scheduled="2025-03-11T08:00Z", actual="2025-03-11T09:00Z", status="Landed")
    land(folder, flight_page([changed]), "20250313120000")
    runs.daily(lake, folder)
    after = stamps()
    assert [d for d in after if after[d] != before[d]] == ["2025-03-11"]
    rows = sorted(tuple(r) for r in lake.airport_hourly.read().drop("gold_processed_at").collect())
    full = gold.airport_hourly(lake.fact.read()).drop("gold_processed_at")
    assert rows == sorted(tuple(r) for r in full.collect())


def test_pieces_above_the_limit_do_not_cover(spark):
    pages = spark.createDataFrame([("g", 0, 10**12), ("g", 0, 50)], "g string, page_offset long, page_limit long")
    assert [tuple(r) for r in audits.page_coverage(pages, ["g"], 50).collect()] == [("g", 0, 50)]
    assert audits.odd_limits(pages, ["g"], 50).count() == 1


def test_runs_are_told_apart_by_the_pause_between_fetches(spark, lake, tmp_path):
    """A run over noon is one run; two runs of one evening are two, each with its own holes."""
    folder = str(tmp_path / "landing")

    def page(fetched, offset, total):
        land(folder, flight_page([flight(str(offset))], total=total), fetched, offset=offset)

    page("20250310115900", 0, 100)
    page("20250310120100", 50, 100)
    page("20250310200000", 0, 100)
    page("20250310200100", 50, 100)
    page("20250310223000", 0, 100)
    runs.ingest_flights(lake, folder)
    gaps = [(r.fetch_run, r.page_offset) for r in audit.missing_flight_pages(lake).collect()]
    assert gaps == [(dt.datetime(2025, 3, 10, 22, 30), 50)]


def test_runs_are_chains_per_hub_and_do_not_depend_on_slices(spark):
    start = dt.datetime(2025, 3, 10)
    minutes = {"A": [0, 89, 178, 269, 400], "B": [0, 91, 92], None: [5]}
    rows = [(hub, start + dt.timedelta(minutes=m)) for hub, ms in minutes.items() for m in ms for _ in range(2)]
    found = audits.with_fetch_run(spark.createDataFrame(rows, "hub string, fetched_at timestamp_ntz"), ["hub"])
    minute = lambda t: (t - start).seconds // 60
    got = {(r.hub, minute(r.fetched_at), minute(r.fetch_run)) for r in found.collect()}
    assert found.count() == len(rows)
    assert got == {
        ("A", 0, 0), ("A", 89, 0), ("A", 178, 0), ("A", 269, 269), ("A", 400, 400),
        ("B", 0, 0), ("B", 91, 91), ("B", 92, 91), (None, 5, 5),
    }


def test_audits_of_late_runs_see_whole_runs(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    for fetched, offset in (("20250310233000", 0), ("20250311003000", 50), ("20250312120000", 50)):
        land(folder, flight_page([flight()], total=100), fetched, offset=offset)
    runs.ingest_flights(lake, folder)
    # The first run began before midnight and is complete; only the second one is asked for and lacks a page.
    gaps = audit.missing_flight_pages(lake, since=dt.datetime(2025, 3, 11)).collect()
    assert [(r.fetch_run, r.page_offset) for r in gaps] == [(dt.datetime(2025, 3, 12, 12), 0)]


def test_page_of_another_run_does_not_fill_a_runs_hole(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    slots = [f"2025-03-{d:02d}T{h}00" for d in range(4, 11) for h in ("00", "04", "08", "12", "16", "20")]
    for n, prefix in enumerate(f"FRA_{kind}_{slot}" for slot in slots for kind in ("arrivals", "departures")):
        for fetched in ("20250310200000", "20250310230000"):
            if (fetched, n) not in (("20250310200000", 5), ("20250310230000", 7)):
                land(folder, flight_page([flight()]), fetched, prefix)
    runs.ingest_flights(lake, folder)
    assert audit.missing_slots(lake, dt.date(2025, 3, 10)).count() == 0
    holes = {r.fetch_run.hour: (str(r.day), r.slot, r.flight_type) for r in audit.missing_slots_by_run(lake).collect()}
    assert holes == {20: ("2025-03-04", "08:00", "departures"), 23: ("2025-03-04", "12:00", "departures")}


def test_audits_read_only_the_days_asked_for(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    for day in range(1, 9):
        land(folder, flight_page([flight()], total=100), f"2025030{day}120000")
    runs.ingest_flights(lake, folder)
    since = dt.datetime(2025, 3, 7)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    for frame in (
        audit.missing_flight_pages(lake, since),
        audit.missing_slots_by_run(lake, since),
        audit.flight_page_duplicates(lake, since),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(fetch_day" in plan and "fetch_day" in plan.split("PartitionFilters")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert {r.fetch_run.day for r in audit.missing_flight_pages(lake, since).collect()} == {7, 8}


def test_micro_batches_do_not_grow_in_number_with_the_backlog(spark, lake, tmp_path):
    folder, text = str(tmp_path / "landing"), F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit("}"))
    pages = spark.range(40, numPartitions=1).select(text).write
    pages.option("maxRecordsPerFile", 1).text(folder)
    per_batch = flows.files_per_batch(spark.read.text(folder), 2)
    assert per_batch == 5
    query = flows.landing_to_bronze(spark, folder, lake.bronze_flights, str(tmp_path / "chk"), "landed", per_batch)
    query.awaitTermination()
    assert sum(progress.numInputRows > 0 for progress in query.recentProgress) == flows.MOST_BATCHES
    assert lake.bronze_flights.read().select("page_text").distinct().count() == 40
    assert flows.files_per_batch(spark.read.text(folder), 4, 3) == 14
    # A small backlog is taken as before.
    assert flows.files_per_batch(spark.read.text(folder), 6) == 6
