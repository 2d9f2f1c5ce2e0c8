"""One query per operator, over the test tables."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from tarmac.functions.lineage import lineage_columns
from tarmac.functions.pages import items_at
from tarmac.functions.times import parse_utc_minute
from tarmac.operators import audits, dimensions, drift, flatten, keyed, metrics, quality
from tarmac.operators import features as feat
from tarmac.plans import gold, runs
from tarmac.plans.lake import Lake
from tarmac.schemas import FACT_COLUMNS, FLIGHT_ITEM, FLIGHT_ITEMS_PATH
from tarmac.settings import (
    FLIGHT_KEYS,
    FLIGHT_PAGE_LIMIT,
    LOOKBACK_DAYS,
    REFERENCE_PAGE_LIMIT,
    REFERENCE_RESOURCES,
)
from tarmac.sources import landing
from tarmac.sources.shared import shared_folder
from tarmac.sources.tables import KeyedTable
from tarmac.streaming import flows


def airport_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.airport_hourly(feat.business_features(views.flights(spark, sf_dir)))


def ripple_3h(spark, sf_dir):
    return airport_hourly(spark, sf_dir).select(
        "scheduled_date", "scheduled_hour", "direction", "total_delay_minutes", "past_3_hours_delay"
    )


def flight_performance(spark, sf_dir):
    return metrics.flight_performance(feat.business_features(views.flights(spark, sf_dir)))


def local_times(spark, sf_dir):
    return feat.localise(views.flights_with_id(spark, sf_dir)).select(
        "event_id", *feat.LOCAL_COLUMNS
    )


def direction(spark, sf_dir):
    return feat.with_direction(views.flights_with_id(spark, sf_dir)).select(
        "event_id", "dep_airport_code", "arr_airport_code", "direction"
    )


def delay_minutes(spark, sf_dir):
    rows = feat.with_delays(feat.with_direction(views.flights_with_id(spark, sf_dir)))
    return rows.select("event_id", "dep_delay_minutes", "arr_delay_minutes", "delay_minutes")


def status_category(spark, sf_dir):
    rows = feat.with_delays(feat.with_direction(views.flights_with_id(spark, sf_dir)))
    return feat.with_status(rows).select("event_id", "flight_status_desc", "status_category")


def valid_flights(spark, sf_dir):
    return feat.completed_flights(views.flights_with_id(spark, sf_dir)).select(
        "event_id", "flight_status_desc", "actual_departure_utc", "actual_arrival_utc"
    )


def business_features(spark, sf_dir):
    return feat.business_features(views.flights_with_id(spark, sf_dir)).select(
        "event_id",
        "direction",
        "reference_time",
        "scheduled_date",
        "scheduled_hour",
        "is_morning_wave",
        "is_weekend",
        "delay_minutes",
        "status_category",
    )


def json_flatten_events(spark, sf_dir):
    pages = landing.good_pages(landing.classify(views.flight_pages(spark, sf_dir)))
    return flatten.flight_items(pages)


def singleton_array(spark, sf_dir):
    pages = landing.classify(views.flight_pages(spark, sf_dir))
    items = items_at(F.col("page_text"), FLIGHT_ITEMS_PATH, FLIGHT_ITEM)
    return pages.select("page_id", "event_type", F.size(items).cast("bigint").alias("n_items"))


def classify_pages(spark, sf_dir):
    return landing.classify(views.responses(spark, sf_dir)).select(
        "event_id", "page_status", "error_type", "error_description", "total_count"
    )


def lineage_parse(spark, sf_dir):
    names = views.file_names(spark, sf_dir)
    lineage = lineage_columns(F.col("file_name"))
    return names.select("event_id", *(value.alias(name) for name, value in lineage.items()))


def parse_ts(spark, sf_dir):
    return views.clock_texts(spark, sf_dir).select(
        "event_id", "clock_text", parse_utc_minute(F.col("clock_text")).alias("parsed")
    )


def valid_split(spark, sf_dir):
    rows = quality.valid_rows(views.incomplete_flights(spark, sf_dir), FLIGHT_KEYS)
    return rows.select("event_id", *FLIGHT_KEYS)


def quarantine_split(spark, sf_dir):
    rows = quality.quarantined_rows(views.incomplete_flights(spark, sf_dir), FLIGHT_KEYS)
    return rows.select("event_id", *FLIGHT_KEYS)


def reference_rows(spark, sf_dir, endpoint):
    pages = landing.good_pages(landing.classify(views.reference_pages(spark, sf_dir, endpoint)))
    return flatten.reference_items(pages, endpoint)


def reference_family(spark, sf_dir):
    parts = [
        reference_rows(spark, sf_dir, endpoint).toDF(
            "code", "name", *(["c", "d", "e", "f", "g"] if endpoint == "airports" else [])
        ).select(F.lit(endpoint).alias("endpoint"), "code", "name")
        for endpoint in REFERENCE_RESOURCES
    ]
    return reduce(DataFrame.unionByName, parts)


def cast_dims(spark, sf_dir):
    return reference_rows(spark, sf_dir, "airports").select(
        "airport_code", "latitude", "longitude", "time_zone_offset"
    )


def _dimension(endpoint):
    def query(spark, sf_dir):
        return dimensions.coded_rows(reference_rows(spark, sf_dir, endpoint))

    return query


def dim_airports(spark, sf_dir):
    airports, cities, countries = (
        _dimension(endpoint)(spark, sf_dir) for endpoint in ("airports", "cities", "countries")
    )
    return dimensions.join_airports(airports, cities, countries)


LINE_KEYS = ["l_orderkey", "l_linenumber"]


def dedup_lineitem(spark, sf_dir):
    return keyed.latest_per_key(views.table(spark, sf_dir, "lineitem"), LINE_KEYS, ["l_shipdate"])


def _finished_and_open(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    finished = lines.filter("l_linestatus = 'F'")
    return keyed.latest_per_key(finished, LINE_KEYS, ["l_shipdate"]), lines.filter(
        "not l_linestatus <=> 'F'"
    )


def upsert_scd1(spark, sf_dir):
    return keyed.upsert(*_finished_and_open(spark, sf_dir), LINE_KEYS)


def upsert_keep_columns(spark, sf_dir):
    return keyed.upsert(*_finished_and_open(spark, sf_dir), LINE_KEYS, keep=["l_tax"]).select(
        *LINE_KEYS, "l_partkey", "l_shipdate", "l_tax"
    )


def cdc_latest(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").drop("props")
    order = ["ts", "event_id"]
    first = keyed.latest_per_key(events.filter("value >= 250"), ["user_id"], order)
    rest = events.filter("coalesce(value < 250, true)")
    return keyed.upsert(first, rest, ["user_id"], order)


def page_gaps(spark, sf_dir):
    return audits.page_gaps(views.landed_pages(spark, sf_dir), ["request_id"], FLIGHT_PAGE_LIMIT)


def coverage_gaps(spark, sf_dir):
    landed = views.landed_slots(spark, sf_dir)
    spans = landed.groupBy("hub").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
    return audits.coverage_gaps(landed, spans)


def page_dupes(spark, sf_dir):
    items = views.landed_items(spark, sf_dir)
    totals = audits.latest_totals(items, ["request_id"])
    return audits.page_duplicates(
        items, totals, ["request_id"], ["record_key"], REFERENCE_PAGE_LIMIT
    )


def keyed_table_upsert(spark, sf_dir):
    """The stored form of ``upsert_scd1``: initial load, then a merge, in 16 parts."""
    finished, still_open = _finished_and_open(spark, sf_dir)
    folder = shared_folder(spark)
    table = KeyedTable(
        spark,
        f"tarmac_checks.lines_{os.path.basename(folder)[-32:]}",
        f"{folder}/lines",
        ", ".join(f"{name} {kind}" for name, kind in finished.dtypes),
        LINE_KEYS,
        part=F.pmod(F.hash("l_orderkey"), F.lit(16)),
    )
    table.upsert(finished)
    table.upsert(still_open)
    return table.read()


def _parsed_lake(spark, sf_dir):
    """A new lake whose flattened flights come from a stream of pages, and that stream."""
    lake = Lake(spark, shared_folder(spark))
    pages = landing.good_pages(landing.classify(views.streamed_flight_pages(spark, sf_dir)))
    query = lake.parsed_flights.append(flows.parsed_rows(pages), lake.checkpoint("parsed_flights"), "parsed_flights")
    query.awaitTermination()
    return lake, flows.route_counts(query)


def _merged_lake(spark, sf_dir):
    lake, _ = _parsed_lake(spark, sf_dir)
    runs.merge_flights(lake)
    return lake


def stream_route_counts(spark, sf_dir):
    """Rows parsed, and where they went, as the stream itself observed."""
    _, counts = _parsed_lake(spark, sf_dir)
    return spark.createDataFrame(counts, "batch long, parsed long, valid long, quarantined long").agg(
        *(F.sum(name).alias(name) for name in ("parsed", "valid", "quarantined"))
    )


def stream_quarantine(spark, sf_dir):
    lake, _ = _parsed_lake(spark, sf_dir)
    return flows.quarantine(lake.parsed_flights.read()).select(*FACT_COLUMNS)


def stream_fact_flights(spark, sf_dir):
    """The fact, read by name, after three deliveries merged one after the other, of which many rows are stale."""
    folder = shared_folder(spark)
    lake, schema = Lake(spark, folder), "fetched_at timestamp_ntz, file_name string, page_text string"
    for part in range(3):
        pages = views.single_pages(views.versions_of_flights(spark, sf_dir, part))
        pages.write.mode("append").parquet(f"{folder}/pages")
        stream = landing.good_pages(landing.classify(flows.read_table(spark, f"{folder}/pages", schema)))
        lake.parsed_flights.append(
            flows.parsed_rows(stream), lake.checkpoint("parsed_flights"), "parsed_flights"
        ).awaitTermination()
        flows.parsed_to_fact(lake.parsed_flights, lake.fact.upsert, lake.checkpoint("fact_flights")).awaitTermination()
    return spark.read.table(lake.name("fact_flights")).select(*FACT_COLUMNS, "fetched_at")


def batch_by_name(spark, sf_dir):
    """Airports joined with their names, all three tables read by their names in the catalog."""
    lake = Lake(spark, shared_folder(spark))
    for endpoint in ("airports", "cities", "countries"):
        rows = _dimension(endpoint)(spark, sf_dir)
        lake.reference(endpoint).upsert(
            rows.withColumns({"fetched_at": F.lit(None), "file_name": F.lit(None), "silver_processed_at": F.lit(None)})
        )
    stamps = ("fetched_at", "file_name", "silver_processed_at")
    tables = {
        name: spark.read.table(lake.name(f"reference_{name}")).drop(*stamps)
        for name in ("airports", "cities", "countries")
    }
    return dimensions.join_airports(**tables)


def stream_by_name(spark, sf_dir):
    """Bronze read as a stream by its name in several micro-batches, flattened, and the outcome read by name."""
    folder, pages = shared_folder(spark), views.named_pages(spark, sf_dir)
    lake = Lake(spark, folder)
    for part in range(2):
        pages.filter(F.pmod(F.hash("file_name"), F.lit(2)) == part).write.mode("append").parquet(f"{folder}/pages")
        stream = flows.read_table(spark, f"{folder}/pages", "page_text string, file_name string")
        lake.bronze_flights.append(landing.bronze_pages(stream), lake.checkpoint("bronze"), "bronze").awaitTermination()
        per_batch = flows.files_per_batch(lake.bronze_flights.read(), 4, 3)
        flows.bronze_to_parsed(
            lake.bronze_flights, lake.parsed_flights, lake.checkpoint("parsed"), per_batch
        ).awaitTermination()
    return spark.read.table(lake.name("parsed_flights")).select(*FACT_COLUMNS, "fetched_at", "route")


def stream_gold_hourly(spark, sf_dir):
    lake = _merged_lake(spark, sf_dir)
    gold.publish(lake)
    return lake.airport_hourly.read().drop("gold_processed_at")


def stream_gold_performance(spark, sf_dir):
    lake = _merged_lake(spark, sf_dir)
    gold.publish(lake)
    return lake.flight_performance.read().drop("gold_processed_at")


def _stream_result(spark, stream, schema):
    folder = shared_folder(spark)
    flows.append_table(stream, f"{folder}/out", f"{folder}/chk", "result").awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out")


def stream_landing(spark, sf_dir):
    """Reference pages as one JSON file each, taken by the file stream into bronze, then as rows."""
    folder, pages = shared_folder(spark), views.reference_pages(spark, sf_dir, "aircraft")
    writer = pages.select("page_text").write.option("maxRecordsPerFile", 1)
    writer.text(f"{folder}/landing")
    bronze = Lake(spark, folder).bronze_reference("aircraft")
    per_batch = flows.files_per_batch(spark.read.text(f"{folder}/landing"), 64)
    flows.landing_to_bronze(
        spark, f"{folder}/landing", bronze, f"{folder}/chk", "landed", per_batch
    ).awaitTermination()
    stamped = bronze.read().filter(F.col("fetched_at").isNotNull() & F.col("bronze_ingested_at").isNotNull())
    rows = flatten.reference_items(landing.good_pages(stamped), "aircraft")
    return dimensions.coded_rows(rows)


def sql_views(spark, sf_dir):
    """Valid and quarantined flights per airline, by SQL over the lake's views."""
    lake = _merged_lake(spark, sf_dir)
    gold.publish(lake)
    lake.register_views()
    return spark.sql("""
        select airline_id, count_if(valid) as valid_flights,
          count_if(not valid) as quarantined_flights,
          count_if(stamp is null) as without_stamp
        from (
          select airline_id, true as valid, silver_processed_at as stamp from fact_flights
          union all
          select airline_id, false, quarantined_at from quarantine_flights)
        group by airline_id""")


def stream_dim_airports(spark, sf_dir):
    """Airports as a stream, joined with the stored names."""
    pages = landing.good_pages(landing.classify(views.streamed_airport_pages(spark, sf_dir)))
    airports = flatten.reference_items(pages, "airports")
    cities, countries = (
        _dimension(endpoint)(spark, sf_dir) for endpoint in ("cities", "countries")
    )
    joined = dimensions.join_airports(airports, cities, countries)
    return _stream_result(spark, joined, joined.schema)


def run_page_gaps(spark, sf_dir):
    """Missing pages per fetch run: a page that another run brought does not count."""
    pages = audits.with_fetch_run(views.fetched_pages(spark, sf_dir), ["hub"])
    return audits.page_gaps(pages, ["fetch_run", "hub", "flight_type", "slot_start"], FLIGHT_PAGE_LIMIT)


def run_coverage_gaps(spark, sf_dir):
    """Requests of the last seven days that a run should have made and of which it brought no page."""
    pages = audits.with_fetch_run(views.fetched_pages(spark, sf_dir), ["hub"])
    clock = F.date_format("slot_start", "HH:mm")
    landed = pages.select("fetch_run", "hub", F.to_date("slot_start").alias("day"), clock.alias("slot"), "flight_type")
    return audits.coverage_gaps(landed, audits.run_spans(landed, LOOKBACK_DAYS), by=["fetch_run", "hub"])


def schema_drift(spark, sf_dir):
    """Fields of flight items that the declared schema lacks or has as another kind."""
    return drift.schema_drift(views.drifted_items(spark, sf_dir), FLIGHT_ITEM)


def stream_first_seen_within(spark, sf_dir):
    """One row per user and type among events of an hour, in micro-batches, with state that expires; late rows are dropped."""
    folder = shared_folder(spark)
    keys = ["user_id", "event_type"]
    for part in views.timed_parts(spark, sf_dir):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = flows.read_table(spark, f"{folder}/in", "user_id long, event_type string, ts timestamp_ntz")
        unique = flows.first_seen_within(stream, keys, "ts", views.DEDUP_DELAY)
        flows.append_table(unique, f"{folder}/out", f"{folder}/chk", "result").awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{folder}/out")


def stream_first_seen(spark, sf_dir):
    """One row per user and event type from a stream that repeats them."""
    keys = ["user_id", "event_type"]
    unique = flows.first_seen(views.streamed(spark, sf_dir, "events"), keys).select(*keys)
    return _stream_result(spark, unique, unique.schema)


QUERIES = {
    "airport_hourly": airport_hourly,
    "ripple_3h": ripple_3h,
    "flight_performance": flight_performance,
    "local_times": local_times,
    "direction": direction,
    "delay_minutes": delay_minutes,
    "status_category": status_category,
    "valid_flights": valid_flights,
    "business_features": business_features,
    "json_flatten_events": json_flatten_events,
    "singleton_array": singleton_array,
    "classify_pages": classify_pages,
    "lineage_parse": lineage_parse,
    "parse_ts": parse_ts,
    "valid_split": valid_split,
    "quarantine_split": quarantine_split,
    "reference_family": reference_family,
    "cast_dims": cast_dims,
    "dim_airports": dim_airports,
    "dim_airlines": _dimension("airlines"),
    "dim_aircraft": _dimension("aircraft"),
    "dedup_lineitem": dedup_lineitem,
    "upsert_scd1": upsert_scd1,
    "upsert_keep_columns": upsert_keep_columns,
    "cdc_latest": cdc_latest,
    "page_gaps": page_gaps,
    "coverage_gaps": coverage_gaps,
    "page_dupes": page_dupes,
    "keyed_table_upsert": keyed_table_upsert,
    "stream_quarantine": stream_quarantine,
    "stream_fact_flights": stream_fact_flights,
    "stream_gold_hourly": stream_gold_hourly,
    "stream_gold_performance": stream_gold_performance,
    "stream_dim_airports": stream_dim_airports,
    "stream_landing": stream_landing,
    "sql_views": sql_views,
    "stream_first_seen": stream_first_seen,
    "stream_first_seen_within": stream_first_seen_within,
    "stream_route_counts": stream_route_counts,
    "batch_by_name": batch_by_name,
    "stream_by_name": stream_by_name,
    "run_page_gaps": run_page_gaps,
    "run_coverage_gaps": run_coverage_gaps,
    "schema_drift": schema_drift,
}
