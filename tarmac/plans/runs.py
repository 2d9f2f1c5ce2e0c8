"""The two recurring runs: flights every day, reference data every month.

Each step waits for the one before and hands over through storage, so a step
can be run again on its own.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.dimensions import join_airports
from tarmac.operators.flatten import reference_items
from tarmac.operators.quality import valid_rows
from tarmac.plans import gold
from tarmac.plans.lake import Lake
from tarmac.settings import REFERENCE_RESOURCES, Hub
from tarmac.sources.landing import good_pages
from tarmac.streaming import flows


def ingest_flights(
    lake: Lake, landing: str, max_files: int | None = None, archive: str | None = None
) -> None:
    flows.landing_to_bronze(
        lake.spark,
        landing,
        lake.bronze_flights,
        lake.checkpoint("bronze_flight_status"),
        "bronze_flight_status",
        max_files,
        archive,
    ).awaitTermination()


def parse_flights(lake: Lake, max_files: int | None = None) -> None:
    """Flatten new pages. Fails if the rows parsed are not those valid and those in quarantine."""
    query = flows.bronze_to_parsed(
        lake.bronze_flights, lake.parsed_flights, lake.checkpoint("parsed_flights"), max_files
    )
    query.awaitTermination()
    flows.route_counts(query)


def merge_flights(lake: Lake, hub: Hub = Hub(), max_files: int | None = None) -> None:
    """Complete rows into the fact, then what follows from every day a batch changed.

    Measures and hourly report are written within the batch. A batch that is repeated after a failure writes
    them again, and with them every date whose report an earlier attempt left undone.
    """

    def merge(batch: DataFrame) -> None:
        changed_days = lake.fact.upsert(batch)
        if changed_days:
            gold.publish_hourly(lake, gold.refresh_days(lake, changed_days, hub))

    flows.parsed_to_fact(
        lake.parsed_flights, merge, lake.checkpoint("fact_flights"), max_files
    ).awaitTermination()


def daily(
    lake: Lake,
    landing: str,
    hub: Hub = Hub(),
    max_files: int | None = None,
    archive: str | None = None,
) -> None:
    ingest_flights(lake, landing, max_files, archive)
    parse_flights(lake, max_files)
    merge_flights(lake, hub, max_files)
    gold.publish_performance(lake)


def ingest_reference(lake: Lake, landing: str, max_files: int | None = None) -> None:
    """One bronze table per endpoint, from a landing folder per endpoint."""
    for endpoint in REFERENCE_RESOURCES:
        name = f"reference_{endpoint}"
        flows.landing_to_bronze(
            lake.spark,
            f"{landing.rstrip('/')}/{endpoint}",
            lake.bronze_reference(endpoint),
            lake.checkpoint(f"bronze_{name}"),
            f"bronze_{name}",
            max_files,
        ).awaitTermination()


def refine_reference(lake: Lake, endpoint: str, max_files: int | None = None) -> None:
    """Merge new pages of one endpoint into its silver table, latest fetch winning."""
    table = lake.reference(endpoint)
    pages = good_pages(lake.bronze_reference(endpoint).stream(max_files))
    rows = reference_items(pages, endpoint, ["fetched_at", "file_name"])

    def merge(batch: DataFrame) -> None:
        coded = valid_rows(batch, table.keys)
        table.upsert(coded.withColumn("silver_processed_at", F.current_timestamp()))

    flows.each_batch(
        rows, merge, lake.checkpoint(f"silver_{endpoint}"), f"silver_{endpoint}"
    ).awaitTermination()


def assemble_airports(lake: Lake) -> None:
    """Join the three tables anew, so a name that arrives late still reaches its airports."""
    tables = {
        name: lake.reference(name).read().drop("fetched_at", "file_name", "silver_processed_at")
        for name in ("airports", "cities", "countries")
    }
    joined = join_airports(**tables)
    lake.dim_airports.replace(joined.withColumn("silver_processed_at", F.current_timestamp()))


def monthly(lake: Lake, landing: str, max_files: int | None = None) -> None:
    ingest_reference(lake, landing, max_files)
    for endpoint in REFERENCE_RESOURCES:
        refine_reference(lake, endpoint, max_files)
    assemble_airports(lake)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the flight or the reference pipeline once.")
    parser.add_argument("run", choices=["daily", "monthly"])
    parser.add_argument("--landing", required=True, help="folder with the landed JSON pages")
    parser.add_argument("--lake", required=True, help="folder for the tables")
    parser.add_argument("--database", default="", help="database that holds the tables' names")
    parser.add_argument("--hub", default=Hub.airport)
    parser.add_argument("--timezone", default=Hub.timezone)
    parser.add_argument("--max-files", type=int, help="pages or files per micro-batch")
    parser.add_argument("--archive", help="folder to which landed flight pages move once taken")
    options = parser.parse_args(argv)
    lake = Lake(SparkSession.builder.getOrCreate(), options.lake, options.database)
    if options.run == "daily":
        hub = Hub(options.hub, options.timezone)
        daily(lake, options.landing, hub, options.max_files, options.archive)
    else:
        monthly(lake, options.landing, options.max_files)


if __name__ == "__main__":
    main()
