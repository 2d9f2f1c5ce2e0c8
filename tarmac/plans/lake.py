"""Which tables one lake has, and under which names."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import (
    BRONZE_PAGES,
    DAY_DATES,
    DAY_MEASURES,
    HOURLY_REPORT,
    PARSED_FLIGHTS,
    PERFORMANCE_REPORT,
)
from tarmac.settings import HOURLY_KEYS, PERFORMANCE_KEYS
from tarmac.sources.tables import KeyedTable, StreamTable
from tarmac.streaming.flows import fact_table, quarantine

REFERENCE_TABLES = {
    "airports": "airport_code string, airport_name string, city_code string,"
    " country_code string, latitude double, longitude double, time_zone_offset string",
    "cities": "city_code string, city_name string",
    "countries": "country_code string, country_name string",
    "airlines": "airline_code string, airline_name string",
    "aircraft": "aircraft_code string, aircraft_name string",
}
STAMPS = ", fetched_at timestamp_ntz, file_name string, silver_processed_at timestamp"


@dataclass(frozen=True)
class Lake:
    """``root`` must be storage every executor can reach; ``database`` holds the tables' names."""

    spark: SparkSession
    root: str
    database: str = ""

    def path(self, *names: str) -> str:
        return "/".join([self.root.rstrip("/"), *names])

    def name(self, table: str) -> str:
        """A table's name in the catalog; without a database of its own, a lake has one named after its root."""
        database = self.database or f"tarmac_{zlib.crc32(self.root.rstrip('/').encode()):08x}"
        return f"{database}.{table}"

    def checkpoint(self, name: str) -> str:
        return self.path("checkpoints", name)

    def _bronze(self, table: str) -> StreamTable:
        path = self.path("bronze", table)
        return StreamTable(self.spark, self.name(f"bronze_{table}"), path, BRONZE_PAGES, ("fetch_day",))

    @property
    def bronze_flights(self) -> StreamTable:
        return self._bronze("flight_status")

    def bronze_reference(self, endpoint: str) -> StreamTable:
        return self._bronze(f"reference_{endpoint}")

    @property
    def parsed_flights(self) -> StreamTable:
        path = self.path("silver", "parsed_flights")
        return StreamTable(self.spark, self.name("parsed_flights"), path, PARSED_FLIGHTS, ("route",))

    def _keyed(self, layer: str, table: str, schema: str, keys: list[str], **options) -> KeyedTable:
        return KeyedTable(self.spark, self.name(table), self.path(layer, table), schema, keys, **options)

    @property
    def fact(self) -> KeyedTable:
        return fact_table(self.spark, self.name("fact_flights"), self.path("silver", "fact_flights"))

    def reference(self, endpoint: str) -> KeyedTable:
        """Latest fetch wins; the file name decides between pages of one second."""
        schema = REFERENCE_TABLES[endpoint] + STAMPS
        order = ["fetched_at", "file_name"]
        return self._keyed("silver", f"reference_{endpoint}", schema, [schema.split()[0]], sequence=order)

    @property
    def dim_airports(self) -> KeyedTable:
        schema = (
            REFERENCE_TABLES["airports"]
            + ", city_name string, country_name string, silver_processed_at timestamp"
        )
        return self._keyed("silver", "dim_airports", schema, ["airport_code"])

    @property
    def day_measures(self) -> KeyedTable:
        """What the reports need to keep of a fact day, for both of them."""
        keys = ["flight_day", *dict.fromkeys([*HOURLY_KEYS, *PERFORMANCE_KEYS])]
        return self._keyed("gold", "day_measures", DAY_MEASURES, keys, part=F.col("flight_day"))

    @property
    def day_dates(self) -> KeyedTable:
        """Which hub dates the flights of a fact day fall on or once did: a few rows a day."""
        return self._keyed("gold", "day_dates", DAY_DATES, ["flight_day", "hub_date"])

    @property
    def airport_hourly(self) -> KeyedTable:
        date = F.col("scheduled_date")
        return self._keyed("gold", "gold_airport_hourly_operations", HOURLY_REPORT, HOURLY_KEYS, part=date)

    @property
    def flight_performance(self) -> KeyedTable:
        return self._keyed("gold", "gold_flight_performance", PERFORMANCE_REPORT, PERFORMANCE_KEYS)

    def register_views(self) -> list[str]:
        """Temporary views of the current tables, for SQL without the database's name. Call again to see a later run."""
        tables = {
            "bronze_flight_status": self.bronze_flights,
            "fact_flights": self.fact,
            "dim_airports": self.dim_airports,
            "dim_airlines": self.reference("airlines"),
            "dim_aircraft": self.reference("aircraft"),
            "gold_airport_hourly_operations": self.airport_hourly,
            "gold_flight_performance": self.flight_performance,
        }
        for name, table in tables.items():
            table.read().createOrReplaceTempView(name)
        quarantine(self.parsed_flights.read()).createOrReplaceTempView("quarantine_flights")
        return [*tables, "quarantine_flights"]
