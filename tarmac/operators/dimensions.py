"""Reference rows to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.operators.keyed import latest_per_key
from tarmac.operators.quality import valid_rows

AIRPORT_COLUMNS = [
    "airport_code",
    "airport_name",
    "city_code",
    "country_code",
    "latitude",
    "longitude",
    "time_zone_offset",
    "city_name",
    "country_name",
]


def coded_rows(rows: DataFrame, sequence: list[str] = ()) -> DataFrame:
    """One row per code, rows without a code dropped. The code is the first column."""
    code = rows.columns[0]
    return latest_per_key(valid_rows(rows, [code]), [code], sequence)


def join_airports(airports: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Airports with city and country names; an unknown code leaves the name null.

    ``airports`` may be a stream. There is no broadcast hint: Spark broadcasts
    a lookup whose measured size is under the session's threshold, and sorts
    and merges, splitting skewed partitions, when it is not. Lookup codes are
    unique, so no airport row is multiplied.
    """
    named = airports.join(cities, "city_code", "left").join(countries, "country_code", "left")
    others = [name for name in airports.columns if name not in AIRPORT_COLUMNS]
    return named.select(*AIRPORT_COLUMNS, *others)
