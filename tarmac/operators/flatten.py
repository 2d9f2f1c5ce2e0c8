"""Pages to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.pages import english_name, items_at
from tarmac.functions.times import parse_utc_minute
from tarmac.schemas import FACT_COLUMNS, FLIGHT_ITEM, FLIGHT_ITEMS_PATH, REFERENCE_ITEMS


def explode_items(
    pages: DataFrame, path: str, item_type: str, carry: list[str] = ()
) -> DataFrame:
    """One row per item, as struct ``item``; a page without items gives one null item."""
    items = items_at(F.col("page_text"), path, item_type)
    return pages.select(*carry, F.explode_outer(items).alias("item"))


def _utc(path: str) -> Column:
    return parse_utc_minute(F.col(f"item.{path}.DateTime"))


def flight_items(pages: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Flight pages as fact rows (operating carrier only), plus the page columns in ``carry``."""
    columns = {
        "airline_id": F.col("item.OperatingCarrier.AirlineID"),
        "flight_number": F.col("item.OperatingCarrier.FlightNumber"),
        "scheduled_departure_utc": _utc("Departure.ScheduledTimeUTC"),
        "actual_departure_utc": _utc("Departure.ActualTimeUTC"),
        "scheduled_arrival_utc": _utc("Arrival.ScheduledTimeUTC"),
        "actual_arrival_utc": _utc("Arrival.ActualTimeUTC"),
        "aircraft_code": F.col("item.Equipment.AircraftCode"),
        "aircraft_registration": F.col("item.Equipment.AircraftRegistration"),
        "flight_status_code": F.col("item.FlightStatus.Code"),
        "flight_status_desc": F.col("item.FlightStatus.Definition"),
    }
    for prefix, leg in (("dep", "Departure"), ("arr", "Arrival")):
        columns |= {
            f"{prefix}_airport_code": F.col(f"item.{leg}.AirportCode"),
            f"{prefix}_terminal": F.col(f"item.{leg}.Terminal.Name"),
            f"{prefix}_gate": F.col(f"item.{leg}.Terminal.Gate"),
            f"{prefix}_time_status_code": F.col(f"item.{leg}.TimeStatus.Code"),
            f"{prefix}_time_status_desc": F.col(f"item.{leg}.TimeStatus.Definition"),
        }
    exploded = explode_items(pages, FLIGHT_ITEMS_PATH, FLIGHT_ITEM, carry)
    return exploded.select(*(columns[name].alias(name) for name in FACT_COLUMNS), *carry)


def _name() -> Column:
    return english_name(F.col("item.Names.Name"))


def _coordinate(axis: str) -> Column:
    return F.col(f"item.Position.Coordinate.{axis}").try_cast("double")


def _reference_columns(endpoint: str) -> dict[str, Column]:
    if endpoint == "airports":
        return {
            "airport_code": F.col("item.AirportCode"),
            "airport_name": _name(),
            "city_code": F.col("item.CityCode"),
            "country_code": F.col("item.CountryCode"),
            "latitude": _coordinate("Latitude"),
            "longitude": _coordinate("Longitude"),
            "time_zone_offset": F.col("item.UtcOffset"),
        }
    code, field, label = {
        "cities": ("city_code", "CityCode", "city_name"),
        "countries": ("country_code", "CountryCode", "country_name"),
        "airlines": ("airline_code", "AirlineID", "airline_name"),
        "aircraft": ("aircraft_code", "AircraftCode", "aircraft_name"),
    }[endpoint]
    return {code: F.col(f"item.{field}"), label: _name()}


def reference_items(pages: DataFrame, endpoint: str, carry: list[str] = ()) -> DataFrame:
    """Reference pages of one endpoint as rows; the code comes first."""
    exploded = explode_items(pages, *REFERENCE_ITEMS[endpoint], carry)
    columns = _reference_columns(endpoint)
    return exploded.select(*(value.alias(name) for name, value in columns.items()), *carry)
