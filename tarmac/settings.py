"""Fixed values and run parameters."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they name or shape the airline API's data, so they must not drift. ---

HUB_AIRPORT = "FRA"
HUB_TIMEZONE = "Europe/Berlin"
LOOKBACK_DAYS = 7
TIME_SLOTS = ["04:00", "08:00", "12:00", "16:00", "20:00", "00:00"]
FLIGHT_TYPES = ["arrivals", "departures"]

FLIGHT_PAGE_LIMIT = 50
REFERENCE_PAGE_LIMIT = 100

FLIGHT_RESOURCE = "FlightStatusResource"
REFERENCE_RESOURCES = {
    "airports": "AirportResource",
    "cities": "CityResource",
    "countries": "CountryResource",
    "airlines": "AirlineResource",
    "aircraft": "AircraftResource",
}

ERROR_ROOT = "ProcessingErrors"
ERROR_ITEM = "ProcessingError"
ERROR_TYPE_DEFAULT = "Unknown"
ERROR_DESCRIPTION_DEFAULT = "No description"
PROXY_ERROR_KEYS = ["Error", "error", "ERROR", "message", "Message", "detail", "details"]
META = "Meta"
TOTAL_COUNT = "TotalCount"

UTC_MINUTE_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z$"

FLIGHT_KEYS = ["airline_id", "flight_number", "scheduled_departure_utc"]
HOURLY_KEYS = ["scheduled_date", "scheduled_hour", "direction"]
PERFORMANCE_KEYS = ["flight_number", "direction", "airline_id", "aircraft_code"]

MORNING_WAVE_HOURS = (6, 9)
WEEKEND_DAYS = (1, 7)  # dayofweek(): 1 = Sunday, 7 = Saturday
DEPARTURE, ARRIVAL, UNKNOWN = "Departure", "Arrival", "Unknown"
CANCELLED = "Cancelled"
ON_TIME = "On_time"
MINOR_DELAY, MAJOR_DELAY = "Minor_Delay", "Major_Delay"
ON_TIME_MINUTES = 0  # at most
MINOR_DELAY_MINUTES = 15  # fewer than
RIPPLE_HOURS = 3

# --- End of fixed values. ---


@dataclass(frozen=True)
class Hub:
    """The airport whose operations are reported, and the zone its clocks show."""

    airport: str = HUB_AIRPORT
    timezone: str = HUB_TIMEZONE
