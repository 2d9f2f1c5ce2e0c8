"""Declared shapes of API items and of the tables built from them.

Inference is not used on the way in: one page with a lone object where others
have an array is enough to change an inferred type.
"""

from __future__ import annotations

from tarmac.settings import FLIGHT_RESOURCE, REFERENCE_RESOURCES

_LEG = (
    "struct<AirportCode: string,"
    " ScheduledTimeUTC: struct<DateTime: string>,"
    " ActualTimeUTC: struct<DateTime: string>,"
    " Terminal: struct<Name: string, Gate: string>,"
    " TimeStatus: struct<Code: string, Definition: string>>"
)

FLIGHT_ITEM = (
    "struct<OperatingCarrier: struct<AirlineID: string, FlightNumber: string>,"
    f" Departure: {_LEG},"
    f" Arrival: {_LEG},"
    " Equipment: struct<AircraftCode: string, AircraftRegistration: string>,"
    " FlightStatus: struct<Code: string, Definition: string>>"
)
FLIGHT_ITEMS_PATH = f"$.{FLIGHT_RESOURCE}.Flights.Flight"

# Name is taken as text: it is one object when a single language was asked for
# and an array of objects otherwise.
_NAMES = "Names: struct<Name: string>"

REFERENCE_ITEMS = {
    "airports": (
        f"$.{REFERENCE_RESOURCES['airports']}.Airports.Airport",
        f"struct<AirportCode: string, {_NAMES}, CityCode: string, CountryCode: string,"
        " Position: struct<Coordinate: struct<Latitude: string, Longitude: string>>,"
        " UtcOffset: string>",
    ),
    "cities": (
        f"$.{REFERENCE_RESOURCES['cities']}.Cities.City",
        f"struct<CityCode: string, {_NAMES}>",
    ),
    "countries": (
        f"$.{REFERENCE_RESOURCES['countries']}.Countries.Country",
        f"struct<CountryCode: string, {_NAMES}>",
    ),
    "airlines": (
        f"$.{REFERENCE_RESOURCES['airlines']}.Airlines.Airline",
        f"struct<AirlineID: string, {_NAMES}>",
    ),
    "aircraft": (
        f"$.{REFERENCE_RESOURCES['aircraft']}.AircraftSummaries.AircraftSummary",
        f"struct<AircraftCode: string, {_NAMES}>",
    ),
}


FACT_FLIGHTS = (
    "airline_id string, flight_number string, scheduled_departure_utc timestamp_ntz,"
    " dep_airport_code string, actual_departure_utc timestamp_ntz,"
    " dep_terminal string, dep_gate string,"
    " dep_time_status_code string, dep_time_status_desc string,"
    " arr_airport_code string, scheduled_arrival_utc timestamp_ntz,"
    " actual_arrival_utc timestamp_ntz, arr_terminal string, arr_gate string,"
    " arr_time_status_code string, arr_time_status_desc string,"
    " aircraft_code string, aircraft_registration string,"
    " flight_status_code string, flight_status_desc string"
)
FACT_COLUMNS = [field.split()[0] for field in FACT_FLIGHTS.split(",")]

BRONZE_PAGES = (
    "page_text string, page_status string,"
    " error_type string, error_description string,"
    " file_name string, fetched_at timestamp_ntz, endpoint string, hub string,"
    " flight_type string, slot_start timestamp_ntz, page_offset bigint, page_limit bigint,"
    " total_count bigint, bronze_ingested_at timestamp, fetch_day date"
)

FACT_STORED = (
    FACT_FLIGHTS + ", fetched_at timestamp_ntz, file_name string, silver_processed_at timestamp"
)
PARSED_FLIGHTS = FACT_STORED + ", route string"

_HOURLY_KEYS = "scheduled_date date, scheduled_hour int, direction string"
_PERFORMANCE_KEYS = (
    "flight_number string, direction string, airline_id string, aircraft_code string"
)
_MEASURES = (
    "total_flights bigint, on_time_flights bigint, cancelled_flights bigint,"
    " total_delay_minutes bigint, measured_flights bigint, max_delay_minutes bigint"
)

DAY_MEASURES = (
    f"flight_day date, {_HOURLY_KEYS}, {_PERFORMANCE_KEYS.replace(' direction string,', '')}, {_MEASURES}"
)
DAY_DATES = "flight_day date, hub_date string, current boolean, pending boolean"

HOURLY_REPORT = (
    f"{_HOURLY_KEYS}, is_weekend boolean, is_morning_wave boolean, total_flights bigint,"
    " on_time_flights bigint, cancelled_flights bigint, total_delay_minutes bigint,"
    " avg_delay_minutes double, past_3_hours_delay bigint, gold_processed_at timestamp"
)
PERFORMANCE_REPORT = (
    f"{_PERFORMANCE_KEYS}, total_flights bigint, cancelled_times bigint,"
    " avg_delay_minutes double, max_delay_minutes bigint, on_time_times bigint,"
    " on_time_rate double, gold_processed_at timestamp"
)
