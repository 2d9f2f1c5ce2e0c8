"""From the flight fact to rows that can be counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import flights as rules
from tarmac.functions.times import is_morning_wave, is_weekend, to_zone
from tarmac.settings import ARRIVAL, Hub

LOCAL_COLUMNS = {
    "local_scheduled_dep": "scheduled_departure_utc",
    "local_actual_dep": "actual_departure_utc",
    "local_scheduled_arr": "scheduled_arrival_utc",
    "local_actual_arr": "actual_arrival_utc",
}


def localise(flights: DataFrame, hub: Hub = Hub()) -> DataFrame:
    """Add the four wall-clock columns of the hub's zone."""
    return flights.withColumns(
        {local: to_zone(F.col(utc), hub.timezone) for local, utc in LOCAL_COLUMNS.items()}
    )


def with_direction(flights: DataFrame, hub: Hub = Hub()) -> DataFrame:
    return flights.withColumn("direction", rules.direction(hub))


def with_calendar(flights: DataFrame, hub: Hub = Hub()) -> DataFrame:
    """Add the hub's reference time with its date, hour and flags. Needs ``direction``.

    The zone conversion is the costly part, so the right UTC column is chosen
    first and only that one is converted.
    """
    at_hub = F.when(
        F.col("direction") == ARRIVAL, F.col("scheduled_arrival_utc")
    ).otherwise(F.col("scheduled_departure_utc"))
    dated = flights.withColumn("reference_time", to_zone(at_hub, hub.timezone)).withColumns(
        {
            "scheduled_date": F.to_date("reference_time"),
            "scheduled_hour": F.hour("reference_time"),
        }
    )
    return dated.withColumns(
        {
            "is_morning_wave": is_morning_wave(F.col("scheduled_hour")),
            "is_weekend": is_weekend(F.col("scheduled_date")),
        }
    )


def with_delays(flights: DataFrame) -> DataFrame:
    """Add the delay of each leg and the delay the hub answers for. Needs ``direction``."""
    legs = flights.withColumns(
        {
            "dep_delay_minutes": rules.leg_delay(
                "scheduled_departure_utc", "actual_departure_utc"
            ),
            "arr_delay_minutes": rules.leg_delay("scheduled_arrival_utc", "actual_arrival_utc"),
        }
    )
    return legs.withColumn("delay_minutes", rules.hub_delay())


def with_status(flights: DataFrame) -> DataFrame:
    """Add ``status_category``. Needs ``delay_minutes``."""
    return flights.withColumn("status_category", rules.status_category())


def completed_flights(flights: DataFrame, hub: Hub = Hub()) -> DataFrame:
    """Keep flights that are cancelled or have happened at the hub."""
    return flights.filter(rules.has_outcome(hub))


def business_features(flights: DataFrame, hub: Hub = Hub()) -> DataFrame:
    """All features for completed flights.

    The filter comes first, on stored columns; columns a later step does not
    read are pruned by Spark together with the work to derive them.
    """
    done = completed_flights(flights, hub)
    featured = with_calendar(with_direction(localise(done, hub), hub), hub)
    return with_status(with_delays(featured))
