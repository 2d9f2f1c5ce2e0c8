"""The test tables seen as flight-operations data.

Every view is a projection of whole tables: what is random in the tables (gaps,
repeats, ties, skew) becomes the irregularity the operators have to cope with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import FACT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flight_rows(events: DataFrame) -> DataFrame:
    """``events`` as flights: the fact columns plus id, type and time of the event."""
    base = events.selectExpr(
        "event_id",
        "event_type",
        "user_id",
        "ts as fetched_at",
        "upper(substr(event_type, 1, 2)) as airline_id",
        "cast(user_id as string) as flight_number",
        "ts - make_dt_interval(0, 0, 0, extract(second from ts)) as scheduled_departure_utc",
        "case when event_id % 3 = 0 then 'FRA' else 'A' || (event_id % 3) end as dep_airport_code",
        "case when event_id % 3 = 1 then 'FRA' else 'B' || (event_id % 3) end as arr_airport_code",
        "case when event_type = 'error' and event_id % 2 = 0 then 'Cancelled' else 'Landed' end"
        " as flight_status_desc",
        "case when user_id % 50 = 0 then null else 'AC' || (user_id % 7) end as aircraft_code",
        "cast(floor(value) as int) as v",
        "cast(get_json_object(props, '$.k') as int) as k",
    ).selectExpr(
        "*",
        "flight_status_desc = 'Cancelled' or event_id % 17 = 0 as pending",
        "scheduled_departure_utc + make_dt_interval(0, 0, 60 + cast(user_id % 120 as int))"
        " as scheduled_arrival_utc",
    )
    return base.selectExpr(
        "event_id",
        "event_type",
        "fetched_at",
        "airline_id",
        "flight_number",
        "scheduled_departure_utc",
        "dep_airport_code",
        "case when not pending then scheduled_departure_utc + make_dt_interval(0, 0, v - 20) end"
        " as actual_departure_utc",
        "'T' || (user_id % 3) as dep_terminal",
        "case when user_id % 5 > 0 then 'G' || (user_id % 5) end as dep_gate",
        "case when pending then 'NO' else 'DP' end as dep_time_status_code",
        "case when pending then 'No status' else 'Flight departed' end as dep_time_status_desc",
        "arr_airport_code",
        "scheduled_arrival_utc",
        "case when not pending then scheduled_arrival_utc + make_dt_interval(0, 0, k + v - 60) end"
        " as actual_arrival_utc",
        "'T' || (user_id % 2) as arr_terminal",
        "'H' || (user_id % 4) as arr_gate",
        "case when pending then 'NO' else 'LD' end as arr_time_status_code",
        "case when pending then 'No status' else 'Flight landed' end as arr_time_status_desc",
        "aircraft_code",
        "'D-' || upper(event_type) as aircraft_registration",
        "case when flight_status_desc = 'Cancelled' then 'CD' else 'LD' end as flight_status_code",
        "flight_status_desc",
    )


# The same view for the SQL side.
FLIGHTS_SQL = """
e0 as (
  select event_id, event_type, ts fetched_at, user_id u, upper(substr(event_type, 1, 2)) airline_id,
    cast(user_id as varchar) flight_number,
    date_trunc('minute', ts) scheduled_departure_utc,
    case when event_id % 3 = 0 then 'FRA' else 'A' || (event_id % 3) end dep_airport_code,
    case when event_id % 3 = 1 then 'FRA' else 'B' || (event_id % 3) end arr_airport_code,
    case when event_type = 'error' and event_id % 2 = 0 then 'Cancelled' else 'Landed' end
      flight_status_desc,
    case when user_id % 50 = 0 then null else 'AC' || (user_id % 7) end aircraft_code,
    cast(floor(value) as int) v, cast(json_extract_string(props, '$.k') as int) k
  from events),
e1 as (
  select *, flight_status_desc = 'Cancelled' or event_id % 17 = 0 pending,
    scheduled_departure_utc + to_minutes(60 + u % 120) scheduled_arrival_utc
  from e0),
flights as (
  select event_id, event_type, fetched_at, airline_id, flight_number, scheduled_departure_utc,
    dep_airport_code,
    case when not pending then scheduled_departure_utc + to_minutes(v - 20) end
      actual_departure_utc,
    'T' || (u % 3) dep_terminal, case when u % 5 > 0 then 'G' || (u % 5) end dep_gate,
    case when pending then 'NO' else 'DP' end dep_time_status_code,
    case when pending then 'No status' else 'Flight departed' end dep_time_status_desc,
    arr_airport_code, scheduled_arrival_utc,
    case when not pending then scheduled_arrival_utc + to_minutes(k + v - 60) end
      actual_arrival_utc,
    'T' || (u % 2) arr_terminal, 'H' || (u % 4) arr_gate,
    case when pending then 'NO' else 'LD' end arr_time_status_code,
    case when pending then 'No status' else 'Flight landed' end arr_time_status_desc,
    aircraft_code, 'D-' || upper(event_type) aircraft_registration,
    case when flight_status_desc = 'Cancelled' then 'CD' else 'LD' end flight_status_code,
    flight_status_desc
  from e1)
"""

FEATURE_STEPS_SQL = """
f0 as (
  select *, case when dep_airport_code = 'FRA' then 'Departure'
                 when arr_airport_code = 'FRA' then 'Arrival' else 'Unknown' end direction,
    (scheduled_departure_utc at time zone 'UTC') at time zone 'Europe/Berlin' local_scheduled_dep,
    (actual_departure_utc at time zone 'UTC') at time zone 'Europe/Berlin' local_actual_dep,
    (scheduled_arrival_utc at time zone 'UTC') at time zone 'Europe/Berlin' local_scheduled_arr,
    (actual_arrival_utc at time zone 'UTC') at time zone 'Europe/Berlin' local_actual_arr,
    coalesce(date_diff('minute', scheduled_departure_utc, actual_departure_utc), 0)
      dep_delay_minutes,
    coalesce(date_diff('minute', scheduled_arrival_utc, actual_arrival_utc), 0)
      arr_delay_minutes
  from flights),
f1 as (
  select *, case direction when 'Departure' then dep_delay_minutes
      when 'Arrival' then greatest(arr_delay_minutes - dep_delay_minutes, 0) else 0 end
      delay_minutes,
    case when direction = 'Arrival' then local_scheduled_arr else local_scheduled_dep end
      reference_time
  from f0),
f2 as (
  select *, cast(reference_time as date) scheduled_date,
    cast(hour(reference_time) as integer) scheduled_hour,
    hour(reference_time) between 6 and 9 is_morning_wave,
    dayofweek(reference_time) in (0, 6) is_weekend,
    case when flight_status_desc = 'Cancelled' then 'Cancelled'
         when delay_minutes <= 0 then 'On_time'
         when delay_minutes < 15 then 'Minor_Delay' else 'Major_Delay' end status_category
  from f1),
features as (
  select * from f2 where status_category = 'Cancelled'
    or (direction = 'Departure' and local_actual_dep is not null)
    or (direction = 'Arrival' and local_actual_arr is not null))
"""
FEATURES_SQL = f"{FLIGHTS_SQL}, {FEATURE_STEPS_SQL}"


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight fact, 20 columns."""
    return flight_rows(table(spark, sf_dir, "events")).select(*FACT_COLUMNS)


def flights_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_rows(table(spark, sf_dir, "events"))


def as_text(ts: str):
    """A timestamp as the API writes it."""
    return F.concat(
        F.regexp_replace(F.substring(F.col(ts).cast("string"), 1, 16), " ", "T"), F.lit("Z")
    )


def pages_of(
    rows: DataFrame, item: Column, page_keys: list[str], opening: str, as_json: bool = True
) -> DataFrame:
    """Rows packed into pages: an array of items, or the bare item when there is one.

    ``page_keys`` bound how many rows share a page. ``item`` is a struct, or
    JSON text already where ``as_json`` is false.
    """
    packed = (
        rows.select(*page_keys, item.alias("item"))
        .groupBy(*page_keys)
        .agg(F.collect_list("item").alias("items"))
    )
    items, alone = F.col("items"), F.size("items") == 1
    if as_json:
        body = F.when(alone, F.to_json(items[0])).otherwise(F.to_json(items))
    else:
        joined = F.array_join(items, ",")
        body = F.when(alone, joined).otherwise(F.concat(F.lit("["), joined, F.lit("]")))
    total = F.concat(F.lit('},"Meta":{"TotalCount":'), F.size(items).cast("string"), F.lit("}}}"))
    return packed.select(*page_keys, F.concat(F.lit(opening), body, total).alias("page_text"))


def _leg(prefix: str, airport: str, scheduled: str, actual: str):
    return F.struct(
        F.col(airport).alias("AirportCode"),
        F.struct(as_text(scheduled).alias("DateTime")).alias("ScheduledTimeUTC"),
        F.struct(as_text(actual).alias("DateTime")).alias("ActualTimeUTC"),
        F.struct(
            F.col(f"{prefix}_terminal").alias("Name"), F.col(f"{prefix}_gate").alias("Gate")
        ).alias("Terminal"),
        F.struct(
            F.col(f"{prefix}_time_status_code").alias("Code"),
            F.col(f"{prefix}_time_status_desc").alias("Definition"),
        ).alias("TimeStatus"),
    )


def flight_item() -> Column:
    return F.struct(
        F.struct(
            F.col("airline_id").alias("AirlineID"), F.col("flight_number").alias("FlightNumber")
        ).alias("OperatingCarrier"),
        _leg(
            "dep", "dep_airport_code", "scheduled_departure_utc", "actual_departure_utc"
        ).alias("Departure"),
        _leg("arr", "arr_airport_code", "scheduled_arrival_utc", "actual_arrival_utc").alias(
            "Arrival"
        ),
        F.struct(
            F.col("aircraft_code").alias("AircraftCode"),
            F.col("aircraft_registration").alias("AircraftRegistration"),
        ).alias("Equipment"),
        F.struct(
            F.col("flight_status_code").alias("Code"),
            F.col("flight_status_desc").alias("Definition"),
        ).alias("FlightStatus"),
    )


FLIGHT_PAGE_OPEN = '{"FlightStatusResource":{"Flights":{"Flight":'


def flight_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights as API pages: at most 50 of one event type, a lone one as a bare object."""
    page_id = F.expr("event_id div 50")
    # Dealt by page while they are small; packing them needs no other exchange.
    events = table(spark, sf_dir, "events").repartition(page_id, "event_type")
    rows = flight_rows(events).withColumn("page_id", page_id)
    return pages_of(rows, flight_item(), ["page_id", "event_type"], FLIGHT_PAGE_OPEN)


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; the pattern allows for a single file, which a plain path does not."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def spread(events: DataFrame) -> DataFrame:
    """Events dealt evenly over tasks.

    As pages they are ten times their size and more, and a task takes whole row groups of a file, however small
    the file; unspread, a few tasks would make and parse most pages.
    """
    return events.repartition("event_id", "user_id", "ts")


def streamed_flight_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incomplete flights as a stream of pages with one bare object each."""
    return single_pages(without_some_keys(flight_rows(spread(streamed(spark, sf_dir, "events")))))


def single_pages(rows: DataFrame) -> DataFrame:
    """Flights as pages with one bare object each."""
    close = F.lit('},"Meta":{"TotalCount":1}}}')
    return rows.select(
        "fetched_at",
        F.concat(F.lit("flight_"), F.col("event_id").cast("string")).alias("file_name"),
        F.concat(F.lit(FLIGHT_PAGE_OPEN), F.to_json(flight_item()), close).alias("page_text"),
    )


def versions_of_flights(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Incomplete flights as one of three deliveries: each flight comes in versions 0, 1 and 2, an hour apart.

    A third of them comes in that order; for the others the newest version comes first or second and
    an old one after it. The gate tells the version.
    """
    version = (F.col("event_id") + part) % 3
    flights = without_some_keys(flight_rows(spread(table(spark, sf_dir, "events"))))
    return flights.withColumns(
        {
            "fetched_at": F.col("fetched_at") + F.make_dt_interval(hours=version.cast("int")),
            "dep_gate": F.concat(F.lit("V"), version.cast("string")),
        }
    )


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight pages with names as the fetcher gives them."""
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    day, offset = 1 + F.col("page_id") % 3, F.col("page_id") / 3 % 3
    name = F.concat(
        F.lit("202401"), two(day), F.lit("040000_FRA_arrivals_2024-01-"), two(day), F.lit("T0400_off"),
        (F.floor(offset) * 50).cast("string"), F.lit("_lim50.json"),
    )
    return flight_pages(spark, sf_dir).select("page_text", name.alias("file_name"))


def incomplete_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights some of whose keys are missing."""
    return without_some_keys(flights_with_id(spark, sf_dir))


def without_some_keys(flights: DataFrame) -> DataFrame:
    return (
        flights
        .withColumn("airline_id", F.expr("case when event_id % 11 > 0 then airline_id end"))
        .withColumn("flight_number", F.expr("case when event_id % 13 > 0 then flight_number end"))
        .withColumn(
            "scheduled_departure_utc",
            F.expr("case when event_id % 19 > 0 then scheduled_departure_utc end"),
        )
    )


def _reference_json(code_field: str, code, name, plural, extra=()) -> Column:
    """JSON of an item whose name is one object, or a list of them where ``plural``."""
    english = F.struct(F.lit("EN").alias("@LanguageCode"), name.alias("$"))
    german = F.struct(F.lit("DE").alias("@LanguageCode"), F.lit("Name").alias("$"))

    def item(names):
        return F.to_json(F.struct(code.alias(code_field), F.struct(names.alias("Name")).alias("Names"), *extra))

    both = F.when(F.length(name) % 2 == 0, F.array(german, english)).otherwise(F.array(english, german))
    return F.when(plural, item(both)).otherwise(item(english))


def _position():
    latitude = F.when(F.col("s_acctbal") < 1000, F.lit("n/a")).otherwise(
        F.col("s_acctbal").cast("string")
    )
    return F.struct(
        F.struct(
            latitude.alias("Latitude"), (-F.col("s_acctbal")).cast("string").alias("Longitude")
        ).alias("Coordinate")
    )


REFERENCE_SOURCES = {
    "airports": ("supplier", "s_suppkey"),
    "cities": ("nation", "n_nationkey"),
    "countries": ("region", "r_regionkey"),
    "airlines": ("customer", "c_custkey"),
    "aircraft": ("part", "p_partkey"),
}
REFERENCE_PAGE_OPEN = {
    "airports": '{"AirportResource":{"Airports":{"Airport":',
    "cities": '{"CityResource":{"Cities":{"City":',
    "countries": '{"CountryResource":{"Countries":{"Country":',
    "airlines": '{"AirlineResource":{"Airlines":{"Airline":',
    "aircraft": '{"AircraftResource":{"AircraftSummaries":{"AircraftSummary":',
}


def _reference_item(endpoint: str, key: str):
    """Suppliers, nations, regions, customers and parts as items of the five endpoints.

    City codes run past the known nations and country codes past the known
    regions, so some airports find no name. Customers share 25 airline codes,
    and those of one market segment have none.
    """
    plural = F.col(key) % 2 == 0
    if endpoint == "airports":
        return _reference_json(
            "AirportCode",
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
            F.col("s_name"),
            plural,
            (
                F.concat(F.lit("N"), (F.col("s_nationkey") + 3).cast("string")).alias("CityCode"),
                F.concat(F.lit("R"), (F.col("s_suppkey") % 7).cast("string")).alias("CountryCode"),
                _position().alias("Position"),
                F.concat(F.lit("+0"), (F.col("s_suppkey") % 3).cast("string")).alias("UtcOffset"),
            ),
        )
    if endpoint == "airlines":
        code = F.when(
            F.col("c_mktsegment") != "BUILDING",
            F.concat(F.lit("C"), F.col("c_nationkey").cast("string")),
        )
        return _reference_json("AirlineID", code, F.col("c_name"), plural)
    field, letter, name = {
        "cities": ("CityCode", "N", "n_name"),
        "countries": ("CountryCode", "R", "r_name"),
        "aircraft": ("AircraftCode", "P", "p_name"),
    }[endpoint]
    code = F.concat(F.lit(letter), F.col(key).cast("string"))
    return _reference_json(field, code, F.col(name), plural)


def reference_pages(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    """One endpoint's items, at most 100 to a page."""
    source, key = REFERENCE_SOURCES[endpoint]
    rows = table(spark, sf_dir, source).withColumn(
        "page_id", F.expr(f"cast({key} as bigint) div 100")
    )
    item = _reference_item(endpoint, key)
    return pages_of(rows, item, ["page_id"], REFERENCE_PAGE_OPEN[endpoint], as_json=False)


def streamed_airport_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports as a stream of pages with one bare object each."""
    source, key = REFERENCE_SOURCES["airports"]
    close = F.lit('},"Meta":{"TotalCount":1}}}')
    text = F.concat(
        F.lit(REFERENCE_PAGE_OPEN["airports"]), _reference_item("airports", key), close
    )
    return streamed(spark, sf_dir, source).select(text.alias("page_text"))


# One API response per event: data, both kinds of error, and things that are neither.
RESPONSE_TEXT = """
case event_type
  when 'click' then concat('{"FlightStatusResource":{"Flights":{},"Meta":{"TotalCount":',
    event_id % 300, '}}}')
  when 'error' then case event_id % 5
    when 0 then concat('{"ProcessingErrors":{"ProcessingError":{"Type":"T', user_id,
      '","Description":"not found"}}}')
    when 1 then concat('{"ProcessingErrors":{"ProcessingError":[{"Type":"T', user_id,
      '"},{"Type":"second"}]}}')
    when 2 then concat('{"ProcessingErrors":[{"Description":"D', user_id, '"}]}')
    when 3 then '{"ProcessingErrors":{"Type":"flat","Description":"direct"}}'
    else '{"ProcessingErrors":null,"message":"late"}' end
  when 'purchase' then case event_id % 7
    when 0 then '{"Error":"bad gateway"}' when 1 then concat('{"error":', props, '}')
    when 2 then concat('{"ERROR":', user_id, '}') when 3 then '{"message":"slow"}'
    when 4 then '{"Message":[1]}' when 5 then '{"detail":true}'
    else '{"data":1,"details":"0"}' end
  when 'signup' then case event_id % 6
    when 0 then '{"message":""}' when 1 then '{"detail":0,"details":[]}'
    when 2 then '{"Error":null,"error":false,"ERROR":{}}'
    when 3 then '{"Meta":{"TotalCount":5},"message":"kept"}'
    when 4 then '{"MESSAGE":"other spelling"}' else '{"message":"","detail":"second key"}' end
  else case event_id % 3
    when 0 then '[1, 2]' when 1 then '{"cut off": ' else '<html>busy</html>' end
end
"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{RESPONSE_TEXT} as page_text"
    )


FILE_NAME_TEXT = """
case event_type
  when 'click' then concat(stamp, '_FRA_arrivals_', day, 'T0400_off', event_id, '_lim50.json')
  when 'view' then concat(stamp, '_A_B', user_id, '_departures_', day, 'T2000_off0_lim',
    user_id, '.json')
  when 'purchase' then concat(stamp, '_ref_airports_off', event_id, '_lim100.json')
  when 'signup' then concat(stamp, '_ref_cities_lim100.json')
  else concat('report_', event_id, '.csv') end
"""


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names as the fetcher writes them, and some that are not its own."""
    stamped = table(spark, sf_dir, "events").selectExpr(
        "*",
        "regexp_replace(substr(cast(ts as string), 1, 19), '[^0-9]', '') as stamp",
        "substr(cast(ts as string), 1, 10) as day",
    )
    return stamped.selectExpr("event_id", f"{FILE_NAME_TEXT} as file_name")


CLOCK_TEXT = """
case event_type
  when 'click' then concat(minute_text, 'Z') when 'view' then concat(minute_text, ':30Z')
  when 'purchase' then '' when 'signup' then concat('2024-13-', substr(minute_text, 9), 'Z')
  else case when event_id % 2 = 0 then minute_text
    else concat('2024-02-30', substr(minute_text, 11), 'Z') end end
"""


def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, in and out of the API's shape."""
    clocked = table(spark, sf_dir, "events").selectExpr(
        "*", "replace(substr(cast(ts as string), 1, 16), ' ', 'T') as minute_text"
    )
    return clocked.selectExpr("event_id", f"{CLOCK_TEXT} as clock_text")


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as landed pages: half pages where a full one failed, repeats, holes."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as request_id",
        "l_shipdate as fetched_at",
        "(l_linenumber - 1) * 50L + if(l_linestatus = 'O' and l_returnflag = 'R', 25, 0)"
        " as page_offset",
        "if(l_linestatus = 'O', 25L, 50L) as page_limit",
        "350L - cast(l_quantity as bigint) as total_count",
    )


def landed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as records on pages: a supplier is a request, a part is a record."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as request_id",
        "l_partkey as record_key",
        "(l_linenumber - 1) * 50L as page_offset",
        "l_shipdate as fetched_at",
        "cast(floor(l_extendedprice / 100) as bigint) as total_count",
    )


def landed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests made: a user is a hub, an event a page in its four-hour slot."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as hub",
        "to_date(ts) as day",
        "concat(lpad(cast(hour(ts) div 4 * 4 as string), 2, '0'), ':00') as slot",
        "if(event_type in ('click', 'view'), 'arrivals', 'departures') as flight_type",
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flight pages fetched for twelve hubs, at whatever minute of the day."""
    return table(spark, sf_dir, "events").selectExpr(
        "'H' || (user_id % 12) as hub",
        "ts as fetched_at",
        "if(event_type in ('click', 'view'), 'arrivals', 'departures') as flight_type",
        "cast(to_date(ts) as timestamp_ntz)"
        " + make_dt_interval(-cast(event_id % 7 as int), cast(4 * (user_id % 6) as int)) as slot_start",
        "event_id div 7 % 3 * 50 as page_offset",
        "50L as page_limit",
        "50 + user_id % 120 as total_count",
    )


# The same view for the SQL side, with the run of each page by the distance to the fetch before.
FETCH_RUNS_SQL = """
fetched as (
  select 'H' || (user_id % 12) hub, ts fetched_at,
    case when event_type in ('click', 'view') then 'arrivals' else 'departures' end flight_type,
    cast(cast(ts as date) as timestamp) - to_days(cast(event_id % 7 as int)) + to_hours(4 * (user_id % 6)) slot_start,
    event_id // 7 % 3 * 50 page_offset, 50 page_limit, 50 + user_id % 120 total_count
  from events),
opened as (
  select *, case when fetched_at - lag(fetched_at) over w <= interval 90 minute then null else fetched_at end opened
  from fetched window w as (partition by hub order by fetched_at)),
pages as (
  select * exclude (opened), max(opened) over (partition by hub order by fetched_at) fetch_run from opened)
"""


def drifted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight items as text, of which some have a field more or a number where text is declared."""
    rows = flights_with_id(spark, sf_dir).withColumn("item", F.to_json(flight_item()))
    more = F.when(
        F.col("event_type") == "click",
        F.concat(
            F.lit('{"MarketingCarrier":{"AirlineID":"ZZ"},"Codeshares":['),
            F.col("flight_number"), F.lit("],"), F.substr("item", F.lit(2)),
        ),
    ).otherwise(F.col("item"))
    opening = '"FlightStatus":{'
    updated = F.concat(F.lit(opening + '"Updated":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit(","))
    more = F.when(F.col("event_id") % 9 == 0, F.replace(more, F.lit(opening), updated)).otherwise(more)
    return rows.select(F.replace(more, F.lit('"Gate":"G1"'), F.lit('"Gate":1')).alias("item_text"))


DEDUP_DELAY = "1 hour"
_PARTS = 3


def timed_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events in three parts, forty days apart by event time, each later than the watermark allows for the one before.

    Of the later parts, every fifth event is late by more than that. The last event of a part is twelve hours after
    the others, from a user of its own, so that the state of all others can go.
    """
    events = table(spark, sf_dir, "events").withColumn("part", (F.col("event_id") % _PARTS).cast("int"))
    last = events.groupBy("part").agg(F.max("event_id").alias("last_id"))
    final = F.col("event_id") == F.col("last_id")
    late = (F.col("part") > 0) & (F.col("event_id") % 5 == 0) & ~final
    shifted = F.when(late, F.lit(-40)).otherwise(40 * F.col("part"))
    day = F.col("ts").cast("date").cast("timestamp_ntz")
    moved = day + F.make_dt_interval(days=shifted, hours=F.when(final, 12).otherwise(0))
    user = F.when(final, -1 - F.col("part")).otherwise(F.col("user_id"))
    rows = events.join(last, "part").select("part", user.alias("user_id"), "event_type", moved.alias("ts"))
    return [rows.filter(F.col("part") == part).drop("part") for part in range(_PARTS)]
