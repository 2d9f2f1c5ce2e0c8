"""SQL with the same meaning as each query in ``checks.queries``."""

from __future__ import annotations

from checks.views import FEATURES_SQL, FEATURE_STEPS_SQL, FETCH_RUNS_SQL, FLIGHTS_SQL, RESPONSE_TEXT
from tarmac.schemas import FACT_COLUMNS


def half_up_mean(x: str) -> str:
    """Mean to two digits by whole-number arithmetic, halves away from zero."""
    return (
        f"cast(sign(sum({x})) * ((200 * abs(sum({x})) + count(*)) // (2 * count(*))) as double)"
        " / 100.0"
    )


HOURLY_STEPS_SQL = f"""
hourly as (
  select scheduled_date, scheduled_hour, direction, is_weekend, is_morning_wave,
    count(flight_number) total_flights,
    cast(sum(case when status_category = 'On_time' then 1 else 0 end) as bigint) on_time_flights,
    cast(sum(case when status_category = 'Cancelled' then 1 else 0 end) as bigint)
      cancelled_flights,
    cast(sum(delay_minutes) as bigint) total_delay_minutes,
    {half_up_mean("delay_minutes")} avg_delay_minutes
  from features group by all),
ripple as (
  select *, cast(coalesce(sum(total_delay_minutes) over (
      partition by scheduled_date, direction order by scheduled_hour
      range between 3 preceding and 1 preceding), 0) as bigint) past_3_hours_delay
  from hourly)
"""
HOURLY_SQL = f"{FEATURES_SQL}, {HOURLY_STEPS_SQL}"

PERFORMANCE_SELECT = f"""
select flight_number, direction, airline_id, aircraft_code,
  count(flight_number) total_flights,
  cast(sum(case when status_category = 'Cancelled' then 1 else 0 end) as bigint) cancelled_times,
  {half_up_mean("delay_minutes")} avg_delay_minutes,
  max(delay_minutes) max_delay_minutes,
  cast(sum(case when status_category = 'On_time' then 1 else 0 end) as bigint) on_time_times,
  cast((20000 * count(*) filter (status_category = 'On_time') + count(flight_number))
    // (2 * count(flight_number)) as double) / 100.0 on_time_rate
from features group by all"""

INCOMPLETE_SQL = (
    FLIGHTS_SQL
    + """,
incomplete as (
  select * replace (case when event_id % 11 > 0 then airline_id end as airline_id,
    case when event_id % 13 > 0 then flight_number end as flight_number,
    case when event_id % 19 > 0 then scheduled_departure_utc end as scheduled_departure_utc)
  from flights)
"""
)
IS_VALID = (
    "(airline_id is not null and flight_number is not null and scheduled_departure_utc is not null)"
)
KEYS_SELECT = "select event_id, airline_id, flight_number, scheduled_departure_utc from incomplete"

# The fact a stream of incomplete flights leaves behind, as "flights" of the feature steps.
FACT_SQL = f"""{INCOMPLETE_SQL},
fact as (
  select * from incomplete where {IS_VALID}
  qualify row_number() over (
    partition by airline_id, flight_number, scheduled_departure_utc order by fetched_at desc) = 1)
"""
FACT_FEATURES_SQL = f"{FACT_SQL}, {FEATURE_STEPS_SQL.replace('from flights', 'from fact')}"

# Judged with DuckDB's own JSON functions on the same response texts.
RESPONSES_SQL = f"""
r0 as (select event_id, {RESPONSE_TEXT} t from events),
r1 as (
  select event_id, case when json_valid(t) then cast(t as json) end j from r0),
r2 as (
  select *, coalesce(json_type(j) = 'OBJECT', false) is_object,
    json_exists(j, '$.ProcessingErrors') has_errors, json_exists(j, '$.Meta') has_meta,
    [json_extract(j, '$.Error'), json_extract(j, '$.error'), json_extract(j, '$.ERROR'),
     json_extract(j, '$.message'), json_extract(j, '$.Message'), json_extract(j, '$.detail'),
     json_extract(j, '$.details')] messages
  from r1),
r3 as (
  select *, case when not is_object then 'malformed' when has_errors then 'api_error'
      when not has_meta and len(list_filter(messages, lambda m: m is not null
        and cast(m as varchar) not in ('null', 'false', '0', '""', '[]', '{{}}'))) > 0
      then 'proxy_error' else 'ok' end page_status
  from r2),
r4 as (
  select *, coalesce(json_extract(j, '$.ProcessingErrors.ProcessingError[0]'),
      json_extract(j, '$.ProcessingErrors.ProcessingError'),
      json_extract(j, '$.ProcessingErrors[0]'), json_extract(j, '$.ProcessingErrors')) e
  from r3)
"""

REFERENCE_SQL = """
airports as (
  select 'S' || s_suppkey airport_code, s_name airport_name,
    'N' || (s_nationkey + 3) city_code, 'R' || (s_suppkey % 7) country_code,
    case when s_acctbal >= 1000 then s_acctbal end latitude, -s_acctbal longitude,
    '+0' || (s_suppkey % 3) time_zone_offset
  from supplier),
cities as (select 'N' || n_nationkey city_code, n_name city_name from nation),
countries as (select 'R' || r_regionkey country_code, r_name country_name from region),
airlines as (
  select case when c_mktsegment <> 'BUILDING' then 'C' || c_nationkey end airline_code,
    c_name airline_name
  from customer),
aircraft as (select 'P' || p_partkey aircraft_code, p_name aircraft_name from part)
"""

AIRPORTS_SELECT = f"""with {REFERENCE_SQL}
select a.*, city_name, country_name from airports a
  left join cities using (city_code) left join countries using (country_code)"""

LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", *LINE_REST]


def line_winner(source: str, order: list[str]) -> str:
    """Last line per key in ``source``."""
    ranking = ", ".join(f"{name} desc nulls last" for name in order)
    return (
        f"select {', '.join(LINE_COLUMNS)} from {source} qualify row_number() over ("
        f"partition by l_orderkey, l_linenumber order by {ranking}) = 1"
    )


# Ties follow table order, in which the ship date comes last.
MERGE_SQL = f"""
target as ({line_winner("(select * from lineitem where l_linestatus = 'F')",
                        ["l_shipdate", *LINE_REST])}),
source as ({line_winner("(select * from lineitem where l_linestatus = 'O')",
                        [*LINE_REST, "l_shipdate"])}),
old as (
  select t.* from target t anti join source s
    on t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber)
"""

MERGED_SELECT = f"with {MERGE_SQL} select * from old union all select * from source"

ORACLES = {
    "airport_hourly": f"with {HOURLY_SQL} select * from ripple",
    "ripple_3h": f"""with {HOURLY_SQL}
select scheduled_date, scheduled_hour, direction, total_delay_minutes, past_3_hours_delay
from ripple""",
    "flight_performance": f"with {FEATURES_SQL} {PERFORMANCE_SELECT}",
    "local_times": f"""with {FEATURES_SQL}
select event_id, local_scheduled_dep, local_actual_dep, local_scheduled_arr, local_actual_arr
from f0""",
    "direction": f"""with {FEATURES_SQL}
select event_id, dep_airport_code, arr_airport_code, direction from f0""",
    "delay_minutes": f"""with {FEATURES_SQL}
select event_id, dep_delay_minutes, arr_delay_minutes, delay_minutes from f1""",
    "status_category": f"""with {FEATURES_SQL}
select event_id, flight_status_desc, status_category from f2""",
    "valid_flights": f"""with {FEATURES_SQL}
select event_id, flight_status_desc, actual_departure_utc, actual_arrival_utc from features""",
    "business_features": f"""with {FEATURES_SQL}
select event_id, direction, reference_time, scheduled_date, scheduled_hour, is_morning_wave,
  is_weekend, delay_minutes, status_category
from features""",
    "json_flatten_events": f"with {FLIGHTS_SQL} select {', '.join(FACT_COLUMNS)} from flights",
    "singleton_array": """
select event_id // 50 page_id, event_type, count(*) n_items from events group by all""",
    "classify_pages": f"""with {RESPONSES_SQL}
select event_id, page_status,
  case when page_status = 'api_error'
    then coalesce(json_extract_string(e, '$.Type'), 'Unknown') end error_type,
  case when page_status = 'api_error'
    then coalesce(json_extract_string(e, '$.Description'), 'No description') end
    error_description,
  cast(json_extract_string(j, '$.FlightStatusResource.Meta.TotalCount') as bigint) total_count
from r4""",
    "lineage_parse": f"""
with stamped as (
  select *, strftime(ts, '%Y%m%d%H%M%S') stamp, strftime(ts, '%Y-%m-%d') "day" from events)
select event_id,
  case when event_type in ('click', 'view', 'purchase') then date_trunc('second', ts) end
    fetched_at,
  case when event_type = 'purchase' then 'airports' end endpoint,
  case event_type when 'click' then 'FRA' when 'view' then 'A_B' || user_id end hub,
  case event_type when 'click' then 'arrivals' when 'view' then 'departures' end flight_type,
  case event_type when 'click' then date_trunc('day', ts) + interval 4 hour
    when 'view' then date_trunc('day', ts) + interval 20 hour end slot_start,
  case event_type when 'click' then event_id when 'view' then 0 when 'purchase' then event_id end
    page_offset,
  case event_type when 'click' then 50 when 'view' then user_id when 'purchase' then 100 end
    page_limit
from stamped""",
    "parse_ts": """
select event_id,
  case event_type when 'click' then strftime(ts, '%Y-%m-%dT%H:%MZ')
    when 'view' then strftime(ts, '%Y-%m-%dT%H:%M:30Z') when 'purchase' then ''
    when 'signup' then strftime(ts, '2024-13-%dT%H:%MZ')
    else case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M')
      else strftime(ts, '2024-02-30T%H:%MZ') end end clock_text,
  case when event_type = 'click' then date_trunc('minute', ts) end parsed
from events""",
    "valid_split": f"with {INCOMPLETE_SQL} {KEYS_SELECT} where {IS_VALID}",
    "quarantine_split": f"with {INCOMPLETE_SQL} {KEYS_SELECT} where not {IS_VALID}",
    "reference_family": f"""with {REFERENCE_SQL}
select 'airports' endpoint, airport_code code, airport_name "name" from airports
union all select 'cities', city_code, city_name from cities
union all select 'countries', country_code, country_name from countries
union all select 'airlines', airline_code, airline_name from airlines
union all select 'aircraft', aircraft_code, aircraft_name from aircraft""",
    "cast_dims": f"""with {REFERENCE_SQL}
select airport_code, latitude, longitude, time_zone_offset from airports""",
    "dim_airports": AIRPORTS_SELECT,
    "dim_airlines": f"""with {REFERENCE_SQL}
select airline_code, max(airline_name) airline_name from airlines
where airline_code is not null group by 1""",
    "dim_aircraft": f"with {REFERENCE_SQL} select * from aircraft",
    "dedup_lineitem": line_winner("lineitem", ["l_shipdate", *LINE_REST]),
    "upsert_scd1": MERGED_SELECT,
    "upsert_keep_columns": f"""with {MERGE_SQL},
merged as (select * from old union all select * from source)
select m.l_orderkey, m.l_linenumber, m.l_partkey, m.l_shipdate, t.l_tax
from merged m left join target t
  on m.l_orderkey = t.l_orderkey and m.l_linenumber = t.l_linenumber""",
    "cdc_latest": """
select event_id, ts, user_id, event_type, "value" from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    # Brute force: every landed record number is listed and counted.
    "page_gaps": """
with pages as (
  select l_orderkey request_id, l_shipdate fetched_at,
    (l_linenumber - 1) * 50 + case when l_linestatus = 'O' and l_returnflag = 'R' then 25 else 0 end
      off,
    case when l_linestatus = 'O' then 25 else 50 end lim,
    350 - cast(l_quantity as bigint) total_count
  from lineitem),
totals as (
  select request_id, total_count from pages
  qualify row_number() over (partition by request_id
    order by fetched_at desc, total_count desc) = 1),
expected as (
  select request_id, total_count, unnest(range(0, total_count, 50)) page_offset from totals),
records as (
  select distinct request_id, unnest(range(off, off + lim)) record_no from pages),
landed as (
  select request_id, record_no // 50 * 50 page_offset, count(*) landed_records
  from records group by all)
select e.request_id, e.page_offset,
  least(50, e.total_count - e.page_offset) expected_records,
  coalesce(landed_records, 0) landed_records
from expected e left join landed l
  on e.request_id = l.request_id and e.page_offset = l.page_offset
where coalesce(landed_records, 0) < least(50, e.total_count - e.page_offset)""",
    "coverage_gaps": """
with landed as (
  select distinct cast(user_id as varchar) hub, cast(ts as date) "day",
    lpad(cast(hour(ts) // 4 * 4 as varchar), 2, '0') || ':00' slot,
    case when event_type in ('click', 'view') then 'arrivals' else 'departures' end flight_type
  from events),
days as (
  select hub, cast(unnest(range(min("day"), max("day") + interval 1 day, interval 1 day)) as date)
    "day"
  from landed group by hub),
grid as (
  select hub, "day", slot, flight_type from days,
    (values ('00:00'), ('04:00'), ('08:00'), ('12:00'), ('16:00'), ('20:00')) s(slot),
    (values ('arrivals'), ('departures')) f(flight_type))
select * from grid except select * from landed""",
    "page_dupes": """
with items as (
  select l_suppkey request_id, l_partkey record_key, (l_linenumber - 1) * 50 page_offset,
    l_shipdate fetched_at, cast(floor(l_extendedprice / 100) as bigint) total_count
  from lineitem),
totals as (
  select request_id, total_count from items
  qualify row_number() over (partition by request_id
    order by fetched_at desc, total_count desc) = 1),
per_key as (
  select request_id, record_key, count(distinct page_offset) pages, count(*) copies
  from items group by all),
per_group as (
  select request_id, count(*) distinct_keys, count(*) filter (pages > 1) repeated_keys,
    cast(sum(copies) as bigint) landed_rows
  from per_key group by all)
select request_id, total_count, landed_rows, distinct_keys, repeated_keys,
  greatest(total_count - distinct_keys, 0) missing_records,
  total_count % 100 = 0 last_page_full
from per_group join totals using (request_id)""",
    "keyed_table_upsert": MERGED_SELECT,
    "stream_quarantine": f"""with {INCOMPLETE_SQL}
select {', '.join(FACT_COLUMNS)} from incomplete where not {IS_VALID}""",
    "stream_fact_flights": f"""with {INCOMPLETE_SQL},
versions as (
  select * replace (fetched_at + to_hours(v) as fetched_at, 'V' || v as dep_gate)
  from incomplete, (values (0), (1), (2)) t(v) where {IS_VALID}),
fact as (
  select * from versions
  qualify row_number() over (
    partition by airline_id, flight_number, scheduled_departure_utc order by fetched_at desc) = 1)
select {', '.join(FACT_COLUMNS)}, fetched_at from fact""",
    "stream_route_counts": f"""with {INCOMPLETE_SQL}
select count(*) parsed, count(*) filter ({IS_VALID}) valid, count(*) filter (not {IS_VALID}) quarantined
from incomplete""",
    "batch_by_name": f"""with {REFERENCE_SQL}
select a.*, city_name, country_name from airports a
  left join cities using (city_code) left join countries using (country_code)
where airport_code is not null""",
    "stream_by_name": f"""with {FLIGHTS_SQL}
select {', '.join(FACT_COLUMNS)},
  make_timestamp(2024, 1, 1 + event_id // 50 % 3, 4, 0, 0) fetched_at, 'valid' route
from (select * exclude (fetched_at) from flights)""",
    # Brute force: every record number that a run fetched is listed and counted.
    "run_page_gaps": f"""with {FETCH_RUNS_SQL},
totals as (
  select fetch_run, hub, flight_type, slot_start, total_count from pages
  qualify row_number() over (partition by fetch_run, hub, flight_type, slot_start
    order by fetched_at desc, total_count desc) = 1),
expected as (select * exclude (total_count), total_count, unnest(range(0, total_count, 50)) page_offset from totals),
landed as (
  select fetch_run, hub, flight_type, slot_start, record_no // 50 * 50 page_offset, count(*) landed_records
  from (select distinct fetch_run, hub, flight_type, slot_start, unnest(range(page_offset, page_offset + 50)) record_no
    from pages)
  group by all)
select fetch_run, hub, flight_type, slot_start, page_offset,
  least(50, total_count - page_offset) expected_records, coalesce(landed_records, 0) landed_records
from expected left join landed using (fetch_run, hub, flight_type, slot_start, page_offset)
where coalesce(landed_records, 0) < least(50, total_count - page_offset)""",
    "run_coverage_gaps": f"""with {FETCH_RUNS_SQL},
grid as (
  select distinct fetch_run, hub, cast(fetch_run as date) - cast(d as int) "day", slot, flight_type
  from (select distinct fetch_run, hub from pages), range(7) r(d),
    (values ('00:00'), ('04:00'), ('08:00'), ('12:00'), ('16:00'), ('20:00')) s(slot),
    (values ('arrivals'), ('departures')) f(flight_type))
select * from grid except
select fetch_run, hub, cast(slot_start as date), strftime(slot_start, '%H:%M'), flight_type from pages""",
    # Counted from the rows the items are made of, without looking at JSON.
    "schema_drift": f"""with {FLIGHTS_SQL}
select '$' path, 'MarketingCarrier' field, 'object' kind, cast(null as varchar) declared_kind, count(*) items
from flights where event_type = 'click'
union all select '$', 'Codeshares', 'array', null, count(*) from flights where event_type = 'click'
union all select '$.FlightStatus', 'Updated', 'boolean', null, count(*) from flights where event_id % 9 = 0
union all select '$.Departure.Terminal', 'Gate', 'number', 'string', count(*) from flights where dep_gate = 'G1'""",
    # Late events are dropped; of the others every part has its own first ones, as the state of the part before is gone.
    "stream_first_seen_within": """
with parts as (
  select event_id % 3 part, event_id, user_id, event_type,
    event_id = max(event_id) over (partition by event_id % 3) final
  from events)
select user_id, event_type from (
  select distinct part, case when final then -1 - part else user_id end user_id, event_type
  from parts where final or part = 0 or event_id % 5 <> 0)""",
    "stream_gold_hourly": f"with {FACT_FEATURES_SQL}, {HOURLY_STEPS_SQL} select * from ripple",
    "stream_gold_performance": f"with {FACT_FEATURES_SQL} {PERFORMANCE_SELECT}",
    "stream_dim_airports": AIRPORTS_SELECT,
    "stream_landing": f"with {REFERENCE_SQL} select * from aircraft",
    "sql_views": f"""with {FACT_SQL}
select airline_id, count_if(valid)::bigint valid_flights, count_if(not valid)::bigint quarantined_flights,
  0::bigint without_stamp
from (select airline_id, true valid from fact union all
  select airline_id, false from incomplete where not {IS_VALID})
group by airline_id""",
    "stream_first_seen": "select distinct user_id, event_type from events",
}
