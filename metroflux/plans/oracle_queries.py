"""DuckDB oracle text for each name in the query catalogue."""

from __future__ import annotations

from metroflux import oracle as o

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


for _m in ["stg_trips", "demand_basic", "stg_weather", "trips_weather", "trip_metrics",
           "demand_zone_hour", "stg_alerts", "alert_hours", "hourly_disruptions", "subway_impact",
           "dim_location", "dim_time", "dim_weather", "fact_trips"]:
    sql(_m, o.select_model(_m))

sql("surrogate_key", o.with_models("stg_trips") + f"""
select m.pickup_datetime, m.dropoff_datetime, m.pickup_location_id, m.dropoff_location_id,
  m.vendor_id, m.fare_amount, m.trip_distance_miles, m.passenger_count, {o.TRIP_ID} as trip_id
from stg_trips m""")

# --- data quality --------------------------------------------------------------

sql("dq_report", o.suite_sql())
sql("dq_not_null", o.suite_sql({"not_null"}))
sql("dq_unique", o.suite_sql({"unique"}))
sql("dq_accepted", o.suite_sql({"accepted_values"}))
sql("dq_summary", f"""
with r as ({o.suite_sql()})
select coalesce(status, 'TOTAL') as status, count(*) as tests from r group by grouping sets ((status), ())""")

sql("dq_freshness", o.with_models("trips_raw") + """
select max_loaded_at, t.now as snapshotted_at, date_sub('second', max_loaded_at, t.now) as max_loaded_at_time_ago_in_s,
  if(t.now > max_loaded_at + interval 30 day, 'error', if(t.now > max_loaded_at + interval 7 day, 'warn', 'pass')) as status
from (select max(tpep_pickup_datetime) as max_loaded_at from trips_raw) m
cross join (values (timestamp '2024-03-03'), (timestamp '2024-03-14'), (timestamp '2024-05-01')) as t(now)""")

sql("dq_orphans", o.with_models("fact_trips", "dim_location") + """
select f.trip_id, f.pickup_location_id from fact_trips f
left join dim_location d on f.pickup_location_id = d.location_id where d.location_id is null""")

sql("dq_coverage", o.with_models("fact_trips") + """
select trip_id, pickup_datetime, weather_severity from fact_trips where weather_severity is null""")

sql("dq_amount", o.with_models("fact_trips") + f"""
select trip_id, fare_amount, total_amount,
  {o.half_up('(fare_amount - total_amount)', 2)} as adjustment_amount
from fact_trips where total_amount < fare_amount""")

sql("dq_speed", o.with_models("fact_trips", odd=True).replace("trip_distance <= 40", "trip_distance <= 200") + f"""
select trip_id, trip_distance_miles, trip_duration_minutes,
  {o.half_up('(trip_distance_miles / nullif(cast(trip_duration_minutes as double), 0) * 60)', 1)} as implied_speed_mph
from fact_trips where trip_distance_miles > 100 and trip_duration_minutes < 30""")

sql("batch_stats", o.with_models("trips_raw", odd=True) + """
select count(*) as row_count, cast(20 as bigint) as column_count, strftime(tpep_pickup_datetime, '%Y') as data_year,
  strftime(tpep_pickup_datetime, '%m') as data_month, true as schema_validated
from trips_raw where tpep_pickup_datetime is not null group by 3, 4""")

sql("disruptions_across_midnight", o.with_models("stg_alerts") + """
select h::date as alert_date, date_part('hour', h) as hour_of_day,
  count(*) filter (where disruption_severity_score >= 4) as severe_alert_count,
  count(*) filter (where disruption_severity_score >= 2) as moderate_alert_count,
  count(distinct subway_line) as lines_affected, max(disruption_severity_score) as max_severity_score,
  bool_or(is_synthetic) as has_synthetic_data
from (select *, unnest(generate_series(date_trunc('hour', alert_start_datetime), alert_end_datetime, interval 1 hour)) as h from stg_alerts) a
group by 1, 2""")

sql("local_alerts", o.with_models("stg_alerts") + """
select alert_id, subway_line, s as alert_start_datetime, e as alert_end_datetime, date_sub('minute', s, e) as alert_duration_minutes,
  cause, effect, disruption_severity_score, is_synthetic, ingested_at, s::date as alert_date
from (select *, alert_start_datetime at time zone 'UTC' at time zone 'America/New_York' as s,
        alert_end_datetime at time zone 'UTC' at time zone 'America/New_York' as e from stg_alerts) a""")

sql("hour_completeness", o.with_models("stg_weather") + """
select data_year, data_month, make_date(data_year, data_month, 1) as first_day,
  last_day(make_date(data_year, data_month, 1)) as last_day, row_count,
  cast(day(last_day(make_date(data_year, data_month, 1))) * 24 as bigint) as expected_hours,
  row_count = day(last_day(make_date(data_year, data_month, 1))) * 24 as completeness_check
from (select cast(year(weather_datetime) as bigint) as data_year, cast(month(weather_datetime) as bigint) as data_month,
        count(*) as row_count from stg_weather group by 1, 2) g""")

sql("alert_profile", o.with_models("alerts_raw") + """
select count(*) as row_count, count(distinct subway_line) as unique_lines_affected, true as is_synthetic
from alerts_raw""")

# --- reports -------------------------------------------------------------------

_F = o.with_models("fact_trips")


def _kpi_select(where: str = "") -> str:
    return f"""
select count(*) as total_trips, {o.exact_sum('total_amount')} as total_revenue,
  {o.avg_round('fare_amount', 2)} as avg_fare, {o.avg_round('avg_speed_mph', 1)} as avg_speed_mph,
  {o.avg_round('trip_duration_minutes', 2)} as avg_duration_minutes,
  count(*) filter (where has_subway_disruption) as disruption_trips
from fact_trips {where}"""


sql("kpi", _F + _kpi_select())
sql("sliced_kpi", _F + _kpi_select(
    "where analysis_month = 'January' and has_subway_disruption = true "
    "and weather_severity in ('light_rain', 'heavy_rain', 'clear')"))

sql("hourly_by_disruption", _F + f"""
select pickup_hour, has_subway_disruption, count(*) as trips, {o.avg_round('fare_amount', 2)} as avg_fare,
  {o.avg_round('avg_speed_mph', 1)} as avg_speed_mph
from fact_trips group by pickup_hour, has_subway_disruption""")

sql("fare_by_tod", _F + f"""
select time_of_day, has_subway_disruption, {o.avg_round('fare_amount', 2)} as avg_fare,
  {o.avg_round('tip_amount', 2)} as avg_tip, {o.avg_round('tip_percentage', 1)} as avg_tip_percentage
from fact_trips group by time_of_day, has_subway_disruption""")

sql("trips_by_tod", _F + f"""
select time_of_day, has_subway_disruption, count(*) as trips, {o.avg_round('fare_amount', 2)} as avg_fare,
  {o.avg_round('avg_speed_mph', 1)} as avg_speed_mph,
  {o.avg_round('trip_duration_minutes', 1)} as avg_duration_minutes
from fact_trips group by time_of_day, has_subway_disruption""")

sql("monthly_volume", _F + f"""
select cast(date_trunc('month', pickup_date) as date) as month_start, analysis_month, has_subway_disruption,
  count(*) as trips, {o.exact_sum('total_amount')} as revenue, {o.avg_round('fare_amount', 2)} as avg_fare
from fact_trips group by 1, 2, 3""")

_UNFILTERED = o.with_models("trips_raw", extra=[o.STG_TRIPS.replace("stg_trips as (", "unfiltered as (", 1)
    .split("  where rn = 1")[0] + "  where rn = 1\n)"])

sql("fare_bands", _UNFILTERED + f"""
select fare_band, trips, cast({o.rha('10000 * trips', 'sum(trips) over ()')} as double) / 100 as pct_of_total
from (select case when fare_amount < 50 then 'under_50'
                  when fare_amount >= 50 and fare_amount < 100 then '50_to_100'
                  when fare_amount >= 100 and fare_amount <= 150 then '100_to_150'
                  when fare_amount > 150 then 'over_150' end as fare_band, count(*) as trips
      from unfiltered group by 1) b""")

sql("outliers", _UNFILTERED + """
select count(*) as rows_checked,
  count(*) filter (where trip_duration_minutes > 90) as over_max_minutes,
  count(*) filter (where trip_duration_minutes <= 0) as non_positive_minutes,
  count(*) filter (where trip_distance_miles > 40) as over_max_miles,
  count(*) filter (where trip_distance_miles <= 0) as non_positive_miles,
  count(*) filter (where fare_amount > 150) as over_max_fare,
  count(*) filter (where fare_amount <= 0) as non_positive_fare,
  count(*) filter (where trip_duration_minutes > 90 or trip_duration_minutes <= 0
    or trip_distance_miles > 40 or trip_distance_miles <= 0 or fare_amount > 150 or fare_amount <= 0) as any_rule
from unfiltered""")

sql("negative_adjust", _F + f"""
select count(*) as trips,
  {o.avg_round('fare_amount - total_amount', 2)} as avg_gap,
  min(total_amount) as min_total_amount
from fact_trips where total_amount < fare_amount""")

sql("dup_profile", o.with_models("trips_raw") + f"""
select VendorID, count(*) as duplicate_groups, cast(sum(copies - 1) as bigint) as surplus_rows
from (select VendorID, count(*) as copies from trips_raw
      group by VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
        {o.cents('fare_amount')}, {o.cents('trip_distance')}, passenger_count
      having count(*) > 1) g
group by VendorID""")

sql("out_of_window", o.with_models("trips_raw") + f"""
select case when tpep_pickup_datetime is null then 'missing'
            when tpep_pickup_datetime < timestamp '{o.FIXTURE_START}' - interval 1 month
              or tpep_pickup_datetime >= timestamp '{o.FIXTURE_END}' + interval 1 month then 'old_clock'
            when tpep_pickup_datetime < timestamp '{o.FIXTURE_START}' then 'month_overflow_before'
            when tpep_pickup_datetime >= timestamp '{o.FIXTURE_END}' then 'month_overflow_after'
            else 'in_window' end as kind, count(*) as trips
from trips_raw group by 1""")

sql("reduction", o.with_models("stg_trips", "demand_zone_hour") + f"""
select trip_rows, zone_hour_rows,
  cast({o.rha('10000 * (trip_rows - zone_hour_rows)', 'trip_rows')} as double) / 100 as reduction_pct
from (select (select count(*) from stg_trips) as trip_rows,
             (select count(*) from demand_zone_hour) as zone_hour_rows) c""")

sql("holiday", _F + f"""
select is_holiday_period, count(*) as trips, {o.exact_sum('total_amount')} as revenue,
  {o.avg_round('fare_amount', 2)} as avg_fare
from fact_trips group by is_holiday_period""")


_gaps = []
for _c, _n in [("fare_amount", "fare"), ("avg_speed_mph", "speed_mph"), ("trip_duration_minutes", "duration_minutes")]:
    _of = [f"cast({o.avg_round(_c, 2, f' filter (where {w})')} as decimal(22,2))" for w in ("has_subway_disruption", "not has_subway_disruption")]
    _gaps.append(f"cast({_of[0]} - {_of[1]} as double) as {_n}_gap")

sql("disruption_gap", _F + f"""
select time_of_day, count(*) filter (where has_subway_disruption) as disrupted_trips,
  count(*) filter (where not has_subway_disruption) as normal_trips, {", ".join(_gaps)}
from fact_trips group by time_of_day""")

_MEASURES = {"fare": "fare_amount", "total": "total_amount", "tip": "tip_amount", "tip_pct": "tip_percentage", "speed": "avg_speed_mph"}
sql("report_cube", _F + f"""
select cast(date_trunc('month', pickup_date) as date) as month_start, analysis_month, pickup_hour, time_of_day, has_subway_disruption,
  weather_severity, is_holiday_period,
  coalesce({o.TRIP_HOUR_LABELS}[substr({o.TRIP_HOURS}, cast(pickup_hour + 1 as int), 1)], 'off_peak') as trip_time_of_day,
  count(*) as trips, cast(sum(trip_duration_minutes) as bigint) as minutes,
  {", ".join(f"{o.exact_sum(c)} as {m}, count({c}) as {m}_n" for m, c in _MEASURES.items())}
from fact_trips group by 1, 2, 3, 4, 5, 6, 7, 8""")

_PACK = {"kpi": [], "sliced_kpi": [], "hourly_by_disruption": ["pickup_hour", "has_subway_disruption"],
         "fare_by_tod": ["time_of_day", "has_subway_disruption"], "trips_by_tod": ["time_of_day", "has_subway_disruption"],
         "monthly_volume": ["month_start", "analysis_month", "has_subway_disruption"], "holiday": ["is_holiday_period"],
         "disruption_gap": ["time_of_day"]}
_parts = []
for _name, _keys in _PACK.items():
    _slice = f"concat_ws('|', {', '.join(f'cast({k} as varchar)' for k in _keys)})" if _keys else "''"
    _parts.append(f"select '{_name}' as report, slice, measure, value from (unpivot (select {_slice} as slice, "
                  f"columns(* exclude ({', '.join(_keys)}))::double from r_{_name}) on columns(* exclude (slice)) into name measure value value)"
                  .replace("columns(* exclude ())", "columns(*)"))
sql("report_pack", o.with_models("fact_trips", extra=[f"r_{n} as ({ORACLE[n].removeprefix(_F)})" for n in _PACK])
    + "\nunion all\n".join(_parts))

# --- landing and JSON feeds ---------------------------------------------------------

from metroflux.schemas import SUBWAY_LINES as _LINES  # noqa: E402

sql("flatten_weather", o.with_models("weather_raw") + "select * from weather_raw")

_line_list = "[" + ", ".join(f"'{x}'" for x in _LINES) + "]"
sql("flatten_alerts", f"""
with e as (
  select *, cast(epoch(date_trunc('hour', ts)) as bigint) as st from events
  where event_type = 'error' and event_id % 101 <> 0 and event_id % 83 <> 0
    and event_id % 5 <> 0
),
l as (
  select e.*, unnest(case when event_id % 4 = 0
      then [{_line_list}[user_id % 23 + 1], {_line_list}[(user_id + 7) % 23 + 1]]
      else [{_line_list}[user_id % 23 + 1]] end) as subway_line
  from e
)
select concat('a', cast(event_id as varchar)) as alert_id, subway_line,
  case when event_id % 11 = 0 then 'UNKNOWN_CAUSE' when event_id % 5 = 1 then 'ACCIDENT'
       else 'MAINTENANCE' end as cause,
  case event_id % 6 when 0 then 'NO_SERVICE' when 1 then 'SIGNIFICANT_DELAYS'
       when 2 then 'REDUCED_SERVICE' else 'DETOUR' end as effect,
  substr(repeat(props, cast(1 + event_id % 60 as integer)), 1, 500) as header_text,
  case when event_id % 97 = 0 then '' else cast(st as varchar) end as start_time,
  case when event_id % 97 = 0 then '' else cast(st + 3600 * (1 + event_id % 9) as varchar) end as end_time,
  '2024-02-01T00:00:00' as ingested_at
from l""")

sql("load_manifest", o.with_models("trips_raw", "weather_raw", "alerts_raw", odd=True) + """
select 'trips' as source, strftime(tpep_pickup_datetime, '%Y') as data_year,
  strftime(tpep_pickup_datetime, '%m') as data_month, count(*) as row_count, 'success' as status
from trips_raw where tpep_pickup_datetime is not null group by 2, 3
union all
select 'weather', substr(datetime_hour, 1, 4), substr(datetime_hour, 6, 2), count(*), 'success'
from weather_raw group by 2, 3
union all
select 'mta_alerts', strftime(to_timestamp(cast(start_time as bigint)) at time zone 'UTC', '%Y'),
  strftime(to_timestamp(cast(start_time as bigint)) at time zone 'UTC', '%m'), count(*), 'success'
from alerts_raw group by 2, 3""")

# --- second shape ---------------------------------------------------------------------

sql("dedupe_lineitem", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate
from (select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey nulls first, l_suppkey nulls first, l_quantity nulls first,
          l_extendedprice nulls first, l_discount nulls first, l_tax nulls first,
          l_returnflag nulls first, l_linestatus nulls first, l_shipdate nulls first) as rn
      from lineitem) d
where rn = 1""")

sql("orders_star", """
with s as (
  select o.o_orderkey, cast(o.o_orderdate as timestamp) as o_orderdate,
    cast(year(o.o_orderdate) as bigint) as order_year, cast(month(o.o_orderdate) as bigint) as order_month,
    cast(dayofweek(o.o_orderdate) + 1 as bigint) as order_day_of_week,
    dayofweek(o.o_orderdate) in (0, 6) as is_weekend,
    o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
    c.c_name as customer_name, c.c_mktsegment as customer_segment,
    n.n_name as customer_nation, r.r_name as customer_region, o.o_custkey
  from orders o
  left join customer c on o.o_custkey = c.c_custkey
  left join nation n on c.c_nationkey = n.n_nationkey
  left join region r on n.n_regionkey = r.r_regionkey
)
select *, md5(concat_ws('-', coalesce(cast(o_orderkey as varchar), '_null_'),
    coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '_null_'),
    coalesce(cast(o_custkey as varchar), '_null_'))) as order_id
from s""")

sql("dq_lineitem_orphans", """
select l.l_orderkey, l.l_linenumber from lineitem l
where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_orderstatus <> 'P')""")

sql("incremental_landing", o.with_models("trips_raw", odd=True) + """
select strftime(tpep_pickup_datetime, '%Y') as data_year, strftime(tpep_pickup_datetime, '%m') as data_month,
  count(*) as row_count
from trips_raw where tpep_pickup_datetime is not null group by 1, 2""")


sql("landed_trips", o.with_models("trips_raw", odd=True) + """
select t.*, strftime(tpep_pickup_datetime, '%Y') as year, strftime(tpep_pickup_datetime, '%m') as month,
  strftime(tpep_pickup_datetime, '%Y-%m-%d') as day, '2024-02-01T00:00:00' as _ingested_at, 'trips' as _source,
  '1.0.0' as _pipeline_version, 'development' as _environment
from trips_raw t where tpep_pickup_datetime is not null""")

sql("feed_rejects", """
select 'alerts' as feed, count(*) as rejects from events
where event_type = 'error' and (event_id % 101 = 0 or event_id % 83 = 0)
union all select 'weather', count(distinct date_trunc('month', ts)) from events
  where extract(day from ts) % 11 <> 5 or extract(hour from ts) <> 3""")

sql("landed_drift", o.with_models("trips_raw", odd=True) + """
select tpep_pickup_datetime, VendorID, cast(passenger_count as double) as passenger_count, RatecodeID, PULocationID, DOLocationID,
       fare_amount, Airport_fee,
       case when tpep_pickup_datetime < timestamp '2024-02-01' then cbd_congestion_fee end as cbd_congestion_fee,
       case when tpep_pickup_datetime >= timestamp '2024-02-01' and VendorID = 1 then 'app' end as booking
from trips_raw where tpep_pickup_datetime is not null
""")

# the departures are stated; how many rows they concern is counted
sql("schema_drift", o.with_models("trips_raw", odd=True) + """
, departures(later, batch, column_name, kind, found, merged) as (values
    (true, 'after 2024-01', 'RatecodeID', 'type', 'int', 'bigint'),
    (true, 'after 2024-01', 'Airport_fee', 'name', 'airport_fee', 'Airport_fee'),
    (true, 'after 2024-01', 'cbd_congestion_fee', 'missing', null, 'double'),
    (false, 'to 2024-01', 'passenger_count', 'type', 'bigint', 'double'),
    (false, 'to 2024-01', 'booking', 'missing', null, 'string')),
counted as (select tpep_pickup_datetime >= timestamp '2024-02-01' as later, count(*) as row_count
            from trips_raw where tpep_pickup_datetime is not null group by 1)
select batch, column_name, kind, found, merged, row_count
from departures join counted using (later)
""")

sql("landing_balance", o.with_models("trips_raw", "weather_raw", "alerts_raw", odd=True) + """
select 'trips' as source, count(*) as input_rows, count(tpep_pickup_datetime) as accepted,
  count(*) filter (where tpep_pickup_datetime is null) as rejected from trips_raw
union all
select 'weather', hours + months, hours, months
from (select count(*) as hours, count(distinct substr(datetime_hour, 1, 7)) as months from weather_raw) w
union all
select 'mta_alerts', count(*), count(start_time), 0 from alerts_raw""")

sql("landed_rejects", o.with_models("trips_raw", odd=True) + """
select tpep_dropoff_datetime, VendorID, PULocationID, DOLocationID, fare_amount, '2024-02-01T00:00:00' as _ingested_at,
  'no time' as reason
from trips_raw where tpep_pickup_datetime is null""")

sql("landed_zone", o.with_models("trips_raw", odd=True) + """
select tpep_pickup_datetime, PULocationID, DOLocationID, trip_distance, fare_amount
from trips_raw where tpep_pickup_datetime is not null and DOLocationID = 77""")

sql("landed_alerts", "select alert_id, subway_line, cause, effect, header_text, start_time, end_time, null as reject from ("
    + ORACLE["flatten_alerts"] + """) a
union all
select null, null, null, null, null, null, null, case when event_id % 101 = 0 then 'unreadable entity' else 'empty period list' end
from events where event_type = 'error' and (event_id % 101 = 0 or event_id % 83 = 0)""")
