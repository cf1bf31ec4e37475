"""The registered queries as SQL over the given tables, written independently of Spark code."""

from __future__ import annotations

# The readings derived from events (see fixtures.readings).
READINGS = """
readings as (
  select date_trunc('day', ts) + to_hours(cast(hour(ts) // 6 * 6 as bigint)) as index_record_ts,
         'WORLD' as country,
         concat('R_', user_id % 10 % 5 % 2) as state,
         concat('C', user_id % 10 % 5) as city,
         concat('S', user_id % 10) as station,
         cast(user_id % 10 as decimal(12,7)) as latitude,
         cast(user_id % 10 * 2 as decimal(12,7)) as longitude,
         case event_id % 7 when 0 then 'PM2.5' when 1 then 'PM10' when 2 then 'SO2' when 3 then 'NO2'
                           when 4 then 'NH3' when 5 then 'CO' else 'OZONE' end as pollutant_id,
         case when value < 2 then 'NA' else cast(cast(floor(value) as bigint) as varchar) end
           as pollutant_avg
  from events
)"""

_COLUMNS = {
    "pm25_avg": "PM2.5",
    "pm10_avg": "PM10",
    "so2_avg": "SO2",
    "no2_avg": "NO2",
    "nh3_avg": "NH3",
    "co_avg": "CO",
    "o3_avg": "OZONE",
}
_KEYS = "index_record_ts, country, state, city, station, latitude, longitude"
_MEASURES = ", ".join(_COLUMNS)


def _each(template: str, separator: str = ", ") -> str:
    return separator.join(template.format(c=c, code=code) for c, code in _COLUMNS.items())


def _pivot(value: str) -> str:
    return _each(f"max(case when pollutant_id = '{{code}}' then {value} end) as {{c}}")


PIVOTED = READINGS + f""",
pivoted as (select {_KEYS}, {_pivot('pollutant_avg')} from readings group by all)"""

_CLEAN = _each(
    "case when {c} = 'NA' or {c} is null then 0.0::double else round(cast({c} as double)) end as {c}"
)
WIDE = PIVOTED + f""",
wide as (
  select index_record_ts, country, replace(state, '_', ' ') as state, city, station,
         latitude, longitude, {_CLEAN}
  from pivoted
)"""

_FILLED = {c: f"coalesce({c}, 0)" for c in _COLUMNS}
_ABOVE = {c: " and ".join(f"{_FILLED[c]} >= {o}" for o in _FILLED.values()) for c in _COLUMNS}
PROMINENT = (
    f"case when {_ABOVE['pm25_avg']} then 'PM25' when {_ABOVE['pm10_avg']} then 'PM10' "
    f"when {_ABOVE['so2_avg']} then 'SO2' when {_ABOVE['no2_avg']} then 'NO2' "
    f"when {_ABOVE['nh3_avg']} then 'NH3' when {_ABOVE['co_avg']} then 'CO' else 'O3' end"
)
_GASES = " + ".join(
    f"(case when {c} <> 0 then 1 else 0 end)" for c in list(_COLUMNS)[2:]
)
CRITERIA = (
    "cast((case when pm25_avg > 0 or pm10_avg > 0 then 1 else 0 end) "
    f"+ least(2, {_GASES}) as int)"
)
AQI = f"case when {CRITERIA} > 2 then greatest({_MEASURES}) else 0.0::double end"
_INDEX = f"{PROMINENT} as prominent_pollutant, {AQI} as aqi"

FACT = WIDE + f""",
fact as (select {_KEYS}, {_MEASURES}, {_INDEX} from wide),
stations as (select distinct latitude, longitude, country, state, city, station from wide),
times as (select distinct index_record_ts as measurement_time from wide)"""

_FROM_STAR = """
  from fact f
  join times d on f.index_record_ts = d.measurement_time
  join stations l on f.latitude = l.latitude and f.longitude = l.longitude"""
_AVERAGES = _each("avg({c}) as {c}")
HOURS = FACT + f""",
hour_means as (
  select d.measurement_time, l.country, l.state, l.city, {_AVERAGES} {_FROM_STAR}
  group by all
),
hours as (select *, {_INDEX} from hour_means)"""

# Readings with shared coordinates, a renamed station and missing values.
_SPREAD = """,
spread as (
  select index_record_ts, country, state, city,
         case when station = 'S3' and day(index_record_ts) >= 15 then 'S3 new' else station end
           as station,
         cast(floor(latitude / 3) as decimal(12,7)) as latitude,
         cast(7 as decimal(12,7)) as longitude, pollutant_id,
         case when pollutant_avg <> '5' then pollutant_avg end as pollutant_avg
  from readings
)"""
SHARED_HOURS = READINGS + _SPREAD + HOURS.removeprefix(READINGS).replace(
    "from readings", "from spread"
)

# Readings with the stations of even number on one coordinate.
_HOT = """,
hot as (
  select index_record_ts, country, state, city, station,
         case when latitude % 2 = 0 then cast(0 as decimal(12,7)) else latitude end as latitude,
         case when latitude % 2 = 0 then cast(0 as decimal(12,7)) else longitude end as longitude,
         pollutant_id, pollutant_avg
  from readings
)"""
HOT_HOURS = READINGS + _HOT + HOURS.removeprefix(READINGS).replace("from readings", "from hot")

DAYS = HOURS + f""",
day_means as (
  select cast(measurement_time as date) as measurement_date, country, state, city,
         {_each('round(round(avg({c}), 6)) as {c}')}
  from hours group by all
),
days as (select *, {_INDEX} from day_means)"""

_PARTS = """cast(year({t}) as int) as aqi_year, cast(month({t}) as int) as aqi_month,
  cast(quarter({t}) as int) as aqi_quarter, cast(day({t}) as int) as aqi_day"""

# The documents derived from events (see fixtures.documents); i numbers the records.
_HOUR = "date_trunc('hour', ts)"
DOCUMENTS = f"""
documents_ as (
  select *, {_HOUR} as index_record_ts, concat('doc_', event_id) as _stg_file_name,
         event_id % 4 as n
  from events
),
dated as (select * from documents_ where n > 0)"""


def _flat(source: str) -> str:
    return f"""
select index_record_ts, 'WORLD' as country, concat('R_', user_id % 10 % 5 % 2) as state,
       concat('C', user_id % 10 % 5) as city, concat('S', user_id % 10) as station,
       cast(user_id % 10 as decimal(12,7)) as latitude,
       cast(user_id % 10 * 2 as decimal(12,7)) as longitude,
       case (event_id + i) % 7 when 0 then 'PM2.5' when 1 then 'PM10' when 2 then 'SO2'
            when 3 then 'NO2' when 4 then 'NH3' when 5 then 'CO' else 'OZONE' end as pollutant_id,
       cast(cast(floor(value) as bigint) + i + 1 as varchar) as pollutant_max,
       cast(cast(floor(value) as bigint) + i as varchar) as pollutant_min,
       case when value < 2 then 'NA' else cast(cast(floor(value) as bigint) + i as varchar) end
         as pollutant_avg,
       _stg_file_name
from (select *, unnest(range(n)) as i from {source})"""


def _members(kind: str, column: str, source: str, where: str = "true", order: str = "asc") -> str:
    return (
        f"select '{kind}' as kind, cast(row_number() over (order by member {order}) as int) as "
        f"position, member from (select distinct cast({column} as varchar) as member "
        f"from {source} where {where})"
    )


_ONE_CITY = "state = 'R 0' and city = 'C2'"
_ONE_DAY = "date '2024-01-10'"

ORACLES = {
    "q_json_path": """
select event_id, cast(json_extract_string(props, '$.k') as int) as k,
       cast(json_extract_string(props, '$.missing') as int) as missing,
       case when event_id % 4 > 0
            then cast(cast(floor(value) as bigint) as varchar) end as first_min
from events""",
    "q_parse_ts": """
select event_id,
       case event_id % 5 when 1 then null when 2 then null
                         else date_trunc('second', ts) end as parsed
from events""",
    "q_bronze_documents": f"""
with {DOCUMENTS}
select event_id as id, case when n > 0 then index_record_ts end as index_record_ts,
       n as record_count, '1.0' as json_version, _stg_file_name, ts as _stg_file_load_ts,
       case when n = 0 then 'no readable last_update in the first record' end as reject_reason
from documents_""",
    "q_flatten_records": f"with {DOCUMENTS} select * exclude (index_record_ts, latitude, longitude)"
    f" from ({_flat('documents_')})",
    "q_flatten_parsed": f"with {DOCUMENTS} select * exclude (index_record_ts, latitude, longitude)"
    f" from ({_flat('documents_')})",
    "q_silver_long": f"""
with {DOCUMENTS},
newest as (
  select * from dated
  qualify row_number() over (partition by index_record_ts order by ts desc, _stg_file_name desc) = 1
)
{_flat('newest')}""",
    "q_latest_per_key": """
select user_id, event_id, ts, event_type, value from events where user_id is not null
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "q_file_rank_audit": f"""
with {DOCUMENTS}
select index_record_ts, n as record_count, '1.0' as json_version, _stg_file_name,
       ts as _stg_file_load_ts,
       cast(row_number() over (partition by index_record_ts
                               order by ts desc, _stg_file_name desc) as int) as latest_file_rank
from dated""",
    "q_file_rank_audit_top": f"""
with {DOCUMENTS}
select index_record_ts, n as record_count, '1.0' as json_version, _stg_file_name,
       ts as _stg_file_load_ts,
       cast(row_number() over (partition by index_record_ts
                               order by ts desc, _stg_file_name desc) as int) as latest_file_rank
from dated order by index_record_ts desc, latest_file_rank limit 10""",
    "q_bronze_ids": f"with {DOCUMENTS} select event_id as id, index_record_ts from dated",
    "q_load_once": """
with incoming as (
  select concat('doc_', event_id) as _stg_file_name,
         md5(concat(event_type, '|', props)) as _stg_file_md5 from events
),
loaded as (
  select concat('doc_', event_id) as _stg_file_name,
         md5(concat(event_type, '|', case when event_id % 3 = 0 then 'old' else props end))
           as _stg_file_md5 from events
)
select * from incoming i where not exists (
  select 1 from loaded l
  where l._stg_file_name = i._stg_file_name and l._stg_file_md5 = i._stg_file_md5)""",
    "q_pivot_long_to_wide": f"with {PIVOTED} select * from pivoted",
    "q_pivot_numeric": f"""
with {READINGS}
select {_KEYS}, {_pivot('try_cast(pollutant_avg as double)')} from readings group by all""",
    "q_clean_numeric": f"""
with {READINGS}
select index_record_ts, station, pollutant_id, pollutant_avg,
       case when pollutant_avg = 'NA' or pollutant_avg is null then 0.0::double
            else round(cast(pollutant_avg as double)) end as cleaned
from readings""",
    "q_wide_clean": f"with {WIDE} select * from wide",
    "q_dim_date": f"""
with {WIDE}
select distinct index_record_ts as measurement_time, {_PARTS.format(t='index_record_ts')},
       cast(hour(index_record_ts) + 1 as int) as aqi_hour
from wide""",
    "q_dim_location": f"with {FACT} select * from stations",
    "q_fact": f"with {FACT} select * from fact",
    "q_prominent": f"with {WIDE} select {_KEYS}, {PROMINENT} as prominent_pollutant from wide",
    "q_criteria": f"with {WIDE} select {_KEYS}, {CRITERIA} as criteria from wide",
    "q_aqi_rule": f"with {WIDE} select {_KEYS}, {AQI} as aqi from wide",
    "q_sql_udf": f"with {WIDE} select {_KEYS}, {CRITERIA} as criteria, {_INDEX} from wide",
    "q_star_join": f"""
with {FACT}
select d.measurement_time, l.country, l.state, l.city, l.station, {_MEASURES},
       prominent_pollutant, aqi {_FROM_STAR}""",
    "q_star_join_fanout": """
with dim as (select distinct n_regionkey as location_pk, n_name from nation)
select c.c_custkey, n.n_nationkey, d.n_name
from customer c
join nation n on c.c_nationkey = n.n_nationkey
join dim d on n.n_regionkey = d.location_pk""",
    "q_key_uniqueness": """
with dim as (select distinct n_regionkey as location_pk, n_name from nation)
select location_pk, count(*) as occurrences from dim group by 1 having count(*) > 1""",
    "q_city_hour": f"with {HOURS} select * from hours",
    "q_city_hour_shared": f"with {SHARED_HOURS} select * from hours",
    "q_city_hour_hot": f"with {HOT_HOURS} select * from hours",
    "q_star_join_hot": f"""
with {HOT_HOURS}
select d.measurement_time, f.station as fact_station, l.country, l.state, l.city, l.station,
       {_MEASURES} {_FROM_STAR}""",
    "q_city_hour_head": f"""
with {HOURS}
select * from hours order by country, state, city, measurement_time limit 100""",
    "q_city_hour_lookup": f"""
with {HOURS}
select * from hours where city = 'C2' and measurement_time = timestamp '2024-01-10 12:00:00'""",
    "q_city_hour_draft": f"""
with {FACT},
draft as (select d.measurement_time, l.state, l.city, {_AVERAGES} {_FROM_STAR} group by all)
select *, {_INDEX} from draft""",
    "q_city_day": f"with {DAYS} select * from days",
    "q_top_cities_latest_day": f"""
with {DAYS}
select state, city, {_MEASURES}, prominent_pollutant, aqi from days
where measurement_date = (select max(measurement_date) from days)
order by aqi desc, state, city limit 3""",
    "q_members": f"with {HOURS} "
    + " union all ".join(
        [
            _members("states by hour", "state", "hours"),
            _members("cities of a state by hour", "city", "hours", "state = 'R 0'", "desc"),
            _members(
                "dates of a city by hour",
                "cast(measurement_time as date)",
                "hours",
                _ONE_CITY,
                "desc",
            ),
            _members("states", "state", "stations", order="desc"),
            _members("cities of a state", "city", "stations", "state = 'R 0'"),
            _members("stations of a city", "station", "stations", _ONE_CITY),
            _members("dates", "cast(measurement_time as date)", "times"),
        ]
    ),
    "q_city_hourly_trend": f"""
with {HOURS}
select cast(hour(measurement_time) as int) as hour, {_MEASURES} from hours
where {_ONE_CITY} and cast(measurement_time as date) = {_ONE_DAY}""",
    "q_station_drilldown": f"""
with {FACT}
select cast(hour(d.measurement_time) as int) as hour, l.state, l.city, l.station,
       cast(l.latitude as decimal(10,7)) as latitude,
       cast(l.longitude as decimal(10,7)) as longitude,
       {_MEASURES}, prominent_pollutant, aqi
from fact f
join times d on f.index_record_ts = d.measurement_time
            and cast(d.measurement_time as date) = {_ONE_DAY}
join stations l on f.latitude = l.latitude and f.longitude = l.longitude
            and l.state = 'R 0' and l.city = 'C2' and l.station = 'S7'""",
    "q_hourly_index": f"""
with {FACT}
select cast(hour(index_record_ts) as int) as hour, aqi from fact
where state = 'R 0' and station = 'S7' and cast(index_record_ts as date) = {_ONE_DAY}""",
    "q_hourly_pollutants": f"""
with {FACT}
select cast(hour(index_record_ts) as int) as hour, {_MEASURES} from fact
where state = 'R 0' and station = 'S7' and cast(index_record_ts as date) = {_ONE_DAY}""",
    "q_map_points": f"""
with {FACT}
select cast(latitude as double) as lat, cast(longitude as double) as lon from stations""",
    "q_station_inspect": f"""
with {READINGS}
select cast(hour(index_record_ts) as int) as measurement_hours, * from readings
where country = 'WORLD' and state = 'R_0' and station = 'S7'""",
    "q_station_inspect_wide": f"""
with {WIDE}
select cast(hour(index_record_ts) as int) as measurement_hours, * from wide
where country = 'WORLD' and state = 'R 0' and station = 'S7'""",
    "q_fact_point_lookup": f"""
with {FACT}
select {_MEASURES}, prominent_pollutant, aqi from fact
where city = 'C2' and station = 'S7' and index_record_ts = timestamp '2024-01-10 12:00:00'""",
    "q_station_denorm": f"""
with {FACT}
select index_record_ts, {_PARTS.format(t='index_record_ts')},
       cast(hour(index_record_ts) as int) as aqi_hour, * exclude (index_record_ts)
from fact""",
    "q_station_hours_draft": f"""
with {WIDE}
select distinct index_record_ts as measurement_time, {_PARTS.format(t='index_record_ts')},
       cast(hour(index_record_ts) as int) as aqi_hour
from wide""",
    "q_any_rows": f"""
with {WIDE}
select least(10, count(*)) as n_rows, cast(0 as bigint) as n_foreign from wide""",
    "q_lake_city_day": f"with {DAYS} select * from days",
    "q_lake_loads": f"""
with {READINGS}
select folder, count(distinct index_record_ts) as n_documents, count(*) as n_records
from readings, (values ('draft'), ('complete')) as folders(folder) group by folder
union all
select 'broken', count(*), null from nation""",
    "q_sql_questions": f"""
with {DAYS}
(select 'top' as question, state, city, null::varchar as station, null::int as hour, pm25_avg, o3_avg, aqi
 from days where measurement_date = (select max(measurement_date) from days)
 order by aqi desc, state, city limit 3)
union all
select 'trend', state, city, null, hour(measurement_time)::int, pm25_avg, o3_avg, null from hours
where state = 'R 0' and city = 'C2' and cast(measurement_time as date) = date '2024-01-10'
union all
select 'at', state, city, null, hour(measurement_time)::int, pm25_avg, o3_avg, aqi from hours
where city = 'C2' and measurement_time = timestamp '2024-01-10 12:00:00'
union all
select 'station', l.state, l.city, l.station, hour(d.measurement_time)::int, f.pm25_avg, f.o3_avg, f.aqi
{_FROM_STAR}
where l.state = 'R 0' and l.city = 'C2' and l.station = 'S7'
  and cast(d.measurement_time as date) = date '2024-01-10'""",
    "q_staged_preview": """
select least(count(*), 10) as n_rows, true as just_loaded, 0::bigint as n_foreign from events""",
    "q_row_ids": """
select load::int as load, count(*) as n, count(distinct event_id) as n_ids, true as rises
from events, range(1, 4) loads(load) group by load""",
    "q_file_inventory": """
select 'region-' || n_regionkey || '.txt' as name, sum(strlen(n_name) + 1)::bigint as length, true as dated
from nation group by n_regionkey""",
    "q_lake_files": f"""
with {READINGS},
days as (
  select cast(index_record_ts as date) as day, count(*) as n_complete,
         count(distinct index_record_ts) as n_hours
  from readings group by all)
select day,
       case when day(day) % 3 <> 0 and day(day) % 2 = 1 then 'renamed-' else 'day-' end || day || '.txt'
         as _stg_file_name,
       case when day(day) % 3 <> 0 and day(day) % 2 = 0 then n_complete else n_hours end as n_records,
       case when day(day) % 3 = 0 then 3 else 2 end::bigint as n_versions,
       case when n_complete > n_hours and (day(day) % 3 = 0 or day(day) % 2 = 0) then 2 else 1 end::bigint
         as n_checksums
from days""",
    "q_split_documents": """
with days as (
  select cast(ts as date) as day, count(*) as n, arg_min(ts, event_id) as first_ts,
         day(day) % 5 <> 0 as ended
  from events group by 1),
by_station as (
  select cast(ts as date) as day, concat('S', user_id % 10) as station, count(*) as n_records,
         count(distinct event_type) as n_kinds, sum(cast(floor(value) as bigint))::bigint as total_avg
  from events group by 1, 2)
select 'day-' || d.day || '.txt' as _stg_file_name,
       case when ended then date_trunc('second', first_ts)::timestamp end as index_record_ts,
       case when ended then n else 0 end::bigint as record_count,
       ended as was_split,
       case when not ended then 'malformed JSON' end as reject_reason,
       station, n_records, n_kinds, total_avg
from days d left join by_station s on d.day = s.day and ended""",
    "q_inserted_documents": f"""
with {READINGS},
hours as (
  select index_record_ts, count(*) as n, dayofyear(index_record_ts) % 3 = 0 as timeless
  from readings group by 1)
select case when not timeless then cast(index_record_ts as date) end as day,
       case when timeless then 7 else 0 end::bigint as record_count,
       case when timeless then '2.0' else '1.0' end as json_version,
       case when timeless then 'no index_record_ts' end as reject_reason,
       count(*) as n_documents, sum(n)::bigint as n_records, count(*) as n_dated
from hours group by all""",
    "q_odd_documents": f"""
with {DOCUMENTS},
judged as (select *, event_id % 8 in (0, 1, 2, 3, 6) as spoiled from documents_)
select event_id, case when not spoiled then '1.0' end as json_version,
       case when not spoiled then cast(n as int) end as n_records,
       case when spoiled then 'malformed JSON'
            when n = 0 then 'no readable last_update in the first record' end as reject_reason
from judged""",
}
