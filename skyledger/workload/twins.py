"""SQL building blocks for the DuckDB twins of the registered queries.

The twins merge archives in two steps (pivot per archive, then merge) and number rows with plain
windows, so they share no method with the Spark plans.
"""

from __future__ import annotations

RAW = """
select cast(l_suppkey + 1 as bigint) as station_id,
       case when l_suppkey % 10 = 1 then date '1995-01-01' + cast(date_diff('day', date '1995-01-01', cast(l_shipdate as date)) % 40 as int)
            else cast(l_shipdate as date) end as obs_date,
       case l_linenumber % 5 when 0 then 'TN' when 1 then 'TX' when 2 then 'TG' when 3 then 'RR' else 'FG' end as element,
       (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey as line_no,
       cast(case when l_partkey % 37 = 0 then -9999
                 when l_partkey % 101 = 0 then 650
                 when l_partkey % 53 = 0 then -400
                 when l_linenumber % 5 = 3 then cast(floor(l_extendedprice) as bigint) % 6000
                 when l_linenumber % 5 = 4 then cast(floor(l_extendedprice) as bigint) % 700
                 else cast(floor(l_extendedprice) as bigint) % 300 - 50 + 40 * (case l_linenumber % 5 when 0 then -1 when 1 then 1 else 0 end) end as int) as tenths,
       cast(case l_returnflag when 'A' then 1 when 'R' then 0 else case when l_partkey % 29 = 0 then 9 else 0 end end as int) as qflag,
       l_partkey, l_orderkey
from lineitem
"""

STATIONS = """
select cast(s_suppkey + 1 as bigint) as station_id, s_name as station_name,
       case when n_regionkey = 3 then 'GB' else 'IE' end as country,
       49.5::double + (s_suppkey % 115)::double / 10.0::double as latitude,
       -8.0::double + (s_suppkey % 100)::double / 10.0::double as longitude
from supplier join nation on s_nationkey = n_nationkey
where s_suppkey % 10 <> 0
"""

SUPPLIER_STATIONS = """
select cast(s_suppkey as bigint) as station_id, s_name as station_name,
       case s_nationkey % 4 when 0 then 'GB' when 1 then 'uk' when 2 then 'United Kingdom' else 'IE' end as country,
       48.0::double + (s_suppkey * 37 % 1400)::double / 100.0::double as latitude,
       -9.0::double + (s_suppkey * 61 % 1200)::double / 100.0::double as longitude
from supplier
"""

_RANK = "case element when 'TN' then 0 when 'TX' then 1 when 'TG' then 2 when 'RR' then 3 else 4 end"
_VALUE = "cast(cast({} as float) / cast(10 as float) as float)"
_TEMPS = "element in ('TN', 'TX', 'TG')"

OBS = f"""
select station_id, obs_date, element, line_no, {_VALUE.format('tenths')} as value, qflag, {_RANK} as mr
from raw where tenths <> -9999
"""

ARCHIVE_OBS = f"""
select archive_ord, station_id, obs_date, element, line_no,
       {_VALUE.format('tenths + case when archive_ord = 3 then 5 else 0 end')} as value,
       case when archive_ord = 3 and l_partkey % 2 = 0 then 1 else qflag end as qflag, {_RANK} as mr
from (
  select *, case when element in ('TN', 'TX') then 0 when element = 'TG' then 1 else 2 end as archive_ord from raw
  union all
  select *, 3 as archive_ord from raw where l_partkey % 7 = 0
) where tenths <> -9999
"""

ARCHIVE_STATIONS = """
select station_id, station_name || '/' || archive as station_name, country, latitude, longitude,
       archive_ord, archive
from stations, (values (0, 'a'), (1, 'b'), (2, 'c'), (3, 'd')) t(archive_ord, archive)
where archive <> 'd' or station_id % 17 <> 5
"""

_VALUES = """
  arg_max(value, line_no) filter (where element = 'TN') as temp_min,
  arg_max(value, line_no) filter (where element = 'TX') as temp_max,
  arg_max(value, line_no) filter (where element = 'TG') as temp_avg,
  arg_max(value, line_no) filter (where element = 'RR') as precipitation,
  arg_max(value, line_no) filter (where element = 'FG') as wind_speed,
  cast(arg_max(qflag, line_no) filter (where element = 'RR') as varchar) as precip_quality,
  cast(arg_max(qflag, line_no) filter (where element = 'FG') as varchar) as wind_quality
"""
_COMPACT = f"""
  list_reduce(list(cast(qflag as varchar) order by mr, line_no) filter (where {_TEMPS}),
              lambda a, b: case when contains(a, b) then a else a || b end) as temp_quality
"""
_POSITIONAL = f"""
  case when count(*) filter (where {_TEMPS}) > 0 then
    coalesce(cast(arg_max(qflag, line_no) filter (where element = 'TN') as varchar), '9') ||
    coalesce(cast(arg_max(qflag, line_no) filter (where element = 'TG') as varchar), '9') ||
    coalesce(cast(arg_max(qflag, line_no) filter (where element = 'TX') as varchar), '9') end as temp_quality
"""


def _wide(source: str, keys: str, flags: str, where: str) -> str:
    return f"select {keys}, obs_date as date, {_VALUES}, {flags} from {source} where {where} group by {keys}, obs_date"


def _graded(source: str, extra: str = "") -> str:
    return f"""
select {extra} station_id, station_name, date, latitude, longitude, temp_min, temp_max, temp_avg, precipitation,
  wind_speed, temp_quality, precip_quality, wind_quality,
  case when temp_min not between -90 and 60 then 'Invalid' when temp_min not between -35 and 45 then 'Suspect'
       when temp_max not between -90 and 60 then 'Invalid' when temp_max not between -35 and 45 then 'Suspect'
       when temp_avg not between -90 and 60 then 'Invalid' when temp_avg not between -35 and 45 then 'Suspect'
       when temp_min is not null or temp_max is not null or temp_avg is not null then 'Valid' end as temp_validation,
  case when precipitation not between 0 and 2000 then 'Invalid' when precipitation > 500 then 'Suspect'
       when precipitation is not null then 'Valid' end as precip_validation,
  case when wind_speed not between 0 and 120 then 'Invalid' when wind_speed > 50 then 'Suspect'
       when wind_speed is not null then 'Valid' end as wind_validation
from {source}
"""


_KNOWN = "station_id in (select station_id from stations)"
_KNOWN_ARCHIVE = "(archive_ord, station_id) in (select (archive_ord, station_id) from archive_stations)"
_MERGED = """
select station_id, date,
  arg_max(temp_min, archive_ord) filter (where temp_min is not null) as temp_min,
  arg_max(temp_max, archive_ord) filter (where temp_max is not null) as temp_max,
  arg_max(temp_avg, archive_ord) filter (where temp_avg is not null) as temp_avg,
  arg_max(precipitation, archive_ord) filter (where precipitation is not null) as precipitation,
  arg_max(wind_speed, archive_ord) filter (where wind_speed is not null) as wind_speed,
  {temp_quality} as temp_quality,
  arg_max(precip_quality, archive_ord) filter (where precip_quality is not null) as precip_quality,
  arg_max(wind_quality, archive_ord) filter (where wind_quality is not null) as wind_quality,
  arg_min(station_name, archive_ord) as station_name,
  arg_min(latitude, archive_ord) as latitude,
  arg_min(longitude, archive_ord) as longitude
from {source} group by station_id, date
"""
_MERGED_POSITIONAL = """case when max(temp_quality) is not null then
  coalesce(arg_max(temp_quality[1], archive_ord) filter (where temp_min is not null), '9') ||
  coalesce(arg_max(temp_quality[2], archive_ord) filter (where temp_avg is not null), '9') ||
  coalesce(arg_max(temp_quality[3], archive_ord) filter (where temp_max is not null), '9') end"""

BREAK = """case when temp_min is not null and temp_avg is not null and temp_max is not null and temp_min > temp_avg + cast(1 as float) then 'MinGreaterThanAvg'
  when temp_min is not null and temp_avg is not null and temp_max is not null and temp_avg > temp_max + cast(1 as float) then 'AvgGreaterThanMax'
  when latitude not between -90 and 90 or longitude not between -180 and 180 or temp_min not between -50 and 50
    or temp_max not between -50 and 50 or temp_avg not between -50 and 50 or precipitation not between 0 and 1000
    or wind_speed not between 0 and 100 then 'OutOfRange' end"""

HAS_TEMP = "(temp_min is not null or temp_max is not null or temp_avg is not null)"
FLAG_VALID = "coalesce(temp_quality = '000', false)"
ALL_VALID = f"({FLAG_VALID} and coalesce(precip_quality = '0', false) and coalesce(wind_quality = '0', false))"


def any_flag(d: str) -> str:
    return " or ".join(f"coalesce(contains({c}, '{d}'), false)" for c in ("temp_quality", "precip_quality", "wind_quality"))


def _assess(flag_missing: str, flag_suspect: str, validity: str) -> str:
    return f"""case when {flag_missing} then 'Missing' when {validity} = 'Invalid' then 'Invalid'
      when {flag_suspect} and {validity} = 'Suspect' then 'SuspectBoth' when {flag_suspect} then 'SuspectOriginal'
      when {validity} = 'Suspect' then 'SuspectRange' else 'Valid' end"""


TEMP_Q = _assess("contains(temp_quality, '9')", "contains(temp_quality, '1')", "temp_validation")
RAIN_Q = _assess("precip_quality = '9'", "precip_quality = '1'", "precip_validation")
WIND_Q = _assess("wind_quality = '9'", "wind_quality = '1'", "wind_validation")

_CONSOLIDATED = f"""
select w.station_id, s.station_name, w.date, s.latitude, s.longitude,
  coalesce(temp_min, cast(-9999 as float)) as min_temp, coalesce(temp_max, cast(-9999 as float)) as max_temp,
  coalesce(temp_avg, cast(-9999 as float)) as avg_temp, temp_quality as quality_flags
from wide_pos w join stations s using (station_id)
where {HAS_TEMP}
"""

CTES = {
    "raw": ([], RAW),
    "stations": ([], STATIONS),
    "supplier_stations": ([], SUPPLIER_STATIONS),
    "obs": (["raw"], OBS),
    "archive_obs": (["raw"], ARCHIVE_OBS),
    "archive_stations": (["stations"], ARCHIVE_STATIONS),
    "wide": (["obs", "stations"], _wide("obs", "station_id", _COMPACT, _KNOWN)),
    "wide_pos": (["obs", "stations"], _wide("obs", "station_id", _POSITIONAL, _KNOWN)),
    "rec": (["wide", "stations"], _graded("wide join stations using (station_id)")),
    "rec_pos": (["wide_pos", "stations"], _graded("wide_pos join stations using (station_id)")),
    "arc_wide": (
        ["archive_obs", "archive_stations"],
        _wide("archive_obs", "archive_ord, station_id", _COMPACT, _KNOWN_ARCHIVE),
    ),
    "arc_wide_pos": (
        ["archive_obs", "archive_stations"],
        _wide("archive_obs", "archive_ord, station_id", _POSITIONAL, _KNOWN_ARCHIVE),
    ),
    "arc": (
        ["arc_wide", "archive_stations"],
        _graded("arc_wide join archive_stations using (archive_ord, station_id)", "archive_ord,"),
    ),
    "arc_pos": (
        ["arc_wide_pos", "archive_stations"],
        _graded("arc_wide_pos join archive_stations using (archive_ord, station_id)", "archive_ord,"),
    ),
    "merged": (
        ["arc"],
        _MERGED.format(
            source="arc",
            temp_quality="arg_max(temp_quality, archive_ord) filter (where temp_quality is not null)",
        ),
    ),
    "merged_pos": (["arc_pos"], _MERGED.format(source="arc_pos", temp_quality=_MERGED_POSITIONAL)),
    "uni": (["merged"], _graded("merged")),
    "uni_pos": (["merged_pos"], _graded("merged_pos")),
    "con_all": (["wide_pos", "stations"], _CONSOLIDATED),
    "con": (["con_all"], "select * from con_all where min_temp <> -9999 and max_temp <> -9999 and avg_temp <> -9999"),
}


def sql(body: str, *needs: str) -> str:
    """`body` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in CTES[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return body.strip()
    return "with " + ",\n".join(f"{n} as ({CTES[n][1].strip()})" for n in order) + "\n" + body.strip()
