"""Registered queries with their SQL twins (None where SQL has no equal)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions import geo as G
from ..functions import quality as Q
from ..functions import text as X
from ..operators import catalog as C
from ..operators import integrity as I
from ..operators import neighbours as NB
from ..operators import pivot as V
from ..operators import profile as R
from ..operators.batches import process_in_batches, register_batch_function
from ..plans import documented as D
from ..plans import jobs as J
from ..sources import parsing as P
from ..sources import tables as T
from ..tuning import materialize, scratch_folder
from . import inputs as N
from . import twins as W
from .twins import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if twin is not None:
            TWINS[name] = twin
        return run

    return register


def records(spark: SparkSession, d: str, mode: str = "compact") -> DataFrame:
    return V.single_source_records(N.observations(spark, d), N.stations(spark, d), mode, N.SEQ_BITS, rows=N.raw_rows(spark, d))


def archive_records(spark: SparkSession, d: str, mode: str = "compact") -> DataFrame:
    rows = 2 * N.raw_rows(spark, d)  # an observation is in two archives at most
    return V.archive_records(N.archive_observations(spark, d), N.archive_stations(spark, d), mode, N.SEQ_BITS, rows=rows)


def unified(spark: SparkSession, d: str, mode: str = "compact") -> DataFrame:
    rows = 2 * N.raw_rows(spark, d)
    return V.unified_records(N.archive_observations(spark, d), N.archive_stations(spark, d), mode, N.SEQ_BITS, rows)


def consolidated(spark: SparkSession, d: str, allow_incomplete: bool = True) -> DataFrame:
    return V.consolidated_records(N.observations(spark, d), N.stations(spark, d), allow_incomplete, N.SEQ_BITS, N.raw_rows(spark, d))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means are compared to a fixed number of digits, as summation order differs."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- text rules --------------------------------------------------------------------------------

_LINES = """
select station_id, element, obs_date, line_no, l_partkey as p, tenths, qflag, l_orderkey,
  case element when 'TN' then 0 when 'TX' then 1 when 'TG' then 2 when 'RR' then 3 else 4 end * 9007199254740992 + line_no as seq,
  element in ('TN', 'TX', 'TG') as is_temp
from raw
"""
_TYPED = f"""
select station_id, element, seq,
  case when p % 211 = 0 then case when is_temp then 'source id: x1' end
       when p % 223 = 0 then 'date: 19500230'
       when p % 227 = 0 then case when is_temp then 'value: 1.5' end
       when p % 229 = 0 then case when is_temp then 'flag: 5' end
       when p % 233 = 0 or p % 239 = 0 then null
       when p % 241 = 0 then 'value: 1f' end as defect,
  case when p % 211 = 0 then null when p % 227 = 0 or p % 229 = 0 then 101 else l_orderkey end as source_id,
  obs_date,
  cast(case when p % 211 = 0 then 12.0 when p % 227 = 0 then 1.5 when p % 229 = 0 then 125.0
       else tenths end as float) / cast(10 as float) as value,
  case when p % 211 = 0 or p % 227 = 0 then 0 when p % 229 = 0 then 5 else qflag end as qflag,
  p % 233 = 0 and p % 211 <> 0 and p % 223 <> 0 and p % 227 <> 0 and p % 229 <> 0
    or p % 239 = 0 and p % 211 <> 0 and p % 223 <> 0 and p % 227 <> 0 and p % 229 <> 0 and p % 233 <> 0
    or p % 251 = 0 and p % 211 <> 0 and p % 223 <> 0 and p % 227 <> 0 and p % 229 <> 0 and p % 233 <> 0 and p % 239 <> 0 and p % 241 <> 0
    or tenths = -9999 and p % 211 <> 0 and p % 223 <> 0 and p % 227 <> 0 and p % 229 <> 0 and p % 241 <> 0
    as absent
from ({_LINES})
"""


@query(
    "observation_lines",
    sql(
        f"""select station_id, element, seq, cast(source_id as bigint) as source_id, obs_date, value, qflag
from ({_TYPED}) where defect is null and not absent""",
        "raw",
    ),
)
def observation_lines(spark, d):
    """Station file lines to typed rows, damaged lines dropped."""
    parsed = P.parse_observation_lines(N.observation_lines(spark, d))
    return P.good_observations(parsed, "drop", "drop").select(
        "station_id", "element", "seq", "source_id", "obs_date", "value", "qflag"
    )


@query(
    "defective_lines",
    sql(
        f"select element, defect, count(*) as lines from ({_TYPED}) where defect is not null group by 1, 2",
        "raw",
    ),
)
def defective_lines(spark, d):
    parsed = P.parse_observation_lines(N.observation_lines(spark, d))
    return P.defective_lines(parsed).groupBy("element", "defect").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "station_list",
    """
with l as (select c_custkey as k, c_name as name from customer),
p as (
  select k, name, k % 41 = 0 as plain,
    case when k % 5 = 0 or k % 7 = 0 then null else k % 900 end as elevation
  from l where k % 31 <> 0 and k % 37 <> 0 and (k % 41 = 0 or k % 43 <> 0)
)
select cast(k as bigint) as station_id, name as station_name, case when plain then 'IE' else 'GB' end as country,
  case when plain then 53.5 else k % 90 + (k * 7 % 60) / 60.0::double + (k * 11 % 60) / 3600.0::double end as latitude,
  case when plain then -6.25 else
    (case when k % 2 = 0 then -1 else 1 end) * (k % 180 + (k * 3 % 60) / 60.0::double + (k * 5 % 60) / 3600.0::double) end as longitude,
  cast(elevation as int) as elevation
from p
""",
)
def station_list(spark, d):
    """Station list lines with coordinates in degrees, minutes and seconds or as decimals."""
    lines = N.station_lines(spark, d)
    return P.last_station_wins(P.parse_station_lines(lines, "drop"))


_NAMES = """case c_custkey % 8 when 0 then 'TX_STAID' || lpad(cast(c_custkey as varchar), 6, '0') || '.txt'
  when 1 then 'RR_STAID' || cast(c_custkey as varchar) || '.txt' when 2 then 'dir/TN_STAID000012.txt'
  when 3 then 'TG_STAID000000.txt' when 4 then 'stations.txt' when 5 then 'FG_STAID' || lpad(cast(c_custkey as varchar), 6, '0') || '.csv'
  when 6 then 'QQ_STAID' || lpad(cast(c_custkey as varchar), 6, '0') || '.txt' else 'TN_STAID12a.txt' end"""


@query(
    "entry_names",
    f"""select c_custkey, {_NAMES} as entry,
  case c_custkey % 8 when 0 then 'TX' when 1 then 'RR' when 3 then 'TG' when 7 then 'TN' end as element,
  cast(case c_custkey % 8 when 0 then nullif(c_custkey, 0) when 1 then nullif(c_custkey, 0) when 2 then 12
    when 5 then nullif(c_custkey, 0) when 6 then nullif(c_custkey, 0) end as bigint) as station_id
from customer""",
)
def entry_names(spark, d):
    """Element and station from file names."""
    names = N.table(spark, d, "customer").selectExpr("c_custkey", f"{_NAMES.replace('varchar', 'string')} as entry")
    return names.select(
        "c_custkey",
        "entry",
        X.entry_prefix(F.col("entry")).alias("element"),
        X.entry_station(F.col("entry")).alias("station_id"),
    )


@query(
    "element_labels",
    sql(
        """select element, count(*) as n,
  case element when 'TN' then 'Temperature (Min)' when 'TX' then 'Temperature (Max)' when 'TG' then 'Temperature (Avg)'
    when 'RR' then 'Precipitation' else 'Wind Speed' end as display_name,
  case element when 'RR' then '0.1mm' when 'FG' then '0.1 m/s' else '0.1°C' end as units,
  case element when 'RR' then 'precipitation' when 'FG' then 'wind_speed' else 'temperature' end as metric,
  element as prefix
from raw group by element""",
        "raw",
    ),
)
def element_labels(spark, d):
    e = F.col("element")
    counted = N.raw_observations(spark, d).groupBy("element").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "element",
        "n",
        X.element_display_name(e).alias("display_name"),
        X.element_units(e).alias("units"),
        X.element_metric(e).alias("metric"),
        X.element_prefix(X.element_display_name(e)).alias("prefix"),
    )


@query(
    "flag_rules",
    sql(
        """select qflag, count(*) as n, qflag in (0, 1, 9) as legal, qflag in (0, 1) as usable, qflag = 0 as strict
from raw group by qflag""",
        "raw",
    ),
)
def flag_rules(spark, d):
    q = F.col("qflag")
    counted = N.raw_observations(spark, d).groupBy("qflag").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "qflag",
        "n",
        Q.flag_is_legal(q).alias("legal"),
        Q.flag_is_usable(q).alias("usable"),
        Q.flag_is_strict(q).alias("strict"),
    )


@query(
    "station_report",
    sql(
        """
with s as (select *, abs(latitude) as y, abs(longitude) as x from supplier_stations),
m as (select *, (y - floor(y)) * 60.0::double as ym, (x - floor(x)) * 60.0::double as xm from s)
select station_id, station_name, country,
  (case when latitude < 0 then '-' else '' end) || printf('%d:%02d:%05.2f', floor(y)::bigint, floor(ym)::bigint, (ym - floor(ym)) * 60.0::double) as latitude_dms,
  (case when longitude < 0 then '-' else '' end) || printf('%d:%02d:%05.2f', floor(x)::bigint, floor(xm)::bigint, (xm - floor(xm)) * 60.0::double) as longitude_dms,
  upper(country) in ('GB', 'UK', 'UNITED KINGDOM') as is_uk,
  latitude between 49.5 and 61 and longitude between -8 and 2 as in_uk_box,
  length(station_name) >= 1 and latitude between -90 and 90 and longitude between -180 and 180 as in_range
from m""".replace("with s as", "with supplier_stations as (" + W.SUPPLIER_STATIONS + "), s as")
    ),
)
def station_report(spark, d):
    return C.station_report(N.supplier_stations(spark, d))


_HAVERSINE = """2 * 6371.0::double * asin(sqrt(least(1.0::double,
  pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2)
  + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"""


@query(
    "station_distance",
    sql(
        f"""select a.station_id, a.country, round({_HAVERSINE.format(a='h', b='a')}, 6) as distance_km
from supplier_stations a join (
  select country, arg_min(latitude, station_id) as latitude, arg_min(longitude, station_id) as longitude
  from supplier_stations group by country) h using (country)""",
        "supplier_stations",
    ),
)
def station_distance(spark, d):
    """Great-circle distance of each station to the first station of its country."""
    stations = N.supplier_stations(spark, d)
    first = stations.groupBy("country").agg(
        F.min_by("latitude", "station_id").alias("lat0"), F.min_by("longitude", "station_id").alias("lon0")
    )
    km = G.haversine_km(F.col("lat0"), F.col("lon0"), F.col("latitude"), F.col("longitude"))
    return stations.join(first, "country").select("station_id", "country", F.round(km, 6).alias("distance_km"))


@query(
    "station_neighbours",
    sql(
        f"""select a.station_id, b.station_id as other_id, round({_HAVERSINE.format(a='a', b='b')}, 6) as distance_km
from supplier_stations a join supplier_stations b on a.station_id < b.station_id
where {_HAVERSINE.format(a='a', b='b')} <= 150""",
        "supplier_stations",
    ),
)
def station_neighbours(spark, d):
    return rounded(NB.station_neighbours(N.supplier_stations(spark, d), 150.0), "distance_km")


# --- pivot and merge ---------------------------------------------------------------------------


@query("single_source_records", sql("select * from rec", "rec"))
def single_source_records(spark, d):
    return records(spark, d)


@query("single_source_records_positional", sql("select * from rec_pos", "rec_pos"))
def single_source_records_positional(spark, d):
    return records(spark, d, "positional")


@query("archive_records", sql("select * from arc", "arc"))
def archive_records_query(spark, d):
    return archive_records(spark, d)


@query("unified_records", sql("select * from uni", "uni"))
def unified_records(spark, d):
    return unified(spark, d)


@query("unified_records_positional", sql("select * from uni_pos", "uni_pos"))
def unified_records_positional(spark, d):
    return unified(spark, d, "positional")


@query("merge_stored_archives", sql("select * from uni", "uni"))
def merge_stored_archives(spark, d):
    """The two-step way: stored per-archive records merged by key."""
    stored = materialize(archive_records(spark, d))
    return V.merge_records(stored, rows=stored.count())


@query("merge_stored_archives_positional", sql("select * from uni_pos", "uni_pos"))
def merge_stored_archives_positional(spark, d):
    stored = materialize(archive_records(spark, d, "positional"))
    return V.merge_records(stored, "positional", rows=stored.count())


@query("unified_station_filter", sql("select * from uni where station_id = 7", "uni"))
def unified_station_filter(spark, d):
    return unified(spark, d).filter(F.col("station_id") == 7)


@query("consolidated_complete", sql("select * from con", "con"))
def consolidated_complete(spark, d):
    return consolidated(spark, d, False)


@query("consolidated_incomplete", sql("select * from con_all", "con_all"))
def consolidated_incomplete(spark, d):
    return consolidated(spark, d)


@query(
    "unknown_stations",
    sql(
        f"select station_id, count(*) as observations, count(distinct element) as elements from obs where not {W._KNOWN} group by 1",
        "obs",
        "stations",
    ),
)
def unknown_stations(spark, d):
    return V.unknown_stations(N.observations(spark, d), N.stations(spark, d))


@query(
    "unknown_archive_stations",
    sql(
        f"""select archive_ord, station_id, count(*) as observations, count(distinct element) as elements
from archive_obs where not {W._KNOWN_ARCHIVE} group by 1, 2""",
        "archive_obs",
        "archive_stations",
    ),
)
def unknown_archive_stations(spark, d):
    return V.unknown_stations(N.archive_observations(spark, d), N.archive_stations(spark, d), "archive_ord")


@query(
    "uk_station_observations",
    sql(
        """select station_id, element, count(*) as n from obs
where station_id in (select station_id from stations where upper(country) in ('GB', 'UK', 'UNITED KINGDOM')) group by 1, 2""",
        "obs",
        "stations",
    ),
)
def uk_station_observations(spark, d):
    uk = N.stations(spark, d).filter(G.is_uk_country(F.col("country")))
    kept = V.keep_known_stations(N.observations(spark, d), uk)
    return kept.groupBy("station_id", "element").agg(F.count(F.lit(1)).alias("n"))


# --- record rules ------------------------------------------------------------------------------


@query(
    "record_quality",
    sql(
        f"""select station_id, date, {W.HAS_TEMP} as has_temperature,
  temp_min is not null and temp_max is not null and temp_avg is not null as has_complete_temperature,
  precipitation is not null as has_precipitation, wind_speed is not null as has_wind,
  concat_ws(',', case when {W.HAS_TEMP} then 'temperature' end, case when precipitation is not null then 'precipitation' end,
    case when wind_speed is not null then 'wind_speed' end) as metrics,
  cast((cast({W.HAS_TEMP} as int) + cast(precipitation is not null as int) + cast(wind_speed is not null as int)) as float) / cast(3 as float) as coverage,
  temp_max - temp_min as temperature_range,
  {W.FLAG_VALID} as temp_flag_valid, coalesce(precip_quality = '0', false) as precip_flag_valid,
  coalesce(wind_quality = '0', false) as wind_flag_valid,
  ({W.any_flag('1')}) as suspect, ({W.any_flag('9')}) as missing,
  {W.TEMP_Q} as temp_assessed, {W.RAIN_Q} as precip_assessed, {W.WIND_Q} as wind_assessed,
  ({W.TEMP_Q}) = 'Invalid' or ({W.RAIN_Q}) = 'Invalid' or ({W.WIND_Q}) = 'Invalid' as invalid,
  (temp_validation is null or ({W.TEMP_Q}) = 'Valid') and (precip_validation is null or ({W.RAIN_Q}) = 'Valid')
    and (wind_validation is null or ({W.WIND_Q}) = 'Valid') as high_quality
from uni_pos""",
        "uni_pos",
    ),
)
def record_quality(spark, d):
    """Every scalar test on wide records."""
    return unified(spark, d, "positional").select(
        "station_id",
        "date",
        Q.has_temperature().alias("has_temperature"),
        Q.has_complete_temperature().alias("has_complete_temperature"),
        Q.has_precipitation().alias("has_precipitation"),
        Q.has_wind().alias("has_wind"),
        F.array_join(Q.available_metrics(), ",").alias("metrics"),
        Q.metric_coverage().alias("coverage"),
        Q.temperature_range().alias("temperature_range"),
        Q.temperature_flag_valid().alias("temp_flag_valid"),
        Q.precipitation_flag_valid().alias("precip_flag_valid"),
        Q.wind_flag_valid().alias("wind_flag_valid"),
        Q.has_suspect_flag().alias("suspect"),
        Q.has_missing_flag().alias("missing"),
        Q.temperature_quality().alias("temp_assessed"),
        Q.precipitation_quality().alias("precip_assessed"),
        Q.wind_quality().alias("wind_assessed"),
        Q.has_invalid_data().alias("invalid"),
        Q.has_high_quality_data().alias("high_quality"),
    )


@query(
    "triple_check",
    sql(
        """select station_id, date,
  case when temp_min > temp_avg + cast(0.1 as float) then 'MinGreaterThanAvg'
       when temp_avg > temp_max + cast(0.1 as float) then 'AvgGreaterThanMax' end as violation, temp_quality as flags
from rec_pos where temp_min is not null and temp_avg is not null and temp_max is not null""",
        "rec_pos",
    ),
)
def triple_check(spark, d):
    rows = records(spark, d, "positional").filter(Q.has_complete_temperature())
    check = Q.triple_violation(F.col("temp_min"), F.col("temp_avg"), F.col("temp_max"))
    return rows.select("station_id", "date", check.alias("violation"), F.col("temp_quality").alias("flags"))


_V1_BREAK = """case when min_temp > avg_temp + cast(1 as float) then 'MinGreaterThanAvg'
  when avg_temp > max_temp + cast(1 as float) then 'AvgGreaterThanMax'
  when latitude not between -90 and 90 or longitude not between -180 and 180 or min_temp not between -50 and 50
    or max_temp not between -50 and 50 or avg_temp not between -50 and 50 then 'OutOfRange' end"""


@query(
    "consolidated_checks",
    sql(
        f"""select station_id, date, {_V1_BREAK} as violation, max_temp - min_temp as temperature_range,
  quality_flags = '000' as valid, contains(quality_flags, '1') as suspect, contains(quality_flags, '9') as missing,
  min_temp <> -9999 and min_temp between -50 and 50 as min_in_range
from con_all""",
        "con_all",
    ),
)
def consolidated_checks(spark, d):
    return consolidated(spark, d).select(
        "station_id",
        "date",
        Q.v1_violation().alias("violation"),
        Q.v1_temperature_range().alias("temperature_range"),
        Q.v1_valid().alias("valid"),
        Q.v1_suspect().alias("suspect"),
        Q.v1_missing().alias("missing"),
        Q.temperature_in_range(F.col("min_temp")).alias("min_in_range"),
    )


# --- integrity ---------------------------------------------------------------------------------


def _totals_sql(source: str, keys: str = "") -> str:
    by = f"group by {keys.rstrip(', ')}" if keys else ""
    return f"""select {keys} count(*) as total_records, count(*) filter (where {W.ALL_VALID}) as valid_records,
  count(*) filter (where not {W.ALL_VALID} and ({W.any_flag('1')})) as suspect_records,
  count(*) filter (where not {W.ALL_VALID} and not ({W.any_flag('1')}) and ({W.any_flag('9')})) as missing_data_records,
  count(*) filter (where ({W.BREAK}) is not null) as invalid_records
from {source} {by}"""


@query("integrity_totals", sql(_totals_sql("uni_pos"), "uni_pos"))
def integrity_totals(spark, d):
    return I.integrity_totals(unified(spark, d, "positional"))


@query(
    "combined_integrity_totals",
    sql(
        "select "
        + ", ".join(
            f"cast(sum({c}) as bigint) as {c}"
            for c in ("total_records", "valid_records", "suspect_records", "missing_data_records", "invalid_records")
        )
        + f" from ({_totals_sql('arc', 'archive_ord, ')})",
        "arc",
    ),
)
def combined_integrity_totals(spark, d):
    """Totals per archive, added up."""
    return I.combine_totals(I.integrity_totals(archive_records(spark, d), "archive_ord"))


@query(
    "integrity_percentages",
    sql(
        f"""select *, 100.0::double * valid_records / total_records as valid_percent,
  100.0::double * suspect_records / total_records as suspect_percent,
  100.0::double * invalid_records / total_records as invalid_percent from ({_totals_sql('rec')})""",
        "rec",
    ),
)
def integrity_percentages(spark, d):
    return I.summary_percentages(I.integrity_totals(records(spark, d)))


_VIOLATIONS = f"""select station_id, date, {W.BREAK} as violation, temp_min, temp_max, temp_avg, precipitation, wind_speed
from rec where ({W.BREAK}) is not null"""


@query("record_violations", sql(_VIOLATIONS, "rec"))
def record_violations(spark, d):
    return I.violations(records(spark, d))


@query("first_violations", sql(f"select * from ({_VIOLATIONS}) order by station_id, date, violation limit 10", "rec"))
def first_violations(spark, d):
    return I.first_violations(I.violations(records(spark, d)), 10)


def _stats_sql(source: str, keys: str = "") -> str:
    return f"""select {keys} station_id, count(*) as total_records, count(*) filter (where {W.FLAG_VALID}) as valid_records,
  count(*) filter (where not {W.FLAG_VALID} and ({W.any_flag('1')})) as suspect_records,
  count(*) filter (where not {W.FLAG_VALID} and not ({W.any_flag('1')}) and ({W.any_flag('9')})) as missing_data_records,
  min(temp_min) as min_temp, max(temp_max) as max_temp, round(avg(cast(temp_avg as double)), 6) as avg_temp
from {source} group by {keys} station_id"""


@query("station_statistics", sql(_stats_sql("uni_pos"), "uni_pos"))
def station_statistics(spark, d):
    return rounded(I.station_statistics(unified(spark, d, "positional")), "avg_temp")


@query(
    "combined_station_statistics",
    sql(
        f"""select station_id, total_records, valid_records, suspect_records, missing_data_records, min_temp, max_temp, avg_temp
from ({_stats_sql('arc', 'archive_ord, ')}) qualify row_number() over (partition by station_id order by archive_ord desc) = 1""",
        "arc",
    ),
)
def combined_station_statistics(spark, d):
    """Per-archive station rows; the last archive's row stays."""
    per = I.station_statistics(archive_records(spark, d), "archive_ord")
    return rounded(I.combine_station_statistics(per), "avg_temp")


@query(
    "v1_totals",
    sql(
        """select count(*) as total_records, count(*) filter (where quality_flags = '000') as valid_records,
  count(*) filter (where quality_flags <> '000' and contains(quality_flags, '1')) as suspect_records,
  count(*) filter (where quality_flags <> '000' and not contains(quality_flags, '1')) as invalid_records,
  count(*) filter (where contains(quality_flags, '9')) as missing_data_records from con_all""",
        "con_all",
    ),
)
def v1_totals(spark, d):
    return I.v1_totals(consolidated(spark, d))


_V1_LONG = """select station_id, date, 'min' as part, min_temp as value from con_all
union all select station_id, date, 'max', max_temp from con_all
union all select station_id, date, 'avg', avg_temp from con_all"""


@query(
    "v1_range_violations",
    sql(
        f"select station_id, date, 'OutOfRange' as violation, part, value from ({_V1_LONG}) where value <> -9999 and value not between -50 and 50",
        "con_all",
    ),
)
def v1_range_violations(spark, d):
    return I.v1_range_violations(consolidated(spark, d))


@query(
    "v1_relation_violations",
    sql(
        """select * from (select station_id, date,
  case when min_temp <> -9999 and avg_temp <> -9999 and max_temp <> -9999 then
    case when min_temp > avg_temp + cast(1 as float) then 'MinGreaterThanAvg'
         when avg_temp > max_temp + cast(1 as float) then 'AvgGreaterThanMax' end end as violation,
  cast(null as varchar) as part, cast(null as float) as value from con_all) where violation is not null""",
        "con_all",
    ),
)
def v1_relation_violations(spark, d):
    return I.v1_relation_violations(consolidated(spark, d))


@query(
    "v1_relation_violations_parity",
    sql(
        f"""select station_id, date, 'MinGreaterThanAvg' as violation, cast(null as varchar) as part, cast(null as float) as value
from con_all where ({_V1_BREAK}) is not null""",
        "con_all",
    ),
)
def v1_relation_violations_parity(spark, d):
    return I.v1_relation_violations(consolidated(spark, d), parity=True)


def _v1_stats_sql(high: str, mean: str) -> str:
    return f"""select station_id, count(*) as total_records, count(*) filter (where quality_flags = '000') as valid_records,
  count(*) filter (where quality_flags <> '000' and contains(quality_flags, '1')) as suspect_records,
  count(*) filter (where contains(quality_flags, '9')) as missing_data_records,
  min(min_temp) filter (where min_temp <> -9999) as min_temp, max({high}) filter (where {high} <> -9999) as max_temp,
  {mean} as avg_temp from con_all group by station_id"""


@query(
    "v1_station_statistics",
    sql(
        _v1_stats_sql("max_temp", "round(avg(cast(avg_temp as double)) filter (where avg_temp <> -9999), 6)"),
        "con_all",
    ),
)
def v1_station_statistics(spark, d):
    return rounded(I.v1_station_statistics(consolidated(spark, d)), "avg_temp")


@query("v1_station_statistics_parity", sql(_v1_stats_sql("min_temp", "cast(null as double)"), "con_all"))
def v1_station_statistics_parity(spark, d):
    return I.v1_station_statistics(consolidated(spark, d), parity=True)


def _jumps_sql(source: str, low: str, high: str, mid: str) -> str:
    parts = "\nunion all ".join(
        f"""select station_id, date, '{n}' as part, lag(date) over w as previous_date, lag({c}) over w as previous_value,
  {c} as value, abs({c} - lag({c}) over w) as jump from {source} window w as (partition by station_id order by date)"""
        for n, c in (("min", low), ("max", high), ("avg", mid))
    )
    return f"select * from ({parts}) where jump > 20"


@query("temperature_jumps", sql(_jumps_sql("uni", "temp_min", "temp_max", "temp_avg"), "uni"))
def temperature_jumps(spark, d):
    return I.weather_jumps(unified(spark, d))


_V1_VALUES = "(select station_id, date, nullif(min_temp, -9999) as lo, nullif(max_temp, -9999) as hi, nullif(avg_temp, -9999) as mid from con_all)"


@query("v1_temperature_jumps", sql(_jumps_sql(_V1_VALUES, "lo", "hi", "mid"), "con_all"))
def v1_temperature_jumps(spark, d):
    return I.v1_jumps(consolidated(spark, d))


# --- profile -----------------------------------------------------------------------------------


@query(
    "composition",
    sql(
        f"""select *, 100.0::double * records_with_temperature / total_records as temperature_percent,
  100.0::double * records_with_precipitation / total_records as precipitation_percent,
  100.0::double * records_with_wind_speed / total_records as wind_speed_percent,
  concat_ws(',', case when records_with_temperature > 0 then 'temperature' end,
    case when records_with_precipitation > 0 then 'precipitation' end,
    case when records_with_wind_speed > 0 then 'wind_speed' end) as available_metrics
from (select count(*) as total_records, count(*) filter (where {W.HAS_TEMP}) as records_with_temperature,
  count(precipitation) as records_with_precipitation, count(wind_speed) as records_with_wind_speed from uni)""",
        "uni",
    ),
)
def composition(spark, d):
    return R.composition(unified(spark, d))


@query(
    "dataset_bounds",
    sql(
        """select count(*) as total_records, count(distinct station_id) as total_stations, min(date) as first_date,
  max(date) as last_date, min(latitude) as min_lat, max(latitude) as max_lat, min(longitude) as min_lon, max(longitude) as max_lon,
  cast(year(max(date)) - year(min(date)) as int) as years,
  case when min(longitude) < -5 and max(latitude) > 53 then 'GB/IE' when max(latitude) > 55 then 'GB' else 'IE' end as countries
from uni""",
        "uni",
    ),
)
def dataset_bounds(spark, d):
    return R.dataset_bounds(R.station_profile(unified(spark, d)))


def _coverage_sql(metric: str, present: str, usable: str, low: str, high: str) -> str:
    zero = "cast(0 as float)"
    lo = f"min({low}) filter (where {usable})" if metric == "temperature" else zero
    hi = f"max({high}) filter (where {usable})"
    return f"""select '{metric}' as metric, count(distinct station_id) filter (where {present}) as stations,
  count(*) filter (where {present}) as records,
  100.0::double * count(*) filter (where {present}) / count(*) as coverage_percent,
  min(date) filter (where {present}) as first_date, max(date) filter (where {present}) as last_date,
  case when {hi} is not null and {lo} is not null then {lo} end as low_value,
  case when {hi} is not null and {lo} is not null then {hi} end as high_value from uni"""


@query(
    "metric_coverage",
    sql(
        "\nunion all ".join(
            [
                _coverage_sql("temperature", W.HAS_TEMP, f"({W.TEMP_Q}) <> 'Invalid'", "temp_min", "temp_max"),
                _coverage_sql("precipitation", "precipitation is not null", f"({W.RAIN_Q}) <> 'Invalid'", "", "precipitation"),
                _coverage_sql("wind_speed", "wind_speed is not null", f"({W.WIND_Q}) <> 'Invalid'", "", "wind_speed"),
            ]
        ),
        "uni",
    ),
)
def metric_coverage(spark, d):
    return R.metric_coverage(R.station_profile(unified(spark, d)))


_FLAG_ROWS = f"""select case when contains(temp_quality, '0') then 'valid' when contains(temp_quality, '1') then 'suspect'
  when contains(temp_quality, '9') then 'missing' end as f from uni where {W.HAS_TEMP}
union all select case precip_quality when '0' then 'valid' when '1' then 'suspect' when '9' then 'missing' end from uni where precipitation is not null
union all select case wind_quality when '0' then 'valid' when '1' then 'suspect' when '9' then 'missing' end from uni where wind_speed is not null"""


def _named_counts(key: str, names: list[str], rows: str) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return f"select k.n as {key}, count(r.f) as n from (values {values}) k(n) left join ({rows}) r on r.f = k.n group by k.n"


@query("source_flag_counts", sql(_named_counts("source_flag", ["valid", "suspect", "missing"], _FLAG_ROWS), "uni"))
def source_flag_counts(spark, d):
    return R.source_flag_counts(R.station_profile(unified(spark, d)))


@query(
    "physical_validity_counts",
    sql(
        _named_counts(
            "validity",
            ["Valid", "Suspect", "Invalid"],
            " union all ".join(f"select {c} as f from uni" for c in S.VALIDATION_COLUMNS),
        ),
        "uni",
    ),
)
def physical_validity_counts(spark, d):
    return R.physical_validity_counts(R.station_profile(unified(spark, d)))


@query(
    "combined_quality_counts",
    sql(
        _named_counts(
            "quality",
            R.QUALITY_NAMES,
            f"select {W.TEMP_Q} as f from uni union all select {W.RAIN_Q} from uni union all select {W.WIND_Q} from uni",
        ),
        "uni",
    ),
)
def combined_quality_counts(spark, d):
    return R.combined_quality_counts(R.station_profile(unified(spark, d)))


def _extreme_sql(name: str, column: str, quality: str, direction: str) -> str:
    return f"""(select '{name}' as extreme, * from uni where {column} is not null and ({quality}) <> 'Invalid'
order by {column} {direction}, station_id, date limit 1)"""


@query(
    "extreme_records",
    sql(
        " union all ".join(
            [
                _extreme_sql("coldest", "temp_min", W.TEMP_Q, "asc"),
                _extreme_sql("hottest", "temp_max", W.TEMP_Q, "desc"),
                _extreme_sql("wettest", "precipitation", W.RAIN_Q, "desc"),
                _extreme_sql("windiest", "wind_speed", W.WIND_Q, "desc"),
            ]
        ),
        "uni",
    ),
)
def extreme_records(spark, d):
    return R.extreme_records(unified(spark, d))


def _sample_sql(size: int) -> str:
    columns = ", ".join(S.WEATHER_COLUMNS)
    return f"""select {columns} from (
select *, row_number() over (order by main desc, i) as pick from (
  select *, row_number() over (partition by station_name, date order by main desc, i) as once from (
    select *, turn <= 2 and main_rank <= {size} as main from (
      select *, row_number() over (partition by turn <= 2 order by i) as main_rank from (
        select *, row_number() over (partition by station_name order by i) as turn from (
          select *, row_number() over (order by station_id, date) - 1 as i, count(*) over () as total,
            case when count(*) over () > {size * 100} then count(*) over () // {size * 50}
                 else greatest(1, count(*) over () // {size}) end as step
          from uni) where i % step = 0))) where main or i % (step * 2) = 0)
  where main or once = 1) where pick <= {size}"""


@query("diverse_sample", sql(_sample_sql(10), "uni"))
def diverse_sample(spark, d):
    return R.diverse_sample(unified(spark, d), 10)


@query("diverse_sample_with_fill", sql(_sample_sql(60), "uni"))
def diverse_sample_with_fill(spark, d):
    """More samples than two per station name allow, so that the fill takes part."""
    return R.diverse_sample(unified(spark, d), 60)


@query(
    "v1_statistics",
    sql(
        """
, t as (select count(*) as total_records, count(distinct station_id) as unique_stations, min(date) as first_date, max(date) as last_date,
  avg(cast(avg_temp as double)) filter (where avg_temp between -50 and 50) as avg_temp,
  count(*) filter (where quality_flags = '000') as valid_records, count(*) filter (where contains(quality_flags, '1')) as suspect_records,
  count(*) filter (where contains(quality_flags, '9')) as missing_records,
  min(latitude) as min_lat, max(latitude) as max_lat, min(longitude) as min_lon, max(longitude) as max_lon from con_all),
lo as (select * from con_all where min_temp between -50 and 50 order by min_temp, station_id, date limit 1),
hi as (select * from con_all where max_temp between -50 and 50 order by max_temp desc, station_id, date limit 1)
select total_records, unique_stations, first_date, last_date, cast((last_date - first_date) // 365 as int) as years,
  (select min_temp from lo) as min_temp, (select station_name || ' (' || date || ')' from lo) as min_temp_place,
  (select max_temp from hi) as max_temp, (select station_name || ' (' || date || ')' from hi) as max_temp_place,
  round(avg_temp, 6) as avg_temp, valid_records, suspect_records, missing_records, total_records - missing_records as complete_records,
  100.0::double * valid_records / total_records as valid_percent, 100.0::double * suspect_records / total_records as suspect_percent,
  100.0::double * missing_records / total_records as missing_percent, min_lat, max_lat, min_lon, max_lon from t""",
        "con_all",
    ),
)
def v1_statistics(spark, d):
    return rounded(R.v1_statistics(consolidated(spark, d)), "avg_temp")


@query(
    "coverage_report",
    sql(
        f"""select cast(sum(n) as bigint) as total_records, count(*) as total_stations,
  count(*) filter (where c) as stations_with_complete_temperature, count(*) filter (where t) as stations_with_any_temperature,
  count(*) filter (where p) as stations_with_precipitation, count(*) filter (where w) as stations_with_wind,
  count(*) filter (where cast(t as int) + cast(p as int) + cast(w as int) >= 2) as multi_metric_stations
from (select station_id, count(*) as n, bool_or({W.HAS_TEMP}) as t, bool_or(precipitation is not null) as p,
  bool_or(wind_speed is not null) as w, bool_or(temp_min is not null and temp_max is not null and temp_avg is not null) as c
  from uni group by station_id)""",
        "uni",
    ),
)
def coverage_report(spark, d):
    return R.coverage_report(unified(spark, d))


# --- catalog -----------------------------------------------------------------------------------

_FILES_SQL = "select distinct archive_ord, element, station_id from archive_obs"
_COUNT_SQL = f"""select chr(cast(97 + archive_ord as int)) as archive, count(*) as total_files, count(distinct station_id) as station_count,
  {', '.join(f"count(*) filter (where element = '{p}') as files_{p}" for p in S.PREFIXES)} from ({_FILES_SQL}) group by archive_ord"""


def _entries(spark, d):
    """The files the archives would hold: one per archive, element and station."""
    found = N.archive_observations(spark, d).select("archive_ord", "element", "station_id").distinct()
    return found.withColumn("archive", F.element_at(F.array(*map(F.lit, N.ARCHIVES)), F.col("archive_ord") + 1))


@query(
    "archive_catalog",
    sql(
        f"""select *, concat_ws(',', {', '.join(f"case when files_{p} > 0 then '{p}' end" for p in S.PREFIXES)}) as elements,
  {', '.join(f"files_{p} / cast(station_count as double) as coverage_{p}" for p in S.PREFIXES)},
  files_TN > 0 or files_TX > 0 or files_TG > 0 as has_temperature_data,
  files_TN > 0 and files_TX > 0 and files_TG > 0 as has_complete_temperature from ({_COUNT_SQL})""",
        "archive_obs",
    ),
)
def archive_catalog(spark, d):
    return C.archive_catalog(_entries(spark, d))


@query(
    "archive_summary",
    sql(
        f"""select count(*) as archives, cast(sum(total_files) as bigint) as total_files,
  cast({' + '.join(f'cast(max(files_{p}) > 0 as int)' for p in S.PREFIXES)} as int) as unique_metrics from ({_COUNT_SQL})""",
        "archive_obs",
    ),
)
def archive_summary(spark, d):
    return C.archive_summary(C.archive_catalog(_entries(spark, d)))


@query(
    "archives_per_element",
    sql(
        f"""select element, case element when 'TN' then 'Temperature (Min)' when 'TX' then 'Temperature (Max)' when 'TG' then 'Temperature (Avg)'
    when 'RR' then 'Precipitation' else 'Wind Speed' end as display_name,
  case element when 'RR' then '0.1mm' when 'FG' then '0.1 m/s' else '0.1°C' end as units,
  count(distinct archive_ord) as archives, count(*) as files from ({_FILES_SQL}) group by element""",
        "archive_obs",
    ),
)
def archives_per_element(spark, d):
    return C.archives_per_element(C.element_files(_entries(spark, d)))


@query(
    "unlisted_elements",
    sql(
        f"""select distinct chr(cast(97 + archive_ord as int)) as archive, element from ({_FILES_SQL})
where archive_ord in (0, 3) and not (archive_ord = 0 and element = 'TN') and not (archive_ord = 3 and element in ('TG', 'RR'))""",
        "archive_obs",
    ),
)
def unlisted_elements(spark, d):
    """Archive a lists TN only, archive d lists TG and RR, the others have no list."""
    files = C.element_files(_entries(spark, d))
    listed = files.filter(
        ((F.col("archive") == "a") & (F.col("element") == "TN"))
        | ((F.col("archive") == "d") & F.col("element").isin("TG", "RR"))
    )
    return C.unlisted_elements(files, listed)


@query(
    "archive_dates",
    sql(
        "select archive_ord, min(obs_date) as first_date, max(obs_date) as last_date from archive_obs group by 1",
        "archive_obs",
    ),
)
def archive_dates(spark, d):
    return C.archive_dates(N.archive_observations(spark, d), "archive_ord")


@query(
    "archive_country",
    """with c as (select chr(cast(97 + s_suppkey % 4 as int)) as archive,
  case s_nationkey % 3 when 0 then 'GB' when 1 then 'IE' else 'FR' end as country from supplier),
n as (select archive, country, count(*) as n from c group by 1, 2)
select archive, (list(country order by n desc, country))[1] as country, count(*) as country_count,
  string_agg(country, ',' order by country) as countries from n group by archive""",
)
def archive_country(spark, d):
    codes = N.table(spark, d, "supplier").selectExpr(
        "char(97 + s_suppkey % 4) as archive",
        "case s_nationkey % 3 when 0 then 'GB' when 1 then 'IE' else 'FR' end as country",
    )
    return C.archive_country(codes)


# --- documented queries ------------------------------------------------------------------------


@query("station_history", sql("select * from uni where station_id = 3 order by date", "uni"))
def station_history(spark, d):
    return D.station_history(unified(spark, d), 3)


@query(
    "newest_multi_metric",
    sql(
        """select station_name, date, temp_avg, precipitation, wind_speed from uni
where temp_avg is not null and precipitation is not null and wind_speed is not null order by date desc, station_name, station_id limit 100""",
        "uni",
    ),
)
def newest_multi_metric(spark, d):
    return D.newest_multi_metric(unified(spark, d))


@query(
    "metric_quality_counts",
    sql(
        """select count(*) as total_records, count(temp_min) as temp_records, count(precipitation) as precip_records,
  count(wind_speed) as wind_records, cast(sum(case when temp_validation = 'Invalid' then 1 else 0 end) as bigint) as invalid_temp from uni""",
        "uni",
    ),
)
def metric_quality_counts(spark, d):
    return D.metric_quality_counts(unified(spark, d))


@query(
    "extreme_events",
    sql(
        """select date, station_name, temp_max, precipitation, wind_speed from uni
where (temp_max > 35.0 or precipitation > 100.0 or wind_speed > 30.0)
  and temp_validation != 'Invalid' and precip_validation != 'Invalid' and wind_validation != 'Invalid'
order by temp_max desc, precipitation desc, wind_speed desc""",
        "uni",
    ),
)
def extreme_events(spark, d):
    return D.extreme_events(unified(spark, d))


def _monthly_sql(least: int) -> str:
    return f"""select station_id, station_name, cast(date_trunc('month', date) as date) as month, round(avg(temp_avg), 6) as monthly_temp,
  round(avg(precipitation), 6) as monthly_precip, count(*) as record_count from uni
where temp_validation = 'Valid' and precip_validation = 'Valid' group by 1, 2, 3 having count(*) >= {least} order by 1, 3"""


@query("monthly_means", sql(_monthly_sql(2), "uni"))
def monthly_means(spark, d):
    """Monthly means of stations; two days per month suffice, as the derived series are sparse."""
    return rounded(D.monthly_means(unified(spark, d), 2), "monthly_temp", "monthly_precip")


@query("monthly_means_dense", sql(_monthly_sql(20), "uni"))
def monthly_means_dense(spark, d):
    return rounded(D.monthly_means(unified(spark, d)), "monthly_temp", "monthly_precip")


@query(
    "complete_temperature_stations",
    sql(
        """select station_id, station_name, count(*) as record_count from uni
where temp_min is not null and temp_max is not null and temp_avg is not null group by 1, 2""",
        "uni",
    ),
)
def complete_temperature_stations(spark, d):
    return D.complete_temperature_stations(unified(spark, d))


@query(
    "monthly_temperature_and_rain",
    sql(
        """select cast(date_trunc('month', date) as date) as month, round(avg(temp_avg), 6) as avg_temperature,
  round(avg(precipitation), 6) as avg_precipitation from uni where temp_avg is not null and precipitation is not null group by 1 order by 1""",
        "uni",
    ),
)
def monthly_temperature_and_rain(spark, d):
    return rounded(D.monthly_temperature_and_rain(unified(spark, d)), "avg_temperature", "avg_precipitation")


@query(
    "metric_coverage_counts",
    sql(
        """select count(temp_min) as temp_coverage, count(precipitation) as precip_coverage, count(wind_speed) as wind_coverage,
  count(*) as total_records from uni""",
        "uni",
    ),
)
def metric_coverage_counts(spark, d):
    return D.metric_coverage_counts(unified(spark, d))


@query(
    "high_quality_temperatures",
    sql("select * from uni_pos where temp_validation = 'Valid' and temp_quality = '000'", "uni_pos"),
)
def high_quality_temperatures(spark, d):
    return D.high_quality_temperatures(unified(spark, d, "positional"))


@query(
    "high_quality_temperatures_compact",
    sql("select * from uni where temp_validation = 'Valid' and temp_quality = '000'", "uni"),
)
def high_quality_temperatures_compact(spark, d):
    """Empty: compact flag text never reads 000."""
    return D.high_quality_temperatures(unified(spark, d))


@query(
    "physically_valid",
    sql(
        """select * from uni where (temp_validation != 'Invalid' or temp_validation is null)
  and (precip_validation != 'Invalid' or precip_validation is null) and (wind_validation != 'Invalid' or wind_validation is null)""",
        "uni",
    ),
)
def physically_valid(spark, d):
    return D.physically_valid(unified(spark, d))


@query(
    "valid_precipitation",
    sql("select * from uni where precipitation is not null and precip_validation = 'Valid' and precip_quality = '0'", "uni"),
)
def valid_precipitation(spark, d):
    return D.valid_precipitation(unified(spark, d))


@query(
    "fully_valid_multi_metric",
    sql(
        """select * from uni where temp_min is not null and precipitation is not null and wind_speed is not null
  and temp_validation = 'Valid' and precip_validation = 'Valid' and wind_validation = 'Valid'""",
        "uni",
    ),
)
def fully_valid_multi_metric(spark, d):
    return D.fully_valid_multi_metric(unified(spark, d))


# --- tables, user code -------------------------------------------------------------------------


@query("table_roundtrip", sql("select * from uni", "uni"))
def table_roundtrip(spark, d):
    """Records written sorted as Parquet and read back."""
    path = scratch_folder(spark)
    T.write_weather(unified(spark, d), path, "zstd", probe=N.archive_observations(spark, d))
    return T.read_weather(spark, path)


@query(
    "table_roundtrip_13_columns",
    sql(
        "select * replace (cast(null as varchar) as temp_validation, cast(null as varchar) as precip_validation, cast(null as varchar) as wind_validation) from rec",
        "rec",
    ),
)
def table_roundtrip_13_columns(spark, d):
    """A table of the earlier layout without validations."""
    path = scratch_folder(spark)
    records(spark, d).drop(*S.VALIDATION_COLUMNS).write.parquet(path)
    return T.read_weather(spark, path)


@query("consolidated_roundtrip", sql("select * from con_all", "con_all"))
def consolidated_roundtrip(spark, d):
    path = scratch_folder(spark)
    T.write_consolidated(consolidated(spark, d), path, "gzip", probe=N.observations(spark, d))
    return T.read_consolidated(spark, path)


ROW_GROUP = 500


@query(
    "table_statistics",
    sql("select count(*) as total_rows, 'SNAPPY' as codecs, true as rows_as_read, true as groups_as_limited, true as files_found from rec", "rec"),
)
def table_statistics(spark, d):
    """Totals from the footers; per file they agree with the rows read from it and the limit of a row group."""
    path = scratch_folder(spark)
    records(spark, d).write.option("compression", "snappy").option("parquet.block.row.count.limit", str(ROW_GROUP)).parquet(path)
    name = F.element_at(F.split(F.col("file"), "/"), -1).alias("file")
    counted = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("found")).select(name, "found")
    each = T.file_statistics(spark, path).select(name, "rows", "row_groups").join(counted, "file", "left")
    agree = each.agg(
        F.bool_and(F.col("rows") == F.coalesce("found", F.lit(0))).alias("rows_as_read"),
        F.bool_and(F.col("row_groups") == F.ceil(F.col("rows") / ROW_GROUP)).alias("groups_as_limited"),
        F.count("*").alias("n"),
    )
    totals = T.table_statistics(spark, path).select("total_rows", "codecs", "files")
    return totals.join(F.broadcast(agree), F.col("n") == F.col("files")).select("total_rows", "codecs", "rows_as_read", "groups_as_limited", (F.col("files") > 0).alias("files_found"))


@query("table_head", sql("select * from con_all order by station_id, date limit 50", "con_all"))
def table_head(spark, d):
    """The first rows of a stored table in its order."""
    path = scratch_folder(spark)
    T.write_consolidated(consolidated(spark, d), path, probe=N.observations(spark, d))
    return T.read_consolidated(spark, path).orderBy("station_id", "date").limit(50)


@query(
    "table_layouts",
    """select * from (values ('all', 'weather', true), ('first13', 'weather', true), ('v1', 'consolidated', true),
  ('other', 'unknown', true), ('empty', 'none', false)) t(name, layout, written)""",
)
def table_layouts(spark, d):
    """Layouts of stored tables by their columns; an empty result leaves no table."""
    wide, v1 = records(spark, d), consolidated(spark, d)
    paths = {k: scratch_folder(spark) for k in ("all", "first13", "v1", "other", "empty")}
    written = {
        "all": T.write_weather(wide, paths["all"]),
        "v1": T.write_consolidated(v1, paths["v1"]),
        "empty": T.write_weather(wide.filter(F.col("station_id") < 0), paths["empty"]),
    }
    wide.drop(*S.VALIDATION_COLUMNS).write.parquet(paths["first13"])
    v1.drop("min_temp").write.parquet(paths["other"])
    rows = []
    for name, path in paths.items():
        there = written.get(name, True)
        rows.append((name, T.detect_layout(spark.read.parquet(path)) if there else "none", there))
    return spark.createDataFrame(rows, "name string, layout string, written boolean")


@query(
    "profile_limited",
    sql(
        """select count(*) as total_records, count(distinct station_id) as total_stations, min(date) as first_date,
  max(date) as last_date from (select * from rec order by station_id, date limit 1000)""",
        "rec",
    ),
)
def profile_limited(spark, d):
    """A profile of the first thousand records of a stored table, through the job."""
    path = scratch_folder(spark)
    T.write_weather(records(spark, d), path)
    bounds = J.profile_dataset(spark, path, limit=1000).members["bounds"]
    return bounds.select("total_records", "total_stations", "first_date", "last_date")


@query(
    "profile_of_grown_table",
    sql(
        f"""select 'bounds' as member, count(*) as n, min(date) as first_date, max(date) as last_date from rec
union all select 'station estimate within 4 %', 1, null, null
union all select 'temperature', count(*), min(date), max(date) from rec where coalesce(temp_min, temp_max, temp_avg) is not null""",
        "rec",
    ),
)
def profile_of_grown_table(spark, d):
    """A table that grows by a third after its first profile: only the new files are read."""
    path, state = scratch_folder(spark), scratch_folder(spark)
    rows = records(spark, d)
    rows.where("station_id % 3 != 0").write.parquet(path)
    J.refresh_profile(spark, path, state)
    rows.where("station_id % 3 = 0").write.mode("append").parquet(path)
    members = J.refresh_profile(spark, path, state)
    bounds = members["bounds"].select("total_records", "first_date", "last_date", "total_stations")
    none, number = F.lit(None).cast("date"), F.lit(None).cast("long")
    exact = rows.agg(F.count_distinct("station_id").alias("exact")).select(number.alias("total_stations"), "exact")
    both = bounds.select("total_stations", number.alias("exact")).unionByName(exact)
    close = both.agg(F.max("total_stations").alias("total_stations"), F.max("exact").alias("exact"))
    near = F.abs(F.col("total_stations") - F.col("exact")) <= 0.04 * F.col("exact")
    temperature = members["coverage"].where("metric = 'temperature'")
    return (
        bounds.select(F.lit("bounds").alias("member"), F.col("total_records").alias("n"), "first_date", "last_date")
        .unionByName(close.select(F.lit("station estimate within 4 %").alias("member"), near.cast("long").alias("n"), none.alias("first_date"), none.alias("last_date")))
        .unionByName(temperature.select(F.lit("temperature").alias("member"), F.col("records").alias("n"), "first_date", "last_date"))
    )


@query(
    "batch_hook",
    sql("select station_id, date, temp_max - temp_min as spread from rec where temp_max is not null and temp_min is not null", "rec"),
)
def batch_hook(spark, d):
    """User code over Arrow batches."""

    def spread(batch):
        batch = batch.dropna()
        spread = (batch["temp_max"] - batch["temp_min"]).astype("float32")
        return batch.assign(spread=spread)[["station_id", "date", "spread"]]

    source = records(spark, d).select("station_id", "date", "temp_min", "temp_max")
    return process_in_batches(source, spread, "station_id long, date date, spread float")


@query(
    "batch_function_in_sql",
    sql(
        """select station_id, date, cast(temp_max::double - lag(temp_max) over (partition by station_id, extract(year from date) order by date)::double as float) as rise,
  count(*) over (partition by station_id, extract(year from date)) as days from rec where temp_max is not null""",
        "rec",
    ),
)
def batch_function_in_sql(spark, d):
    """User code over whole groups, called from SQL."""

    def rises(group):
        rise = group["temp_max"].astype("float64").diff()
        return group[["station_id", "date"]].assign(rise=rise, days=len(group))

    records(spark, d).createOrReplaceTempView("batch_records")
    register_batch_function(spark, "rises", rises, "station_id long, date date, rise float, days long", batch_rows=None)
    return spark.sql(
        """select * from rises(table(select station_id, date, temp_max, year(date) as year from batch_records where temp_max is not null)
           partition by (station_id, year) order by date)"""
    )
