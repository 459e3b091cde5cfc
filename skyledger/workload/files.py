"""Registered queries over files that Spark first writes from the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..operators import pivot as V
from ..plans import jobs as J
from ..plans.store import RecordStore
from ..sources import reader as RD
from ..sources import stations as ST
from ..streaming import keyed as KD
from ..streaming import landing as LD
from ..tuning import scratch_folder
from . import inputs as N
from . import twins as W
from .queries import _jumps_sql, query
from .twins import sql

# Stations of an archive, and archives that share them: the number of archives grows with the data,
# their size does not.
ARCHIVE_STATIONS, ARCHIVE_SHARES = 20, 4
HEADER = "header\n" * 20


def _file_name(element: Column, station: Column) -> Column:
    return F.concat(element, F.lit("_STAID"), F.lpad(station.cast("string"), 6, "0"), F.lit(".txt"))


def _data_line(spoiled: bool = False) -> Column:
    """A line of a station file; `spoiled` makes some values of rain and some flags of wind unreadable."""
    day = F.date_format("obs_date", "yyyyMMdd")
    value, flag = F.col("tenths").cast("string"), F.col("qflag").cast("string")
    if spoiled:
        value = F.when((F.col("element") == "RR") & (F.col("l_partkey") % 11 == 0), "n/a").otherwise(value)
        flag = F.when((F.col("element") == "FG") & (F.col("l_partkey") % 13 == 0), "?").otherwise(flag)
    return F.concat_ws(", ", F.col("l_orderkey").cast("string"), day, value, flag)


def _station_line() -> Column:
    return F.concat_ws(
        ",",
        F.col("station_id").cast("string"),
        F.col("station_name"),
        F.col("country"),
        F.col("latitude").cast("string"),
        F.col("longitude").cast("string"),
        F.lit("-999"),
    )


def write_archive_folder(spark, d, spoiled: bool = False) -> str:
    """Each archive holds a share of the orders of some stations, and the list of those stations."""
    folder = scratch_folder(spark)
    number = F.floor(F.col("station_id") / ARCHIVE_STATIONS) * ARCHIVE_SHARES + F.col("l_orderkey") % ARCHIVE_SHARES
    raw = N.raw_observations(spark, d).withColumn("number", number)
    name = F.format_string("part_%010d.zip", "number")
    digits = F.col("number").cast("string")  # the same name; a format is slow where it meets every line
    quick = F.when(F.col("number") >= 0, F.concat(F.lit("part_"), F.lpad(digits, F.greatest(F.lit(10), F.length(digits)), F.lit("0")), F.lit(".zip"))).otherwise(name)
    data = raw.select(
        quick.alias("archive"),
        _file_name(F.col("element"), F.col("station_id")).alias("entry"),
        F.col("line_no").alias("pos"),
        _data_line(spoiled).alias("line"),
    )
    archives = raw.select("number").distinct().select(name.alias("archive"))
    listed = N.stations(spark, d).select("station_id", F.col("station_id").alias("pos"), _station_line().alias("line"))
    every = raw.select("number", "station_id").distinct().join(listed, "station_id")
    metadata = every.select(name.alias("archive"), F.lit(S.STATIONS_FILE).alias("entry"), "pos", "line")
    elements = archives.select(
        "archive",
        F.lit(S.ELEMENTS_FILE).alias("entry"),
        F.posexplode(F.array(*[F.lit(f"{p}1, some text, 0.1")for p in ("TN", "TX", "TG", "RR")])).alias("pos", "line"),
    ).withColumn("pos", F.col("pos").cast("long"))
    N.write_archives(data.unionByName(metadata).unionByName(elements), folder, HEADER).count()
    return folder


_SHARD = f"cast((station_id // {ARCHIVE_STATIONS}) * {ARCHIVE_SHARES} + l_orderkey % {ARCHIVE_SHARES} as int)"
# Entries are written in name order, so TG comes before TN and TX.
_SHARD_OBS = f"""select {_SHARD} as archive_ord, station_id, obs_date, element, line_no,
  cast(cast(tenths as float) / cast(10 as float) as float) as value, qflag,
  case element when 'TG' then 0 when 'TN' then 1 else 2 end as mr from raw where tenths <> -9999"""
_SHARD_WIDE = W._wide("shard_obs", "archive_ord, station_id", W._COMPACT, W._KNOWN)
_SHARD_RECORDS = W._graded("shard_wide join stations using (station_id)", "archive_ord,")
_SHARD_MERGED = W._MERGED.format(
    source="shard",
    temp_quality="arg_max(temp_quality, archive_ord) filter (where temp_quality is not null)",
)
_SHARDS = f""", shard_obs as ({_SHARD_OBS}), shard_wide as ({_SHARD_WIDE}), shard as ({_SHARD_RECORDS}),
shard_merged as ({_SHARD_MERGED}), shard_uni as ({W._graded('shard_merged')})
"""


@query("archives_to_records", sql(_SHARDS + "select * from shard_uni", "raw", "stations"))
def archives_to_records(spark, d):
    """ZIP archives read, parsed, merged and graded; small splits cut entries in pieces."""
    src = ST.open_archives(spark, write_archive_folder(spark, d), split_bytes=512 << 10)
    return V.unified_records(src.observations, src.stations)


@query(
    "archives_one_station",
    sql(_SHARDS + "select * from shard_uni where station_id = 4", "raw", "stations"),
)
def archives_one_station(spark, d):
    """Only the entries of one station are unpacked."""
    src = ST.open_archives(spark, write_archive_folder(spark, d), stations=[4])
    return V.unified_records(src.observations, src.stations)


@query(
    "archives_process_report",
    sql(
        _SHARDS
        + "select "
        + ", ".join(
            f"cast(sum({c}) as bigint) as {c}"
            for c in ("total_records", "valid_records", "suspect_records", "missing_data_records", "invalid_records")
        )
        + f""" from (select archive_ord, count(*) as total_records, count(*) filter (where {W.ALL_VALID}) as valid_records,
  count(*) filter (where not {W.ALL_VALID} and ({W.any_flag('1')})) as suspect_records,
  count(*) filter (where not {W.ALL_VALID} and not ({W.any_flag('1')}) and ({W.any_flag('9')})) as missing_data_records,
  count(*) filter (where ({W.BREAK}) is not null) as invalid_records from shard group by archive_ord)""",
        "raw",
        "stations",
    ),
)
def archives_process_report(spark, d):
    """The whole directory job with its output; totals of the per-archive reports."""
    job = J.process_directory(spark, write_archive_folder(spark, d), scratch_folder(spark))
    return job.per_archive.totals


@query(
    "archives_catalog",
    sql(
        f""", f as (select distinct {_SHARD} as shard, element, station_id from raw)
select printf('part_%010d.zip', shard) as archive, count(*) + 2 as total_files, count(distinct station_id) as station_count,
  concat_ws(',', {', '.join(f"case when count(*) filter (where element = '{p}') > 0 then '{p}' end" for p in S.PREFIXES)}) as elements
from f group by shard""",
        "raw",
    ),
)
def archives_catalog(spark, d):
    """Contents of archives from their directories."""
    catalog = J.describe_archives(spark, write_archive_folder(spark, d)).catalog
    return catalog.select("archive", "total_files", "station_count", "elements")


@query(
    "archives_dates",
    sql(
        f"""select printf('part_%010d.zip', {_SHARD}) as archive, min(obs_date) as first_date, max(obs_date) as last_date
from raw group by 1""",
        "raw",
    ),
)
def archives_dates(spark, d):
    return J.describe_archives(spark, write_archive_folder(spark, d)).dates


@query(
    "archives_unknown_files",
    sql(
        f"select distinct printf('part_%010d.zip', {_SHARD}) as archive, element, station_id from raw where not {W._KNOWN}",
        "raw",
        "stations",
    ),
)
def archives_unknown_files(spark, d):
    src = ST.open_archives(spark, write_archive_folder(spark, d))
    return src.unknown_stations().select("archive", "element", "station_id")


@query(
    "archives_unlisted_elements",
    sql(f"select distinct printf('part_%010d.zip', {_SHARD}) as archive, element from raw where element = 'FG'", "raw"),
)
def archives_unlisted_elements(spark, d):
    return J.describe_archives(spark, write_archive_folder(spark, d)).unlisted


@query(
    "archives_read_format",
    sql(
        f"""select printf('part_%010d.zip', {_SHARD}) as archive, element, station_id, count(*) as lines, sum(l_orderkey) as sources
from raw where element in ('TX', 'RR') and station_id between 5 and 60 and {_SHARD} % 10 = 2 group by all""",
        "raw",
    ),
)
def archives_read_format(spark, d):
    """The data source; its filters on element, station and archive leave entries unopened."""
    found = RD.lines(spark, write_archive_folder(spark, d), shareBytes=4 << 20)
    wanted = found.where("element in ('TX', 'RR') and station_id >= 5 and station_id <= 60 and archive like '%2.zip'")
    source = F.split("line", ",")[0].cast("long")
    return wanted.groupBy("archive", "element", "station_id").agg(F.count("*").alias("lines"), F.sum(source).alias("sources"))


@query(
    "archives_in_sql",
    sql(
        _SHARDS
        + """select cast(extract(year from date) as int) as year, count(*) as days, count(temp_max) as with_maximum, max(temp_max) as highest,
  count(*) filter (where precip_validation = 'Suspect') as suspect from shard_uni where station_id in (3, 4, 32) group by 1""",
        "raw",
        "stations",
    ),
)
def archives_in_sql(spark, d):
    """Views over a folder of archives, asked in SQL; only the entries of three stations are read."""
    RD.create_views(spark, write_archive_folder(spark, d), "archive_")
    return spark.sql(
        """select year(date) as year, count(*) as days, count(temp_max) as with_maximum, max(temp_max) as highest,
             count_if(precip_validation = 'Suspect') as suspect
           from archive_weather where station_id in (3, 4, 32) group by year(date)"""
    )


@query("archives_jumps_kept_up", sql(_SHARDS + _jumps_sql("shard_uni", "temp_min", "temp_max", "temp_avg"), "raw", "stations"))
def archives_jumps_kept_up(spark, d):
    """Jumps asked for between additions to a stored merge; only what changed is looked at again."""
    folder, store = write_archive_folder(spark, d), RecordStore(spark, scratch_folder(spark), buckets=4)
    for pattern in ("2.zip", None):
        store.add_archives(folder, pattern)
        found = store.jumps()
    return found


@query(
    "archives_line_counts",
    sql(
        f"""select count(*) filter (where not spoiled) as observations, 0::bigint as defect_source_id, 0::bigint as defect_date,
  count(*) filter (where element = 'RR' and spoiled) as defect_value, count(*) filter (where element = 'FG' and spoiled) as defect_flag
from (select *, (element = 'RR' and l_partkey % 11 = 0) or (element = 'FG' and l_partkey % 13 = 0) as spoiled from raw where {W._KNOWN})
where tenths <> -9999 or (element = 'RR' and spoiled)""",
        "raw",
        "stations",
    ),
)
def archives_line_counts(spark, d):
    """Rows and defective lines of a directory job, counted in its own pass."""
    job = J.process_directory(spark, write_archive_folder(spark, d, spoiled=True), scratch_folder(spark))
    names = list(job.line_counts)
    return spark.createDataFrame([tuple(job.line_counts.values())], ", ".join(f"{n} long" for n in names))


@query("archives_added_one_after_another", sql(_SHARDS + "select * from shard_uni", "raw", "stations"))
def archives_added_one_after_another(spark, d):
    """A stored merge that archives are added to against their order; each is read once."""
    folder, store = write_archive_folder(spark, d), RecordStore(spark, scratch_folder(spark), buckets=4)
    for pattern in ("3.zip", "2.zip", None):
        store.add_archives(folder, pattern)
    store.compact(1)
    return store.records()


# --- folders -----------------------------------------------------------------------------------

_FOLDER_OF = {v: k for k, v in S.V1_FOLDERS.items()}


def write_station_folders(spark, d) -> str:
    """The three temperature folders of the older layout."""
    folder = scratch_folder(spark)
    raw = N.raw_observations(spark, d).filter(F.col("element").isin(S.TEMPERATURE_PREFIXES))
    home = F.element_at(
        F.create_map(*[F.lit(x) for p, f in _FOLDER_OF.items() for x in (p, f)]), F.col("element")
    )
    data = raw.select(
        F.concat_ws("/", home, _file_name(F.col("element"), F.col("station_id"))).alias("file"),
        F.col("line_no").alias("pos"),
        _data_line().alias("line"),
    )
    listed = N.stations(spark, d).select(
        F.lit(f"uk_temp_min/{S.STATIONS_FILE}").alias("file"),
        F.col("station_id").cast("long").alias("pos"),
        _station_line().alias("line"),
    )
    N.write_station_files(data.unionByName(listed), folder, HEADER).count()
    return folder


@query("folders_to_consolidated", sql("select * from con_all where station_id in (select station_id from stations where country = 'GB')", "con_all"))
def folders_to_consolidated(spark, d):
    """Station folders to nine-column records, UK stations only; the station list selects the files."""
    src = ST.open_folders(spark, write_station_folders(spark, d), split_bytes=256 << 10)
    return V.consolidated_records(src.observations, src.stations, allow_incomplete=True)


@query("folders_one_station", sql("select * from con_all where station_id = 12", "con_all"))
def folders_one_station(spark, d):
    src = ST.open_folders(spark, write_station_folders(spark, d), station=12)
    return V.consolidated_records(src.observations, src.stations, allow_incomplete=True)


# --- streaming ---------------------------------------------------------------------------------

_LANDING_ARCHIVE = "case when l_orderkey % 5 = 0 then 'b' else 'a' end"


def write_landing_folder(spark, d) -> str:
    """Station files of two archives below one landing folder."""
    folder = scratch_folder(spark)
    raw = N.raw_observations(spark, d)
    data = raw.select(
        F.concat_ws(
            "/", F.expr(_LANDING_ARCHIVE), _file_name(F.col("element"), F.col("station_id"))
        ).alias("file"),
        F.col("line_no").alias("pos"),
        _data_line().alias("line"),
    )
    N.write_station_files(data, folder, HEADER).count()
    return folder


_LANDED = f""", landed_obs as (select case when l_orderkey % 5 = 0 then 1 else 0 end as archive_ord, station_id, obs_date, element, line_no,
  cast(cast(tenths as float) / cast(10 as float) as float) as value, qflag, {W._RANK} as mr from raw where tenths <> -9999),
landed_wide as ({W._wide('landed_obs', 'archive_ord, station_id', W._COMPACT, W._KNOWN)}),
landed as ({W._graded('landed_wide join stations using (station_id)', 'archive_ord,')}),
landed_merged as ({W._MERGED.format(source='landed', temp_quality='arg_max(temp_quality, archive_ord) filter (where temp_quality is not null)')}),
landed_uni as ({W._graded('landed_merged')})
select * from landed_uni"""


@query("landed_files_to_records", sql(_LANDED, "raw", "stations"))
def landed_files_to_records(spark, d):
    """Files arriving in several micro-batches; the maintained table equals a batch run."""
    work = scratch_folder(spark)
    stream = LD.maintain_records(
        spark, write_landing_folder(spark, d), N.stations(spark, d), f"{work}/table", f"{work}/state",
        buckets=8, max_files=300,
    )
    stream.awaitTermination()
    return LD.read_records(spark, f"{work}/table")


@query("landed_records_by_keyed_state", sql(_LANDED, "raw", "stations"))
def landed_records_by_keyed_state(spark, d):
    """Records as the batches change them; the last one of a station and day counts."""
    session, work = spark.newSession(), scratch_folder(spark)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", KD.ROCKSDB)
    session.conf.set("spark.sql.shuffle.partitions", str(2 * spark.sparkContext.defaultParallelism))

    def keep(batch, number):
        LD.let_go(number)
        batch.write.mode("overwrite").parquet(f"{work}/changed/batch={number}")

    changed = KD.stream_records(session, write_landing_folder(session, d), N.stations(session, d), max_files=3000, lists=f"{work}/lists")
    changed.writeStream.outputMode("update").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    every = spark.read.parquet(f"{work}/changed")
    last = every.groupBy("station_id", "date").agg(F.max("batch").alias("batch"))
    return every.join(last, ["station_id", "date", "batch"]).select(S.WEATHER_COLUMNS)


# --- jobs and readers as users call them -------------------------------------------------------

_LINE_OBS = f"""select station_id, obs_date, element, cast(cast(tenths as float) / cast(10 as float) as float) as value, qflag
from raw where tenths <> -9999"""


@query("one_station_file", sql(f"select * from ({_LINE_OBS}) where station_id = 3 and element = 'TX'", "raw"))
def one_station_file(spark, d):
    """The file of one station and element."""
    folder = write_station_folders(spark, d)
    path = f"{folder}/uk_temp_max/TX_STAID000003.txt"
    return ST.read_station_files(spark, path).select("station_id", "obs_date", "element", "value", "qflag")


@query(
    "archives_by_name",
    sql(f"select distinct printf('part_%010d.zip', {_SHARD}) as archive from raw where {_SHARD} % 10 = 3", "raw"),
)
def archives_by_name(spark, d):
    """Only archives whose name contains a text."""
    return ST.list_contents(spark, write_archive_folder(spark, d), "3.zip").archives.select("archive")


@query(
    "archives_validated",
    sql(
        _SHARDS
        + f""", t as (select count(*) as total_records, count(*) filter (where {W.ALL_VALID}) as valid_records,
  count(*) filter (where not {W.ALL_VALID} and ({W.any_flag('1')})) as suspect_records,
  count(*) filter (where not {W.ALL_VALID} and not ({W.any_flag('1')}) and ({W.any_flag('9')})) as missing_data_records,
  count(*) filter (where ({W.BREAK}) is not null) as invalid_records from shard_uni)
select *, round(100.0::double * valid_records / total_records, 6) as valid_percent,
  round(100.0::double * suspect_records / total_records, 6) as suspect_percent,
  round(100.0::double * invalid_records / total_records, 6) as invalid_percent from t""",
        "raw",
        "stations",
    ),
)
def archives_validated(spark, d):
    """Validation without an output: totals of the merged records with percentages."""
    summary = J.validate(spark, write_archive_folder(spark, d)).summary
    return summary.totals.withColumns({f"{k}_percent": F.round(f"{k}_percent", 6) for k in ("valid", "suspect", "invalid")})


@query(
    "archives_first_violations",
    sql(
        _SHARDS
        + f"""select station_id, date, {W.BREAK} as violation from shard_uni where ({W.BREAK}) is not null
order by station_id, date, violation limit 10""",
        "raw",
        "stations",
    ),
)
def archives_first_violations(spark, d):
    """The first ten broken records of a validation."""
    return J.validate(spark, write_archive_folder(spark, d)).summary.first_violations.select("station_id", "date", "violation")
