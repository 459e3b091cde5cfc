"""The four user jobs: one archive, a folder of archives, validation only, and dataset profile."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..operators import catalog as C
from ..operators import integrity as I
from ..operators import pivot as V
from ..operators import profile as R
from ..sources import archives as A
from ..sources import parsing as P
from ..sources import tables as T
from ..sources.ranges import listed
from ..sources.stations import ArchiveSet, FolderSet, list_contents, open_archives, open_folders
from ..tuning import materialize


@dataclass
class IntegrityReport:
    """Report of records, per `keys`. Totals and statistics come from one scan, made when one is first
    asked for; `combined` adds the totals of all keys up and keeps the last key's row of a station."""

    records: DataFrame
    keys: tuple[str, ...] = ()
    combined: bool = False

    @cached_property
    def state(self) -> DataFrame:
        return materialize(I.report_state(self.records, *self.keys))

    @property
    def totals(self) -> DataFrame:
        return I.totals_of_state(self.state, *(() if self.combined else self.keys))

    @property
    def violations(self) -> DataFrame:
        return I.violations(self.records, *self.keys)

    @property
    def station_statistics(self) -> DataFrame:
        found = I.station_statistics_of_state(self.state, *self.keys)
        return I.combine_station_statistics(found) if self.combined else found


@dataclass
class IntegritySummary:
    """What a user reads first: totals with percentages, and the first broken records."""

    totals: DataFrame
    first_violations: DataFrame


@dataclass
class ArchiveJob:
    """Result of a run over archives. Every member is a DataFrame read from one stored result."""

    source: ArchiveSet
    records: DataFrame
    composition: DataFrame
    per_archive: IntegrityReport
    unified: IntegrityReport
    written: bool | None = None
    line_counts: dict[str, int] | None = None

    @property
    def summary(self) -> IntegritySummary:
        return IntegritySummary(
            I.summary_percentages(self.unified.totals), I.first_violations(self.unified.violations)
        )


def process_directory(
    spark: SparkSession,
    folder: str,
    output: str | None = None,
    pattern: str | None = None,
    station: int | None = None,
    codec: str = "snappy",
    quality_mode: str = "compact",
    filter_report: bool = False,
    **source_options,
) -> ArchiveJob:
    """Read, merge, grade and report all archives of a folder; write when `output` is given.

    The long rows are shuffled once, into the records of each archive. These are stored as a table
    in the shared folder, as both the merge and the per-archive reports start from them. `station`
    limits the records; the reports keep all stations unless `filter_report` is set, in which case
    other stations' entries stay unread. `line_counts` has the rows read and the defective lines per
    kind, counted in the same pass.
    """
    T.check_codec(codec)
    if station is not None and filter_report:
        source_options["stations"] = [station]
    src = open_archives(spark, folder, pattern, count_lines=True, **source_options)
    per_archive = materialize(
        V.archive_records(src.observations, src.stations, quality_mode, all_known=True)
    )
    wanted = per_archive if station is None else per_archive.filter(F.col("station_id") == station)
    stored = per_archive.count()
    records = V.merge_records(wanted, quality_mode, src.stations, stored)
    written = None
    if output is None:
        records = materialize(records)
    else:
        written = T.write_weather(records, output, codec, probe=wanted, like=wanted)
        records = T.read_weather(spark, output) if written else records
    everything = records if station is None else V.merge_records(per_archive, quality_mode, src.stations, stored)
    return ArchiveJob(
        src,
        records,
        R.composition(records),
        IntegrityReport(per_archive, ("archive_ord",), combined=True),
        IntegrityReport(everything),
        written,
        src.line_counts(),
    )


def process_archive(spark: SparkSession, path: str, output: str | None = None, **options) -> ArchiveJob:
    """One archive: the same job over the single file `path`."""
    if not path.endswith(".zip"):
        raise ValueError(f"not a zip archive: {path}")
    return process_directory(spark, path, output, **options)


def validate(spark: SparkSession, folder: str, **options) -> ArchiveJob:
    """Reports only; nothing is written to an output."""
    return process_directory(spark, folder, None, **options)


@dataclass
class CatalogJob:
    catalog: DataFrame
    countries: DataFrame
    dates: DataFrame
    summary: DataFrame
    per_element: DataFrame
    unlisted: DataFrame
    errors: DataFrame


def describe_archives(spark: SparkSession, folder: str, pattern: str | None = None) -> CatalogJob:
    """What the archives of a folder contain. Only `dates` reads observation lines, of all data
    files; station lines count by their country alone and need not parse."""
    src = list_contents(spark, folder, pattern)
    good = src.entries.filter(F.col("error").isNull())
    files = C.element_files(good)
    codes = P.station_country_codes(A.archive_metadata_lines(src.archives, S.STATIONS_FILE))
    listed = P.parse_element_lines(A.archive_metadata_lines(src.archives, S.ELEMENTS_FILE))
    with_list = good.filter(F.col("entry") == S.ELEMENTS_FILE).select("archive").distinct()
    catalog = C.archive_catalog(good)
    names = src.archives.select("archive", "archive_ord")
    lines = A.archive_lines(A.data_entries(src.entries, src.archives))
    return CatalogJob(
        catalog,
        C.archive_country(codes),
        C.archive_dates(P.line_dates(lines), "archive_ord").join(names, "archive_ord").drop("archive_ord"),
        C.archive_summary(catalog),
        C.archives_per_element(files),
        C.unlisted_elements(files, listed, with_list),
        src.errors,
    )


@dataclass
class DatasetProfile:
    layout: str
    files: DataFrame
    members: dict[str, DataFrame]


def profile_dataset(spark: SparkSession, path: str, sample: int = 10, limit: int = 0) -> DatasetProfile:
    """Profile a stored table of either layout. `limit` reads only so many records, 0 all."""
    table = spark.read.parquet(path)
    layout = T.detect_layout(table)
    files = T.file_statistics(spark, path)
    if layout == "weather":
        records = T.read_weather(spark, path)
        records = records.orderBy("station_id", "date").limit(limit) if limit else records
        per_station = materialize(R.station_profile(records))  # one scan for five members
        members = {
            "bounds": R.dataset_bounds(per_station),
            "coverage": R.metric_coverage(per_station),
            "source_flags": R.source_flag_counts(per_station),
            "physical_validity": R.physical_validity_counts(per_station),
            "combined_quality": R.combined_quality_counts(per_station),
            "extremes": R.extreme_records(records),
            "sample": R.diverse_sample(records, sample),
        }
    elif layout == "consolidated":
        records = T.read_consolidated(spark, path)
        records = records.orderBy("station_id", "date").limit(limit) if limit else records
        members = {"statistics": R.v1_statistics(records), "sample": records.limit(sample)}
    else:
        raise ValueError(f"unknown table layout: {table.columns}")
    return DatasetProfile(layout, files, members)


def refresh_profile(spark: SparkSession, path: str, state: str) -> dict[str, DataFrame]:
    """Profile of a growing table; only files that `state` doesn't know are read.

    `state` is a folder of partial profiles, a row per data file. A file counts by its name and size as
    it lies in the table now, so files that went are left out. Members are those of `profile_dataset`
    but extremes and sample; numbers of stations are estimates (`SKETCH_BITS`), all else is exact. Two
    refreshes at once do no harm, as a file's rows are equal. A table without files is an error.
    """
    files = [(name, file, size) for file, name, size in listed(path, recursive=True) if name.endswith(".parquet")]
    if not files:
        raise ValueError(f"no data files in {path}")
    present = spark.createDataFrame([(name, size) for name, _, size in files], "file string, bytes long")
    try:
        known = spark.read.parquet(state) if listed(state) else None
    except ValueError:
        known = None
    new = present if known is None else present.join(known.select("file", "bytes"), ["file", "bytes"], "left_anti")
    names = {r.file for r in new.collect()}  # names of files, not of rows
    paths = [file for name, file, _ in files if name in names]
    if paths:
        records = T.as_weather(spark.read.parquet(*paths)).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
        # a file without rows has a row of its own, so that it isn't read again
        partial = R.file_profile(records, F.col("_file"))
        new.join(partial, "file", "left").write.mode("append").parquet(state)
    rows = spark.read.parquet(state).join(present, ["file", "bytes"], "left_semi").dropDuplicates(["file", "bytes"])
    rows = materialize(rows.where("n is not null"))
    return {
        "bounds": R.dataset_bounds(rows),
        "coverage": R.metric_coverage(rows),
        "source_flags": R.source_flag_counts(rows),
        "physical_validity": R.physical_validity_counts(rows),
        "combined_quality": R.combined_quality_counts(rows),
    }


@dataclass
class ConsolidatedJob:
    source: FolderSet
    records: DataFrame
    totals: DataFrame
    violations: DataFrame
    station_statistics: DataFrame
    written: bool | None = None


def consolidate_folders(
    spark: SparkSession,
    base: str,
    output: str | None = None,
    allow_incomplete: bool = False,
    parity: bool = False,
    codec: str = "snappy",
    **source_options,
) -> ConsolidatedJob:
    """The older flow: three temperature folders to nine-column records and their report."""
    T.check_codec(codec)
    src = open_folders(spark, base, **source_options)
    records = materialize(V.consolidated_records(src.observations, src.stations, allow_incomplete))
    written = None if output is None else T.write_consolidated(records, output, codec)
    jumps = I.v1_jumps(records).select(
        "station_id", "date", F.lit("SuspiciousJump").alias("violation"), "part", "value"
    )
    found = (
        I.v1_relation_violations(records, parity)
        .unionByName(I.v1_range_violations(records))
        .unionByName(jumps)
    )
    return ConsolidatedJob(
        src, records, I.v1_totals(records), found, I.v1_station_statistics(records, parity), written
    )
