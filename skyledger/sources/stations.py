"""Whole reads: archives and folders to station and observation tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F

from .. import schemas as S
from ..functions import geo as G
from ..tuning import materialize, small_side
from . import archives as A
from . import parsing as P


@dataclass
class ArchiveSet:
    """A set of archives: what is in them, what was left out, stations and observations."""

    entries: DataFrame
    archives: DataFrame
    errors: DataFrame
    stations: DataFrame
    lines: DataFrame
    parsed: DataFrame
    observations: DataFrame
    counted: Observation | None = None

    def line_counts(self) -> dict[str, int]:
        """Rows and defective lines per kind, as the first pass over `observations` counted them; waits for it."""
        if self.counted is None:
            raise ValueError("the archives were opened without count_lines")
        return self.counted.get

    def unknown_stations(self) -> DataFrame:
        """Data files whose station is not in the station list of their archive."""
        files = self.entries.filter(F.col("element").isNotNull() & F.col("station_id").isNotNull())
        listed = self.stations.join(self.archives.select("archive", "archive_ord"), "archive_ord")
        return files.select("archive", "entry", "element", "station_id").join(
            listed.select("archive", "station_id"), ["archive", "station_id"], "left_anti"
        )


def open_archives(
    spark: SparkSession,
    folder: str,
    pattern: str | None = None,
    elements: list[str] | None = None,
    stations: list[int] | None = None,
    temperature_defects: str = "fail",
    other_defects: str = "drop",
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = A.SPLIT_BYTES,
    count_lines: bool = False,
) -> ArchiveSet:
    """The usable archives of `folder` in file-name order.

    Unusable archives are listed in `errors`; it is an error when none is left. `elements` and
    `stations` leave entries unread by their name, and so are files of stations that their archive's
    list lacks. With `count_lines`, the first pass over the observations counts rows and defects.
    """
    listing = list_contents(spark, folder, pattern)
    return _opened(listing, elements, stations, temperature_defects, other_defects, header_lines, split_bytes, count_lines)


def open_listed(spark: SparkSession, archives: DataFrame, **options) -> ArchiveSet | None:
    """The usable ones of some listed archives, with the options of `open_archives`; None if there are none."""
    listing = _contents(archives)
    defaults = {"elements": None, "stations": None, "temperature_defects": "fail", "other_defects": "drop"}
    options = defaults | {"header_lines": S.HEADER_LINES, "split_bytes": A.SPLIT_BYTES, "count_lines": False} | options
    return None if listing.archives.isEmpty() else _opened(listing, **options)


def _opened(listing: Listing, elements, stations, temperature_defects, other_defects, header_lines, split_bytes, count_lines) -> ArchiveSet:
    lines = A.archive_metadata_lines(listing.archives, S.STATIONS_FILE)
    # small, and looked at several times: unpacked once
    found = materialize(P.last_station_wins(P.parse_station_lines(lines), "archive_ord"))
    files = A.data_entries(listing.entries, listing.archives, elements, stations)
    known = files.join(found.select("archive_ord", "station_id"), ["archive_ord", "station_id"], "left_semi")
    data = A.archive_lines(known, header_lines, split_bytes)
    parsed = P.parse_observation_lines(data)
    counted = Observation() if count_lines else None
    rows = P.observed_lines(parsed, counted) if counted else parsed
    good = P.good_observations(rows, temperature_defects, other_defects)
    return ArchiveSet(listing.entries, listing.archives, listing.errors, found, data, parsed, good, counted)


@dataclass
class Listing:
    """What a set of archives holds by their directories: entries, usable archives, those left out."""

    entries: DataFrame
    archives: DataFrame
    errors: DataFrame


def list_contents(spark: SparkSession, folder: str, pattern: str | None = None) -> Listing:
    """Opens each archive of `folder` once; no line of a station list or data file is parsed."""
    found = _contents(A.list_archives(spark, folder, pattern))
    if found.archives.isEmpty():
        raise ValueError(f"no valid zip files found in {folder}")
    return found


def _contents(archives: DataFrame) -> Listing:
    entries = materialize(A.archive_entries(archives))
    return Listing(entries, A.usable_archives(entries), A.catalog_errors(entries))


# Bits of the order of lines in files that share a station and element: file, byte offset.
_FILE_SHIFT = 40


def _file_order(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Packs the processing order of files that share a station and element, and of their lines."""
    # Files of one station and element differ in the zeros of their number, or lie in folders of one name.
    nth = F.row_number().over(W.partitionBy("archive", "station_id", "element").orderBy("entry", "path")) - 1
    numbered = files.select("path", "archive", "entry", "station_id", "element", nth.alias("_nth"))
    several = numbered.filter(F.col("_nth") > 0).select("path", "_nth")
    nth = F.coalesce("_nth", F.lit(0)).cast("long")
    too_big = (F.col("line_pos") >= 1 << _FILE_SHIFT) | (nth >= 1 << (S.SEQ_BITS - _FILE_SHIFT))
    seq = F.shiftleft(nth, _FILE_SHIFT) + F.col("line_pos")
    return (
        rows.join(small_side(several), "path", "left")
        .withColumn("seq", F.when(too_big, F.raise_error(F.lit("too many or too large files of a station")).cast("long")).otherwise(seq))
        .drop("_nth", "line_pos", "path")
    )


@dataclass
class FolderSet:
    """The older layout: one folder per temperature element, station list in the first."""

    stations: DataFrame
    parsed: DataFrame
    observations: DataFrame


def read_station_list(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """One station list file. `line_pos` orders its lines, so the last line of a station wins."""
    files = (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            "path",
            "length",
            F.lit("").alias("archive"),
            F.element_at(F.split("path", "/"), -1).alias("entry"),
            F.lit("").alias("element"),
            F.lit(0).alias("station_id"),
        )
    )
    lines = A.folder_lines(files, header_lines=0).select("line_pos", "line")
    return P.last_station_wins(P.parse_station_lines(lines, on_bad))


def open_folders(
    spark: SparkSession,
    base: str,
    station: int | None = None,
    uk_only: bool = True,
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = A.SPLIT_BYTES,
    temperature_defects: str = "fail",
) -> FolderSet:
    """Temperatures below `base`. Files of other countries, or of other stations than `station`,
    are dropped from the listing and never opened."""
    base = base.rstrip("/")
    stations = read_station_list(spark, f"{base}/{next(iter(S.V1_FOLDERS))}/{S.STATIONS_FILE}")
    files = A.list_station_files(spark, [f"{base}/{f}" for f in S.V1_FOLDERS])
    belongs: Column = F.lit(False)
    for folder, prefix in S.V1_FOLDERS.items():
        belongs = belongs | ((F.col("archive") == folder) & (F.col("element") == prefix))
    files = files.filter(belongs)
    if station is not None:
        files = files.filter(F.col("station_id") == station)
    elif uk_only:
        uk = stations.filter(G.is_uk_country(F.col("country"))).select("station_id")
        files = files.join(small_side(uk), "station_id", "left_semi")
    lines = A.folder_lines(files, header_lines, split_bytes)
    parsed = _file_order(P.parse_observation_lines(lines), files)
    return FolderSet(stations, parsed, P.good_observations(parsed, temperature_defects))


def read_station_files(
    spark: SparkSession,
    path: str,
    station: int | None = None,
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = A.SPLIT_BYTES,
    temperature_defects: str = "fail",
) -> DataFrame:
    """Observations of one station file or of a folder of them; station and element by file name."""
    files = A.list_station_files(spark, path)
    if station is not None:
        files = files.filter(F.col("station_id") == station)
    lines = A.folder_lines(files, header_lines, split_bytes)
    return P.good_observations(
        _file_order(P.parse_observation_lines(lines), files), temperature_defects
    )
