"""What archives contain, from entry names, metadata lines and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions import geo as G
from ..functions import text as X


def element_files(entries: DataFrame) -> DataFrame:
    """Files and stations per archive and element. Needs archive, entry, element, station_id."""
    named = entries.filter(F.col("element").isNotNull())
    return named.groupBy("archive", "element").agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct("station_id").alias("stations")
    )


def archive_catalog(entries: DataFrame) -> DataFrame:
    """Per archive: elements, station and entry counts, coverage per element."""
    has = {p: F.count_if(F.col("element") == p) for p in S.PREFIXES}
    counts = entries.groupBy("archive").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.countDistinct(F.when(F.col("element").isNotNull(), F.col("station_id"))).alias("station_count"),
        *[n.alias(f"files_{p}") for p, n in has.items()],
    )
    stations = F.nullif(F.col("station_count"), F.lit(0))
    temps = [F.col(f"files_{p}") > 0 for p in S.TEMPERATURE_PREFIXES]
    return counts.select(
        "*",
        F.concat_ws(",", *[F.when(F.col(f"files_{p}") > 0, F.lit(p)) for p in S.PREFIXES]).alias("elements"),
        *[(F.col(f"files_{p}") / stations).alias(f"coverage_{p}") for p in S.PREFIXES],
        (temps[0] | temps[1] | temps[2]).alias("has_temperature_data"),
        (temps[0] & temps[1] & temps[2]).alias("has_complete_temperature"),
    )


def archive_country(codes: DataFrame) -> DataFrame:
    """Most frequent country per archive (ties by name) and how many there are."""
    per = codes.groupBy("archive", "country").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((-F.col("n")).alias("n"), F.col("country"))
    # two-letter codes: at most a few hundred per archive
    return per.groupBy("archive").agg(
        F.min(rank)["country"].alias("country"),
        F.count(F.lit(1)).alias("country_count"),
        F.array_join(F.array_sort(F.collect_list("country")), ",").alias("countries"),
    )


def archive_dates(obs: DataFrame, *keys: str) -> DataFrame:
    return obs.groupBy(*(keys or ("archive",))).agg(
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date")
    )


def archive_summary(catalog: DataFrame) -> DataFrame:
    """Totals over all archives."""
    present = F.filter(
        F.array(*[F.when(F.max(f"files_{p}") > 0, F.lit(p)) for p in S.PREFIXES]), lambda x: x.isNotNull()
    )
    return catalog.agg(
        F.count(F.lit(1)).alias("archives"),
        F.sum("total_files").alias("total_files"),
        F.size(present).alias("unique_metrics"),
    )


def archives_per_element(files: DataFrame) -> DataFrame:
    out = files.groupBy("element").agg(
        F.count(F.lit(1)).alias("archives"), F.sum("files").alias("files")
    )
    return out.select(
        "element",
        X.element_display_name(F.col("element")).alias("display_name"),
        X.element_units(F.col("element")).alias("units"),
        "archives",
        "files",
    )


def unlisted_elements(files: DataFrame, listed: DataFrame, with_list: DataFrame | None = None) -> DataFrame:
    """Elements with files but without a line in the archive's element list.

    `with_list` names the archives that have a list, even one without an element we know; others are
    left out, as nothing can be compared there. By default they are those with a line in `listed`.
    """
    known = listed.select("archive", "element").distinct()
    if with_list is None:
        with_list = known.select("archive").distinct()
    have = files.join(with_list, "archive", "left_semi")
    return have.join(known, ["archive", "element"], "left_anti").select("archive", "element")


def station_report(stations: DataFrame) -> DataFrame:
    """Stations with coordinates as text and the place tests."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return stations.select(
        "station_id",
        "station_name",
        "country",
        X.degrees_to_dms(lat).alias("latitude_dms"),
        X.degrees_to_dms(lon).alias("longitude_dms"),
        G.is_uk_country(F.col("country")).alias("is_uk"),
        G.in_box(lat, lon).alias("in_uk_box"),
        G.station_in_range(F.col("station_name"), lat, lon).alias("in_range"),
    )
