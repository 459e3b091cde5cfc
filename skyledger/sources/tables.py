"""Parquet tables of weather records: write, read, detect the layout, describe the files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas as S
from . import ranges

cloudpickle.register_pickle_by_value(ranges)


def check_codec(name: str) -> str:
    """The codec name Spark uses; unknown names are refused before any work is done.

    For lz4 that is the frame all Parquet readers share.
    """
    if name not in S.CODECS:
        raise ValueError(f"unsupported compression: {name}")
    return "lz4_raw" if name == "lz4" else name


FILE_ROWS = 1 << 20
_YEARS = 1 << 14  # a key holds the station and the year


def in_sorted_files(records: DataFrame, like: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """`records` sorted by (station, day) over tasks, each with its own range of (station, year).

    `like` has station_id and date of at least the same keys and is cheap to read, for instance stored
    rows before a merge. Quantiles of its keys are the split points, so `records` are computed once; a
    range exchange would compute them once more for its sample.
    """
    key = F.col("station_id") * _YEARS + F.year("date")
    rows = like.where("date is not null").agg(F.count(F.lit(1)).alias("n")).first().n
    files = max(1, -(-rows // file_rows))
    if files == 1:
        return records.repartitionById(1, F.lit(0)).sortWithinPartitions("station_id", "date")
    shares = [i / files for i in range(1, files)]
    cuts = like.agg(F.percentile_approx(key, shares, max(10_000, 10 * files)).alias("cuts")).first().cuts
    cuts = sorted(set(cuts))

    def part(lo: int, hi: int) -> Column:
        """The number of cuts that a key lies behind, by halving, so an expression of any size is short to evaluate."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= cuts[mid], part(lo, mid)).otherwise(part(mid + 1, hi))

    dealt = records.repartitionById(len(cuts) + 1, part(0, len(cuts)))
    return dealt.sortWithinPartitions("station_id", "date")


def _write(df: DataFrame, path: str, codec: str, row_group_rows: int, probe, mode: str, like=None) -> bool:
    codec = check_codec(codec)
    if (df if probe is None else probe).isEmpty():
        return False
    (
        (df.orderBy("station_id", "date") if like is None else in_sorted_files(df, like))
        .write.mode(mode)
        .option("compression", codec)
        .option("parquet.block.row.count.limit", str(row_group_rows))
        .parquet(path)
    )
    return True


def write_weather(
    records: DataFrame,
    path: str,
    codec: str = "snappy",
    row_group_rows: int = S.ROW_GROUP_ROWS,
    probe: DataFrame | None = None,
    mode: str = "errorifexists",
    like: DataFrame | None = None,
) -> bool:
    """Write wide records sorted by (station, day); an empty result writes nothing.

    The sort is a range exchange on both keys, so one large station is spread over several files.
    `probe` is something cheaper that is empty exactly when `records` is, for instance the
    observations before their pivot. With `like`, stored rows of the same stations and days, the
    records are computed once (`in_sorted_files`).
    """
    return _write(records.select(*S.WEATHER_COLUMNS), path, codec, row_group_rows, probe, mode, like)


def write_consolidated(
    records: DataFrame,
    path: str,
    codec: str = "snappy",
    row_group_rows: int = S.ROW_GROUP_ROWS,
    probe: DataFrame | None = None,
    mode: str = "errorifexists",
) -> bool:
    return _write(records.select(*S.CONSOLIDATED_COLUMNS), path, codec, row_group_rows, probe, mode)


def detect_layout(df: DataFrame) -> str:
    """`consolidated` (9 columns), `weather` (13 or 16) or `unknown`, by column count and names."""
    names = df.columns
    if names == S.CONSOLIDATED_COLUMNS:
        return "consolidated"
    if names in (S.WEATHER_COLUMNS, S.WEATHER_COLUMNS[:13]):
        return "weather"
    return "unknown"


def as_weather(df: DataFrame) -> DataFrame:
    """Bring a 13- or 16-column table to the 16-column layout; any other layout gives no rows.

    Absent validations are NULL, unknown validation text is NULL, unsigned ids become BIGINT.
    """
    if detect_layout(df) != "weather":
        return df.sparkSession.createDataFrame([], S.WEATHER)

    def column(name: str) -> Column:
        kind = S.WEATHER[name].dataType
        if name not in df.columns:
            return F.lit(None).cast(kind).alias(name)
        value = F.col(name)
        if name in S.VALIDATION_COLUMNS:
            value = F.when(value.isin("Valid", "Suspect", "Invalid"), value)
        return value.cast(kind).alias(name)

    return df.select(*[column(n) for n in S.WEATHER_COLUMNS])


def read_weather(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    df = as_weather(spark.read.parquet(path))
    return df.limit(limit) if limit else df


def read_consolidated(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.CONSOLIDATED])
    return df.limit(limit) if limit else df


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Rows, row groups, bytes and codec per data file, from the file footers.

    Spark lists the files and spreads the footer reads; no data page is read.
    """

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file, size in zip(batch["path"], batch["length"]):
                with ranges.open_input(file) as raw:
                    meta = pq.ParquetFile(raw).metadata
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                codecs = sorted({g.column(0).compression for g in groups})
                rows.append(
                    (file, meta.num_rows, len(groups), [g.num_rows for g in groups], size, ",".join(codecs))
                )
            yield pd.DataFrame(
                rows, columns=["file", "rows", "row_groups", "row_group_rows", "bytes", "codec"]
            )

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    return files.mapInPandas(
        footers,
        "file string, rows long, row_groups int, row_group_rows array<long>, bytes long, codec string",
    )


def table_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Totals of `file_statistics` over the table."""
    return file_statistics(spark, path).agg(
        F.sum("rows").alias("total_rows"),
        F.sum("row_groups").alias("row_groups"),
        F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("files"),
        F.array_join(F.array_sort(F.collect_set("codec")), ",").alias("codecs"),
    )
