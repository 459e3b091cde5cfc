"""Inputs in the shape of weather data, derived by Spark from the provided tables."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..sources import ranges

cloudpickle.register_pickle_by_value(ranges)

# The derived order numbers need more bits than text offsets; there are four archives.
SEQ_BITS = 56
_LINE_BITS = 53


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station_id, obs_date, element, line_no, tenths (-9999 is missing), qflag, l_partkey.

    Every supplier is a station, so stations grow with the data. A tenth of them report within forty
    days, so that months are dense and keys repeat.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey + 1 as bigint) as station_id",
        """case when l_suppkey % 10 = 1
             then date_add(date'1995-01-01', cast(datediff(cast(l_shipdate as date), date'1995-01-01') % 40 as int))
             else cast(l_shipdate as date) end as obs_date""",
        """case l_linenumber % 5 when 0 then 'TN' when 1 then 'TX' when 2 then 'TG'
             when 3 then 'RR' else 'FG' end as element""",
        "(l_orderkey * 10 + l_linenumber) * 100000 + l_partkey as line_no",
        """cast(case when l_partkey % 37 = 0 then -9999
             when l_partkey % 101 = 0 then 650
             when l_partkey % 53 = 0 then -400
             when l_linenumber % 5 = 3 then cast(floor(l_extendedprice) as bigint) % 6000
             when l_linenumber % 5 = 4 then cast(floor(l_extendedprice) as bigint) % 700
             else cast(floor(l_extendedprice) as bigint) % 300 - 50
               + 40 * (case l_linenumber % 5 when 0 then -1 when 1 then 1 else 0 end)
             end as int) as tenths""",
        """cast(case l_returnflag when 'A' then 1 when 'R' then 0
             else case when l_partkey % 29 = 0 then 9 else 0 end end as int) as qflag""",
        "l_partkey",
        "l_orderkey",
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> int:
    """Number of raw observations, from the files' footers."""
    return table(spark, sf_dir, "lineitem").count()


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station list: every supplier but each tenth, which is unknown on purpose."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_suppkey % 10 <> 0")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
        .selectExpr(
            "cast(s_suppkey + 1 as bigint) as station_id",
            "s_name as station_name",
            "case when n_regionkey = 3 then 'GB' else 'IE' end as country",
            "49.5D + cast(s_suppkey % 115 as double) / 10.0D as latitude",
            "-8.0D + cast(s_suppkey % 100 as double) / 10.0D as longitude",
        )
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a station, so that the number of stations grows with the data."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as bigint) as station_id",
        "s_name as station_name",
        "case s_nationkey % 4 when 0 then 'GB' when 1 then 'uk' when 2 then 'United Kingdom' else 'IE' end as country",
        "48.0D + cast(s_suppkey * 37 % 1400 as double) / 100.0D as latitude",
        "-9.0D + cast(s_suppkey * 61 % 1200 as double) / 100.0D as longitude",
    )


def _rank() -> Column:
    return F.element_at(
        F.create_map(*[F.lit(x) for i, p in enumerate(S.PREFIXES) for x in (p, i)]), F.col("element")
    )


def _seq() -> Column:
    return F.shiftleft(_rank().cast("long"), _LINE_BITS) + F.col("line_no")


def _value(tenths: Column) -> Column:
    return (tenths.cast("float") / F.lit(10)).cast("float")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source: long observations without the missing ones."""
    return (
        raw_observations(spark, sf_dir)
        .filter(F.col("tenths") != -9999)
        .select(
            F.lit(0).alias("archive_ord"),
            "station_id",
            "obs_date",
            "element",
            _value(F.col("tenths")).alias("value"),
            "qflag",
            _seq().alias("seq"),
        )
    )


ARCHIVES = ["a", "b", "c", "d"]


def archive_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four archives: extremes in a, means in b, the rest in c; d holds changed copies of a part."""
    home = F.when(F.col("element").isin("TN", "TX"), 0).when(F.col("element") == "TG", 1).otherwise(2)
    copied = F.col("l_partkey") % 7 == 0
    return (
        raw_observations(spark, sf_dir)
        .filter(F.col("tenths") != -9999)
        .withColumn("archive_ord", F.explode(F.when(copied, F.array(home, F.lit(3))).otherwise(F.array(home))))
        .select(
            "archive_ord",
            "station_id",
            "obs_date",
            "element",
            _value(F.col("tenths") + F.when(F.col("archive_ord") == 3, 5).otherwise(0)).alias("value"),
            F.when((F.col("archive_ord") == 3) & (F.col("l_partkey") % 2 == 0), 1)
            .otherwise(F.col("qflag"))
            .alias("qflag"),
            _seq().alias("seq"),
        )
    )


def archive_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station list per archive: names carry the archive, and archive d lacks a share of them."""
    letters = F.posexplode(F.array(*[F.lit(a) for a in ARCHIVES])).alias("archive_ord", "archive")
    return (
        stations(spark, sf_dir)
        .select("*", letters)
        .filter((F.col("archive") != "d") | (F.col("station_id") % 17 != 5))
        .withColumn("station_name", F.concat_ws("/", "station_name", "archive"))
    )




# --- text --------------------------------------------------------------------------------------


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of station files, a few of them damaged in every way the rules know."""
    raw = raw_observations(spark, sf_dir)
    p = F.col("l_partkey")
    day = F.date_format("obs_date", "yyyyMMdd")
    good = F.concat(
        F.lit("  "), F.col("l_orderkey").cast("string"), F.lit(", "), day, F.lit(", "),
        F.col("tenths").cast("string"), F.lit(",   "), F.col("qflag").cast("string"), F.when(p % 13 == 0, "\t\r\n").otherwise(""),
    )
    line = (
        F.when(p % 211 == 0, F.concat(F.lit("x1,"), day, F.lit(",12,0")))
        .when(p % 223 == 0, F.lit("101,19500230,12,0"))
        .when(p % 227 == 0, F.concat(F.lit("101,"), day, F.lit(",1.5,0")))
        .when(p % 229 == 0, F.concat(F.lit("101,"), day, F.lit(",125,5")))
        .when(p % 233 == 0, F.concat(F.lit("101,"), day, F.lit(",-9999,x")))
        .when(p % 239 == 0, F.concat(F.lit("101,"), day, F.lit(",125")))
        .when(p % 241 == 0, F.concat(F.lit("101,"), day, F.lit(",1f,300")))
        .when(p % 251 == 0, F.lit("   \t "))
        .otherwise(good)
    )
    return raw.select(
        F.lit(0).alias("archive_ord"), "station_id", "element", _seq().alias("seq"), line.alias("line")
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a station list, one per customer, with headings and lines that are too short."""
    k = F.col("c_custkey")
    dms = F.format_string("%d:%02d:%02d", k % 90, k * 7 % 60, k * 11 % 60)
    west = F.concat(F.when(k % 2 == 0, "-").otherwise(""), F.format_string("%d:%02d:%02d", k % 180, k * 3 % 60, k * 5 % 60))
    height = F.when(k % 5 == 0, "-999").when(k % 7 == 0, "").otherwise((k % 900).cast("string"))
    line = (
        F.when(k % 31 == 0, F.lit("STAID,STANAME,CN,LAT,LON,HGHT"))
        .when(k % 37 == 0, F.concat_ws(",", k.cast("string"), F.lit("SHORT"), F.lit("GB")))
        .when(k % 41 == 0, F.concat_ws(",", k.cast("string"), F.col("c_name"), F.lit("IE"), F.lit("53.5"), F.lit("-6.25"), height))
        .when(k % 43 == 0, F.concat_ws(",", k.cast("string"), F.col("c_name"), F.lit("IE"), F.lit("53:61:00"), F.lit("-6:00:00"), height))
        .otherwise(F.concat(F.lit("  "), F.concat_ws(" , ", k.cast("string"), F.col("c_name"), F.lit("GB"), dms, west, height)))
    )
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line_pos"), line.alias("line"))


# --- files -------------------------------------------------------------------------------------


def texts_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, bool, memoryview]]:
    """(keys, whether its lines stand before the header, text) per run of equal keys; no line becomes an object."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cut = np.zeros(n, bool)
        for key in (*keys, "early"):
            column = batch[key]
            cut[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(cut)))
        text = batch["line"].cast(pa.string())
        ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1]
        data = memoryview(text.buffers()[2])
        at = pa.array(starts)
        names = zip(*(batch[k].take(at).to_pylist() for k in (*keys, "early")))
        for (*name, early), a, b in zip(names, ends[starts], ends[np.append(starts[1:], n)]):
            yield tuple(name), early, data[a:b]


def _in_order(lines: DataFrame, home: str, *keys: str) -> DataFrame:
    """Rows dealt by `home` and sorted; lines with their ends. Lines without a place stand before the header."""
    rows = lines.repartition(home).sortWithinPartitions(*keys, "pos")
    return rows.select(*keys, F.col("pos").isNull().alias("early"), F.concat("line", F.lit("\n")).alias("line"))


def write_archives(lines: DataFrame, folder: str, header: str = "") -> DataFrame:
    """Write (archive, entry, pos, line) rows as ZIP files; returns one row per archive.

    Rows are sorted inside the tasks and streamed into the entries, so no archive is held in memory.
    Station files begin with the text `header`.
    """
    head = header.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = entry = None
        raw = out = stream = None
        due = b""  # a header that is still to be written
        done = []

        def close():
            stream.write(due)
            stream.close()
            out.close()
            raw.close()
            ranges.rename(f"{folder}/.{name}", f"{folder}/{name}")
            done.append(name)

        for (archive, file), early, text in texts_of(batches, "archive", "entry"):
            if archive != name:
                if out is not None:
                    close()
                raw = ranges.open_output(f"{folder}/.{archive}")
                out = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                name, entry = archive, None
            if file != entry:
                if entry is not None:
                    stream.write(due)
                    stream.close()
                stream = out.open(file, "w")
                entry, due = file, head if "_STAID" in file else b""
            if due and not early:
                stream.write(due)
                due = b""
            stream.write(text)
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array(done, pa.string())})

    return _in_order(lines, "archive", "archive", "entry").mapInArrow(run, "archive string")


def write_station_files(lines: DataFrame, folder: str, header: str = "") -> DataFrame:
    """Write (file, pos, line) rows as plain files below `folder`; returns one row per file. Station
    files begin with the text `header`."""
    head = header.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, due, done = None, None, b"", []

        def close():
            out.write(due)
            out.close()
            ranges.rename(f"{folder}/{name}.part", f"{folder}/{name}")
            done.append(name)

        for (file,), early, text in texts_of(batches, "file"):
            if file != name:
                if out is not None:
                    close()
                out, name, due = ranges.open_output(f"{folder}/{file}.part"), file, head if "_STAID" in file else b""
            if due and not early:
                out.write(due)
                due = b""
            out.write(text)
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"file": pa.array(done, pa.string())})

    return _in_order(lines, "file", "file").mapInArrow(run, "file string")
