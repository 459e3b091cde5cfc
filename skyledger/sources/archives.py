"""Station archives (ZIP) and station folders as DataFrames of text lines.

Spark lists the files, cuts their text into byte ranges and spreads the ranges over tasks. A large
archive, or one large file in it, is therefore read by many tasks.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .. import schemas as S
from ..functions import text as X
from . import ranges

# The task-side module travels with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(ranges)

SPLIT_BYTES = 64 << 20

ENTRY_SCHEMA = (
    "path string, archive string, entry string, entry_ord int, element string, station_id long, "
    "entry_bytes long, base long, error string, header_offset long, stored_bytes long, method int, crc long"
)
LINE_SCHEMA = "archive_ord int, station_id long, element string, seq long, line string"
LINEAGE_SCHEMA = "archive string, entry string, " + LINE_SCHEMA


def list_archives(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """The `.zip` files right below `folder`, optionally those whose name contains `pattern`.

    `folder` may also be one archive.
    """
    try:
        files = ranges.listed(folder)
    except ValueError as e:
        raise ValueError(f"no valid zip files found in {folder}") from e
    found = [f for f in files if f[1].endswith(".zip") and (not pattern or pattern in f[1])]
    frame = spark.createDataFrame(found, "path string, archive string, length long")
    return frame.repartition(max(1, min(len(found), spark.sparkContext.defaultParallelism)))


def archive_entries(listing: DataFrame) -> DataFrame:
    """One row per archive entry, from the archives' directories; entries are not unpacked.

    An archive that cannot be used, be it damaged, encrypted or packed in an unknown way, gives one
    row with `error` set and no entry. Failing reads aren't caught, so the task runs again.
    """
    prefixes, stations_file, marks = S.PREFIXES, S.STATIONS_FILE, S.BANNER_MARKS

    def rows_of(path: str, archive: str) -> list[dict]:
        try:
            with ranges.open_input(path) as raw, zipfile.ZipFile(raw) as z:
                data = {e[1]: e for e in ranges.usable_entries(z, prefixes, stations_file, marks)}
                rows = []
                for number, info in enumerate(z.infolist()):
                    _, _, element, station, base = data.get(number, (None,) * 5)
                    rows.append(
                        {"path": path, "archive": archive, "entry": info.filename,
                         "entry_ord": number, "element": element, "station_id": station,
                         "entry_bytes": info.file_size, "base": base, "error": None,
                         "header_offset": info.header_offset, "stored_bytes": info.compress_size,
                         "method": info.compress_type, "crc": info.CRC}
                    )
                return rows
        except (ValueError, EOFError, RuntimeError, zlib.error, zipfile.BadZipFile) as e:
            # bad or unreadable contents; NotImplementedError is a RuntimeError. A failing storage raises.
            return [{"path": path, "archive": archive, "error": f"{type(e).__name__}: {e}"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("archive", pa.string()), ("entry", pa.string()),
             ("entry_ord", pa.int32()), ("element", pa.string()), ("station_id", pa.int64()),
             ("entry_bytes", pa.int64()), ("base", pa.int64()), ("error", pa.string()),
             ("header_offset", pa.int64()), ("stored_bytes", pa.int64()), ("method", pa.int32()), ("crc", pa.int64())]
        )
        for batch in batches:
            for path, archive in zip(batch["path"].to_pylist(), batch["archive"].to_pylist()):
                yield pa.RecordBatch.from_pylist(rows_of(path, archive), schema=schema)

    return listing.select("path", "archive").mapInArrow(run, ENTRY_SCHEMA)


def catalog_errors(entries: DataFrame) -> DataFrame:
    """Archives left out, with the reason."""
    return entries.filter(F.col("error").isNotNull()).select("archive", "error")


def usable_archives(entries: DataFrame) -> DataFrame:
    """One row per usable archive with its order number (by file name) and amount of text."""
    per_archive = (
        entries.filter(F.col("error").isNull())
        .groupBy("path", "archive")
        .agg(F.max(F.col("base") + F.col("entry_bytes") + 1).alias("text_bytes"))
    )
    # One row per archive: the size of the file listing, not of the data.
    number = F.row_number().over(W.orderBy("archive", "path")) - 1
    too_big = (number >= 1 << (63 - S.SEQ_BITS)) | (F.col("text_bytes") >= 1 << S.SEQ_BITS)
    return per_archive.select(
        "path",
        "archive",
        F.when(too_big, F.raise_error(F.lit("too many or too large archives")).cast("int"))
        .otherwise(number)
        .alias("archive_ord"),
        "text_bytes",
    )


def tasks_for(spark: SparkSession, total_bytes: int, files: int, split_bytes: int) -> int:
    """One task per split's worth of text; small inputs still use the cores there are files for."""
    return max(1, -(-total_bytes // split_bytes), min(files, spark.sparkContext.defaultParallelism))


def _spread(splits: DataFrame, split_bytes: int, tasks: int | None) -> DataFrame:
    """Give each task about one split's worth of text. The rows moved are names and offsets."""
    if tasks is None:
        total = splits.agg(F.sum(F.col("hi") - F.col("lo")), F.count(F.lit(1))).first()
        tasks = tasks_for(splits.sparkSession, total[0] or 0, total[1], split_bytes)
    return splits.repartition(tasks)


def _cut(files: DataFrame, size: str, split_bytes: int) -> DataFrame:
    cuts = F.sequence(F.lit(0).cast("long"), F.col(size) - 1, F.lit(split_bytes).cast("long"))
    return (
        files.filter(F.col(size) > 0)
        .withColumn("lo", F.explode(cuts))
        .withColumn("hi", F.least(F.col("lo") + split_bytes, F.col(size)))
    )


def data_entries(
    entries: DataFrame,
    archives: DataFrame,
    elements: list[str] | None = None,
    stations: list[int] | None = None,
) -> DataFrame:
    """Data entries of the usable archives; `elements` and `stations` leave others out by name."""
    named = entries.filter(F.col("error").isNull() & F.col("element").isNotNull() & F.col("station_id").isNotNull())
    if elements:
        named = named.filter(F.col("element").isin(elements))
    if stations:
        named = named.filter(F.col("station_id").isin(stations))
    return named.join(archives.select("path", "archive_ord"), "path")


def archive_lines(
    files: DataFrame,
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = SPLIT_BYTES,
    lineage: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Data lines of the entries in `files`, as `data_entries` gives them.

    A task gets entries by their places in the archives, about one split's worth of text, and reads
    nothing else. A compressed entry can't be entered in the middle and is one task's stream; an
    uncompressed one is cut like a plain file. `tasks` saves the pass that sizes the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [("archive_ord", pa.int32()), ("station_id", pa.int64()), ("element", pa.string())]
        if lineage:
            names = [("archive", pa.string()), ("entry", pa.string()), *names]
        yield from ranges.in_large_batches(pieces(batches, [n for n, _ in names]), pa.schema(names), "seq")

    def pieces(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
        path, raw = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:  # rows come in the order of archives and entries
                    if raw is not None:
                        raw.close()
                    path, raw = row["path"], ranges.open_input(row["path"])
                with ranges.open_entry(raw, row) as stream:
                    for offsets, text in ranges.text_in_range(stream, row["lo"], row["hi"], header_lines, row["entry_bytes"]):
                        yield tuple(row[n] for n in names), offsets + row["base"], text
        if raw is not None:
            raw.close()

    step = F.when(F.col("method") == zipfile.ZIP_STORED, F.lit(split_bytes)).otherwise(F.col("entry_bytes"))
    cuts = F.sequence(F.lit(0).cast("long"), F.col("entry_bytes") - 1, step.cast("long"))
    splits = (
        files.filter("entry_bytes > 0")
        .withColumn("lo", F.explode(cuts))
        .withColumn("hi", F.least(F.col("lo") + step, F.col("entry_bytes")))
    )
    schema = LINEAGE_SCHEMA if lineage else LINE_SCHEMA
    if tasks is None:
        total = splits.agg(F.sum(F.col("hi") - F.col("lo")), F.count(F.lit(1))).first()
        tasks = tasks_for(splits.sparkSession, total[0] or 0, total[1], split_bytes)
    place = ("archive_ord", "header_offset", "lo")
    return splits.repartitionByRange(tasks, *place).sortWithinPartitions(*place).mapInArrow(run, schema)


def archive_metadata_lines(archives: DataFrame, entry: str) -> DataFrame:
    """Lines of one metadata entry (`stations.txt`, `elements.txt`) of every archive that has it.

    The numbered archives come as one partition, so they are dealt over the tasks again.
    """
    tasks = 2 * archives.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with ranges.open_input(row["path"]) as raw, zipfile.ZipFile(raw) as z:
                    if entry not in z.NameToInfo:
                        continue
                    with z.open(entry) as stream:
                        for offsets, lines in ranges.lines_in_range(stream, 0, 1 << 62, 0):
                            n = len(lines)
                            yield pa.RecordBatch.from_pydict(
                                {
                                    "archive": pa.repeat(row["archive"], n),
                                    "archive_ord": pa.repeat(pa.scalar(row["archive_ord"], pa.int32()), n),
                                    "line_pos": pa.array(offsets, pa.int64()),
                                    "line": lines,
                                }
                            )

    return archives.repartition(tasks).mapInArrow(run, "archive string, archive_ord int, line_pos long, line string")


# --- folders of plain files --------------------------------------------------------------------


def list_station_files(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """Station files in or below the folders, by name; other files are left out."""
    folders = [folders] if isinstance(folders, str) else folders
    found = [(path, size) for f in folders for path, name, size in ranges.listed(f, recursive=True) if "_STAID" in name and name.endswith(".txt")]
    listing = spark.createDataFrame(found, "path string, length long")
    return name_station_files(listing.repartition(max(1, min(len(found), spark.sparkContext.defaultParallelism))))


def name_station_files(files: DataFrame, *keep: str) -> DataFrame:
    """Element, station and folder from the path of each file; `keep` has further columns."""
    parts = F.split("path", "/")
    entry = F.element_at(parts, -1)
    return files.select(
        "path",
        "length",
        F.element_at(parts, -2).alias("archive"),
        entry.alias("entry"),
        X.entry_prefix(entry).alias("element"),
        X.entry_station(entry).alias("station_id"),
        *keep,
    ).filter(F.col("element").isNotNull() & F.col("station_id").isNotNull())


def folder_lines(
    files: DataFrame,
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = SPLIT_BYTES,
    tasks: int | None = None,
    numbers: tuple[str, ...] = (),
) -> DataFrame:
    """Data lines of plain station files, with the file they come from.

    `files` has path, length, archive, entry, element and station_id. `line_pos` is the byte offset
    of the line in its file. `tasks` saves the pass over the listing that sizes the tasks; with 0, files are
    read where their rows lie. `numbers` names int columns of `files` that the lines have as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [("path", pa.string()), ("archive", pa.string()), ("entry", pa.string()), ("station_id", pa.int64()), ("element", pa.string())]
        names += [(n, pa.int32()) for n in numbers]
        pieces = (piece for batch in batches for row in batch.to_pylist() for piece in read_split(row, [n for n, _ in names]))
        yield from ranges.in_large_batches(pieces, pa.schema(names), "line_pos")

    def read_split(row: dict, names: list[str]) -> Iterator[tuple]:
        with ranges.open_input(row["path"]) as stream:
            hi = row["hi"] if row["hi"] < row["length"] else 1 << 62  # a file may have become longer
            for offsets, text in ranges.text_in_range(stream, row["lo"], hi, header_lines, row["length"]):
                yield tuple(row[n] for n in names), offsets, text

    splits = _cut(files, "length", split_bytes)
    return (splits if tasks == 0 else _spread(splits, split_bytes, tasks)).mapInArrow(
        run,
        "path string, archive string, entry string, station_id long, element string, "
        + "".join(f"{n} int, " for n in numbers)
        + "line_pos long, line string",
    )
