"""Station files landing in `<folder>/<archive>/<ELEMENT>_STAID<number>.txt`.

New files become long observation rows whose place in the order of all rows follows from names alone:
archive, element, file, byte offset. The states of batches can therefore be merged when they are read or
compacted, in whatever order files land; no batch reads earlier rows again. A reader
sees the state between two batches, never one half written.

Spark's own source of files keeps the name of every file that ever landed in the driver, and writes them all
again every ten batches. Where what has landed is to be worked off, tasks list the folder instead and keep
the names as lists, each of them a batch; the stream is one of lists.
"""

from __future__ import annotations

import fnmatch
import gc
import hashlib
import uuid
from collections.abc import Iterator
from concurrent.futures import Future

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import InheritableThread
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..plans.store import RecordStore
from ..sources import archives as A
from ..sources import parsing as P
from ..sources import ranges
from ..sources.snapshots import Manifest
from ..tuning import materialize

_FILES = "path string, modificationTime timestamp, length long, content binary"
_FOUND = "path string, length long, modified long"
_PATTERN = "*_STAID*.txt"

# What a list has of a file; `opened` is false where its station isn't known.
LIST = "path string, length long, archive string, entry string, element string, station_id long, opened boolean"
_FILE = [c.split()[0] for c in LIST.split(", ")[:-1]]

_NUMBERED = [("path", pa.string()), ("length", pa.int64()), ("archive", pa.string()), ("entry", pa.string()), ("element", pa.string()), ("station_id", pa.int64()), ("archive_ord", pa.int32()), ("list", pa.int32())]

AHEAD = 8  # lists worked off together while batches are laid down

LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Bits of the in-archive order of landed rows: element, file of that element, byte offset.
_FILE_SHIFT, _ELEMENT_SHIFT = 37, 41


def found_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length and modified (microseconds) of the station files in or below `folder`, listed by a task per folder below it."""
    rows = [(folder, False)] + [(f, True) for f in ranges.subfolders(folder)]
    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
    pattern, most = _PATTERN, 1 << 13

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                for path, name, size, modified in ranges.walked(row["folder"], row["deep"]):
                    if fnmatch.fnmatchcase(name, pattern):
                        held.append((path, size, modified))
                    if len(held) >= most:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*held))], schema=schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*held))], schema=schema)

    tasks = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(rows, "folder string, deep boolean").repartition(tasks).mapInArrow(run, _FOUND)


def list_landed(spark: SparkSession, folder: str, lists: str, max_files: int, stations: DataFrame | None = None) -> None:
    """Puts the files of `folder` that no list has yet into new lists of `max_files`, the oldest first.

    Lists are files below `lists`; a list that is there stays as it is. With `stations`, files of other
    stations are marked as not to be opened. One call at a time.
    """
    if max_files < 1:
        raise ValueError(f"a list needs a file at least: {max_files}")
    system, inner = ranges.file_system(lists)
    system.create_dir(inner, recursive=True)
    files = A.name_station_files(found_files(spark, folder), "modified").withColumn("length", F.greatest("length", F.lit(1)))  # what is empty now may be filled
    if ranges.listed(lists):
        known = spark.read.schema(LIST).parquet(lists)
        files = files.join(known.select("path"), "path", "left_anti")
    if stations is None:
        files = files.withColumn("opened", F.lit(True))
    else:
        listed = stations.select("station_id").distinct().withColumn("opened", F.lit(True))
        files = files.join(listed, "station_id", "left").withColumn("opened", F.coalesce("opened", F.lit(False)))
    # rows of a sorted part are numbered in it, and parts by what comes before them
    place = materialize(materialize(files).orderBy("modified", "path").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = {r.part: r.rows for r in place.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()}  # parts of a sort
    if not counts:
        return
    before, starts = 0, []
    for k in range(max(counts) + 1):
        starts.append(before)
        before += counts.get(k, 0)
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<long>"), part.cast("int"))
    nth = start + F.col("place").bitwiseAND((1 << 33) - 1)
    columns, run_name = [c.split()[0] for c in LIST.split(", ")], uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        number, held, done = None, [], []

        def close():
            name = f"{run_name}-{number:012d}.parquet"
            with ranges.open_output(f"{lists}/.{name}") as out:
                pq.write_table(pa.Table.from_batches(held).select(columns), out)
            ranges.rename(f"{lists}/.{name}", f"{lists}/{name}")
            done.append(number)

        for batch in batches:
            numbers = batch["list"].to_numpy()
            cuts = [0, *(i for i in range(1, len(numbers)) if numbers[i] != numbers[i - 1]), len(numbers)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if numbers[a] != number:
                    if held:
                        close()
                    number, held = int(numbers[a]), []
                held.append(batch.slice(a, b - a))
        if held:
            close()
        yield pa.RecordBatch.from_pydict({"list": pa.array(done, pa.int64())})

    dealt = place.withColumn("list", F.floor(nth / max_files)).withColumn("nth", nth).repartition("list").sortWithinPartitions("nth")
    dealt.select("list", *columns).mapInArrow(run, "list long").count()


def stream_files(spark: SparkSession, folder: str, max_files: int = 1000, stations: DataFrame | None = None, lists: str | None = None, named: bool = False) -> DataFrame:
    """New station files of `folder` as a stream; with `stations`, only theirs.

    Without `lists` it is Spark's source of files, which goes on finding files as long as the stream runs and
    keeps all their names in the driver. With `lists`, a folder that is the same for all streams of a checkpoint,
    it has what landed before this call; which files are opened is settled then. With `named`, `list` is
    the name of a file's list, if any.
    """
    if lists is not None:
        list_landed(spark, folder, lists, max_files, stations)
        source = spark.readStream.schema(LIST).option("maxFilesPerTrigger", "1").option("maxFileAge", "36500d")  # no list is too old
        return source.parquet(lists).where("opened").select(*_FILE, *[F.col("_metadata.file_name").alias("list")] * named)
    if LISTING_SETTING not in spark.conf.getAll:
        spark.conf.set(LISTING_SETTING, str(4 * spark.sparkContext.defaultParallelism))
    found = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", _PATTERN)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .load(folder)
        .select("path", "length")
    )
    files = A.name_station_files(found)
    if stations is not None:
        files = files.join(stations.select("station_id"), "station_id", "left_semi")
    return files.select(*_FILE, *[F.lit(None).cast("string").alias("list")] * named)


def file_observations(
    files: DataFrame,
    tasks: int | None = None,
    temperature_defects: str = "fail",
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = A.SPLIT_BYTES,
    numbers: tuple[str, ...] = (),
) -> DataFrame:
    """The observations of station files, which are read by byte range in the tasks.

    `tasks` and `numbers` as in `archives.folder_lines`.
    """
    tasks = 2 * files.sparkSession.sparkContext.defaultParallelism if tasks is None else tasks
    lines = A.folder_lines(files, header_lines, split_bytes, tasks, numbers).drop("path")
    return P.good_observations(P.parse_observation_lines(lines), temperature_defects)


def stream_observations(
    spark: SparkSession,
    folder: str,
    max_files: int = 1000,
    tasks: int | None = None,
    temperature_defects: str = "fail",
    header_lines: int = S.HEADER_LINES,
    split_bytes: int = A.SPLIT_BYTES,
    stations: DataFrame | None = None,
    lists: str | None = None,
) -> DataFrame:
    """New files of `folder` as a streaming table of observations; `lists` as in `stream_files`.

    With `stations`, files of other stations aren't opened, so what is in them can't fail the stream.
    Only names and sizes go through the stream source; the text is read by byte range in the tasks.
    The paths of a batch are looked up by a few tasks and not by one each, unless the session has a
    setting of its own.
    """
    files = stream_files(spark, folder, max_files, stations, lists)
    return file_observations(files, tasks, temperature_defects, header_lines, split_bytes)


def with_place(obs: DataFrame) -> DataFrame:
    """Adds `seq`, the order within an archive: elements in fixed order, files by name, lines by offset.

    Files of one station and element differ in the zeros of their number, and more zeros sort first.
    """
    digits = F.regexp_extract("entry", r"_STAID(0*)[1-9][0-9]*\.txt$", 1)
    zeros = F.length(digits)
    nth = F.lit((1 << (_ELEMENT_SHIFT - _FILE_SHIFT)) - 1) - zeros
    rank = F.array_position(F.array(*map(F.lit, S.PREFIXES)), F.col("element")) - 1
    seq = F.shiftleft(rank, _ELEMENT_SHIFT) + F.shiftleft(nth.cast("long"), _FILE_SHIFT) + F.col("line_pos")
    odd = ~F.col("entry").rlike(r"_STAID0*[1-9][0-9]*\.txt$") | (nth < 0) | (F.col("line_pos") >= 1 << _FILE_SHIFT)
    text = F.concat(F.lit("station file too large or oddly named: "), "entry")
    return obs.withColumn("seq", F.when(odd, F.raise_error(text).cast("long")).otherwise(seq))


def let_go(number: int, each: int = 8) -> None:
    """To be called with the number of each batch: the driver lets go of the plans of earlier ones.

    Python's garbage holds on to them in the JVM, a megabyte or two a batch, and as its own part of them is
    small, Python's collector comes by too seldom.
    """
    if number % each == 0:
        gc.collect()


class _Ahead:
    """States of the next lists, written while the batch of one list is laid beside the others.

    A batch is small, and most of its time goes by while Spark plans and deals out its tasks. So the `AHEAD`
    lists that are expected next are worked off together meanwhile, each into a folder of its own; the batch of a
    list lays its folder down. What is wrong with a list is raised in its own batch.
    """

    def __init__(self, spark: SparkSession, store: RecordStore, lists: str | None, options: dict):
        self.spark, self.store, self.lists, self.options = spark, store, lists, options
        self.next: list[tuple[int, str]] | None = None  # (time, name) of lists to come
        self.begun: dict[str, tuple[Future, int]] = {}

    def folder(self, rows: list[Row], base: Manifest) -> str | None:
        """The folder with the state of the files `rows` of one batch, if they have any."""
        own = self.begun.pop(rows[0].list, None)
        if own is None and self.begun:
            self.begun.pop(next(iter(self.begun)))  # expected and not come: an earlier run had it
        alone = own is None
        future, number = own or (self._begin([rows], base), 0)
        if self.next and len(self.begun) <= AHEAD // 2:
            self._look_ahead(base)
        if not alone and (future.exception() or not self.store.table.has(future.result()[0])):
            # another list failed, or what no snapshot has was vacuumed
            future, number = self._begin([rows], base), 0
        name, numbers = future.result()
        return f"{name}/list={number}" if number in numbers else None

    def took(self, rows: list[Row]) -> None:
        """The batch of these files is being worked off."""
        name = rows[0].list if rows else None
        if name is None:
            return
        if self.next is None:  # the stream takes lists by their time
            found = sorted((changed // 1000, n) for _, n, _, changed in ranges.walked(self.lists, recursive=False))
            since = next(t for t, n in found if n == name)
            self.next = [x for x in found if x[0] >= since]
        self.next = [x for x in self.next if x[1] != name]

    def _look_ahead(self, base: Manifest) -> None:
        """Begins with the next lists, up to one with an archive that has no number yet."""
        wanted = {}
        for _, name in self.next[:AHEAD]:
            with ranges.open_input(f"{self.lists}/{name}") as f:
                rows = [Row(**r) for r in pq.read_table(f).to_pylist() if r["opened"]]
            if not {r.archive for r in rows} <= set(base.names):
                break
            wanted[name] = rows
        self.next = self.next[len(wanted) :]
        wanted = {name: rows for name, rows in wanted.items() if rows}
        if wanted:
            future = self._begin([*wanted.values()], base)
            self.begun |= {name: (future, i) for i, name in enumerate(wanted)}

    def _begin(self, lists: list[list[Row]], base: Manifest) -> Future:
        """Writes the states of lists of files in a thread of its own."""
        place, future = {n: i for i, n in enumerate(sorted(base.names))}, Future()
        rows = [{k: r[k] for k in _FILE} | {"archive_ord": place[r.archive], "list": i} for i, files in enumerate(lists) for r in files]
        rows.sort(key=lambda r: -r["length"])
        tasks = self.options.get("tasks")
        if tasks is None and rows[0]["length"] <= self.options.get("split_bytes", A.SPLIT_BYTES):
            # a local table's rows are cut into a task per core; large files are dealt over them
            n, tasks = min(len(rows), self.spark.sparkContext.defaultParallelism), 0
            rows = [r for k in range(n) for r in rows[k::n]]
        table = pa.Table.from_pylist(rows, pa.schema(_NUMBERED))

        def run():
            try:
                obs = file_observations(self.spark.createDataFrame(table), **self.options | {"tasks": tasks}, numbers=("archive_ord", "list"))
                future.set_result(self.store.write_placed(with_place(obs), base, "list"))
            except BaseException as e:
                future.set_exception(e)

        InheritableThread(target=run, daemon=True, session=self.spark).start()
        return future


def maintain_records(
    spark: SparkSession,
    folder: str,
    stations: DataFrame,
    table: str,
    checkpoint: str,
    buckets: int = 64,
    available_now: bool = True,
    most_folders: int = 8,
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Keep the records of `table` equal to a batch run over everything that landed.

    A batch that is replayed after a failure is left out where its snapshot was written, and changes
    nothing otherwise. A batch writes the state of its own rows beside the stored ones; `most_folders` of such
    are merged into a larger one, and as many of those again. `RecordStore(...).vacuum()` deletes what no
    reader needs any more. `options` are those of `file_observations`. With `available_now` the names of the
    batches' files are kept as lists beside the table.
    """
    store = RecordStore(spark, table, buckets)
    store.set_stations(stations)
    lists = f"{store.path}/lists/{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:16]}" if available_now else None
    files = stream_files(spark, folder, max_files, stations, lists, named=True)
    ahead = _Ahead(spark, store, lists, options)

    def process(batch: DataFrame, batch_id: int) -> None:
        let_go(batch_id)
        base = store.table.manifest()
        done = base.notes.get("batches", {})
        if done.get(checkpoint, -1) >= batch_id:
            return
        notes = {"batches": done | {checkpoint: batch_id}}
        rows = batch.collect()  # names, `max_files` at most
        ahead.took(rows)
        if {r.archive for r in rows} <= set(base.names):
            store.lay(ahead.folder(rows, base) if rows else None, notes)
        else:  # an archive gets its number with its first observation
            obs = file_observations(batch.sparkSession.createDataFrame(rows, batch.schema), **options)
            store.add(materialize(with_place(obs)), notes=notes, beside=True)
        store.compact(most_folders)

    writer = files.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_records(spark: SparkSession, table: str, quality_mode: str = "compact") -> DataFrame:
    """The records after the last batch; later batches don't change what this DataFrame reads."""
    return RecordStore(spark, table).records(quality_mode)
