"""Archives of station files as a Spark data source, for `spark.read.format` and SQL.

The driver only lists the archives; each is cut into shares of its bytes, and small archives are read
several by one task. It reads an archive's directory and then the entries that begin in its share; an uncompressed entry is read by every share
that it reaches into, each for the lines that start there. Tests on archive, entry, element and station
are pushed into the source: archives and entries that they leave out aren't opened.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window as W, datasource as D, functions as F

from ..schemas import BANNER_MARKS, HEADER_LINES, PREFIXES, SEQ_BITS, STATIONS_FILE
from . import parsing as P, ranges

FORMAT = "station_archives"
SHARE_BYTES = 64 << 20
OPEN_BYTES = 1 << 20  # what opening an archive counts for when archives are dealt to tasks
COLUMNS = "archive string, archive_ord int, entry string, element string, station_id long, seq long, line string"
NAMES = pa.schema([("archive", pa.string()), ("archive_ord", pa.int32()), ("entry", pa.string()), ("element", pa.string()), ("station_id", pa.int64())])
PUSHED = ("archive", "entry", "element", "station_id")


@dataclass
class Share(D.InputPartition):
    """The bytes [lo, hi) of an archive; `number` is its place by name among the listed ones."""

    path: str
    archive: str
    number: int
    lo: int
    hi: int


@dataclass
class Shares(D.InputPartition):
    """The shares that one task reads."""

    shares: list[Share]


@dataclass
class Test:
    """One pushed test on a column: `kind` says how it compares with `value`."""

    column: str
    kind: str
    value: object

    def holds(self, x) -> bool:
        if x is None:
            return False
        if self.kind == "in":
            return x in self.value
        if self.kind == "starts":
            return x.startswith(self.value)
        if self.kind == "ends":
            return x.endswith(self.value)
        if self.kind == "contains":
            return self.value in x
        if self.kind == "over":
            return x > self.value
        if self.kind == "from":
            return x >= self.value
        if self.kind == "under":
            return x < self.value
        return x <= self.value


def _test(f: D.Filter) -> Test | None:
    """The filter as a test of a column that names entries; None if it can't be one."""
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in PUSHED:
        return None
    column = f.attribute[0]
    if isinstance(f, D.EqualTo):
        return Test(column, "in", (f.value,))
    if isinstance(f, D.In):
        return Test(column, "in", tuple(f.value))
    if column == "station_id":
        kinds = {D.GreaterThan: "over", D.GreaterThanOrEqual: "from", D.LessThan: "under", D.LessThanOrEqual: "upto"}
        kind = kinds.get(type(f))
    else:
        kind = {D.StringStartsWith: "starts", D.StringEndsWith: "ends", D.StringContains: "contains"}.get(type(f))
    return Test(column, kind, f.value) if kind else None


class ArchiveReader(D.DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        if not self.path:
            raise ValueError(f"the source {FORMAT} needs a path")
        self.pattern = options.get("pattern", "")
        self.header_lines = int(options.get("headerLines", HEADER_LINES))
        self.share_bytes = int(options.get("shareBytes", SHARE_BYTES))
        self.metadata = options.get("metadata")
        self.damaged = options.get("damaged", "fail")
        if self.damaged not in ("fail", "skip"):
            raise ValueError(f"unknown choice for damaged archives: {self.damaged}")
        self.tests: list[Test] = []
        for option, column in (("elements", "element"), ("stations", "station_id")):
            if options.get(option):
                names = [x.strip() for x in options[option].split(",")]
                self.tests.append(Test(column, "in", tuple(map(int, names) if column == "station_id" else names)))

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for f in filters:
            test = _test(f)
            if test is None or (self.metadata and test.column in ("element", "station_id")):
                yield f
            else:
                self.tests.append(test)

    def _wanted(self, **columns) -> bool:
        return all(t.holds(columns[t.column]) for t in self.tests if t.column in columns)

    def partitions(self) -> list[Shares]:
        files = sorted((name, path, size) for path, name, size in ranges.listed(self.path) if name.endswith(".zip") and self.pattern in name)
        if not files:
            raise ValueError(f"no valid zip files found in {self.path}")
        if len(files) >= 1 << (63 - SEQ_BITS):
            raise ValueError("too many archives")
        tasks, left = [], 0
        for number, (name, path, size) in enumerate(files):
            if self._wanted(archive=name):
                step = size + 1 if self.metadata else self.share_bytes
                for lo in range(0, max(size, 1), step):
                    share = Share(path, name, number, lo, min(lo + step, max(size, 1)))
                    cost = share.hi - share.lo + OPEN_BYTES
                    if cost > left:
                        tasks.append(Shares([]))
                        left = self.share_bytes
                    tasks[-1].shares.append(share)
                    left -= cost
        return tasks or [Shares([])]

    def read(self, partition: Shares) -> Iterator[pa.RecordBatch]:
        lines = (piece for share in partition.shares for piece in self._lines(share))
        for batch in ranges.in_large_batches(lines, NAMES, "seq"):
            yield batch.select([c.split()[0] for c in COLUMNS.split(", ")])

    def _lines(self, share: Share) -> Iterator[tuple]:
        try:
            with ranges.open_input(share.path) as raw, zipfile.ZipFile(raw) as z:
                data = ranges.usable_entries(z, PREFIXES, STATIONS_FILE, BANNER_MARKS)
                if self.metadata:
                    if self.metadata in z.NameToInfo and self._wanted(entry=self.metadata):
                        with z.open(self.metadata) as stream:
                            for offsets, text in ranges.text_in_range(stream, 0, 1 << 62, 0):
                                yield (share.archive, share.number, self.metadata, None, None), offsets, text
                    return
                for info, _, element, station, base in data:
                    if station is None or not self._wanted(entry=info.filename, element=element, station_id=station):
                        continue
                    lo, hi = self._part(raw, info, share)
                    if lo >= hi:
                        continue
                    if base + info.file_size >= 1 << SEQ_BITS:
                        raise OverflowError(f"too much text in {share.path}")
                    with z.open(info) as stream:
                        for offsets, text in ranges.text_in_range(stream, lo, hi, self.header_lines, info.file_size):
                            yield (share.archive, share.number, info.filename, element, station), offsets + base, text
        except (ValueError, EOFError, RuntimeError, zlib.error, zipfile.BadZipFile) as e:
            if self.damaged == "fail":
                raise ValueError(f"{share.path}: {type(e).__name__}: {e}") from e

    @staticmethod
    def _part(raw, info: zipfile.ZipInfo, share: Share) -> tuple[int, int]:
        """The range of an entry's text that belongs to a share."""
        if info.compress_type != zipfile.ZIP_STORED:
            return (0, info.file_size) if share.lo <= info.header_offset < share.hi else (0, 0)
        if info.header_offset >= share.hi:
            return 0, 0
        raw.seek(info.header_offset + 26)
        sizes = raw.read(4)
        start = info.header_offset + 30 + int.from_bytes(sizes[:2], "little") + int.from_bytes(sizes[2:], "little")
        lo = 0 if share.lo <= info.header_offset else max(0, share.lo - start)
        return lo, min(info.file_size, max(0, share.hi - start))


class StationArchives(D.DataSource):
    """`path` is a folder of `.zip` files or one of them. Options:

    `pattern` (part of the file name), `headerLines`, `shareBytes`, `elements` and `stations` (lists with
    commas), `metadata` (the lines of this entry, such as stations.txt, in place of the data lines),
    `damaged` (`fail`, or `skip` to leave out archives that can't be read or lack what they need).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


# The source travels with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(ranges)
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["FORMAT"]))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets filters be pushed into sources written in Python."""
    spark.dataSource.register(StationArchives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Data lines of the archives below `path`, or with `metadata` the lines of one entry of each."""
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)


def observations(spark: SparkSession, path: str, temperature_defects: str = "fail", other_defects: str = "drop", **options) -> DataFrame:
    """Typed rows; a filter on archive, entry, element or station_id reaches the source."""
    parsed = P.parse_observation_lines(lines(spark, path, **options))
    return P.good_observations(parsed, temperature_defects, other_defects)


def stations(spark: SparkSession, path: str, **options) -> DataFrame:
    """The stations that each archive lists; the last line of a station wins."""
    found = lines(spark, path, metadata=STATIONS_FILE, **options)
    named = found.select("archive", "archive_ord", F.col("seq").alias("line_pos"), "line")
    return P.last_station_wins(P.parse_station_lines(named), "archive_ord")


def create_views(spark: SparkSession, path: str, prefix: str = "", **options) -> None:
    """Temporary views `observations`, `stations` and `weather` over the archives below `path`.

    `weather` has the merged records, as the documented queries expect them. Nothing is read before a
    query asks; a filter of `observations` reaches the source, one of `weather` by station does, too.
    """
    from ..operators import pivot as V

    obs, places = observations(spark, path, **options), stations(spark, path, **{k: v for k, v in options.items() if k in ("pattern", "damaged")})
    obs.createOrReplaceTempView(f"{prefix}observations")
    places.createOrReplaceTempView(f"{prefix}stations")
    V.unified_records(obs, places).createOrReplaceTempView(f"{prefix}weather")
