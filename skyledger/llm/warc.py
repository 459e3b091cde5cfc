"""Pages written as WARC archives and read back by byte range.

A range of an archive can't tell by itself whether `WARC/1.1` begins a record or stands in a payload.
So every range emits its candidates with the offset at which the record after each would begin, and
how far the chain of candidates leads within the range. Pointer jumping over those exits, from offset 0
of each file, finds the one place where the true chain enters each range; only what hangs on it is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm.common import open_output, ship, slices, table
from skyledger.sources.ranges import open_input
from skyledger.tuning import materialize, scratch_folder, small_side

FILE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
HEADER_BYTES = 64 << 10  # read at first; a longer header is read on
TASKS = 1 << 14  # at most, for the ranges of all files
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
RECORD = "page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: str | None) -> str:
    """A header line; control characters and spaces are percent-encoded."""
    return "" if value is None else f"{name}: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', value)}\r\n"


def record(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = "WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response")
    head += _line("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>") + _line("WARC-Date", DATE)
    head += _line("WARC-Target-URI", url) + _line("WARC-Payload-Digest", f"sha1:{digest}")
    if revisit:
        head += _line("WARC-Profile", PROFILE) + _line("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>")
        head += _line("X-Refers-To-Page", str(refers_to))
    head += _line("X-Page", None if page_id is None else str(page_id))
    head += f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row of (page_id, url, html) below `folder`; returns (path, bytes, records).

    Of rows with equal payloads of at least `least_bytes` bytes, those with the smallest page_id are
    responses and the others revisits that refer to it. A null html is an empty payload; a null
    page_id is never referred to: where all of a group have none, all are responses. A null url is
    left out of the record; other columns are left out; repeated rows are repeated records. Repeated
    digests are found by their keys alone and broadcast if they are few; payloads then stay where they are
    read. With more, they travel compressed. Only files of finished tasks come into the result.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    first = pages.select("page_id", F.sha1(payload).alias("sha1"), F.length(payload).alias("size")).where(F.col("size") >= least_bytes)
    first = first.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = small_side(materialize(first))

    def prepare(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for part, texts in slices(batches, "html", binary=True):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([hashlib.sha1(t).hexdigest() for t in texts], pa.string()), pa.array([pack.compress(t) for t in texts], pa.binary())],
                ["page_id", "url", "sha1", "packed"],
            )

    def write(batches):
        out, path, at, n, seq, rows = None, None, 0, 0, 0, []
        for batch in batches:
            for page, url, sha1, packed, least in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{seq:04d}-{uuid.uuid4().hex}.warc"
                    out, at, n, seq = open_output(path), 0, 0, seq + 1
                html = zstandard.decompress(packed)
                revisit = least is not None and page != least
                data = record(page, url, base64.b32encode(bytes.fromhex(sha1)).decode(), html, least, revisit)
                out.write(data)
                at, n = at + len(data), n + 1
                if at >= FILE_BYTES:
                    out.close()
                    rows.append((path, at, n))
                    out = None
        if out is not None:
            out.close()
            rows.append((path, at, n))
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    rows = rows.mapInArrow(prepare, "page_id long, url string, sha1 string, packed binary").join(first, "sha1", "left")
    return materialize(rows.select("page_id", "url", "sha1", "packed", "first").mapInArrow(write, "path string, bytes long, records long"))


def parse_header(head: bytes) -> dict[str, str] | None:
    """The fields of a record header without its last blank line, by lower-case name; None if it is none."""
    lines = head.split(b"\r\n")
    if not MAGIC.match(lines[0] + b"\r\n"):
        return None
    fields = {}
    for line in lines[1:]:
        name, sign, value = line.partition(b":")
        if not sign or not name or b" " in name:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdecimal() else None


def _may_go_on(head: bytes) -> bool:
    """Whether all whole lines behind the first can be a header's fields, so that its end may follow."""
    fields = (line.partition(b":") for line in head.split(b"\r\n")[1:-1])
    return bool(MAGIC.match(head)) and all(sign and name and b" " not in name for name, sign, _ in fields)


class _Window:
    """Bytes of a stream by offset; one stretch is held."""

    def __init__(self, path: str, size: int):
        self.stream, self.size, self.lo, self.data = open_input(path), size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if not (self.lo <= at and at + n <= self.lo + len(self.data)):
            self.stream.seek(at)
            self.lo, self.data = at, self.stream.read(max(n, min(1 << 20, self.size - at)))
        return self.data[at - self.lo : at - self.lo + n]

    def header(self, at: int) -> tuple[dict[str, str], int] | None:
        """Fields and the offset of the block of a record at this offset, if one may begin here."""
        n = HEADER_BYTES
        head = self.get(at, n)
        while (end := head.find(b"\r\n\r\n")) < 0 and at + n < self.size and _may_go_on(head):
            n *= 4
            head = self.get(at, n)
        fields = parse_header(head[:end]) if end > 0 else None
        return (fields, at + end + 4) if fields else None


def candidates(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, bytes, lo, hi, offset, next, leaves) for each place that looks like the start of a record.

    `next` is where the record after it would begin; `leaves` is where the chain of candidates from
    here leaves the range. A place whose record would end behind the file is no candidate.
    """
    ship(archives.sparkSession)
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("lo"))
    count = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1

    def scan(batches):
        for batch in batches:
            rows = []
            for path, size, lo in zip(*(c.to_pylist() for c in batch.columns)):
                hi = min(lo + range_bytes, size)
                window = _Window(path, size)
                data = window.get(lo, min(hi + 16, size) - lo)
                found = {}
                for m in MAGIC.finditer(data):
                    at = lo + m.start()
                    if at < hi and (got := window.header(at)):
                        after = got[1] + int(got[0]["content-length"]) + 4
                        if after <= size and window.get(after - 4, 4) == b"\r\n\r\n":
                            found[at] = after
                leaves = {}
                for at in sorted(found, reverse=True):
                    leaves[at] = leaves.get(found[at], found[at])
                rows += [(path, size, lo, hi, at, found[at], leaves[at]) for at in found]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.string()] + [pa.int64()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "bytes", "lo", "hi", "offset", "next", "leaves"])

    schema = "path string, bytes long, lo long, hi long, offset long, next long, leaves long"
    return ranges.repartition(min(int(count), TASKS)).mapInArrow(scan, schema)


def entries(found: DataFrame) -> DataFrame:
    """(path, offset) where the chain from offset 0 enters each range that it enters, by pointer jumping.

    `found` must be stored. After k rounds all places within 2 ** k exits are reached. A file whose
    chain breaks off before its end is an error.
    """
    exits = found.select("path", F.col("leaves").alias("offset")).union(found.where("offset = 0").select("path", "offset")).distinct()
    jumps = materialize(found.select("path", "offset", "leaves").join(exits, ["path", "offset"], "left_semi"))
    steps = jumps
    reached = materialize(found.where("offset = 0").select("path", "offset"))
    size = -1
    while (now := reached.count()) != size:
        size = now
        ahead = reached.join(steps, ["path", "offset"]).select("path", F.col("leaves").alias("offset"))
        reached = materialize(reached.union(ahead.join(jumps, ["path", "offset"], "left_semi")).distinct())
        further = steps.select("path", F.col("offset").alias("leaves"), F.col("leaves").alias("to"))
        steps = materialize(steps.join(further, ["path", "leaves"]).select("path", "offset", F.col("to").alias("leaves")))
    return reached


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives (path, bytes), with their payloads if asked for.

    Size and digest of a response are taken from its payload, and the digest must be the stored one;
    those of a revisit are the stored ones. A file without a record at 0 or whose chain doesn't reach
    its end is an error.
    """
    found = materialize(candidates(archives, range_bytes))
    true = entries(found)
    starts = materialize(found.join(true, ["path", "offset"]).select("path", "bytes", "lo", "hi", "offset", "leaves"))
    whole = starts.groupBy("path").agg(F.max("leaves").alias("end"))
    broken = archives.where("bytes > 0").join(whole, "path", "left").where("end is null or end != bytes").count()
    if broken:
        raise ValueError(f"{broken} archives don't hold a whole chain of records")

    def read(batches):
        for batch in batches:
            for path, size, hi, at in zip(*(c.to_pylist() for c in batch.columns)):
                window, rows, held = _Window(path, size), [], 0
                while at < hi:
                    fields, block = window.header(at)
                    length = int(fields["content-length"])
                    rows.append(_parsed(fields, window.get(block, length), payloads))
                    at, held = block + length + 4, held + length
                    if held > 4 << 20:
                        yield _record_rows(rows)
                        rows, held = [], 0
                yield _record_rows(rows)

    return starts.select("path", "bytes", "hi", "offset").repartition(max(1, min(starts.count(), TASKS))).mapInArrow(read, RECORD)


def _parsed(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    number = lambda name: int(fields[name]) if name in fields else None
    if kind == "response":
        size = len(payload)
        if base32_sha1(payload) != digest:
            raise ValueError(f"the payload of page {fields.get('x-page')} differs from its digest")
    else:
        size, payload = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", head)[1]), None
    return number("x-page"), kind, number("x-refers-to-page"), fields.get("warc-target-uri"), size, digest, payload if payloads else None


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 7
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in RECORD.split(", ")])


def op2_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), scratch_folder(spark))
    return read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The digest's 160 bits as 32 letters of 5 bits.
_HEX = "sha1(encode(coalesce(html, '')))"
TWIN = f"""
with p as (select page_id, coalesce(html, '') html, strlen(coalesce(html, '')) payload_bytes, {_HEX} h from pages),
b as (select *, array_to_string(list_transform(range(40), lambda i: right('0000' || bin(('0x' || h[i + 1])::int), 4)), '') bits from p),
d as (select *, array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_reduce(
    list_transform(range(5), lambda j: bits[5 * i + j + 1]::int), lambda x, y: 2 * x + y) + 1]), '') payload_digest from b),
f as (select *, min(page_id) over (partition by html) least from d)
select page_id, payload_bytes, payload_digest,
    case when page_id = least then 'response' else 'revisit' end record_type,
    case when page_id != least then least end refers_to from f
"""
