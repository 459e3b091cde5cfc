"""Token ids in files of bit-plane or byte-plane blocks, written and read by Spark tasks.

A file holds blocks of a fixed number of ids (the last may be shorter). A block is transposed into planes,
one per bit or byte of an id, and each plane is compressed with zstandard: high planes are nearly
constant and cost next to nothing. Behind the blocks stand the index of the planes' places and the
table of documents, so any stretch of ids is read from the blocks that hold it.
"""

from __future__ import annotations

import gc
import json
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import open_output, ship, slices, table
from skyledger.llm.tokens import ENCODED_CHARS, encoder, vocabulary
from skyledger.sources.ranges import open_input
from skyledger.tuning import materialize, scratch_folder

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25  # a file is closed after this many ids, or this many documents
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of unsigned 32-bit ids: 4 of bytes or 32 of bits, least significant first."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if bits:
        planes = np.packbits(np.unpackbits(planes.reshape(4, -1, 1), axis=2, bitorder="little").transpose(0, 2, 1), axis=2).reshape(32, -1)
    return [p.tobytes() for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    raw = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        raw = np.unpackbits(raw.reshape(4, 8, -1), axis=2, count=n)
        raw = np.packbits(raw.transpose(0, 2, 1), axis=2, bitorder="little").reshape(4, n)
    return np.ascontiguousarray(raw.T).view("<u4").reshape(-1)


class PlaneWriter:
    """Streams documents into one file; at most a block of ids is held."""

    def __init__(self, path: str, bits: bool = False, block_ids: int = BLOCK_IDS, level: int = 1):
        self.path, self.bits, self.block_ids = path, bits, block_ids
        self.out = open_output(path)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.held, self.held_bytes = [], 0
        self.index: list[int] = [self.at]
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.zstd = zstandard.ZstdCompressor(level=level)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= 4 * self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data, size = b"".join(self.held), 4 * self.block_ids
        end = len(data) if last else len(data) // size * size
        for a in range(0, end, size):
            for plane in to_planes(np.frombuffer(data[a : min(a + size, end)], "<u4"), self.bits):
                packed = self.zstd.compress(plane)
                self.out.write(packed)
                self.at += len(packed)
                self.index.append(self.at)
        self.held, self.held_bytes = [data[end:]], len(data) - end

    def close(self) -> None:
        self._flush(True)
        parts = [
            np.array(self.index, "<i8").tobytes(),
            np.array([d is not None for d in self.docs], np.uint8).tobytes(),
            np.array([d or 0 for d in self.docs], "<i8").tobytes(),
            np.array(self.counts, "<i8").tobytes(),
        ]
        packed = [self.zstd.compress(p) for p in parts]
        head = {"bits": self.bits, "block_ids": self.block_ids, "n_ids": self.n_ids, "at": self.at, "sizes": [len(p) for p in packed]}
        head = json.dumps(head).encode()
        self.out.write(b"".join(packed) + head + len(head).to_bytes(8, "little") + MAGIC)
        self.out.close()


class PlaneReader:
    def __init__(self, path: str):
        self.stream = open_input(path)
        self.stream.seek(0, 2)
        size = self.stream.tell()
        tail = self._bytes(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is cut off or no file of ids")
        n = int.from_bytes(tail[:8], "little")
        head = json.loads(self._bytes(size - 16 - n, n))
        self.bits, self.block_ids, self.n_ids = head["bits"], head["block_ids"], head["n_ids"]
        at, parts = head["at"], []
        for length in head["sizes"]:
            parts.append(zstandard.decompress(self._bytes(at, length)))
            at += length
        self.index = np.frombuffer(parts[0], "<i8")
        known, docs = np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<i8")
        self.docs = [int(d) if k else None for k, d in zip(known, docs)]
        self.counts = np.frombuffer(parts[3], "<i8")

    def _bytes(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def block(self, k: int) -> np.ndarray:
        planes = 32 if self.bits else 4
        ends = self.index[k * planes : (k + 1) * planes + 1]
        data = self._bytes(int(ends[0]), int(ends[-1] - ends[0]))
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        parts = [zstandard.decompress(data[a - ends[0] : b - ends[0]]) for a, b in zip(ends, ends[1:])]
        return from_planes(parts, n, self.bits)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the file, from the blocks that hold them."""
        hi = min(hi, self.n_ids)
        if lo >= hi:
            return np.zeros(0, "<u4")
        first = lo // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, -(-hi // self.block_ids))])
        return got[lo - first * self.block_ids : hi - first * self.block_ids]

    def documents(self):
        """(doc_id, first id, ids as bytes) in order; a block at a time is in memory, or a document."""
        held, start, k = b"", 0, 0
        for doc, n in zip(self.docs, self.counts.tolist()):
            if len(held) < 4 * n:
                more = [held]
                have = len(held)
                while have < 4 * n:
                    more.append(self.block(k).tobytes())
                    have += len(more[-1])
                    k += 1
                held = b"".join(more)
            yield doc, start, held[: 4 * n]
            held, start = held[4 * n :], start + n


def write_ids(documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, bits: bool = False, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes the documents' ids in ascending doc_id order below `folder`; returns the manifest.

    Manifest rows are (part, seq, path, n_docs, n_ids); files follow each other by (part, seq).
    Names hold a random part and only files of finished tasks come into the manifest, so tasks may
    run twice. A null text is empty and gives the end id alone; null doc_ids come first; rows of one
    doc_id follow in the order of the input; other columns are left out; an empty table gives an
    empty manifest. `path`: a vocabulary file that drops white space and case.
    """
    ship(documents.sparkSession)
    path = path or vocabulary(VOCABULARY)
    end = int(end_id).to_bytes(4, "little")

    def write(batches):
        gc.disable()
        part, seq, out, rows = TaskContext.get().partitionId(), 0, None, []
        for batch, texts in slices(batches, chars=ENCODED_CHARS):
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(path, False).encode(texts)):
                out = out or PlaneWriter(f"{folder}/ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.planes", bits, block_ids)
                out.add(doc, ids + end)
                if out.n_ids >= FILE_IDS or len(out.docs) >= FILE_IDS // 16:
                    out.close()
                    rows.append((part, seq, out.path, len(out.docs), out.n_ids))
                    out, seq = None, seq + 1
        if out:
            out.close()
            rows.append((part, seq, out.path, len(out.docs), out.n_ids))
        encoder(path, False).rest()
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "seq", "path", "n_docs", "n_ids"])

    at = "_ids_at"
    rows = documents.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias(at))
    ordered = rows.repartitionByRange("doc_id", at).sortWithinPartitions("doc_id", at)
    return materialize(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST))


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document of the files; `start` counts the ids of all before it.

    One task reads a file as a stream. The window runs over the manifest, a row per file.
    """

    ship(manifest.sparkSession)
    def read(batches):
        for batch in batches:
            for path, base in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                docs, starts, data, held = [], [], [], 0
                for doc, start, ids in PlaneReader(path).documents():
                    docs.append(doc)
                    starts.append(base + start)
                    data.append(ids)
                    held += len(ids)
                    if held > 4 << 20:
                        yield _read_rows(docs, starts, data)
                        docs, starts, data, held = [], [], [], 0
                yield _read_rows(docs, starts, data)

    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return files.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, ids binary")


def _read_rows(docs, starts, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "start", "ids"])


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_ids(table(spark, sf_dir, "documents"), scratch_folder(spark))
    return read_ids(manifest).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
