"""Documents cut into pieces of token ids and packed into sequences, best fit first.

Best-fit decreasing needs only the number of pieces of each length: pieces of one length are
interchangeable, and a bin that takes one of them takes as many as fit before the next tightest
bin is asked. A segment tree over the remaining capacities finds the tightest open bins. The driver
sees one count per length (at most `capacity` rows, whatever the number of documents); each piece
then finds its bin from its rank among the pieces of its length.
"""

from __future__ import annotations

import gc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import ship, slices, table
from skyledger.llm.tokens import ENCODED_CHARS, encoder, vocabulary
from skyledger.tuning import materialize

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
_RANKS = 1 << 40
OUT_BYTES = 1 << 20  # of ids that leave a task together
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class OpenBins:
    """Bins by remaining capacity, with a segment tree that finds the tightest in log time.

    Bins of one remaining capacity are kept as runs of consecutive numbers.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = [0] * (2 * self.leaves)  # runs below each node
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _count(self, remaining: int, by: int) -> None:
        node = remaining + self.leaves
        while node:
            self.some[node] += by
            node >>= 1

    def push(self, first: int, bins: int, remaining: int) -> None:
        if bins and remaining:
            self.runs.setdefault(remaining, []).append((first, bins))
            self._count(remaining, 1)

    def pop_tightest(self, length: int) -> tuple[int, int, int] | None:
        """(first bin, bins, remaining) of a run with the least remaining capacity of `length` or more."""
        node = length + self.leaves
        while not self.some[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.some[2 * node])
        remaining = node - self.leaves
        self._count(remaining, -1)
        return *self.runs[remaining].pop(), remaining


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing for `counts[length]` pieces of each length.

    Rows (length, first rank, first bin, pieces per bin, offset): the pieces of a length from that
    rank on go to the bins from the first on, so many to a bin, the first of them at the offset.
    """
    bins, rows, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            if found := bins.pop_tightest(length):
                first, many, remaining = found
            else:
                first, many, remaining = opened, -(-left // (capacity // length)), capacity
                opened += many
            fit = remaining // length
            full = min(many, left // fit)
            if full:
                rows.append((length, rank, first, fit, capacity - remaining))
                rank, left = rank + full * fit, left - full * fit
                bins.push(first, full, remaining - fit * length)
            if left and full < many:
                rows.append((length, rank, first + full, left, capacity - remaining))
                bins.push(first + full, 1, remaining - left * length)
                bins.push(first + full + 1, many - full - 1, remaining)
                left = 0
            else:
                bins.push(first + full, many - full, remaining)
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def cut_documents(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids) of the documents' token ids and an end id.

    Only documents of more than `capacity` ids are cut; the first piece takes what is left over.
    `ids` holds little-endian unsigned 32-bit integers. A null text counts as empty and gives the
    end id alone; a null doc_id is kept; repeated rows give repeated pieces; other columns are left
    out; no rows give no pieces. `path` is a byte-level vocabulary file of the tokenizers library.
    """
    ship(documents.sparkSession)
    path = path or vocabulary(VOCABULARY)
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        gc.disable()  # many strings, no cycles
        for part, texts in slices(batches, chars=ENCODED_CHARS):
            ids, pieces, starts, lengths, data, held = [], [], [], [], [], 0
            for doc, own in zip(part.column(0).to_pylist(), encoder(path, True).encode(texts)):
                own += end
                n = len(own) // 4
                bounds = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    ids.append(doc)
                    pieces.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    data.append(own[4 * a : 4 * b])
                held += len(own)
                if held > OUT_BYTES:
                    yield _pieces(ids, pieces, starts, lengths, data)
                    ids, pieces, starts, lengths, data, held = [], [], [], [], [], 0
            yield _pieces(ids, pieces, starts, lengths, data)
        encoder(path, True).rest()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def _pieces(ids, pieces, starts, lengths, data) -> pa.RecordBatch:
    columns = zip((ids, pieces, starts, lengths, data), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["doc_id", "piece", "start", "length", "ids"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: as few sequences of `capacity` as best fit finds.

    Any frame with an integer column `length` will do; its columns stay, but for earlier ones of the
    two names. A length that is null or below 1 takes no place and gets nulls; one above `capacity`
    is an error. Pieces of one length and repeated rows are told apart by their place in the input.
    The input is computed once and kept in the shared folder, so ranks hold when tasks run again.
    """
    ship(pieces.sparkSession)
    if not 0 < capacity < 1 << 22:
        raise ValueError("capacity must be from 1 to 4194303")
    part, at, rank = "_pack_part", "_pack_at", "_pack_rank"
    pieces = pieces.drop("sequence_id", "offset")
    stored = materialize(pieces.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}))
    counts = stored.where("length >= 1").groupBy(part, "length").agg(F.count("*").alias("_pack_n"))
    counts = materialize(counts)
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_pack_n").alias("n")).limit(capacity + 1).collect()}
    if total and max(total) > capacity:
        raise ValueError(f"a piece of {max(total)} is longer than {capacity}")
    plan = best_fit(total, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    sent = pieces.sparkSession.sparkContext.broadcast((plan, plan[:, 0] * _RANKS + plan[:, 1]))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, own: pd.Series) -> pd.DataFrame:
        rows, keys = sent.value
        found = length.notna() & own.notna()
        key = length[found].to_numpy(np.int64) * _RANKS + own[found].to_numpy(np.int64)
        size, first_rank, first, fit, offset = rows[np.searchsorted(keys, key, side="right") - 1].T
        nth = own[found].to_numpy(np.int64) - first_rank
        out = pd.DataFrame(pd.NA, length.index, ["sequence_id", "offset"], "Int64")
        out.loc[found, "sequence_id"] = first + nth // np.maximum(fit, 1)
        out.loc[found, "offset"] = offset + nth % np.maximum(fit, 1) * size
        return out

    before = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(part, "length", F.coalesce(F.sum("_pack_n").over(before), F.lit(0)).alias(rank))
    within = F.row_number().over(Window.partitionBy(part, "length").orderBy(at)) - 1
    placed = stored.withColumn("_pack_k", within).join(bases, [part, "length"], "left")
    placed = placed.withColumn("_pack", place(F.col("length").cast("long"), F.col(rank) + F.col("_pack_k")))
    return placed.select(*pieces.columns, "_pack.sequence_id", "_pack.offset")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def packed_documents(documents: DataFrame) -> DataFrame:
    """One row per piece, its ids told by their checksum."""
    pieces = cut_documents(documents)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
