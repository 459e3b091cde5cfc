"""Hard negatives of labelled vectors, by Fagin's threshold algorithm.

Vectors are packed into shards that hold a sorted list of their rows per dimension. For an anchor, each
list is read from the end where its component's sign makes products large; rows met there get their
whole integer score, and a window of scores is closed once the threshold, the score that a row with the
last values read would have, is strictly below its k-th best score or below the window itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from skyledger.llm.common import ship, table
from skyledger.llm.topk import usable
from skyledger.tuning import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score in percent of the positive's
SHARD_ROWS = 4096
BLOCK_ANCHORS = 1024
FIRST_DEPTH = 64  # rows read of each list at first, twice as many each time after
EXACT = float(1 << 53)
_SHARD = "n int, width int, kind string, ids binary, labels array<string>, data binary, lists binary"


@dataclass
class Window:
    """The `k` best (score, id) with low <= score <= high; larger scores first, then smaller ids."""

    low: float
    high: float
    k: int
    best: list[tuple[int, int]] = field(default_factory=list)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = -self.best[-1][0] if len(self.best) == self.k else self.low
        fit = np.flatnonzero((scores >= max(least, self.low)) & (scores <= self.high))
        if len(fit) > self.k:
            fit = fit[np.lexsort((ids[fit], -scores[fit]))[: self.k]]
        if len(fit):
            found = [(-int(s), int(i)) for s, i in zip(scores[fit], ids[fit])]
            self.best = sorted(self.best + found)[: self.k]

    def closed(self, threshold: float) -> bool:
        """Whether no row with at most this score can come in."""
        return threshold < self.low or (len(self.best) == self.k and threshold < -self.best[-1][0])


@dataclass
class Shard:
    """Rows with their ids and labels; `lists` has the rows' places by ascending value, per dimension."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    lists: np.ndarray

    def __post_init__(self):
        self.reach = np.abs(self.rows).max(axis=0, initial=0)
        self.whole = None

    def search(self, anchor: np.ndarray, windows: list[Window], wanted: np.ndarray) -> int:
        """Adds the `wanted` rows to the windows they belong to; returns how many rows were scored."""
        width = min(len(anchor), self.rows.shape[1])
        anchor, rows = anchor[:width], self.rows[:, :width]
        if np.abs(anchor) @ self.reach[:width] >= EXACT:  # beyond doubles: Python's integers
            if self.whole is None:
                self.whole = np.vectorize(int, otypes=[object])(self.rows)
            anchor, rows = np.vectorize(int, otypes=[object])(anchor), self.whole[:, :width]
        n, up, down = len(self.ids), np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, depth, step = np.zeros(n, bool), 0, FIRST_DEPTH
        if not len(up) and not len(down):
            depth, step = 0, n
        while depth < n:
            upto = min(n, depth + step)
            fresh = np.zeros(n, bool)
            if len(up) or len(down):
                fresh[self.lists[up, n - upto : n - depth].ravel()] = True
                fresh[self.lists[down, depth:upto].ravel()] = True
                fresh &= ~seen
            else:
                fresh[:] = True
            seen |= fresh
            new = np.flatnonzero(fresh & wanted)
            if len(new):
                scores = rows[new] @ anchor
                for window in windows:
                    window.add(scores, self.ids[new])
            if seen.all():
                break
            last = anchor[up] @ rows[self.lists[up, n - upto], up] + anchor[down] @ rows[self.lists[down, upto - 1], down]
            if all(window.closed(last) for window in windows):
                break
            depth, step = upto, step * 2
        return int(seen.sum())


def packed_shards(vectors: DataFrame, rows: int = SHARD_ROWS, scale: float = SCALE) -> DataFrame:
    """Shards of up to `rows` vectors (vec_id, label, embedding) with components floor(scale * x) and their lists."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], [], []]
        for batch in batches:
            for i, c in enumerate(held):
                c += batch.column(i).to_pylist()
            while len(held[0]) >= rows:
                yield shard(*(c[:rows] for c in held))
                for c in held:
                    del c[:rows]
        if held[0]:
            yield shard(*held)

    def shard(ids, labels, data):
        values = np.zeros((len(ids), max(1, *map(len, data))))
        for i, x in enumerate(data):
            values[i, : len(x)] = np.floor(scale * np.array(x, np.float64))
        kind = "<i2" if np.abs(values).max(initial=0) < 1 << 15 else "<f8"
        lists = np.argsort(values, axis=0, kind="stable").T.astype("<u4")
        cells = [len(ids), values.shape[1], kind, np.array(ids, "<i8").tobytes(), labels, values.astype(kind).tobytes(), lists.tobytes()]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds)], ["n", "width", "kind", "ids", "labels", "data", "lists"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(pack, _SHARD)


def _shard(row: dict) -> Shard:
    n, width = row["n"], row["width"]
    rows = np.frombuffer(row["data"], row["kind"]).reshape(n, width).astype(np.float64)
    return Shard(rows, np.frombuffer(row["ids"], "<i8"), np.array(row["labels"], object), np.frombuffer(row["lists"], "<u4").reshape(width, n))


def _searched(shards: DataFrame, anchors: DataFrame, groups: int, blocks: int, k: int, hunt: str) -> DataFrame:
    """(key, place, anchor_id, positive_id, positive_score, vec_id, score): the best of each group of shards.

    Anchors (key, vec_id, label, embedding, positives) meet all shards in tasks of a block of anchors and
    a group of shards; one task goes from shard to shard with the best found so far. `hunt` is "same" for
    the best rows of the anchor's label and "other" for those of other labels in each positive's window.
    """
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    none = [F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in _SHARD.split(", ")) if c not in ("labels",)]
    ask = anchors.select(everywhere, block, F.lit(0).alias("turn"), "key", "vec_id", "label", "embedding", "positives", *none, F.lit(None).cast("array<string>").alias("labels"))
    give = shards.select(
        F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("turn"),
        *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in ("key", "vec_id", "label", "embedding", "positives")], "n", "width", "kind", "ids", "labels", "data", "lists",
    )
    tasks = ask.unionByName(give).repartition(groups * blocks, "part", "block").sortWithinPartitions("part", "block", "turn")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, asked = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(i)[at].as_py() for i, c in enumerate(batch.schema.names)}
                if (row["part"], row["block"]) != task:
                    yield results(asked)
                    task, asked = (row["part"], row["block"]), []
                if row["turn"] == 0:
                    asked.append((row, np.floor(SCALE * np.array(row["embedding"], np.float64)), windows(row)))
                elif asked:
                    shard = _shard(row)
                    for who, anchor, open_ in asked:
                        same = shard.labels == who["label"]
                        shard.search(anchor, open_, same & (shard.ids != who["vec_id"]) if hunt == "same" else ~same)
        yield results(asked)

    def windows(row: dict) -> list[Window]:
        if hunt == "same":
            return [Window(-np.inf, np.inf, k)]
        return [Window(-(-LOW * p["score"] // 100), HIGH * p["score"] // 100, k) for p in row["positives"]]

    def results(asked: list) -> pa.RecordBatch:
        out = []
        for who, _, found in asked:
            for place, window in enumerate(found):
                about = who["positives"][place] if hunt == "other" else {"vec_id": None, "score": None}
                out += [(who["key"], place, who["vec_id"], about["vec_id"], about["score"], i, -s) for s, i in window.best]
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
        columns = list(zip(*out)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "place", "anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    found = tasks.mapInArrow(search, "key long, place int, anchor_id long, positive_id long, positive_score long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("key", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both frames have (vec_id, label, embedding). Components count as floor(256 * x); shorter vectors are
    filled up with zeros. An anchor's positives are its best rows of its label under another vec_id; for
    each, the best `negatives` rows of other labels scoring between LOW and HIGH percent of the
    positive's score come out, ties by smaller vec_id. Rows with a null vec_id, a null label or an
    unusable vector take no part; repeated rows are ranked each, repeated anchors answered each. Scores
    are exact; one beyond 64 bits is an error. Anchors without positives or negatives give no rows.
    """
    ship(vectors.sparkSession)
    clean = [
        f.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
        for f in (vectors, anchors)
    ]
    shards = materialize(packed_shards(clean[0], shard_rows).withColumn("shard", F.monotonically_increasing_id()))
    asked = materialize(clean[1].withColumn("key", F.monotonically_increasing_id()))
    groups = max(1, min(shards.count(), vectors.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, -(-asked.count() // BLOCK_ANCHORS))
    none = F.lit(None).cast("array<struct<rank: int, vec_id: bigint, score: bigint>>").alias("positives")
    near = _searched(shards, asked.select("*", none), groups, blocks, positives, "same")
    pairs = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    found = _searched(shards, materialize(asked.join(pairs, "key")), groups, blocks, negatives, "other")
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


TWIN = """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) e
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
    select a.vec_id anchor_id, c.vec_id, a.l = c.l same,
           coalesce(list_sum(list_transform(range(least(len(a.e), len(c.e))), lambda i: a.e[i + 1] * c.e[i + 1])), 0)::bigint score
    from v a join v c on a.vec_id % 50 = 0 and a.vec_id != c.vec_id),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) r from s where same) where r <= 5),
n as (
    select p.anchor_id, p.vec_id positive_id, s.vec_id negative_id, p.score positive_score, s.score negative_score,
           row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) rank
    from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank::int rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
