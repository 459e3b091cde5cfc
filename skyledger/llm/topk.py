"""Exact largest inner products, by branch and bound over a ball tree per shard.

Vectors are packed into shards, and each shard's tree is searched for a block of queries at once: a
node is left when no query's upper bound (its product with the centre plus its norm times the radius)
reaches that query's current k-th score. The k-th scores found in a few shards are shared with the
search of all others, and within a task from shard to shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import ship, table
from skyledger.tuning import materialize

K = 10
SCALE = 1024
SHARD_ROWS = 4096
QUERY_ROWS = 8192  # searched for at once
LEAF = 96
EXACT = float(1 << 53)


@dataclass
class BallTree:
    """Rows in tree order; nodes are (lo, hi, left, right), leaves have no children."""

    rows: np.ndarray
    ids: np.ndarray
    nodes: list[tuple[int, int, int, int]]
    centres: np.ndarray
    radii: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray) -> BallTree:
        order, nodes, centres, radii = np.arange(len(ids)), [], [], []

        def grow(lo: int, hi: int) -> int:
            own = rows[order[lo:hi]]
            centre = own.mean(axis=0)
            away = np.linalg.norm(own - centre, axis=1)
            at = len(nodes)
            nodes.append((lo, hi, -1, -1))
            centres.append(centre)
            radii.append(away.max())
            if hi - lo > LEAF and away.max() > 0:
                pole = own[away.argmax()]
                other = own[np.linalg.norm(own - pole, axis=1).argmax()]
                side = own @ (other - pole)
                order[lo:hi] = order[lo:hi][np.argsort(side, kind="stable")]
                mid = (lo + hi) // 2
                nodes[at] = (lo, hi, grow(lo, mid), grow(mid, hi))
            return at

        if len(ids):
            grow(0, len(ids))
        return cls(rows[order], ids[order], nodes, np.array(centres), np.array(radii))


class Search:
    """The best `k` of what has been seen for each query: larger scores first, then smaller ids."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.queries, self.ids, self.k = queries, ids, k
        self.norms = np.linalg.norm(queries, axis=1)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor

    def least(self, who: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[who, -1], self.floor[who])

    def add(self, tree: BallTree) -> None:
        if not tree.nodes or not len(self.ids):
            return
        width = max(tree.rows.shape[1], self.queries.shape[1])
        queries, rows, centres = (_wide(x, width) for x in (self.queries, tree.rows, tree.centres))
        slack = 1 + 1e-9 * width
        stack = [(0, np.arange(len(self.ids)), None)]
        while stack:
            node, who, bound = stack.pop()
            if bound is None:
                bound = self._bound(queries, centres, tree, node, who, slack)
            who = who[bound >= self.least(who)]
            if not len(who):
                continue
            lo, hi, left, right = tree.nodes[node]
            if left < 0:
                self._take(queries[who] @ rows[lo:hi].T, tree.ids[lo:hi], who)
                continue
            both = [(child, who, self._bound(queries, centres, tree, child, who, slack)) for child in (left, right)]
            stack += sorted(both, key=lambda x: x[2].sum())  # the better one is searched first

    def _bound(self, queries, centres, tree, node, who, slack) -> np.ndarray:
        product, reach = queries[who] @ centres[node], self.norms[who] * tree.radii[node]
        return product + reach + (slack - 1) * (np.abs(product) + reach + self.norms[who] * np.linalg.norm(centres[node])) + 1

    def _take(self, scores: np.ndarray, ids: np.ndarray, who: np.ndarray) -> None:
        scores = np.where(ids[None, :] == self.ids[who][:, None], -np.inf, scores)
        some = (scores >= self.least(who)[:, None]).any(axis=1)
        who, scores = who[some], scores[some]
        if len(who):
            scores = np.concatenate([self.scores[who], scores], axis=1)
            names = np.concatenate([self.found[who], np.broadcast_to(ids, (len(who), len(ids)))], axis=1)
            best = np.lexsort((names, -scores), axis=1)[:, : self.k]
            self.scores[who] = np.take_along_axis(scores, best, axis=1)
            self.found[who] = np.take_along_axis(names, best, axis=1)


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def usable(vector: Column) -> Column:
    """Neither null nor with a null, infinite or not-a-number component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def packed(vectors: DataFrame, rows: int, scale: float = SCALE) -> DataFrame:
    """(n, width, ids, data): blocks of up to `rows` vectors with components floor(scale * x)."""

    def pack(batches):
        ids, data = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            data += batch.column(1).to_pylist()
            while len(ids) >= rows:
                yield block(ids[:rows], data[:rows])
                del ids[:rows], data[:rows]
        if ids:
            yield block(ids, data)

    def block(ids, data):
        width = max(map(len, data))
        out = np.zeros((len(ids), width))
        for k, x in enumerate(data):
            out[k, : len(x)] = np.floor(scale * np.array(x, np.float64))
        values = [[len(ids)], [width], [np.array(ids, "<i8").tobytes()], [out.astype("<f8").tobytes()]]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["n", "width", "ids", "data"])

    return vectors.mapInArrow(pack, "n int, width int, ids binary, data binary")


def _matrix(n: int, width: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data, "<f8").reshape(n, width), np.frombuffer(ids, "<i8")


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's `k` largest integer inner products.

    Both frames have (vec_id, embedding). Components count as floor(1024 * x); shorter vectors are
    filled up with zeros. A query meets all rows but those of its own vec_id; ties go to the smaller
    vec_id; fewer rows than `k` give fewer results. Rows with a null vec_id or an unusable vector take
    no part. Repeated rows are ranked each; repeated queries are answered once per row under one id.
    Products must stay below 2 ** 53, so that they are exact; larger ones are an error. Queries are
    searched for in blocks of `query_rows`, each against all shards.
    """
    ship(vectors.sparkSession)
    clean = [f.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))) for f in (vectors, queries)]
    shards = materialize(packed(clean[0], SHARD_ROWS).withColumn("shard", F.monotonically_increasing_id()))
    blocks = materialize(packed(clean[1], query_rows).withColumn("block", F.monotonically_increasing_id()))
    numbers = [r.block for r in blocks.select("block").orderBy("block").collect()]
    out = []
    for number in numbers:
        row = blocks.where(F.col("block") == number).first()
        own = _matrix(row.n, row.width, bytes(row.ids), bytes(row.data))
        out.append(_answers(shards, own, k))
    if not out:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    answers = out[0]
    for more in out[1:]:
        answers = answers.unionAll(more)
    return answers


def _answers(shards: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """Searches a few shards first, then the others above the k-th scores found there."""
    seeds = F.pmod(F.xxhash64("shard"), F.lit(16)) == 0
    first = materialize(_search(shards.where(seeds), queries, k, None))
    floor = np.full(len(queries[1]), -np.inf)
    ranked = first.groupBy("query").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k)
    for r in ranked.select("query", F.col("s")[k - 1].alias("least")).collect():
        floor[r.query] = r.least
    rest = _search(shards.where(~seeds), queries, k, floor)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    best = materialize(first.unionAll(rest).withColumn("rank", rank).where(F.col("rank") <= k))
    return best.select("query_id", "rank", "vec_id", "score")


def _search(shards: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int, floor: np.ndarray | None) -> DataFrame:
    sent = shards.sparkSession.sparkContext.broadcast((queries, floor))

    def search(batches):
        (rows, ids), floor = sent.value
        state = Search(rows, ids, k, floor)
        longest = state.norms.max(initial=0)
        for batch in batches:
            for shard in zip(*(batch.column(c).to_pylist() for c in ("n", "width", "ids", "data"))):
                own, names = _matrix(*shard)
                if longest * np.linalg.norm(own, axis=1).max(initial=0) >= EXACT:
                    raise ValueError("inner products beyond 2 ** 53 are not exact")
                state.add(BallTree.build(own, names))
        query, place = np.nonzero(np.isfinite(state.scores))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query.astype(np.int32)),
                pa.array(ids[query]),
                pa.array(state.found[query, place]),
                pa.array(state.scores[query, place].astype(np.int64)),
            ],
            ["query", "query_id", "vec_id", "score"],
        )

    return shards.select("n", "width", "ids", "data").mapInArrow(search, "query int, query_id long, vec_id long, score long")


def op7_ball_tree_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.where("vec_id % 100 = 0"))


TWIN = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) e from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
    select q.vec_id query_id, c.vec_id, list_sum(list_transform(range(least(len(q.e), len(c.e))), lambda i: q.e[i + 1] * c.e[i + 1]))::bigint score
    from v q join v c on q.vec_id % 100 = 0 and c.vec_id != q.vec_id)
select query_id, rank::int rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 10
"""
