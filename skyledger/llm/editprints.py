"""Fingerprints of texts by a randomised embedding of edit distance into Hamming distance.

A walk goes over a text's characters: at each step it writes down the character it stands on and goes on
to the next one if the coin of (step, character), shared by all texts, says so. What two texts write down
becomes equal again soon after a difference between them. A fingerprint samples the written places, by a
consistent choice that depends on the walk's length only, and keeps four bits of each; bands of digits
find candidates, which are verified by edit distance.
"""

from __future__ import annotations

import functools
import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import extended, ship, slices, table, with_columns
from skyledger.llm.components import components
from skyledger.tuning import materialize

WALKS = 2
SLOTS = 128  # sampled places of a walk, a hexadecimal digit each
BAND = 8  # digits
PERIOD = 1 << 13  # after so many steps the coins come again
END = 0x110000  # stands behind the last character
SIMILARITY = 0.8
_BATCH_STEP, _LONE_STEP = 8.0, 0.15  # microseconds of a step for many texts at once, for one text


class Walks:
    """The shared walks: their coins, and the places that are sampled from walks of any length."""

    def __init__(self):
        coins = np.random.default_rng(11).random((WALKS * 256, PERIOD)) < 0.5
        places = np.where(np.hstack([coins, coins]), np.arange(2 * PERIOD), 4 * PERIOD)
        ahead = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
        stay = (ahead - np.arange(PERIOD) + 1).astype(np.uint8)  # steps on a character, from a step on
        self.flat = stay.ravel()
        self.rows = [r.tobytes() for r in stay]
        self.places = [_records(random.Random(slot)) for slot in range(WALKS * SLOTS)]
        self.salt = np.random.default_rng(12).integers(0, 1 << 63, WALKS * SLOTS, dtype=np.uint64)

    def alone(self, walk: int, classes: bytes) -> np.ndarray:
        """The steps at which one text's characters are reached, and the walk's length."""
        rows, mask, t, out = self.rows[walk * 256 : walk * 256 + 256], PERIOD - 1, 0, [0]
        reached = out.append
        for row in map(rows.__getitem__, classes):
            t += row[t & mask]
            reached(t)
        return np.array(out)

    def sampled(self, walk: int, lengths: np.ndarray) -> np.ndarray:
        """(text, slot): the sampled steps of walks of these lengths."""
        own = self.places[walk * SLOTS : walk * SLOTS + SLOTS]
        return np.stack([p[np.searchsorted(p, lengths, "left") - 1] for p in own], axis=1)

    def digits(self, walk: int, symbols: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Four bits of each sampled (step, character)."""
        salt = self.salt[walk * SLOTS : walk * SLOTS + SLOTS]
        x = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ salt + steps.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(60)).astype(np.uint8)

    def together(self, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sampled steps, characters' places there) per walk of many texts, the longest first.

        All walks of all texts go on by a character at a time; what they need and leave for the k-th
        characters lies side by side.
        """
        long, columns = int(sizes[0]), WALKS * len(sizes)
        left = len(sizes) - np.searchsorted(sizes[::-1], np.arange(1, long + 1), "left")  # texts with a k-th character
        offset = np.concatenate(([0], np.cumsum(left) * WALKS))
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row = classes[np.repeat(starts, sizes) + place].astype(np.int32) * PERIOD
        at = offset[place] + np.repeat(np.arange(len(sizes)) * WALKS, sizes)
        rows = np.empty(offset[-1], np.int32)
        for walk in range(WALKS):
            rows[at + walk] = row + walk * 256 * PERIOD
        del row, at, place
        times, now, spot = np.empty(offset[-1], np.int32), np.zeros(columns, np.int32), np.empty(columns, np.int32)
        mask, flat, lo = np.int32(PERIOD - 1), self.flat, 0
        for hi in offset[1:].tolist():
            n = hi - lo
            some, here = now[:n], spot[:n]
            times[lo:hi] = some
            np.bitwise_and(some, mask, out=here)
            here += rows[lo:hi]
            some += flat[here]
            lo = hi
        who = np.arange(len(sizes))[:, None] * WALKS
        for walk in range(WALKS):
            steps = self.sampled(walk, now[walk::WALKS].astype(np.int64))
            low, high = np.zeros(steps.shape, np.int64), np.broadcast_to(sizes[:, None] - 1, steps.shape).copy()
            while (low < high).any():  # the last character reached by each step
                mid = (low + high + 1) // 2
                reached = times[offset[mid] + who + walk] <= steps
                low, high = np.where(reached, mid, low), np.where(reached, high, mid - 1)
            yield steps, low


def _records(draw: random.Random) -> np.ndarray:
    """Steps at which a sequence of random numbers has a new minimum; the last one before any length is a uniform place."""
    at, out = 0, []
    while at < 1 << 46:
        out.append(at)
        at = int((at + 1) / (1.0 - draw.random()))
    return np.array(out)


@functools.cache
def walks() -> Walks:
    """The walks, built once in a process."""
    return Walks()


def fingerprints(texts: list[str]) -> list[str]:
    """One string of WALKS * SLOTS hexadecimal digits per text; an empty text has one, too."""
    if not texts:
        return []
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    symbols = np.full(sizes.sum(), END, np.uint32)
    inside = np.ones(len(symbols), bool)
    inside[starts + sizes - 1] = False
    symbols[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    classes = (symbols & 255).astype(np.uint8)
    order = np.argsort(-sizes, kind="stable")
    alone = np.concatenate(([0], np.cumsum(sizes[order])))  # the longest texts walk alone where that is faster
    cut = int(np.argmin(_LONE_STEP * WALKS * alone + _BATCH_STEP * np.append(sizes[order], 0)))
    digits, shared, together = np.empty((len(texts), WALKS, SLOTS), np.uint8), walks(), order[cut:]
    for i in order[:cut]:
        own = slice(starts[i], starts[i] + sizes[i])
        for walk in range(WALKS):
            times = shared.alone(walk, classes[own].tobytes())
            steps = shared.sampled(walk, times[-1:])
            at = np.searchsorted(times, steps[0], "right") - 1
            digits[i, walk] = shared.digits(walk, symbols[own][at], steps[0])
    if len(together):
        for walk, (steps, at) in enumerate(shared.together(classes, starts[together], sizes[together])):
            digits[together, walk] = shared.digits(walk, symbols[starts[together][:, None] + at], steps)
    figures = np.frombuffer(b"0123456789abcdef", np.uint8)[digits.reshape(len(texts), -1)]
    return [row.tobytes().decode() for row in figures]


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """0 to 1: the share of equal digits in the better walk, less what chance gives."""
    a, b = (np.frombuffer("".join(x).encode(), np.uint8).reshape(len(x), WALKS, SLOTS) for x in (left, right))
    equal = (a == b).mean(axis=2).max(axis=1) if len(left) else np.zeros(0)
    return np.maximum(0.0, (equal - 1 / 16) / (15 / 16))


def shared_bands(left: list[str], right: list[str]) -> np.ndarray:
    """How many bands of digits are equal; texts with one at least are candidates."""
    a, b = (np.frombuffer("".join(x).encode(), np.uint8).reshape(len(x), WALKS * SLOTS // BAND, BAND) for x in (left, right))
    return (a == b).all(axis=2).sum(axis=1)


def fingerprinted(documents: DataFrame) -> DataFrame:
    """`documents` and the column `fingerprint` of `text`; a null text counts as empty."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            yield with_columns(rows, {"fingerprint": pa.array(fingerprints(texts), pa.string())})

    return documents.mapInArrow(run, extended(documents, "fingerprint string"))


# --- near copies ---------------------------------------------------------------------------------


def near_classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id): the least doc_id of the texts linked with a document's, itself included.

    Texts that share a band are linked if their edit distance is at most (1 - similarity) of the longer
    one's length. Each band first pairs its texts with the least one; then only texts whose classes still
    differ meet, so a group of copies isn't multiplied. Bands find a pair with a probability that grows
    with its likeness (over 0.99 where 0.8 of the digits are equal). A null text counts as empty; one
    row comes out per distinct doc_id and text, rows without a doc_id take no part.
    """
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("name", F.sha2("text", 256))
    heads = materialize(rows.groupBy("name").agg(F.min("doc_id").alias("head")))
    texts = materialize(fingerprinted(rows.join(heads, "name").where("doc_id = head").dropDuplicates(["name"]).select("head", "name", "text")))
    numbers = range(0, WALKS * SLOTS, BAND)
    bands = F.array(*[F.xxhash64(F.lit(n), F.substring("fingerprint", n + 1, BAND)) for n in numbers])
    bands = materialize(texts.select("name", F.explode(bands).alias("band")))
    least = bands.groupBy("band").agg(F.min("name").alias("least"), F.count("*").alias("n")).where("n > 1")
    pairs = bands.join(least, "band").where("name != least").select(F.col("least").alias("a"), F.col("name").alias("b")).distinct()
    links = materialize(_verified(pairs, texts, similarity))
    labels = materialize(components(links))
    told = bands.join(labels.withColumnRenamed("node", "name"), "name", "left").select("band", "name", F.coalesce("label", "name").alias("label"))
    open_ = told.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("band")
    told = materialize(told.join(open_, "band"))
    left, right = told.toDF("band", "a", "label_a"), told.toDF("band", "b", "label_b")
    rest = left.join(right, "band").where("label_a < label_b").select("a", "b").distinct()
    links = links.union(_verified(rest, texts, similarity))
    classes = materialize(components(links)).withColumnRenamed("node", "name")
    named = heads.join(classes, "name", "left").select("name", "head", F.coalesce("label", "name").alias("label"))
    first = named.groupBy("label").agg(F.min("head").alias("class_id"))
    return rows.select("doc_id", "name").join(named, "name").join(first, "label").select("doc_id", "class_id")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    one, other = (texts.select(F.col("name").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
    both = pairs.join(one, "a").join(other, "b")
    most = F.floor(F.lit(1 - similarity + 1e-9) * F.greatest(F.length("text_a"), F.length("text_b"))).cast("int")
    apart = F.levenshtein("text_a", "text_b")
    close = F.abs(F.length("text_a") - F.length("text_b")) <= most
    return both.where(close & (apart <= most)).select("a", "b")


# --- each document and the one behind it -----------------------------------------------------------

_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_bands_edited int, shared_bands_next int"


def _compared(ids: list, texts: list[str], nexts: list[str], next_prints: list[str] = ()) -> tuple[list[list], list[str]]:
    """The result's columns for documents and the texts behind them; the fingerprints of `texts`.

    Without `next_prints`, each text but the last is behind the one before, and only `nexts` of these
    are given.
    """
    n = len(nexts)
    edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts, nexts)]
    prints = fingerprints(texts + edited)
    prints, edited_prints = prints[: len(texts)], prints[len(texts) :]
    behind = next_prints or prints[1:]
    columns = [
        ids[:n],
        [len(t) for t in texts[:n]],
        [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        prints[:n],
        edited_prints,
        likeness(prints[:n], edited_prints).tolist(),
        likeness(prints[:n], behind).tolist(),
        shared_bands(prints[:n], edited_prints).tolist(),
        shared_bands(prints[:n], behind).tolist(),
    ]
    return columns, prints


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def edited_with_next(documents: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness to it and to the next one's.

    Documents follow each other by descending doc_id, those without one last; rows of one doc_id in the
    order of a hash of their text; after the last comes the first, which may be the same. The edited text
    has its last third (rounded down) replaced by the next document's first as many characters, or all. A
    null text counts as empty; repeated rows give a row each; other columns aren't looked at. Texts are
    dealt by range of doc_id once; the last document of a task meets the first of the next one later.
    """
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch, texts in slices(batches):
            ids = batch.column(0).to_pylist()
            if held is not None:
                ids, texts = [held[0], *ids], [held[1], *texts]
            done, prints = _compared(ids, texts, texts[1:])
            if held is None:
                yield edge("first", part, ids[0], texts[0], prints[0])
            held = ids[-1], texts[-1], prints[-1]
            n = len(ids) - 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, _KINDS)] + [pa.nulls(n, t) for t in (pa.string(), pa.int32(), pa.string())], [*_NAMES, "edge", "part", "text"])
        if held is not None:
            yield edge("last", part, *held)

    def edge(which: str, part: int, doc_id, text: str, own: str) -> pa.RecordBatch:
        cells = [doc_id, None, None, own, *[None] * 5, which, part, text]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, [*_KINDS, pa.string(), pa.int32(), pa.string()])], [*_NAMES, "edge", "part", "text"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, _ = _compared(*(batch.column(i).to_pylist() for i in range(4)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, _KINDS)], _NAMES)

    found = materialize(dealt.mapInArrow(run, f"{_RESULT}, edge string, part int, text string"))
    first = found.where("edge = 'first'").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("after_print"))
    follows = Window.orderBy("part")  # one row per task
    behind = first.select(F.col("part").alias("own"), F.coalesce(F.lead("part").over(follows), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("part"))
    last = found.where("edge = 'last'").select("doc_id", "text", F.col("part").alias("own"))
    pairs = last.join(behind, "own").join(first, "part").select("doc_id", "text", "after", "after_print")
    return found.where("edge is null").select(_NAMES).unionByName(pairs.mapInArrow(meet, _RESULT))


def op11_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_with_next(table(spark, sf_dir, "documents"))
