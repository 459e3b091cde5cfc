"""Documents scored by the difference of two language models' cross-entropies.

A target and a background model count the pairs of neighbouring words over the full vocabulary of the
corpus. Both back off to their counts of single words and these to the counts of all words, with the same
weights, so a document's loss under one minus that under the other tells which corpus it is like, token by
token.

Counting and scoring share one exchange. Tasks send their documents' pairs, packed, to the bucket of the
pair's second word. There all pairs that end in the word meet, so its own count, the pairs' counts and the
count of the word as a first one (its places less those at a text's end) are known without any table, and
only sums of losses per document come back. What is frequent is counted beforehand: pairs that end in a
frequent word are dealt by both words, and frequent pairs are scored where the text is. So no bucket
holds a hot word or pair, and what every task holds has a bound: a share of all tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm.common import extended, ship, slices, table
from skyledger.llm.jaccard import word_hashes
from skyledger.tuning import join_hint, materialize

PSEUDO = 50.0  # tokens of the single-word model in a pair's estimate
PRIOR = 1000.0  # tokens of all words' distribution in a single word's estimate
SHARES = (1 << 18, 1 << 14)  # a word or pair is frequent from this part of all tokens on
COUNTED_TOKENS = 4 << 20
SENT_TOKENS = 3 << 19  # packed at once
BUCKET_ENTRIES = 8 << 20
PART_ENTRIES = 1 << 20  # of a bucket, in memory at once
SENT_ROWS = 1 << 17
TARGET_IDS = 2_000_000  # broadcast at most, 16 MB of numbers
START, END = 0, 1  # stand for a word before a text's first one, and for a text's end
_SCORED, _COUNTED, _TARGET = 4, 2, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _neighbours(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, word) of all words of the texts, and each text's number of words."""
    words, ends = word_hashes(texts)
    words = np.maximum(words, np.uint64(END + 1))
    sizes = np.diff(ends, prepend=0)
    before = np.concatenate((np.zeros(1, np.uint64), words[:-1]))[: len(words)]
    before[(np.array(ends) - sizes)[sizes > 0]] = START
    return before, words, sizes


def _chunks(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, before, word, row behind the first, flags) for some rows of (text, flags) at a time."""
    held, first, row, n = [], 0, 0, 0
    for part, texts in slices(batches, binary=True):
        before, word, sizes = _neighbours(texts)
        flags = np.repeat(part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8), sizes)
        held.append((before, word, np.repeat(np.arange(row - first, row - first + len(texts)), sizes), flags))
        row, n = row + len(texts), n + len(word)
        if n >= tokens:
            yield first, *map(np.concatenate, zip(*held))
            held, first, n = [], row, 0
    if n:
        yield first, *map(np.concatenate, zip(*held))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _batch(ddl: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in ddl.split(", ")))
    arrow = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(columns, kinds)], list(names))


_FREQUENT = "kind int, before long, word long, n long"


def _frequent(shares: tuple[int, int]):
    """Emits each chunk's words (0) and pairs (1) of half the frequent share of its tokens, and their number (2)."""

    def frequent(batches):
        for _, before, word, _, _ in _chunks(batches, COUNTED_TOKENS):
            words, n = np.unique(word, return_counts=True)
            many = n * 2 * shares[0] >= len(word)
            none = np.zeros(many.sum(), np.int64)
            yield _batch(_FREQUENT, [none, none, words[many].view(np.int64), n[many]])
            order = np.argsort(_mixed(before) + word)
            first, second = before[order], word[order]
            at = _starts(first, second)
            n = np.diff(at, append=len(order))
            at, n = (x[n * 2 * shares[1] >= len(word)] for x in (at, n))
            yield _batch(_FREQUENT, [np.ones(len(at), np.int64), first[at].view(np.int64), second[at].view(np.int64), n])
            yield _batch(_FREQUENT, [[2], [0], [0], [len(word)]])

    return frequent


@dataclass
class Frequent:
    """Frequent words and pairs with their exact counts, of target and of all documents.

    `words` ascends; `pairs` are places of two frequent words, or of START and one, as one number. A word
    is counted as a word and as a first one. Behind the last word stand the number of tokens and START's.
    """

    words: np.ndarray
    pairs: np.ndarray
    as_word: np.ndarray
    as_first: np.ndarray  # START's behind the words'
    as_pair: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, pairs: np.ndarray) -> Frequent:
        """`pairs` has rows of two words."""
        words, none = np.unique(words), np.zeros((2, 0))
        own = cls(words, np.zeros(0, np.int64), none, none, none)
        first, second = (own.place(pairs[:, k]) for k in (0, 1))
        first[pairs[:, 0] == START] = len(words)
        known = (first >= 0) & (second >= 0)
        own.pairs = np.sort(first[known] * (len(words) + 1) + second[known])
        return own

    def place(self, words: np.ndarray) -> np.ndarray:
        """Each word's place, -1 if it isn't frequent."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def places(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the words, of the words before them (START's is the last) and of the pairs, for words in text order."""
        second = self.place(word)
        first = np.concatenate((np.full(1, -1), second[:-1]))[: len(second)]
        first[before == START] = len(self.words)
        pair = np.full(len(second), -1)
        both = np.flatnonzero((first >= 0) & (second >= 0))
        if len(self.pairs) and len(both):
            code = first[both] * (len(self.words) + 1) + second[both]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            pair[both] = np.where(self.pairs[at] == code, at, -1)
        return second, first, pair

    @property
    def tokens(self) -> np.ndarray:
        return self.as_word[:, -1]

    def single(self, counts: np.ndarray) -> np.ndarray:
        """Chances of words with these counts (target, all) under the single-word models."""
        shared = np.maximum(counts[1], 1) / (self.tokens[1] + 1)
        return (counts + PRIOR * shared) / (self.tokens[:, None] + PRIOR)

    def first_losses(self) -> np.ndarray:
        """What a frequent first word adds to a token's losses."""
        return np.log(self.as_first + PSEUDO)

    def pair_losses(self) -> np.ndarray:
        """What a frequent pair adds to a token's losses, without its first word's part."""
        single = self.single(self.as_word[:, self.pairs % (len(self.words) + 1)])
        return -np.log(self.as_pair + PSEUDO * single)


_COUNTS = "place int, target long, total long, first_target long, first_total long"


def _counted(sent):
    """Exact counts of the frequent words, then of START and all tokens, then of the frequent pairs."""

    def counted(batches):
        own = sent.value
        n, m = len(own.words), len(own.pairs)
        counts = np.zeros((4, n + 1 + m), np.int64)
        for _, before, word, _, flags in _chunks(batches, SENT_TOKENS):
            second, first, pair = own.places(before, word)
            for k, flag in enumerate((_TARGET, _COUNTED)):
                some = (flags & _COUNTED > 0) & (flags & flag > 0)
                place = np.concatenate((second[some & (second >= 0)], pair[some & (pair >= 0)] + n + 1))
                counts[k] += np.bincount(place, minlength=n + 1 + m)
                counts[k, n] += some.sum()
                counts[2 + k] += np.bincount(first[some & (first >= 0)], minlength=n + 1 + m)
        some = np.flatnonzero(counts.any(axis=0))
        for k in range(0, len(some), SENT_ROWS):
            yield _batch(_COUNTS, [some[k : k + SENT_ROWS], *counts[:, some[k : k + SENT_ROWS]]])

    return counted


def _planes(values: np.ndarray) -> bytes:
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _pack(word: np.ndarray, first: np.ndarray, rare: np.ndarray, code: np.ndarray, n: np.ndarray) -> bytes:
    """Entries in ascending order of words; `first` is the place of the word before, 0 for those in `rare`."""
    at = _starts(word)
    sizes = np.array([len(at), len(word), len(rare)], "<u4").tobytes()
    planes = map(_planes, (np.diff(at, append=len(word)), first, code, n))
    return zstandard.ZstdCompressor(level=1).compress(b"".join((sizes, word[at].tobytes(), rare.tobytes(), *planes)))


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(zstandard.decompress(data), np.uint8)
    runs, n, rare = (int(x) for x in data[:12].copy().view("<u4"))
    data = data[12:].copy()
    longs = data[: 8 * (runs + rare)].view("<u8")
    at, out = 8 * (runs + rare), []
    for size in (runs, n, n, n):
        out.append(np.ascontiguousarray(data[at : at + 4 * size].reshape(4, size).T).view("<u4").reshape(-1))
        at += 4 * size
    return np.repeat(longs[:runs], out[0]), out[1], longs[runs:], out[2], out[3]


_PACKED = "bucket int, part int, base long, entries binary"


def _sending(sent, buckets: int, parts: int):
    """Packs the pairs that aren't scored in place by (bucket, part); equal ones of a document are one entry.

    An infrequent word at a text's end is an entry with END before it. Documents that are only counted are
    one document.
    """

    def send(batches):
        own, task = sent.value, TaskContext.get().partitionId() << 33
        for base, before, word, doc, flags in _chunks(batches, SENT_TOKENS):
            second, first, pair = own.places(before, word)
            last = np.flatnonzero((np.append(doc[1:], -1) != doc) & (second < 0))
            rest = np.flatnonzero(pair < 0)
            code = (np.where(flags & _SCORED, doc, 0) << 3 | flags).astype(np.int64)
            code = np.concatenate((code[rest], code[last]))
            first = np.concatenate((np.where(before == START, 1, np.where(first >= 0, first + 3, 0))[rest], np.full(len(last), 2)))
            light = np.concatenate((second[rest] < 0, np.ones(len(last), bool)))
            before = np.concatenate((before[rest], np.full(len(last), END, np.uint64)))
            word = np.concatenate((word[rest], word[last]))
            del second, pair, doc, flags
            route = _mixed(np.where(light, word, word ^ _mixed(before + np.uint64(1))))
            slot = (route >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            slot = slot * np.uint64(parts) + ((route & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32))
            order = np.lexsort((code, before, word, slot))
            slot, word, before, code, first = (x[order] for x in (slot.astype(np.int64), word, before, code, first))
            at = _starts(word, before, code)
            n = np.diff(at, append=len(order))
            slot, word, before, code, first = (x[at] for x in (slot, word, before, code, first))
            edges = np.append(_starts(slot), len(slot)) if len(slot) else np.zeros(1, np.int64)
            rows = []
            for a, b in zip(edges[:-1], edges[1:]):
                own_first = first[a:b]
                data = _pack(word[a:b], own_first, before[a:b][own_first == 0], code[a:b], n[a:b])
                rows.append((slot[a] // parts, slot[a] % parts, task + base, data))
                if len(rows) == 256:
                    yield _batch(_PACKED, [list(c) for c in zip(*rows)])
                    rows = []
            if rows:
                yield _batch(_PACKED, [list(c) for c in zip(*rows)])

    return send


_SUMS = "_row long, n long, _t double, _b double"


def _part_sums(own: Frequent, entries: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows in ascending order, and their numbers of tokens and sums of losses, from all entries of a part."""
    columns = []
    for base, data in entries:
        word, first, rare, code, n = _unpack(data)
        before = np.where(first == 1, np.uint64(START), np.uint64(END))
        known = first >= 3
        before[known] = own.words[first[known] - 3]
        before[first == 0] = rare
        columns.append((word, before, base + (code >> 3).astype(np.int64), (code & 7).astype(np.uint8), n.astype(np.int64)))
    word, before, row, flags, n = map(np.concatenate, zip(*columns))
    order = np.lexsort((before, word))
    word, before, row, flags, n = (x[order] for x in (word, before, row, flags, n))

    pairs = _starts(word, before)
    counted = n * (flags & _COUNTED > 0)
    in_pair = np.array([np.add.reduceat(counted * (flags & _TARGET > 0), pairs), np.add.reduceat(counted, pairs)])
    end = before[pairs] == END
    words = _starts(word[pairs])
    as_word, ends = (np.add.reduceat(in_pair * some, words, axis=1) for some in (~end, end))
    place = own.place(word[pairs][words])
    frequent = place >= 0
    first_losses = np.where(frequent, 0, np.log(np.maximum(as_word - ends, 0) + PSEUDO))  # frequent ones' are added in place
    as_word = as_word.astype(float)
    as_word[:, frequent] = own.as_word[:, place[frequent]]
    of_word = np.repeat(np.arange(len(words)), np.diff(words, append=len(pairs)))
    single = own.single(as_word)
    losses = np.where(end, -first_losses[:, of_word], first_losses[:, of_word] - np.log(in_pair + PSEUDO * single[:, of_word]))

    of_pair = np.repeat(np.arange(len(pairs)), np.diff(pairs, append=len(n)))
    scored = flags & _SCORED > 0
    row, n, of_pair = row[scored], n[scored], of_pair[scored]
    rows, of_row = np.unique(row, return_inverse=True)
    weights = (n * ~end[of_pair], *(n * losses[k][of_pair] for k in (0, 1)))
    return rows, np.array([np.bincount(of_row, w, len(rows)) for w in weights])


def _scoring(sent):
    """Sums per row of a bucket's entries, which come in the order of their parts."""

    def sums(held):
        rows, of_row = np.unique(np.concatenate([r for r, _ in held]), return_inverse=True)
        values = np.concatenate([v for _, v in held], axis=1)
        return rows, np.array([np.bincount(of_row, v, len(rows)) for v in values])

    def out(rows, values):
        for k in range(0, len(rows), SENT_ROWS):
            own = slice(k, k + SENT_ROWS)
            yield _batch(_SUMS, [rows[own], values[0, own].astype(np.int64), values[1, own], values[2, own]])

    def score(batches):
        own, part, entries, held = sent.value, None, [], []

        def closed():
            nonlocal entries, held
            held.append(_part_sums(own, entries))
            entries = []
            if sum(len(r) for r, _ in held) > PART_ENTRIES:
                held = [sums(held)]
                if len(held[0][0]) > PART_ENTRIES // 2:
                    yield from out(*held[0])
                    held = []

        for batch in batches:
            for number, base, data in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if number != part and entries:
                    yield from closed()
                part = number
                entries.append((base, data))
        if entries:
            yield from closed()
        if held:
            yield from out(*sums(held))

    return score


def _measuring(sent, kept: list[str], names: list[str]):
    """`kept`, number of tokens, of those left to the buckets, and losses of what is frequent."""

    def measure(batches):
        own, row = sent.value, TaskContext.get().partitionId() << 33
        first_losses, pair_losses = own.first_losses(), own.pair_losses()
        for part, texts in slices(batches, binary=True):
            before, word, sizes = _neighbours(texts)
            doc = np.repeat(np.arange(len(texts)), sizes)
            _, first, pair = own.places(before, word)
            left = np.bincount(doc[pair < 0], minlength=len(texts))
            sums = []
            for k in (0, 1):
                whole = np.bincount(doc[first >= 0], first_losses[k, first[first >= 0]], len(texts))
                sums.append(whole + np.bincount(doc[pair >= 0], pair_losses[k, pair[pair >= 0]], len(texts)))
            numbers = (np.asarray(x, np.int64) for x in (sizes, np.arange(row, row + len(texts)), left))
            row += len(texts)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array(x, pa.float64() if k > 2 else pa.int64()) for k, x in enumerate((*numbers, *sums)))], [*kept, *names])

    return measure


def score(
    documents: DataFrame,
    corpus: DataFrame | None = None,
    text: bool = True,
    shares: tuple[int, int] = SHARES,
    bucket_entries: int = BUCKET_ENTRIES,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """`documents` with `n_tokens`, `target_loss`, `background_loss` and `difference`, means per token.

    The models count the rows of `corpus` with a true `target` and all its rows; without one,
    `documents` are the corpus. A null target is false, a null text empty. Words stand between ASCII
    white space, A-Z as lower case, and are named by 64-bit hashes; words that the corpus lacks share the
    chance of a word seen once. A low difference is like the target. A text that is null or
    without words has 0 tokens and nulls. Earlier columns of the four names are replaced; all other columns and
    repeated rows stay, the text only with `text`.

    Tasks and buckets number the rows anew, so `documents` must be a stored table or what a selection or a
    broadcast join makes of one; rows that come in another order the second time raise an error. The other
    arguments bound memory and don't change a result: every task holds at most twice `shares` frequent words and pairs.
    """
    ship(documents.sparkSession)
    spark = documents.sparkSession
    documents = documents.drop("n_tokens", "target_loss", "background_loss", "difference")

    def flagged(df: DataFrame, flags: int) -> DataFrame:
        target = F.coalesce(F.col("target").cast("boolean"), F.lit(False)).cast("int") if flags & _COUNTED else F.lit(0)
        return df.select("text", (target + flags).alias("flags"))

    scored = flagged(documents, _SCORED | (_COUNTED if corpus is None else 0))
    counted = scored if corpus is None else flagged(corpus, _COUNTED)
    sides = [scored] if corpus is None else [scored, counted]

    def all_sides(task, ddl: str) -> DataFrame:
        first, *rest = (side.mapInArrow(task, ddl) for side in sides)
        return first.union(rest[0]) if rest else first

    many = materialize(all_sides(_frequent(shares), _FREQUENT).groupBy("kind", "before", "word").agg(F.sum("n").alias("n")))
    tokens = many.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    words, pairs = (many.where((F.col("kind") == k) & (F.col("n") * (2 * shares[k]) >= tokens)).select("before", "word").toArrow() for k in (0, 1))
    pairs = np.array([pairs.column(k).to_numpy() for k in (0, 1)], np.int64).T.reshape(-1, 2).view(np.uint64)
    own = Frequent.of(words.column(1).to_numpy().astype(np.int64).view(np.uint64), pairs)
    exact = counted.mapInArrow(_counted(spark.sparkContext.broadcast(own)), _COUNTS).groupBy("place").agg(*[F.sum(c.split()[0]).alias(c.split()[0]) for c in _COUNTS.split(", ")[1:]]).toArrow()
    counts = np.zeros((4, len(own.words) + 1 + len(own.pairs)))
    counts[:, exact.column(0).to_numpy()] = [exact.column(k).to_numpy() for k in range(1, 5)]
    n = len(own.words) + 1
    own.as_word, own.as_first, own.as_pair = counts[:2, :n], counts[2:, :n], counts[:2, n:]
    sent = spark.sparkContext.broadcast(own)

    buckets = max(2 * spark.sparkContext.defaultParallelism, math.ceil(tokens / bucket_entries))
    parts = math.ceil(tokens / buckets / part_entries) or 1
    packed = all_sides(_sending(sent, buckets, parts), _PACKED)
    dealt = packed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("part")
    sums = dealt.mapInArrow(_scoring(sent), _SUMS).groupBy("_row").agg(F.sum("n").alias("_n"), F.sum("_t").alias("_jt"), F.sum("_b").alias("_jb"))

    kept = [c for c in documents.columns if text or c != "text"]
    own_ = next(p for p in ("_" * k for k in range(1, 99)) if not any(c.startswith(p) for c in kept))
    row, left, t, b = (own_ + c for c in ("row", "left", "t", "b"))
    schema = extended(documents.select(*kept), f"n_tokens long, {row} long, {left} long, {t} double, {b} double")
    marked = materialize(documents.mapInArrow(_measuring(sent, kept, schema.names[len(kept) :]), schema))
    found = [own_ + c for c in ("n", "jt", "jb")]
    sums = materialize(sums.toDF(row, *found))
    out = marked.join(join_hint(sums)(sums), row, "left")
    n, jt, jb = (F.coalesce(F.col(c), F.lit(0)) for c in found)
    wrong = F.raise_error(F.lit("the rows of the documents came in another order")).cast("long")
    tokens = F.when(F.col(left) == n, F.col("n_tokens")).otherwise(wrong)
    means = [F.when(F.col("n_tokens") > 0, (F.col(x) + y) / F.col("n_tokens")) for x, y in ((t, jt), (b, jb))]
    out = out.withColumns({"target_loss": means[0], "background_loss": means[1], "n_tokens": tokens})
    out = out.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
    return out.select(*kept, "n_tokens", "target_loss", "background_loss", "difference")


def with_target(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, target): whether a label of the document says good quality.

    Up to TARGET_IDS such ids are broadcast, which leaves the documents in their order; with more, the
    join is stored.
    """
    good = materialize(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("target", F.lit(True)))
    rows = documents.select("doc_id", "text")
    if good.limit(TARGET_IDS + 1).count() <= TARGET_IDS:
        return rows.join(F.broadcast(good), "doc_id", "left")
    return materialize(rows.join(good, "doc_id", "left"))


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score(documents, text=False).drop("target")
