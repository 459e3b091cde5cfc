"""Language of a text by a bit-sliced Bloom filter of n-grams.

A slot of the filter holds one bit per language, so a look-up returns all languages that hold an
n-gram at once: the AND of the slots of its hashes. A text's n-grams vote with every language whose
bit is set; per-language popcounts, less the share that the filter's fill explains, decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.llm.common import ship, slices, table
from skyledger.tuning import materialize, small_side

GRAM = 4  # bytes
HASHES = 3
SLOTS = 8  # of the filter for each n-gram of the language with the most, at least
#: A language holds the n-grams that make this share of its text or more: 50,000 at most.
SHARE = 2e-5
#: A text whose best score is below this is of no known language.
LEAST_SCORE = 0.05
HELD_CODES = 1 << 20
UNKNOWN = "und"
#: Letters as lower case and the bytes of other scripts; anything else separates words.
_BYTES = bytes((b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts, one after another, as numbers, and where each text's begin.

    A text of n bytes, with a space before it and two behind, has n n-grams; an empty one has one.
    """
    joined = np.frombuffer(b"".join(b" " + (t or b" ").translate(_BYTES) + b"  " for t in texts), np.uint8).astype(np.uint32)
    code = joined[: len(joined) - GRAM + 1].copy()
    for k in range(1, GRAM):
        code = code << np.uint32(8) | joined[k : len(joined) - GRAM + 1 + k]
    sizes = np.array([max(len(t), 1) for t in texts], np.int64)
    ends = np.cumsum(sizes + GRAM - 1)
    keep = np.ones(len(joined), bool)
    for k in range(1, GRAM):
        keep[ends - k] = False  # n-grams that begin in a text's end reach into the next
    return code[keep[: len(code)]], np.cumsum(sizes) - sizes


@dataclass
class LanguageFilter:
    """`slots`: per slot the bits of all languages, in as many numbers as they need."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    fallback: str

    @classmethod
    def build(cls, held: dict[str, np.ndarray], fallback: str) -> LanguageFilter:
        """The filter of the n-grams that each language holds; its size follows from their numbers."""
        languages = sorted(held)
        most = max(len(held[name]) for name in languages)
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        slots = np.zeros((1 << max(10, (SLOTS * most - 1).bit_length()), -(-len(languages) // 64)), kind)
        for k, name in enumerate(languages):
            for at in _slots(np.asarray(held[name], np.uint32), len(slots)):
                slots[at, k // 64] |= kind(1 << k % 64)
        fill = np.array([(slots[:, k // 64] >> kind(k % 64) & kind(1)).mean() for k in range(len(languages))])
        return cls(languages, slots, fill**HASHES, fallback)

    def holders(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that (seem to) hold it."""
        first, *rest = _slots(codes, len(self.slots))
        found = self.slots[first]
        for at in rest:
            found &= self.slots[at]
        return found

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """Per text and language, the corrected share of the text's n-grams, from 0 to 1."""
        codes, starts = _codes(texts)
        found = self.holders(codes)
        n = np.diff(np.append(starts, len(codes)))
        out = np.empty((len(texts), len(self.languages)))
        for k, rate in enumerate(self.false_rate):
            bit = found[:, k // 64] >> found.dtype.type(k % 64) & found.dtype.type(1)
            hits = np.add.reduceat(bit, starts, dtype=np.int64)
            out[:, k] = (hits / n - rate) / (1 - rate) if rate < 1 else 0
        return np.clip(out, 0, 1)


def _slots(codes: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slots of each code under each hash, of a power of two slots."""
    mixed = (codes ^ codes >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> np.uint32(12)
    odd = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
    return [(mixed + np.uint32(k + 1)) * np.uint32(m) >> np.uint32(33 - slots.bit_length()) for k, m in enumerate(odd[:HASHES])]


def fit(documents: DataFrame) -> LanguageFilter | None:
    """Learns from all rows of `text` and non-null `lang`; None where there are none.

    Every text counts whole, n-grams are numbers of four bytes. A language holds each n-gram that
    makes SHARE or more of its text, whatever other languages hold; that bounds what the driver gets. A
    null text has no n-grams, a language with null or empty texts only is not learned.
    """
    ship(documents.sparkSession)

    def count(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def rows():
            for lang, parts in held.items():
                codes, counts = _added(parts)
                for k in range(0, len(codes), 1 << 17):
                    own = slice(k, k + (1 << 17))
                    columns = [pa.array([lang] * len(codes[own]), pa.string()), pa.array(codes[own], pa.int64()), pa.array(counts[own], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])

        for part, texts in slices(batches, binary=True):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(1).to_pylist(), texts):
                if text:
                    by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                held.setdefault(lang, []).append(np.unique(_codes(own)[0], return_counts=True))
                n += len(held[lang][-1][0])
            if n > HELD_CODES:
                held = {lang: [_added(parts)] for lang, parts in held.items()}
                n = sum(len(parts[0][0]) for parts in held.values())
                if n > HELD_CODES // 2:
                    yield from rows()
                    held, n = {}, 0
        yield from rows()

    counted = documents.where("lang is not null").select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    counted = materialize(counted.groupBy("lang", "code").agg(F.sum("n").alias("n")))
    totals = materialize(counted.groupBy("lang").agg(F.sum("n").alias("total")))
    kept = counted.join(small_side(totals), "lang").where(F.col("n") >= SHARE * F.col("total")).select("lang", "code").toArrow()
    if not len(kept):
        return None
    codes, names = kept.column("code").to_numpy(), np.array(kept.column("lang").to_pylist(), object)
    most = totals.orderBy(F.desc("total"), "lang").first().lang
    return LanguageFilter.build({name: np.sort(codes[names == name]).astype(np.uint32) for name in set(names)}, most)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


_PREDICTED = "struct<lang_pred: string, score: double>"


def predictor(spark: SparkSession, model: LanguageFilter | None):
    """A function from a column of texts to one of (lang_pred, score); only the texts go to Python."""
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_PREDICTED)
    def predict(texts: pa.Array) -> pa.Array:
        own, names, scores = sent.value, [], []
        for _, some in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), binary=True):
            letters = [any(map(str.isalpha, t.decode())) for t in some]
            if own is None:
                names += [UNKNOWN] * len(some)
                scores += [0.0] * len(some)
                continue
            shares = own.shares(some)
            best = shares.argmax(axis=1)
            top = [float(s[b]) if ok else 0.0 for s, b, ok in zip(shares, best, letters)]
            scores += top
            names += [UNKNOWN if not ok else own.languages[b] if s else own.fallback for b, s, ok in zip(best, top, letters)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def identify(documents: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """`documents` with `lang_pred` and `score`, the corrected share of n-grams of that language.

    Only the whole text is looked at. A text that is null, empty or without a letter, or any text
    where there is no model, is `und` with score 0; ties go to the first language by name; a text
    with no known n-gram gets the language with the most training text and score 0. Earlier columns
    of the two names are replaced; all other columns and repeated rows stay.
    """
    documents = documents.drop("lang_pred", "score")
    found = predictor(documents.sparkSession, model)(F.col("text").cast("string"))
    return documents.select("*", found["lang_pred"].alias("lang_pred"), found["score"].alias("score"))


def of_known_language(documents: DataFrame, model: LanguageFilter, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of `documents` whose text has a letter and a score of `least` or more."""
    found = predictor(documents.sparkSession, model)(F.col("text").cast("string"))
    return documents.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))


def held_out() -> Column:
    """Whether a document is kept from training; a null doc_id is in neither part."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(documents: DataFrame) -> LanguageFilter | None:
    return fit(documents.where(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang"))


def op5_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, trained(documents)).select("doc_id", "held_out", "lang_pred", "score")
