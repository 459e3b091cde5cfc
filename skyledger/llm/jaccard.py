"""Jaccard join of documents on word shingles, and the components of its links.

Sets that reach the threshold share a shingle among the rarest few of either (its prefix). Documents
meet on prefix shingles; the lengths, the shingle's places and a bound by parities (in place of a
suffix filter) discard pairs; what is left is compared once. Documents of equal sets count as one throughout.

Groups of near copies would meet in all pairs. So each prefix shingle first pairs its documents with
one of them only, the same for many shingles, and then those that this left apart with another one that
differs from shingle to shingle. The links found make components, and only documents that are still in
different components meet in full. A pair within a component can't change it, so none is missed. That is
`link_components`; `find_links` and `count_links` compare all pairs that pass the filters.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import ship, slices, table
from skyledger.llm.components import components
from skyledger.tuning import materialize, small_side

WORDS = 4
PERCENT = 85
BUCKET_BITS = 20  # of the shingle counts that order shingles; any order is right, rare first is fast
BLOCKS = 16
SLICE = 1 << 19  # bytes of text that a task hashes at once
EARLIER = 4  # shared shingles before an entry's own that it carries
LONGS = 12  # of parities of the hashes in 64 parts each of their range; they bound how far two sets differ
_ODD = np.random.default_rng(7).integers(1, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _BASE, _AT, _SHORT = _ODD[:256], _ODD[256], _ODD[257:273], _ODD[273]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


@functools.lru_cache(1)
def _factors(n: int) -> np.ndarray:
    """An odd factor for each of the first n places of a word, without a rule between neighbours."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """64-bit hashes of all words of the texts in their order, and where each text's words end.

    A-Z count as lower case; words are what stands between ASCII white space. A word is the sum of its
    bytes' numbers, each times the factor of its place.
    """
    raw = np.frombuffer(b"".join(t.lower() + b" " for t in texts), np.uint8)
    space = _SPACE[raw]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    longest = int((ends - starts).max()) if len(starts) else 0
    factors = _factors(1 << max(10, longest.bit_length()))
    letters = np.flatnonzero(~space)
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))  # of the words among the letters
    place = np.arange(len(letters)) - np.repeat(bounds[:-1], np.diff(bounds))
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_BYTE[raw[letters]] * factors[place], out=sums[1:])
    word = _mixed(np.diff(sums[bounds]) + (ends - starts).astype(np.uint64) * _SHORT)
    return word, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles as ascending 64-bit hashes.

    Words are those of `word_hashes`. A text of fewer words is one shingle, a text without words has
    none.
    """
    word, limits = word_hashes(texts)
    n = len(word) - words + 1
    whole = np.zeros(max(n, 0), np.uint64)
    for k in range(words if n > 0 else 0):
        whole += word[k : k + n] * _AT[k]
    whole, out, a = _mixed(whole), [], 0
    for b in limits:
        if b - a >= words:
            own = np.sort(whole[a : b - words + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            own = _mixed((word[a:b] * _AT[: b - a]).sum(keepdims=True) + np.full(1, b - a, np.uint64) * _SHORT)
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        a = b
    return out


def _key(own: np.ndarray) -> int:
    """Names a set: two of n sets share a name with a probability below n * n / 2 ** 65."""
    places = np.arange(1, len(own) + 1, dtype=np.uint64)
    return int(_mixed((_mixed(own + places * _BASE)).sum(keepdims=True) + np.uint64(len(own))).view(np.int64)[0])


def _parts(own: np.ndarray) -> np.ndarray:
    """Whether each part of the hash range holds an odd number of the set's hashes, a bit each."""
    part = (own >> np.uint64(32)) * np.uint64(64 * LONGS) >> np.uint64(32)
    counts = np.bincount(part.astype(np.int64), minlength=64 * LONGS)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


_G = [f"g{k}" for k in range(LONGS)]
PROFILE = "doc_id long, text_hash long, set_key long, n int, " + "".join(f"g{k} long, " for k in range(LONGS)) + "block int, counts binary"


def _profile(words: int):
    def profile(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for part, texts in slices(batches, binary=True, chars=SLICE):
            sets = shingle_sets(texts, words)
            joined = np.concatenate(sets)
            if len(joined):
                counts += np.bincount((joined >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(counts))
            parts = np.array([_parts(s) for s in sets]).reshape(-1, LONGS)
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield _rows(PROFILE, [part.column(0), part.column(1), pa.array([_key(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), *map(pa.array, np.ascontiguousarray(parts.T)), *none])
        _factors.cache_clear()
        pack = zstandard.ZstdCompressor(level=1)
        blocks = [pack.compress(b.astype("<i8").tobytes()) for b in counts.reshape(BLOCKS, -1)]
        nulls = [pa.nulls(BLOCKS, pa.int64())] * 3 + [pa.nulls(BLOCKS, pa.int32())] + [pa.nulls(BLOCKS, pa.int64())] * LONGS
        yield _rows(PROFILE, [*nulls, pa.array(range(BLOCKS), pa.int32()), pa.array(blocks, pa.binary())])

    return profile


def _rows(ddl: str, columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ddl.split(", ")])


def _summed(batches):
    """Adds the count blocks of all tasks as they stream by; a block is in memory once."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(zstandard.decompress(data), "<i8")
            total[block] = total[block] + own if block in total else own
    yield _rows("block int, counts binary", [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())])


def _prefixes(sent, words: int, percent: int):
    """Prefix shingles, rarest first by the counts and then by hash. A task emits equal sets once."""

    def prefixes(batches):
        counts, seen = sent.value, set()
        for _, texts in slices(batches, binary=True, chars=SLICE):
            tokens, keys, sizes, places = [], [], [], []
            for own in shingle_sets(texts, words):
                n = len(own)
                if not n or (key := _key(own)) in seen:
                    continue
                seen.add(key)
                take = n - (percent * n + 99) // 100 + 1
                rank = counts[(own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] << np.uint64(40) | own >> np.uint64(24)
                tokens.append(own[np.argsort(rank, kind="stable")[:take]])
                keys.append(np.full(take, key))
                sizes.append(np.full(take, n, np.int32))
                places.append(np.arange(take, dtype=np.int32))
            if tokens:
                yield _rows("token long, set_key long, n int, place int", [pa.array(np.concatenate(x)) for x in ([t.view(np.int64) for t in tokens], keys, sizes, places)])
        _factors.cache_clear()

    return prefixes


def _sets(words: int):
    def sets(batches):
        seen = set()
        for part, texts in slices(batches, binary=True, chars=SLICE):
            keys, data = [], []
            for want, own in zip(part.column(0).to_pylist(), shingle_sets(texts, words)):
                if want not in seen:
                    seen.add(want)
                    keys.append(want)
                    data.append(own.tobytes())
            yield _rows("set_key long, hashes binary", [pa.array(keys, pa.int64()), pa.array(data, pa.binary())])
        _factors.cache_clear()

    return sets


def _common(x: pd.Series, y: pd.Series) -> pd.Series:
    pairs = ((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(x, y))
    return pd.Series([len(np.intersect1d(a, b, assume_unique=True)) for a, b in pairs], dtype="int32")


def _need(n: Column, m: Column, percent: int) -> Column:
    """What two sets of these sizes must have in common to link."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length and place filter for two prefix entries of one shingle."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    rest = F.least(n - F.col(f"{x}.place") - 1, m - F.col(f"{y}.place") - 1)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (1 + rest >= _need(n, m, percent))


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the parities leave room for a link: parts of unlike parity hold a hash that one set alone has."""
    n, m, differ = F.col(f"{x}.n"), F.col(f"{y}.n"), F.lit(0)
    for g in _G:
        differ = differ + F.bit_count(F.col(f"{x}.{g}").bitwiseXOR(F.col(f"{y}.{g}")))
    return differ <= n + m - 2 * _need(n, m, percent)


def _met(x: str, y: str, percent: int) -> Column:
    """All filters, for entries of `_wide`: a pair with one of the shingles before in common has met there."""
    return _may_link(x, y, percent) & ~F.arrays_overlap(f"{x}.earlier", f"{y}.earlier") & _near(x, y, percent)


def _wide(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """`entries` with their set's parities and the few shingles before their own, of a bounded width.

    What two sets have in common first has nothing before it in common, so no pair is lost.
    """
    before = Window.partitionBy("set_key").orderBy("place").rowsBetween(-EARLIER, -1)
    return entries.withColumn("earlier", F.collect_list("token").over(before)).join(sets.select("set_key", *_G), "set_key")


def _prepared(documents: DataFrame, words: int, percent: int):
    """(rows, sets, entries, links): what meets on prefix shingles, and the function that compares pairs."""
    ship(documents.sparkSession)
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    profile = materialize(texts.mapInArrow(_profile(words), PROFILE))
    blocks = profile.where("block is not null").select("block", "counts").repartition(BLOCKS, "block")
    counts = np.zeros((BLOCKS, (1 << BUCKET_BITS) // BLOCKS), np.uint64)
    for r in blocks.mapInArrow(_summed, "block int, counts binary").collect():
        counts[r.block] = np.frombuffer(r.counts, "<i8")
    sent = spark.sparkContext.broadcast(np.minimum(counts.reshape(-1), (1 << 24) - 1))

    rows = profile.where("block is null").drop("block", "counts")
    sets = rows.where("n > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("least_id"), F.max("n").alias("n"), *[F.max(g).alias(g) for g in _G]
    )
    sets = materialize(sets)

    entries = documents.select("text").mapInArrow(_prefixes(sent, words, percent), "token long, set_key long, n int, place int")
    once = entries.repartition("token").groupBy("token", "set_key").agg(F.max("place").alias("place"))
    shared = once.withColumn("holders", F.count("*").over(Window.partitionBy("token"))).where("holders > 1").drop("holders")
    entries = materialize(shared.join(sets.select("set_key", "n"), "set_key"))

    def links(pairs: DataFrame) -> DataFrame:
        """Compares the sets of each pair; only texts that stand in a pair are read for it."""
        pairs = materialize(pairs)
        wanted = pairs.select("a").union(pairs.select("b")).distinct().join(sets.select(F.col("set_key").alias("a"), "first.*"), "a")
        same = [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("d"), "text_hash"]
        wanted = small_side(materialize(wanted.select(F.col("a").alias("set_key"), *same)))
        chosen = texts.select(*same, "text").join(wanted, ["d", "text_hash"]).select("set_key", "text")
        # dealt by set once, for both ends: stored in between they would be dealt again
        hashes = chosen.mapInArrow(_sets(words), "set_key long, hashes binary").dropDuplicates(["set_key"])
        x = hashes.select(F.col("set_key").alias("a"), F.col("hashes").alias("x"))
        y = hashes.select(F.col("set_key").alias("b"), F.col("hashes").alias("y"))
        both = pairs.join(x, "a").join(y, "b").withColumn("common", F.pandas_udf(_common, "int")("x", "y"))
        union = (F.length("x") + F.length("y")) / 8 - F.col("common")
        return materialize(both.select("a", "b", (100 * F.col("common") >= percent * union).alias("linked")))

    return rows, sets, entries, links


def link_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `documents`.

    Documents link when percent * union <= 100 * intersection of their shingle sets; a component is
    named by its smallest doc_id. A text that is null or without words has no shingles, links with
    nothing and is its own component. Rows of one doc_id each count as a document; a null doc_id
    gives its component no name of its own (null if it has no other). Other columns are left out; an
    empty table gives no rows. Shingles and sets are told apart by 64-bit hashes.
    """
    rows, sets, entries, links = _prepared(documents, words, percent)
    fields = ("set_key", "n", "place")
    x_sets, y_sets = (sets.select(F.col("set_key").alias(end), F.struct("n", *_G).alias(as_)) for end, as_ in (("a", "x"), ("b", "y")))

    def labelled(labels: DataFrame) -> DataFrame:
        return materialize(entries.join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key")))

    def met_with_one(now: DataFrame, order: Column) -> DataFrame:
        """Each entry with the first entry of its shingle in the order, if their labels differ."""
        one = F.min(F.struct(order.alias("order"), *fields, "label")).over(Window.partitionBy("token"))
        met = now.select(F.struct(*fields, "label").alias("x"), one.alias("y")).where("x.label != y.label")
        met = met.where(_may_link("x", "y", percent))
        met = met.select(F.greatest("x.set_key", "y.set_key").alias("a"), F.least("x.set_key", "y.set_key").alias("b")).distinct()
        return met.join(x_sets, "a").join(y_sets, "b").where(_near("x", "y", percent)).select("a", "b")

    tried = links(met_with_one(entries.withColumn("label", F.col("set_key")), F.lit(0)))
    below = tried.where("linked").groupBy("a").agg(F.min("b").alias("b"))  # a is above b
    further = below.select(F.col("a").alias("b"), F.col("b").alias("c"))
    now = labelled(below.join(further, "b", "left").select(F.col("a").alias("set_key"), F.coalesce("c", "b").alias("label")))
    again = met_with_one(now, F.xxhash64("set_key", "token")).join(tried, ["a", "b"], "left_anti")
    tried = tried.union(links(again))
    labels = materialize(components(tried.where("linked")).withColumnRenamed("node", "set_key"))
    now = labelled(labels)
    sizes = now.groupBy("token", "label").count().groupBy("token").agg(F.max(F.struct("count", "label"))["label"].alias("mode"), F.count("*").alias("labels"))
    open_ = _wide(now.join(sizes.where("labels > 1"), "token"), sets)
    x, y = open_.where("label != mode").alias("x"), open_.alias("y")
    apart = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.mode")) | (F.col("x.set_key") > F.col("y.set_key")))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & apart & _met("x", "y", percent))
    pairs = met.select(F.greatest("x.set_key", "y.set_key").alias("a"), F.least("x.set_key", "y.set_key").alias("b")).distinct()
    more = links(pairs.join(tried, ["a", "b"], "left_anti"))
    late = more.where("linked").select("a", "b")
    for end in ("a", "b"):  # links between labels
        name = labels.select(F.col("set_key").alias(end), F.col("label").alias("_label"))
        late = late.join(name, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")
    late = components(late).select(F.col("node").alias("label"), F.col("label").alias("least"))

    named = sets.select("set_key", "least_id").join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    named = named.join(late, "label", "left").withColumn("label", F.coalesce("least", "label"))
    names = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(names, "label").select("set_key", "component_id")
    return rows.join(named, "set_key", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def find_links(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, set_key) per row of `documents`, and the links (a, b) of different sets.

    Every two sets with percent * union <= 100 * intersection are a link, once and with a above b. Rows
    of one set_key link as copies; a text that is null or without words has none. Two sets that share
    many prefix shingles meet on the first and seldom again, as an entry carries the few before it.
    """
    rows, sets, entries, links = _prepared(documents, words, percent)
    wide = _wide(entries, sets)
    x, y = wide.alias("x"), wide.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.set_key") > F.col("y.set_key")) & _met("x", "y", percent))
    linked = links(met.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b")).distinct()).where("linked").select("a", "b")
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "set_key"), linked


def count_links(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of `documents`.

    `n_links` is the number of other rows that the row links with, copies included; the other columns
    are those of `link_components`.
    """
    rows, linked = find_links(documents, words, percent)
    sets = materialize(rows.where("set_key is not null").groupBy("set_key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id")))
    ends = linked.select(F.col("a").alias("from"), F.col("b").alias("set_key")).union(linked.select("b", "a"))
    others = ends.join(sets, "set_key").groupBy(F.col("from").alias("set_key")).agg(F.sum("copies").alias("others"))
    labels = components(linked).withColumnRenamed("node", "set_key")
    named = sets.join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key")).join(others, "set_key", "left")
    named = materialize(named)
    names = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(names, "label").select("set_key", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_links(table(spark, sf_dir, "documents"))


def op8_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))


TWIN = r"""
with recursive words as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) w from documents),
shingles as (
    select distinct doc_id, array_to_string(w[i:i + 3], ' ') s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from words where len(w) > 0)),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
sets as (select doc_id, n, s from shingles join sizes using (doc_id)),
common as (select a.doc_id a, b.doc_id b, any_value(a.n) n, any_value(b.n) m, count(*) k from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from common where 100 * k >= 85 * (n + m - k)),
both_ as (select a, b from links union all select b, a from links),
reach as (select a, b from both_ union select r.a, e.b from reach r join both_ e on r.b = e.a),
least_ as (select a doc_id, min(b) b from reach group by a)
select w.doc_id, coalesce(z.n, 0)::bigint n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) component_id, coalesce(c.n, 0)::bigint n_links
from words w left join sizes z using (doc_id) left join least_ l using (doc_id) left join (select a doc_id, count(*) n from both_ group by a) c using (doc_id)
"""

#: Without the links' number.
TWIN_COMPONENTS = f"select doc_id, n_shingles, component_id from ({TWIN})"
