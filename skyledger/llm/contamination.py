"""Benchmark passages in documents, found with Wu-Manber's multi-pattern search over words.

The strings searched for are word windows of the benchmark items. A window's letters are its words and
a block is two of them: the shift table tells from the block under the window's end how many words
can be skipped; where it says none, the bucket of that suffix names the strings to compare directly.
Strings of one length share tables, so that short items don't shorten the skips of the others.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm.common import extended, ship, slices, table, with_columns
from skyledger.tuning import materialize

WINDOW = 13
BLOCK = 2
ITEM_BYTES = 32 << 20  # of benchmark text searched for at once
#: A-Z as lower case; ASCII letters, digits and all bytes of other characters make words.
_WORDS = bytes((b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WuManber:
    """Search for word strings of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set]):
        self.length = len(next(iter(patterns)))
        self.block = min(BLOCK, self.length)
        self.longest = self.length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[list[bytes], set]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, self.length + 1):
                key = b" ".join(pattern[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.longest), self.length - end)
            self.bucket.setdefault(b" ".join(pattern[self.length - self.block :]), []).append((list(pattern), items))

    def find(self, words: list[bytes]):
        """(end, items) of every occurrence, in order."""
        shift, longest, length, two = self.shift.get, self.longest, self.length, self.block == 2
        end, n = length, len(words)
        while end <= n:
            key = words[end - 2] + b" " + words[end - 1] if two else words[end - 1]
            skip = shift(key, longest)
            if skip:
                end += skip
                continue
            own = words[end - length : end]
            for pattern, items in self.bucket[key]:
                if pattern == own:
                    yield end, items
            end += 1


def searchers(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> list[WuManber]:
    """One for each length of string among the items' windows; an item shorter than a window is one string."""
    by_length: dict[int, dict[tuple[bytes, ...], set]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set()).add(item)
    return [WuManber(patterns) for _, patterns in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`documents` with `n_words`, `hit_spans` (word numbers from and to, exclusive) and `hit_items`.

    Spans of overlapping or touching occurrences are one. A null or wordless text has no words and no
    hits; items without words are not searched for; an item with a null id hits but isn't listed;
    repeated items count once and repeated documents each. Earlier columns of the three names are
    replaced, other columns stay. The benchmark is searched for in blocks of ITEM_BYTES of text, one
    broadcast each; with more than one block the documents are stored between them.
    """
    ship(documents.sparkSession)
    documents = documents.drop("n_words", "hit_spans", "hit_items")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    blocks = math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / ITEM_BYTES) or 1
    found = "n_words long, hit_spans array<struct<from: int, to: int>>, hit_items array<string>"
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).distinct()
        sent = documents.sparkSession.sparkContext.broadcast([(r.item, bytes(r.text)) for r in own.collect()])
        first = k == 0
        names = documents.columns if first else documents.columns[:-3]
        schema = extended(documents.select(*names), found)
        documents = documents.mapInArrow(_searching(sent, window, first), schema)
        if k + 1 < blocks:
            documents = materialize(documents)
    return documents


def _searching(sent, window: int, first: bool):
    def search(batches):
        own = searchers(sent.value, window)
        for part, texts in slices(batches, binary=True):
            old = None if first else part.select(part.schema.names[-3:]).to_pylist()
            sizes, spans, items = [], [], []
            for k, text in enumerate(texts):
                words = words_of(text)
                at, ids = [], set()
                for searcher in own:
                    for end, found in searcher.find(words):
                        at.append((end - searcher.length, end))
                        ids |= found
                if old:
                    at += [(s["from"], s["to"]) for s in old[k]["hit_spans"]]
                    ids.update(old[k]["hit_items"])
                sizes.append(len(words))
                spans.append([{"from": a, "to": b} for a, b in merged(at)])
                items.append(sorted(i for i in ids if i is not None))
            kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            rest = part if first else part.select(part.schema.names[:-3])
            yield with_columns(rest, {"n_words": pa.array(sizes, pa.int64()), "hit_spans": pa.array(spans, kind), "hit_items": pa.array(items, pa.list_(pa.string()))})

    return search


def n_hit():
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


def contaminated():
    """A twentieth of the document's words or more lie in benchmark windows."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def op6_wu_manber_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


TWIN = r"""
with words as (
    select 'd' side, doc_id::varchar id, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
    union all
    select 'b', item_id::varchar, null, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
items as (select id, w, least(13, len(w)) n from words where side = 'b' and len(w) > 0),
windows as (select distinct id, n, array_to_string(w[i:i + n - 1], ' ') k from (select id, w, n, unnest(range(1, len(w) - n + 2)) i from items)),
sizes as (select distinct n from windows),
docs as (select doc_id, coalesce(w, []) w from words where side = 'd'),
places as (select doc_id, s.n, i, array_to_string(w[i:i + s.n - 1], ' ') k from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from docs, sizes where len(w) >= n) s),
found as (select p.doc_id, p.i, p.n, v.id from places p join windows v on v.n = p.n and v.k = p.k),
hit as (select doc_id, count(distinct x) n_hit, count(distinct id) n_items, list(distinct id) ids from (select doc_id, id, unnest(range(i, i + n)) x from found) group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(h.n_hit, 0)::bigint n_hit, coalesce(h.n_items, 0)::bigint n_items,
       sha256(coalesce(array_to_string(list_sort(h.ids), ','), '')) items_sha256, coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) contaminated
from docs d left join hit h on h.doc_id = d.doc_id
"""
