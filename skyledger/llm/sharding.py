"""Rows dealt to shards by a hierarchical weighted hash tree, in built-in column functions only.

A tree has regions, racks and shards. At each level every child makes a draw from the row's key and
its own name, scaled by its weight, and the smallest wins: the child's share is its part of the
weight, and a change of one child's weight moves rows only to or from that child's subtree. A new
shard in a region of its own therefore takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.llm.common import table
from skyledger.tuning import materialize

SHARDS = 40
RACKS_PER_REGION, SHARDS_PER_RACK = 2, 4
ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def even_tree(shards: int, racks: int = RACKS_PER_REGION, per_rack: int = SHARDS_PER_RACK) -> list[Shard]:
    return [Shard(i, f"r{i // (racks * per_rack)}", f"k{i // per_rack}") for i in range(shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """`tree` and one more shard, in a region of its own so that no other shard takes rows."""
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(number, f"own{number}", f"own{number}", weight)]


def _drawn(key: Column, level: str, children: dict[str, float]) -> Column:
    """The name of the child with the least draw, an exponential variate over its weight."""
    draws = []
    for name, weight in children.items():
        bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit(f"|{level}|{name}"))), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        draws.append(F.struct((-F.log(u) / weight).alias("draw"), F.lit(name).alias("name")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["name"]


def _weights(shards: list[Shard], level: str) -> dict[str, float]:
    found: dict[str, float] = {}
    for s in shards:
        name = str(getattr(s, level))
        found[name] = found.get(name, 0.0) + s.weight
    return found


def with_shard(rows: DataFrame, key: Column, tree: list[Shard], name: str) -> DataFrame:
    """`rows` and an int column: the shard of `key` in the tree. A null key counts as empty.

    Shards of weight 0 or less take nothing; an empty tree is an error.
    """
    tree = [s for s in tree if s.weight > 0]
    if not tree:
        raise ValueError("no shard has a weight")
    region, rack = f"_{name}_region", f"_{name}_rack"
    text = F.coalesce(key.cast("string"), F.lit(""))

    def descend(above: str, level: str, groups: dict[str, list[Shard]]) -> Column:
        choice = F.lit(None)
        for parent, own in groups.items():
            choice = F.when(F.col(above) == parent, _drawn(text, level, _weights(own, level))).otherwise(choice)
        return choice

    by_region: dict[str, list[Shard]] = {}
    by_rack: dict[str, list[Shard]] = {}
    for s in tree:
        by_region.setdefault(s.region, []).append(s)
        by_rack.setdefault(s.rack, []).append(s)
    rows = rows.withColumn(region, _drawn(text, "region", _weights(tree, "region")))
    rows = rows.withColumn(rack, descend(region, "rack", by_region))
    rows = rows.withColumn(name, descend(rack, "number", by_rack).cast("int"))
    return rows.drop(region, rack)


def with_slot(rows: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """`rows` and a long column that numbers each shard's rows from 0 in the given order.

    No task takes a whole shard: rows are ranged over (shard, order, place in the input), so a hot
    key is spread too, and each range numbers its own behind those of the ranges before it.
    Rows are written once, and the numbers hold when tasks run again.
    """
    at, part, n, base = "_slot_at", "_slot_part", "_slot_n", "_slot_base"
    stored = materialize(rows.withColumn(at, F.monotonically_increasing_id()))
    ranged = materialize(stored.repartitionByRange(shard, *order, at).withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(shard, part).agg(F.count("*").alias(n))
    bases = counts.select(shard, part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    within = F.row_number().over(Window.partitionBy(shard, part).orderBy(*order, at)) - 1
    numbered = ranged.withColumn(n, within).join(bases, [shard, part])
    return numbered.select(*rows.columns, (F.col(base) + F.col(n)).cast("long").alias(name))


def assign_shards(documents: DataFrame, tree: list[Shard], larger: list[Shard] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) per row, by the tree's draws on doc_id.

    `size` is the text's UTF-8 bytes and ROW_BYTES; a null text has none. A null doc_id is a key of
    its own; rows of one doc_id share a shard and have slots of their own, in the order of size and
    checksum. Slots follow doc_id, nulls first. `grown_shard` is the shard in `larger`, or null.
    Other columns are left out; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select("doc_id", (F.length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = with_shard(rows, F.col("doc_id"), tree, "shard")
    if larger:
        rows = with_shard(rows, F.col("doc_id"), larger, "grown_shard")
    else:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return with_slot(rows, "shard", ["doc_id", "size", "text_crc32"])


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = even_tree(SHARDS)
    rows = assign_shards(table(spark, sf_dir, "documents"), tree, grown(tree))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
