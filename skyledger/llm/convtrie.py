"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct beginning of a conversation; it is named by 128 bits, the exclusive or of hashes
of its (place, turn) pairs, so names come from one running scan. Totals of all subtrees come from
rounds of joins by messages: leaves are raked into their parents, and of each chain of nodes with one
child those with the least draw among their neighbours are spliced out; afterwards the spliced nodes
are put back, the last ones first, each from its child's total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType, IntegerType

from skyledger.llm.common import ship, table
from skyledger.tuning import materialize

FORK = 20  # a conversation begins like the one whose id is the next lower multiple of this
CHUNK_CHARS = 1 << 16


# --- running scans over keys of any size ---------------------------------------------------------


def running(rows: DataFrame, key: str, order: list[Column], xor: list[str] = (), sums: list[str] = ()) -> DataFrame:
    """`rows`, with the long columns `xor` and `sums` scanned up to and with each row, by `key` in `order`.

    Rows are dealt by range, so a key of any size spreads over tasks. A task scans what it holds; the few
    keys that go on in another task, two per boundary at most, get what stood before by a broadcast.
    """
    dealt = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    scans = [(c, np.bitwise_xor) for c in xor] + [(c, np.add) for c in sums]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, [0] * len(scans)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            columns = dict(zip(batch.schema.names, batch.columns))
            for i, (name, op) in enumerate(scans):
                own = columns[name].to_numpy(zero_copy_only=False).astype(np.int64)
                whole = op.accumulate(own)
                before = np.where(starts > 0, whole[starts - 1], 0)
                if last == keys[0]:
                    before[0] = held[i] if op is np.bitwise_xor else -held[i]
                out = whole ^ before[run] if op is np.bitwise_xor else whole - before[run]
                columns[name], held[i] = pa.array(out), int(out[-1])
                columns[f"_own_{name}"] = pa.array(own)
            last = keys[-1]
            columns["_part"] = pa.array(np.full(n, part, np.int32))
            yield pa.RecordBatch.from_pydict(columns)

    own = [StructField(f"_own_{c}", dealt.schema[c].dataType) for c, _ in scans]
    schema = StructType([*dealt.schema.fields, *own, StructField("_part", IntegerType())])
    local = materialize(dealt.mapInArrow(scan, schema))
    spans = local.groupBy(key).agg(F.min("_part").alias("_lo"), F.max("_part").alias("_hi")).where("_lo < _hi")
    pieces = local.join(F.broadcast(spans.select(key)), key).groupBy(key, "_part")
    total = [F.bit_xor(f"_own_{c}").alias(f"_in_{c}") for c in xor] + [F.sum(f"_own_{c}").alias(f"_in_{c}") for c in sums]
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.bit_xor(f"_in_{c}").over(earlier).alias(f"_in_{c}") for c in xor]
    carried += [F.sum(f"_in_{c}").over(earlier).alias(f"_in_{c}") for c in sums]
    carry = pieces.agg(*total).select(key, "_part", *carried)
    joined = local.join(F.broadcast(carry), [key, "_part"], "left")
    scanned = {c: F.col(c).bitwiseXOR(F.coalesce(f"_in_{c}", F.lit(0))) for c in xor}
    scanned |= {c: F.col(c) + F.coalesce(f"_in_{c}", F.lit(0)) for c in sums}
    return joined.withColumns(scanned).select(rows.columns)


# --- turns ---------------------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation from 0 on, in the order of `turn`.

    A null `turn` comes first; turns of one number come in the order of their digest, 16 bytes of the
    SHA-256 of role and text. A null role or text counts as empty. Rows without a conv_id take no part,
    other columns aren't looked at.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.substring(F.unhex(F.sha2(turn, 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.lit(1).cast("long").alias("pos"),
    )
    ranked = running(rows, "conv_id", [F.asc_nulls_first("turn"), F.col("digest")], sums=["pos"])
    return ranked.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "words")


def forked(turns: DataFrame, every: int = FORK) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) rebuilt: each begins with turns of the conversation `conv_id - conv_id % every`.

    Its first h turns, h = crc32(conv_id) % 4, are replaced by the other's first h (all, if fewer; none,
    if there is no such conversation). A conversation may be left without turns.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("from"))
    bases = sizes.select(F.col("conv_id").alias("from"), F.col("n").alias("base_n"))
    own = own.join(bases, "from", "left")
    convs = materialize(own.select("conv_id", "from", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("hb")))
    heads = convs.where("hb > 0").select("conv_id", "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("hb") - 1)).alias("pos"))
    starts = turns.where("pos < 3").select(F.col("conv_id").alias("from"), "pos", "digest", "words")
    first = heads.join(starts, ["from", "pos"]).select("conv_id", "pos", "digest", "words")
    rest = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("hb")).alias("pos"), "digest", "words")
    return convs.select("conv_id"), first.unionByName(rest)


# --- trie ----------------------------------------------------------------------------------------


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct beginning of a conversation, the empty one included.

    `convs` has each conv_id once, also those without turns; `turns` has (conv_id, pos, digest, words)
    with places from 0 on without gaps. conv_id of a node is its smallest member, n_convs their number;
    n_leaves and saved_tokens are over its subtree, itself included; saved_tokens sums (n_convs - 1) *
    words of a node's last turn; ends_sha256 is over the conversations that end there. No conversation,
    no node. Beginnings are told apart by 128 bits of hashes.
    """
    ship(convs.sparkSession)
    place = {c: F.xxhash64(F.lit(seed), "pos", "digest") for c, seed in (("a", 11), ("b", 12))}
    lone = turns.withColumns(place | {"own_a": place["a"], "own_b": place["b"]}).drop("digest")
    named = running(lone, "conv_id", [F.col("pos")], xor=["a", "b"])
    sizes = named.groupBy("conv_id").agg(F.count("*").alias("n"))
    sizes = materialize(convs.join(sizes, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n")))
    zero = F.lit(0).cast("long")
    top = sizes.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), zero.alias("words"))
    up = [F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"up_{c}") for c in ("a", "b")]
    beginnings = materialize(top.unionByName(named.select("conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", *up, "words")))
    members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    same = [F.max(c).alias(c) for c in ("depth", "up_a", "up_b", "words")]
    nodes = materialize(beginnings.groupBy("a", "b").agg(*members, *same).withColumn("node", F.monotonically_increasing_id()))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    tree = materialize(nodes.join(parents, ["up_a", "up_b"], "left").select("node", "parent", "parent_conv_id", "conv_id", "depth", "n_convs", "a", "b", saved))
    totals = subtree_totals(tree.select("node", "parent", "saved_tokens"), ["saved_tokens"])
    ends = beginnings.join(sizes.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"])
    hashed = hashed_members(ends.select("a", "b", "conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (
        tree.drop("saved_tokens").join(totals, "node").join(hashed, ["a", "b"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    )


def hashed_members(members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of (a, b, conv_id): the ids of each (a, b), ascending and comma-joined, hashed.

    Ids are joined in tasks that hold a range of them; one task then hashes the joined pieces of a group
    as a stream, so a large group is a few long rows and never a list.
    """

    def join(batches):
        name, ids, chars, out = None, [], 0, []
        for batch in batches:
            for a, b, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and ((a, b) != name or chars > CHUNK_CHARS):
                    out.append((*name, ids[0], ",".join(map(str, ids))))
                    ids, chars = [], 0
                name = a, b
                ids.append(conv)
                chars += 20
            yield pieces(out)
            out = []
        if ids:
            yield pieces([(*name, ids[0], ",".join(map(str, ids)))])

    def pieces(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["a", "b", "first", "ids"])

    def digest(batches):
        name, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (a, b) != name:
                    if state:
                        out.append((*name, state.hexdigest()))
                    name, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield results(out)
        if state:
            yield results([(*name, state.hexdigest())])

    def results(rows):
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "ends_sha256"])

    ranged = members.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = ranged.mapInArrow(join, "a long, b long, first long, ids string")
    grouped = joined.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return grouped.mapInArrow(digest, "a long, b long, ends_sha256 string")


# --- tree contraction ----------------------------------------------------------------------------


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, n_children, n_leaves, values...) of a forest (node, parent, values...), totals over subtrees.

    `node` is a unique long, `parent` a node or null at a root; values are longs. A childless node is one
    leaf. Each round rakes all leaves and splices out about a third of the nodes with one child, so
    rounds grow with the logarithm of the nodes, not with the depth; a round's messages to one parent are
    added up before they are shuffled. Rounds are written to the shared folder.
    """
    sums = ["n_leaves", *values]
    state = materialize(_with_children(tree, values))
    children = state.select("node", F.col("kids").alias("n_children"))
    live, rounds = state, []
    while True:
        done = materialize(_contracted(live, sums, len(rounds)))
        counts = {r.fate: r.n for r in done.where("parent is not null").groupBy("fate").agg(F.count("*").alias("n")).collect()}
        rounds.append((done, counts.get("spliced", 0)))
        if not counts.get("live") and not counts.get("spliced"):
            break
        live = _spliced(done, sums)
    known = rounds[-1][0].where("fate != 'spliced'").select("node", *sums)
    for done, spliced in rounds[-2::-1]:
        raked = done.where("fate = 'raked'").select("node", *sums)
        if spliced:
            below = known.select(F.col("node").alias("only"), *[F.col(c).alias(f"below_{c}") for c in sums])
            back = done.where("fate = 'spliced'").join(below, "only")
            known = known.unionByName(materialize(back.select("node", *[(F.col(c) + F.col(f"below_{c}")).alias(c) for c in sums])))
        known = known.unionByName(raked)
    return children.join(known, "node")


def _messages(rows: DataFrame, *messages: Column) -> DataFrame:
    """The non-null messages of all rows, as rows."""
    return rows.select(F.inline(F.filter(F.array(*messages), lambda m: m.isNotNull())))


def _with_children(tree: DataFrame, values: list[str]) -> DataFrame:
    """Adds the number of children, and one leaf to a node without any."""
    own = F.struct(F.col("node").alias("to"), "parent", *values, F.lit(0).cast("long").alias("kids"))
    nothing = [F.lit(0).cast("long").alias(c) for c in values]
    word = F.struct(F.col("parent").alias("to"), F.lit(None).cast("long").alias("parent"), *nothing, F.lit(1).cast("long").alias("kids"))
    sent = _messages(tree, own, F.when(F.col("parent").isNotNull(), word))
    got = sent.groupBy(F.col("to").alias("node")).agg(F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in values], F.sum("kids").alias("kids"))
    return got.withColumn("n_leaves", (F.col("kids") == 0).cast("long"))


def _contracted(live: DataFrame, sums: list[str], number: int) -> DataFrame:
    """One round: `fate` is raked (a leaf, its sums are its totals), spliced (out of a chain) or live.

    `sums` of nodes with children get those of their raked leaves; `kids` counts the children left and
    `only` is the child where one is left.
    """
    none = F.lit(None).cast("long")
    leaf = F.col("kids") == 0
    own = F.struct(F.col("node").alias("to"), "parent", "kids", *sums, F.lit(0).cast("long").alias("left"), none.alias("only"))
    given = [F.when(leaf, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in sums]
    word = F.struct(F.col("parent").alias("to"), none.alias("parent"), none.alias("kids"), *given, F.when(leaf, 0).otherwise(1).cast("long").alias("left"), F.when(~leaf, F.col("node")).alias("only"))
    sent = _messages(live, own, F.when(F.col("parent").isNotNull(), word))
    got = sent.groupBy(F.col("to").alias("node")).agg(
        F.max("parent").alias("parent"), F.max("kids").alias("had"), *[F.sum(c).alias(c) for c in sums], F.sum("left").alias("kids"), F.max("only").alias("only")
    )
    draw = {c: F.xxhash64(F.lit(number), F.col(c)) for c in ("node", "parent", "only")}
    least = (F.col("kids") == 1) & F.col("parent").isNotNull() & (draw["node"] < draw["parent"]) & (draw["node"] < draw["only"])
    fate = F.when(F.col("had") == 0, "raked").when(least, "spliced").otherwise("live")
    return got.withColumn("fate", fate).select("node", "parent", "kids", *sums, "only", "fate")


def _spliced(done: DataFrame, sums: list[str]) -> DataFrame:
    """The live nodes; a spliced node's child is given to its parent, and so are its sums.

    Neighbours are never spliced in one round, as each has the least draw of its neighbours, so both
    stay live.
    """
    none, nothing = F.lit(None).cast("long"), [F.lit(0).cast("long").alias(c) for c in sums]
    out = F.col("fate") == "spliced"
    own = F.struct(F.col("node").alias("to"), "parent", none.alias("moved"), "kids", *sums)
    child = F.struct(F.col("only").alias("to"), none.alias("parent"), F.col("parent").alias("moved"), none.alias("kids"), *nothing)
    above = F.struct(F.col("parent").alias("to"), none.alias("parent"), none.alias("moved"), none.alias("kids"), *sums)
    sent = _messages(done.where("fate != 'raked'"), F.when(~out, own), F.when(out, child), F.when(out, above))
    got = sent.groupBy(F.col("to").alias("node")).agg(
        F.coalesce(F.max("moved"), F.max("parent")).alias("parent"), F.max("kids").alias("kids"), *[F.sum(c).alias(c) for c in sums]
    )
    return got.select("node", "parent", "kids", *sums)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(numbered_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(*forked(turns))


TWIN = r"""
with turns as (
    select conv_id, coalesce(role, '') r, coalesce(text, '') t,
           row_number() over (partition by conv_id order by turn nulls first, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 pos
    from conversations where conv_id is not null),
ids as (
    select conv_id, conv_id - conv_id % 20 base,
           xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
               lambda c, x: list_reduce(list_concat([xor(c, x)], list_transform(range(8), lambda i: 0::bigint)), lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 4 h
    from (select distinct conv_id from turns)),
sizes as (select conv_id, count(*) n from turns group by conv_id),
rebuilt as (
    select i.conv_id, t.pos, t.r, t.t from ids i join turns t on t.conv_id = i.base and t.pos < i.h
    union all
    select i.conv_id, t.pos - i.h + least(i.h, coalesce(s.n, 0)), t.r, t.t
    from ids i join turns t on t.conv_id = i.conv_id and t.pos >= i.h left join sizes s on s.conv_id = i.base),
seqs as (
    select i.conv_id, coalesce(s, []) s
    from ids i left join (select conv_id, list({'r': r, 't': t} order by pos) s from rebuilt group by conv_id) using (conv_id)),
starts as (select conv_id, d, s[1:d] p, d = len(s) over_ from (select conv_id, s, unnest(range(0, len(s) + 1)) d from seqs)),
nodes as (
    select p, min(conv_id) conv_id, any_value(d) depth, count(*) n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (over_), '')) ends_sha256
    from starts group by p),
kids as (select p[1:depth - 1] p, count(*) n_children from nodes where depth > 0 group by 1),
full_ as (
    select n.*, coalesce(k.n_children, 0) n_children, u.conv_id parent_conv_id,
           case when n.depth = 0 then 0 else (n.n_convs - 1) * len(regexp_extract_all(n.p[n.depth].t, '[^\x20\x09-\x0D]+')) end saved
    from nodes n left join kids k on k.p = n.p left join nodes u on n.depth > 0 and u.p = n.p[1:n.depth - 1]),
sums as (
    select s.p, sum((f.n_children = 0)::int) n_leaves, sum(f.saved) saved_tokens
    from full_ f join starts s on s.conv_id = f.conv_id and s.d <= f.depth group by s.p)
select f.conv_id, f.depth::bigint depth, f.parent_conv_id, f.n_convs, f.n_children::bigint n_children, s.n_leaves::bigint n_leaves,
       s.saved_tokens::bigint saved_tokens, f.ends_sha256
from full_ f join sums s using (p)
"""
