"""Edit fingerprints (11), hard negatives (12) and the conversation trie (13)."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import convtrie as T, editprints as E, negatives as N, registry

SF = "/root/testdata/sf0.001"


def equal_to_twin(spark, name):
    df = registry.QUERIES[name](spark, SF)
    got = Counter(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin = con.execute(registry.TWINS[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == sorted(df.columns)
    assert got == Counter(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in twin.fetchall())


@pytest.mark.parametrize("name", ["op6_wu_manber_contamination", "op8_jaccard_components", "op8_jaccard_links", "op12_threshold_negatives", "op13_conversation_trie"])
def test_query_equals_its_twin(spark, name):
    equal_to_twin(spark, name)


# --- fingerprints ------------------------------------------------------------------------------


def walked(text):
    """One text's fingerprint, a step at a time."""
    shared, symbols, out = E.walks(), [*map(ord, text), E.END], ""
    for walk in range(E.WALKS):
        t, reached = 0, []
        for s in symbols:
            reached.append(t)
            t += int(shared.flat[(walk * 256 + s % 256) * E.PERIOD + t % E.PERIOD])
        for slot in range(E.SLOTS):
            step = max(int(p) for p in shared.places[walk * E.SLOTS + slot] if p < t)
            place = max(k for k, at in enumerate(reached) if at <= step)
            out += f"{int(shared.digits(walk, np.full(E.SLOTS, symbols[place]), np.full(E.SLOTS, step))[slot]):x}"
    return out


def check_edited(rows, docs):
    """Against plain Python; documents are given in their order."""
    assert len(rows) == len(docs)
    expected = []
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        own, new, behind = E.fingerprints([text, edited, after])
        near = [float(E.likeness([own], [x])[0]) for x in (new, behind)]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, *near))
    fields = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(tuple(r[f] for f in fields) for r in rows) == Counter(expected)


def test_fingerprints_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    rows = E.op11_edit_fingerprints(spark, SF).collect()
    check_edited(rows, sorted(map(tuple, docs), reverse=True))
    assert all(r.near_edited > r.near_next for r in rows if r.n_chars > 100 and r.near_next < 0.3)
    assert all(len(r.fingerprint) == E.WALKS * E.SLOTS for r in rows)


def test_fingerprints_of_odd_documents(spark):
    texts = [(9, "é𝄞" * 50, 1), (7, None, 2), (5, "", 3), (4, "a", 4), (3, "word " * 60_000, 5), (2, "ab" * 3, 6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, fingerprint int").withColumns({"edge": F.lit("x"), "part": F.lit(3)})
    check_edited(E.edited_with_next(docs).collect(), [(i, t or "") for i, t, _ in texts])
    assert E.edited_with_next(docs.limit(0)).collect() == []
    one = E.edited_with_next(docs.where("doc_id = 2")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"ababab"[:4] + b"ab").hexdigest()
    same = spark.createDataFrame([(1, "x y z")] * 3 + [(None, "x y z")] * 2 + [(None, None)], "doc_id long, text string")
    rows = E.edited_with_next(same).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "1", "None", "None", "None"]
    assert len({r.fingerprint for r in rows if r.n_chars}) == 1


def test_walks_one_by_one_and_together_agree():
    draw = random.Random(3)
    texts = ["", "a", "ab", "日本語テキスト" * 9, "x" * 5000] + ["".join(draw.choices("abcdef ", k=draw.randrange(1, 400))) for _ in range(60)]
    together = E.fingerprints(texts)
    assert together == [E.fingerprints([t])[0] for t in texts]
    assert together[:12] == [walked(t) for t in texts[:12]]
    assert E.likeness(together, together).tolist() == [1.0] * len(texts)
    assert E.fingerprints([]) == [] and len(set(together)) == len(set(texts))


def test_likeness_falls_with_edits():
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghijklmnop ", k=2000)) for _ in range(40)]
    means = []
    for edits in (1, 20, 200):
        changed = []
        for t in texts:
            t = list(t)
            for k in draw.sample(range(len(t)), edits):
                t[k] = draw.choice(["", "q", t[k] + "r"])
            changed.append("".join(t))
        means.append(E.likeness(E.fingerprints(texts), E.fingerprints(changed)).mean())
    assert means[0] > 0.9 > means[1] > 0.5 > means[2] > 0.1
    assert E.likeness(E.fingerprints(texts), E.fingerprints(texts[1:] + texts[:1])).max() < 0.3


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_classes_against_brute_force(spark):
    draw = random.Random(8)
    docs, origin = [], []
    for _ in range(6):
        base = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
        for _ in range(5):
            text = list(base)
            for k in draw.sample(range(300), 3):
                text[k] = "#"
            docs.append((len(docs), "".join(text)))
    docs += [(100, docs[3][1]), (101, None), (102, ""), (103, "short"), (None, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("name", F.lit(1))
    got = {r.doc_id: r.class_id for r in E.near_classes(frame).collect()}
    known = [(i, t or "") for i, t in docs if i is not None]
    label = {i: i for i, _ in known}
    for i, a in known:
        for j, b in known:
            if i < j and edit_distance(a, b) <= math.floor(0.2 * max(len(a), len(b))):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    assert got == label
    assert E.near_classes(frame.limit(0)).collect() == []


# --- hard negatives ----------------------------------------------------------------------------


def mined(rows, anchors):
    """Every product in plain Python."""

    def clean(x):
        return [
            (i, label, [math.floor(256 * float(c)) for c in v])
            for i, label, v in x
            if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
        ]

    out = []
    for a, label, v in clean(anchors):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in clean(rows) if i != a or m != label)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][: N.POSITIVES]:
            fit = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][: N.NEGATIVES]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(fit, 1)]
    return Counter(out)


FIELDS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def found(df):
    return Counter(tuple(r[f] for f in FIELDS) for r in df.collect())


def test_negatives_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 1, [0.9, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [0.7, 0.4]), (4, 2, [0.7, 0.4]), (5, 2, [0.6, 0.2]),
        (6, 3, [-1.0, 0.0]), (7, None, [1.0, 1.0]), (8, 1, None), (9, 1, [nan, 0.0]), (10, 2, [inf, 0.0]), (None, 1, [1.0, 0.5]), (11, 2, []),
        (12, 1, [0.0, 0.0]), (13, 2, [0.5]), (14, 1, [0.001, 0.0]), (50, 3, [0.3, 0.3, 7.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"key": F.lit(1), "n": F.lit(2), "turn": F.lit("a")})
    asked = frame.where("vec_id in (0, 6, 12, 14, 50)")
    got = found(N.hard_negatives(frame, asked))
    assert got == mined(rows, [r for r in rows if r[0] in (0, 6, 12, 14, 50)]) and got
    assert N.hard_negatives(frame.limit(0), asked).collect() == [] and N.hard_negatives(frame, asked.limit(0)).collect() == []


def test_negatives_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ANCHORS", 7)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(5, 6))
    rows = [(i, int(i % 3), (centres[i % 5] + draw.normal(size=6) * 0.3).tolist()) for i in range(700)]
    rows += [(1000 + i, int(i % 2), [0.5] * 6) for i in range(200)]  # one vector many times
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    asked = [r for r in rows if r[0] % 40 == 0]
    got = found(N.hard_negatives(frame, frame.where("vec_id % 40 = 0"), shard_rows=64))
    assert got == mined(rows, asked) and len(got) > 50


def test_large_components_are_exact(spark):
    big = float(1 << 22)
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 1, [big, 2.0]), (3, 2, [big * 0.9, 5.0]), (4, 2, [big * 0.9, 6.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert found(N.hard_negatives(frame, frame.where("vec_id = 0"))) == mined(rows, rows[:1])


def test_threshold_leaves_rows_unread():
    draw = np.random.default_rng(2)
    rows = np.floor(256 * draw.normal(size=(4000, 3)))
    rows[:20] *= 30
    lists = np.argsort(rows, axis=0, kind="stable").T
    shard = N.Shard(rows, np.arange(4000), np.zeros(4000), lists)
    for anchor in (rows[5], rows[3000], -rows[7]):
        window = N.Window(-np.inf, np.inf, 5)
        scored = shard.search(anchor, [window], np.ones(4000, bool))
        scores = rows @ anchor
        best = np.lexsort((np.arange(4000), -scores))[:5]
        assert [(-s, i) for s, i in window.best] == [(int(scores[i]), int(i)) for i in best]
        assert scored < 2000
    high = N.Window(1e12, 2e12, 3)  # above all scores: closed by the first threshold
    assert shard.search(rows[5], [high], np.ones(4000, bool)) <= 3 * N.FIRST_DEPTH and not high.best


# --- conversation trie -------------------------------------------------------------------------


def trie(rows):
    """The contract in plain Python."""

    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(who) - 1) * words
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if rebuilt[c] == p)
        parent = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), parent, len(who), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def grown(df):
    fields = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return Counter(tuple(r[f] for f in fields) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_of_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_CHARS", 60)
    draw = random.Random(9)
    rows = [(c, t, draw.choice("ua"), draw.choice(["hi there", "", "a\tb c", "ok"])) for c in range(60) for t in range(c % 5)]
    rows += [(c, t, "u", f"same {t}") for c in range(200, 300) for t in range(6)]  # one conversation many times
    rows += [(500, t, "u", f"turn {t % 7}") for t in range(150)]  # a long one
    rows += [(61, None, None, None), (61, None, "u", "first"), (61, 0, "u", None), (61, 0, "u", None), (61, 0, "a", "tie")]
    rows += [(-3, 1, "u", "below"), (-40, 0, "u", "even"), (19, 5, "u", "only"), (None, 0, "u", "nobody"), (7777, 0, "u", "x")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(1), "pos": F.lit("p"), "a": F.lit(0)}).repartition(4)
    got = grown(T.prefix_trie(*T.forked(T.numbered_turns(frame))))
    assert got == trie(rows)
    assert T.prefix_trie(*T.forked(T.numbered_turns(frame.limit(0)))).collect() == []


def test_conversations_without_turns_meet_at_the_root(spark):
    convs = spark.createDataFrame([(1,), (2,)], "conv_id long")
    turns = spark.createDataFrame([], "conv_id long, pos long, digest binary, words long")
    row = T.prefix_trie(convs, turns).collect()
    assert [tuple(r)[:7] for r in row] == [(1, 0, None, 2, 0, 1, 0)] and row[0].ends_sha256 == hashlib.sha256(b"1,2").hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "mixed"])
def test_contraction_against_recursion(spark, shape):
    draw = random.Random(7)
    parent = {0: None}
    for i in range(1, 120):
        parent[i] = {"chain": i - 1, "star": 0, "mixed": draw.randrange(max(0, i - 3), i)}[shape]
    parent[500], parent[501] = None, 500  # a second tree
    value = {i: draw.randrange(100) for i in parent}
    total, leaves = Counter(), Counter()
    for i in parent:
        at = i
        while at is not None:
            total[at] += value[i]
            leaves[at] += i not in parent.values()
            at = parent[at]
    kids = Counter(parent.values())
    frame = spark.createDataFrame([(i, p, value[i]) for i, p in parent.items()], "node long, parent long, weight long")
    rows = T.subtree_totals(frame, ["weight"]).collect()
    assert {r.node: (r.n_children, r.n_leaves, r.weight) for r in rows} == {i: (kids[i], leaves[i], total[i]) for i in parent}
    assert len(rows) == len(parent)


def test_running_scans_over_boundaries(spark):
    draw = random.Random(1)
    rows = [(0 if draw.random() < 0.7 else draw.randrange(5), i, draw.randrange(1 << 40), 1) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id long, at long, x long, n long").repartition(5)
    got = {(r.id, r.at): (r.x, r.n) for r in T.running(frame, "id", [F.col("at")], xor=["x"], sums=["n"]).collect()}
    state = defaultdict(lambda: (0, 0))
    for i, at, x, n in sorted(rows):
        state[i] = state[i][0] ^ x, state[i][1] + n
        assert got[i, at] == state[i]
    assert len(got) == len(rows)
