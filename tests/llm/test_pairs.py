"""Operators over many rows at once: Jaccard join (8), archives (2), top products (7)."""

import base64
import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import components as G, jaccard as J, topk as K, warc as W
from skyledger.tuning import materialize, scratch_folder

SF = "/root/testdata/sf0.001"


# --- Jaccard -----------------------------------------------------------------------------------


def test_words_made_against_powers_get_two_hashes():
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    hashes, ends = J.word_hashes([word.encode(), other.encode(), b"", b" x\tY  yx\n", b"xy X y", ("q" * 5_000_000).encode()])
    assert ends == [1, 2, 2, 5, 8, 9] and hashes[2] == hashes[6] and hashes[3] == hashes[7]
    assert len(set(hashes.tolist())) == 7


def plain_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(*(words[k:] for k in range(4)))) if len(words) >= 4 else {tuple(words)} if words else set()


def plain_components(docs):
    sets = [plain_sets(t) for _, t in docs]
    at = list(range(len(docs)))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        shared = Counter(o for g in s for o in holders.get(g, ()))
        for o, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[o]) - n):
                at[root(k)] = root(o)
        for g in s:
            holders.setdefault(g, []).append(k)
    names = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            names[root(k)] = min(doc, names.get(root(k), doc))
    return sorted(((doc, len(sets[k]), names.get(root(k))) for k, (doc, _) in enumerate(docs)), key=str)


def test_components_of_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in J.op8_jaccard_components(spark, SF).collect()), key=str)
    assert got == plain_components(docs)
    assert len({r[2] for r in got}) < len(got)


def near_copies(rng, vocabulary, words, copies, changed):
    base = rng.choice(vocabulary, words)
    for _ in range(copies):
        own = base.copy()
        own[rng.choice(words, changed, replace=False)] = rng.choice(vocabulary, changed)
        yield " ".join(own)


def test_components_of_groups_chains_and_odd_documents(spark):
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    texts = []
    for words, copies, changed in ((200, 40, 2), (120, 30, 4), (60, 30, 2), (400, 20, 9), (30, 10, 1)):
        texts += near_copies(rng, vocabulary, words, copies, changed)
    chain = rng.choice(vocabulary, 300)
    for k in range(25):  # each is near the next, the ends are far apart
        texts.append(" ".join(chain[k * 5 : k * 5 + 150]))
    passage = " ".join(rng.choice(vocabulary, 60))
    texts += [passage + " " + " ".join(rng.choice(vocabulary, n)) for n in rng.integers(5, 80, 40)]
    texts += ["", None, "   ", "one", "ONE\t", "a b c", "a  B\nc", "a b c d", "a\xa0b c d", "a b c d", "Ä b c d", "ä b c d", "x " * 40_000]
    texts += texts[:15]
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)] + [(3, texts[0]), (None, texts[50]), (None, "alone here it is"), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "'x' as set_key")
    got = sorted((tuple(r) for r in J.link_components(frame).collect()), key=str)
    assert got == plain_components(docs)
    assert J.link_components(frame.limit(0)).collect() == []


def test_hashes_are_dealt_once_and_not_stored(spark, monkeypatch):
    rng, stored = np.random.default_rng(4), []
    texts = [*near_copies(rng, np.array([f"w{i}" for i in range(900)]), 100, 12, 2)]
    docs = [(i, t) for i, t in enumerate(texts + texts[:3])]

    def watched(df, *partition_by):
        stored.append(df.columns)
        return materialize(df, *partition_by)

    monkeypatch.setattr(J, "materialize", watched)
    got = J.link_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_components(docs)
    assert stored and not any("hashes" in columns for columns in stored)


def plain_links(docs):
    """The number of each row's links, and the number of linked pairs of different sets."""
    sets = [plain_sets(t) for _, t in docs]
    near = lambda x, y: bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)
    counts = [sum(near(x, y) for k, y in enumerate(sets) if k != i) for i, x in enumerate(sets)]
    different = list(set(map(frozenset, sets)))
    return counts, sum(near(x, y) for i, x in enumerate(different) for y in different[:i])


def test_all_links_of_groups_and_chains(spark):
    rng = np.random.default_rng(6)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    texts = [*near_copies(rng, vocabulary, 200, 30, 1), *near_copies(rng, vocabulary, 60, 20, 1), *near_copies(rng, vocabulary, 120, 15, 4)]
    chain = rng.choice(vocabulary, 300)
    texts += [" ".join(chain[k * 5 : k * 5 + 150]) for k in range(25)]
    texts += [None, "", "one", "ONE", "a b c d", "A b c d"] + texts[:12] + texts[60:70]
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, texts[40]), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("set_key", F.lit("x"))
    counts, pairs = plain_links(docs)
    links = [(r.a, r.b) for r in J.find_links(frame)[1].collect()]
    assert len(links) == len(set(links)) == pairs > 200 and all(a > b for a, b in links)
    got = sorted((tuple(r) for r in J.count_links(frame).collect()), key=str)
    assert sorted((r[:3] for r in got), key=str) == plain_components(docs)
    assert sorted(map(str, ((d, n) for d, _, _, n in got))) == sorted(map(str, ((d, n) for (d, _), n in zip(docs, counts))))
    assert J.count_links(frame.limit(0)).collect() == []


def test_links_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = J.op8_jaccard_links(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(docs)
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted((d, n) for (d, _), n in zip(docs, plain_links(docs)[0]))


def test_filters_lose_no_link():
    """Whatever the order, a pair at the threshold shares a prefix shingle that passes the place filter."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, m = rng.integers(1, 60, 2)
        pool = rng.permutation(200)
        common = rng.integers(0, min(n, m) + 1)
        x, y = set(pool[:n]), set(pool[:common]) | set(pool[100 : 100 + m - common])
        i = len(x & y)
        if 100 * i < 85 * len(x | y):
            continue
        rank = {v: r for r, v in enumerate(rng.permutation(200))}
        a, b = sorted(x, key=rank.get), sorted(y, key=rank.get)
        take = lambda s: s[: len(s) - (85 * len(s) + 99) // 100 + 1]
        need = -(-85 * (len(a) + len(b)) // 185)
        assert any(1 + min(len(a) - a.index(t) - 1, len(b) - b.index(t) - 1) >= need for t in set(take(a)) & set(take(b)))


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    edges = [(k, k + 1) for k in range(40)] + [(1000, int(k)) for k in rng.integers(500, 900, 60)] + [(7, 7), (None, 3), (2000, 2001), (2001, 2000), (2000, 2001)]
    got = {r.node: r.label for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[2000] == got[2001] == 2000
    assert len({got[k] for _, k in edges[40:100]} | {got[1000]}) == 1 and 7777 not in got
    assert G.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- archives ----------------------------------------------------------------------------------


def test_archives_equal_their_twin(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    twin = con.execute(W.TWIN)
    names = [d[0] for d in twin.description]
    got = W.op2_warc_boundary_chain(spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(twin.fetchall())


def pages_of(spark, htmls):
    rows = [(k, f"http://x/{k}", h, "z", 0) for k, h in htmls]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string, size int")


def plain_pages(htmls, least=0):
    data = [(k, (h or "").encode()) for k, h in htmls]
    for k, own in data:
        same = [i for i, o in data if o == own and i is not None]
        first = min(same, default=None)
        revisit = len(own) >= least and first is not None and k != first
        digest = base64.b32encode(hashlib.sha1(own).digest()).decode()
        yield k, len(own), digest, "revisit" if revisit else "response", first if revisit else None, None if revisit else own


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
HTMLS = [
    (1, "<p>one</p>"), (2, FAKE), (3, None), (4, ""), (5, "<p>one</p>"), (0, "<p>é</p>"), (7, "x" * 70_000 + FAKE * 3 + "y" * 5000),
    (8, "WARC/1.0\r\n\r\n"), (9, FAKE[:-4] + "WARC/1.1\r\nContent-Length: 999999999\r\n\r\n"), (None, "<p>é</p>"), (1, "<p>one</p>"), (10, "\r\n\r\n"), (None, "only here"), (11, "\r\n\r\n" + FAKE + FAKE),
]


@pytest.mark.parametrize("range_bytes, least", [(64, 0), (1000, 5), (8 << 20, 0)])
def test_archives_with_magic_in_payloads(spark, monkeypatch, range_bytes, least):
    monkeypatch.setattr(W, "FILE_BYTES", 4000)
    archives = W.write_archives(pages_of(spark, HTMLS), scratch_folder(spark), least)
    found = materialize(W.candidates(archives, range_bytes))
    assert found.count() > len(HTMLS)  # the ones in payloads too
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in W.read_archives(archives, range_bytes).collect()]
    assert sorted(got, key=str) == sorted(plain_pages(HTMLS, least), key=str)


def test_headers_of_any_length(spark, monkeypatch):
    """A url longer than what is read at first, and magic far from a header's end."""
    monkeypatch.setattr(W, "TASKS", 3)
    far = "WARC/1.1\r\na: " + "b" * 200_000
    rows = [(1, "http://x/" + "u" * 70_000, "one"), (2, "v" * 300_000, far), (3, None, far + "\r\nno field\r\n\r\n"), (4, "w" * 70_000, "one")]
    archives = W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), scratch_folder(spark))
    got = {r.page_id: r for r in W.read_archives(archives, 5000).collect()}
    assert len(got) == 4 and all(got[k].target_uri == url for k, url, _ in rows)
    assert [got[k].refers_to for k in (1, 2, 3, 4)] == [None, None, None, 1] and bytes(got[2].payload).decode() == far


def test_archives_of_no_pages_and_broken_archives(spark, tmp_path):
    none = W.write_archives(pages_of(spark, HTMLS).limit(0), scratch_folder(spark))
    assert W.read_archives(none).collect() == []
    whole = W.record(1, "http://x/\r\n a", W.base32_sha1(b"abc"), b"abc", None, False)
    for k, data in enumerate((whole[:-2], whole + b"x" + whole, b"none")):
        (tmp_path / f"{k}.warc").write_bytes(data)
        archive = spark.createDataFrame([(str(tmp_path / f"{k}.warc"), len(data))], "path string, bytes long")
        with pytest.raises(ValueError):
            W.read_archives(archive)
    fields, _ = W._Window(str(tmp_path / "1.warc"), len(whole)).header(0)
    assert fields["warc-target-uri"] == "http://x/%0D%0A%20a"


# --- top products ------------------------------------------------------------------------------


def test_top_products_equal_their_twin(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    twin = con.execute(K.TWIN)
    names = [d[0] for d in twin.description]
    got = K.op7_ball_tree_top_products(spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(twin.fetchall())


def plain_products(vectors, queries, k):
    clean = lambda rows: [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in clean(queries):
        scored = []
        for i, y in clean(vectors):
            n = min(len(x), len(y))
            if i != q:
                scored.append((-int(x[:n] @ y[:n]), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("query_rows", [3, 1000])
def test_top_products_with_ties_and_odd_rows(spark, monkeypatch, query_rows):
    monkeypatch.setattr(K, "SHARD_ROWS", 50)
    monkeypatch.setattr(K, "LEAF", 4)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 6)).round(1))]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(1000, rows[5][1]), (None, [1.0]), (2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]), (2004, []), (2005, [3.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "'x' as n", "0 as rank")
    queries = frame.where("vec_id % 100 = 0 or vec_id in (2004, 2005)").distinct()
    got = sorted(tuple(r) for r in K.top_products(frame, queries, 7, query_rows).collect())
    assert got == plain_products(rows, [r for r in dict((i, (i, v)) for i, v in rows if i is not None).values() if r[0] % 100 == 0 or r[0] in (2004, 2005)], 7)
    assert K.top_products(frame.limit(0), queries).collect() == [] and K.top_products(frame, queries.limit(0)).collect() == []
    few = frame.where("vec_id < 3")
    assert len(K.top_products(few, few).collect()) == 6


def test_products_beyond_doubles_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2 \\*\\* 53"):
        K.top_products(frame, frame).collect()


def test_search_leaves_nodes(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 20
    rows = np.floor((centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 0.2) * 64)
    tree, seen = K.BallTree.build(rows, np.arange(4000)), []
    take = K.Search._take
    monkeypatch.setattr(K.Search, "_take", lambda self, s, i, w: (seen.append(s.size), take(self, s, i, w)))
    state = K.Search(rows[:50], np.arange(50), 10)
    state.add(tree)
    exact = rows[:50] @ rows.T
    exact[np.arange(50), np.arange(50)] = -np.inf
    assert (np.sort(exact, axis=1)[:, ::-1][:, :10] == state.scores).all()
    assert sum(seen) < 0.3 * exact.size


def test_dense_groups_dont_go_through_every_round(spark, monkeypatch):
    draw = np.random.default_rng(5)
    pairs = {(int(a), int(b)) for base, n in ((0, 60), (100, 60)) for a, b in draw.integers(base, base + n, (1500, 2))}
    pairs |= {(159, 999), (999, 1000), (2000, 2001), (2001, 2000), (7, 7)}
    seen, flattened = [], G._flattened
    monkeypatch.setattr(G, "_flattened", lambda edges: seen.append(edges.count()) or flattened(edges))
    rounds = []
    large = G._large_star
    monkeypatch.setattr(G, "_large_star", lambda edges: rounds.append(edges.count()) or large(edges))
    got = sorted(tuple(r) for r in G.components(spark.createDataFrame([*pairs, (None, 5)], "a long, b long").coalesce(1)).collect())
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    label = {x: x for x in nodes}
    for _ in nodes:
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == sorted(label.items())
    assert max([*seen, *rounds]) <= len(nodes)  # not the pairs, which grow with the square
