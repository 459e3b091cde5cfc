"""Operators that look at one document at a time: shards (9), language (5), passages (6), secrets (4), scores (3)."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyledger import tuning
from skyledger.llm import contamination as C, langid as L, lmscore as M, secretscan as S, sharding as H

SF = "/root/testdata/sf0.001"


def documents(spark, sf_dir=SF):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


# --- shards ------------------------------------------------------------------------------------


def shard_of(key, tree):
    """The tree's draws in plain Python."""

    def draw(level, names):
        def x(name):
            bits = xxhash.xxh64(f"{'' if key is None else key}|{level}|{name}".encode(), seed=42).intdigest() >> 11
            return -math.log((bits + 0.5) / 2**53) / names[name], name

        return min(map(x, names))[1]

    def weights(own, level):
        out = {}
        for s in own:
            out[str(getattr(s, level))] = out.get(str(getattr(s, level)), 0) + s.weight
        return out

    region = draw("region", weights(tree, "region"))
    rack = draw("rack", weights([s for s in tree if s.region == region], "rack"))
    return int(draw("number", weights([s for s in tree if s.rack == rack], "number")))


def check_shards(rows, docs, tree, larger):
    assert len(rows) == len(docs)
    for r in rows:
        assert r.shard == shard_of(r.doc_id, tree) and r.grown_shard == shard_of(r.doc_id, larger)
        assert r.grown_shard in (r.shard, 40)
    expected = Counter((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    for shard in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in own]
        assert keys == sorted(keys)


def test_shards_of_all_documents(spark):
    tree = H.even_tree(40)
    check_shards(H.op9_hash_tree_shards(spark, SF).collect(), documents(spark), tree, H.grown(tree))


def test_shards_of_odd_documents(spark):
    rows = [(1, "a", 5), (1, "a", 5), (1, None, 5), (None, "é", 0), (None, None, 0), (2, "x" * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    tree = H.even_tree(40)
    check_shards(H.assign_shards(docs, tree, H.grown(tree)).collect(), docs.collect(), tree, H.grown(tree))
    assert H.assign_shards(docs.limit(0), tree).collect() == []
    with pytest.raises(ValueError):
        H.assign_shards(docs, [H.Shard(0, "r", "k", 0.0)])


def test_weights_hold_and_changes_stay_in_their_subtree(spark):
    tree = [H.Shard(i, f"r{i // 4}", f"k{i // 2}", 1.0 + (i == 5) * 2) for i in range(8)]
    keys = spark.range(20_000)
    before = H.with_shard(keys, F.col("id"), tree, "a")
    lower = [s if s.number != 5 else H.Shard(5, "r1", "k2", 1.0) for s in tree]
    both = H.with_shard(before, F.col("id"), lower, "b").collect()
    n = Counter(r.a for r in both)
    assert abs(n[5] / 20_000 - 0.3) < 0.02 and abs(n[0] / 20_000 - 0.1) < 0.02
    moved = [(r.a, r.b) for r in both if r.a != r.b]
    assert moved and all(a >= 4 for a, _ in moved)  # nothing in the other region changes its place but by arrivals


# --- language ----------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in documents(spark)}
    rows = L.op5_language_filters(spark, SF).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98


def plain_languages(train, texts):
    """(lang_pred, score) of each text by sets, popcounts and a filter of whole numbers."""

    def grams(text):
        own = b" " + (bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()) or b" ") + b"  "
        return [int.from_bytes(own[k : k + 4], "big") for k in range(len(own) - 3)]

    counts = {}
    for text, lang in train:
        if text and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    held = {lang: {g for g, n in c.items() if n >= L.SHARE * c.total()} for lang, c in counts.items()}
    bits = (max(1024, L.SLOTS * max(map(len, held.values()))) - 1).bit_length()

    def slots(g):
        x = (g ^ g >> 15) * 0x2C1B3C6D % 2**32
        x ^= x >> 12
        return [(x + k + 1) * m % 2**32 >> 32 - bits for k, m in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))]

    filters = {lang: {s for g in own for s in slots(g)} for lang, own in held.items()}
    most = min((-c.total(), lang) for lang, c in counts.items())[1]
    out = []
    for text in texts:
        if not any(map(str.isalpha, text or "")):
            out.append(("und", 0.0))
            continue
        places, best = [slots(g) for g in grams(text)], (0.0, most)
        for lang in sorted(filters):
            false = (len(filters[lang]) / 2**bits) ** 3
            share = sum(filters[lang].issuperset(p) for p in places) / len(places)
            score = min(1.0, max(0.0, (share - false) / (1 - false)))
            best = max(best, (score, lang), key=lambda b: b[0])
        out.append((best[1], best[0]))
    return out


def test_languages_against_plain_filters(spark):
    rows = documents(spark)
    train = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    expected = dict(zip((r.doc_id for r in rows), plain_languages(train, [r.text for r in rows])))
    for r in L.op5_language_filters(spark, SF).collect():
        assert r.lang_pred == expected[r.doc_id][0] and math.isclose(r.score, expected[r.doc_id][1], abs_tol=1e-12)


def test_all_languages_of_an_ngram(spark):
    """A shared n-gram is held by all its languages, however unlike its shares are."""
    train = spark.createDataFrame([("oo " * 500 + "the", "a"), ("the " * 500, "b"), ("zz the", "c")], "text string, lang string")
    model = L.fit(train)
    codes, _ = L._codes([b"the"])
    assert model.languages == ["a", "b", "c"] and (model.holders(codes[:2])[:, 0] == 7).all()


def test_filter_counts_every_ngram_and_corrects_for_its_fill():
    codes, starts = L._codes([b"ab", b"", b"A b!"])
    assert starts.tolist() == [0, 2, 3] and len(codes) == 7
    assert codes[0] == L._codes([b"AB"])[0][0]
    model = L.LanguageFilter.build({"x": L._codes([b"ab"])[0], "y": np.array([5])}, "x")
    shares = model.shares([b"ab", b"zq"])
    assert shares[0].tolist() == [1, 0] and shares[1].max() < 0.01


def test_language_of_odd_documents(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), (None, "en"), ("le chat et le chien", "fr"), ("?", None)], "text string, lang string")
    model = L.fit(train)
    assert model.languages == ["en", "fr"]
    rows = [(1, "the dog", "fr"), (2, None, None), (3, "123 !?", "en"), (4, "", ""), (5, "le chien " * 20_000, None), (5, "é", None), (None, "the", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    out = L.identify(docs, model).collect()
    assert [r.lang_pred for r in out] == ["en", "und", "und", "und", "fr", "en", "en"]
    assert [r.score for r in out][1:4] == [0, 0, 0] and L.identify(docs.limit(0), model).collect() == []
    assert L.fit(train.where("false")) is None
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}


def test_many_languages_share_a_filter():
    kept = {f"l{k:03d}": [k * 7, k * 7 + 1] for k in range(150)}
    model = L.LanguageFilter.build(kept, "l000")
    hit = model.holders(np.array([7 * 149], np.uint32))[0]
    assert hit[149 // 64] >> np.uint64(149 % 64) & np.uint64(1)


# --- passages ----------------------------------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_passages(docs, items):
    """Contamination by trying every window at every place."""
    words = lambda t: WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                if (w := tuple(own[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        yield doc, len(own), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(own)


def passage_rows(found):
    digest = F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", C.n_hit(), F.size("hit_items"), digest, C.contaminated())


def test_passages_in_all_documents(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [(r.doc_id, r.text) for r in documents(spark)]
    got = sorted(tuple(r) for r in C.op6_wu_manber_contamination(spark, SF).collect())
    assert got == sorted(plain_passages(docs, items)) and any(r[5] for r in got)


@pytest.mark.parametrize("item_bytes", [C.ITEM_BYTES, 60])
def test_passages_in_odd_documents(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(C, "ITEM_BYTES", item_bytes)
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "Short One"), (2, "Short One"), (3, None), (None, "no id"), (10, "!!"), (4, "é"), (5, long[20:])]
    docs = [(1, long.upper()), (2, "a short\none b; SHORT one"), (3, None), (4, ""), (5, "..."), (6, "x no id É é"), (6, "x no id É é"), (7, "a b c " * 30_000 + long), (None, "short one")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    found = C.find_passages(frame, spark.createDataFrame(items, "item_id long, text string"))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in passage_rows(found).collect()), key=key) == sorted(plain_passages(docs, items), key=key)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in C.find_passages(frame, empty).select(C.n_hit().alias("n_hit")).collect()} == {0}
    assert C.find_passages(frame.limit(0), empty).collect() == []


# --- secrets -----------------------------------------------------------------------------------


def plain_base(text):
    found = []
    for kind, pattern in (
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", r"(AKIA[A-Z0-9]+)"),
        ("hex", r"([0-9a-f]+)"),
    ):
        least = {"assign": 6, "access": 20, "hex": 24}[kind]
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, m in enumerate(re.finditer(pattern, text)) if len(m[m.lastindex]) >= least]
    order = ("assign", "access", "hex")
    return [s for *_, s in sorted(found, key=lambda x: (x[0], order.index(x[2].split(":")[0])))]


def test_secrets_in_all_documents(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest that holds some
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf_dir)}
    rows = S.op4_assignment_secrets(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.spans for r in rows)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))


@pytest.mark.parametrize(
    "text",
    ["paſſword=abcdefgh", "api_Key : 'a.b=c-d/e", "toKen=abcdefg", "password==abcdef secret: abc token=abcdef", "AKIAAKIA" + "A1" * 8 + "x" + "0123456789abcdef" * 2, "é password = 12345 passwd='123456"],
)
def test_base_patterns(text):
    assert [":".join(map(str, s)) for s in sorted(S.base_spans(text), key=lambda s: (s[1], S.KINDS.index(s[0])))] == plain_base(text)


def test_literals_reach_sensitive_names():
    text = 'k = "aB3$xZ9qLm2w"\nother = k\ndb_password = other\nclientSecret: \'zQ81kd93hs7A\'\n"api_key": "changeme"\nexport AUTH_TOKEN=ghp_9sd8f7s9d8f7\n'
    assert [text[a:b] for _, a, b in S.literal_spans(text)] == ["aB3$xZ9qLm2w", "zQ81kd93hs7A", "ghp_9sd8f7s9d8f7"]
    for clean in ("The key: it was the secret of the password.", "title = 'A long harmless title'", "token: word", "http://x.y/z", "a == b", "password = ${DB_PASSWORD}"):
        assert S.literal_spans(clean) == []


LITERAL = "aB3xZ9qLm2wQ"
#: Texts in which the literal is a secret, and texts without one.
LABELLED = [
    'const privateKey: string = "%s"', 'private_key = f"%s"', 'private_key = b"%s"', 'private_key = """%s"""', 'private_key = (\n  "%s")',
    'credential =\n    "%s"', "credential:\n  value: %s\n", '{"credential": {"value": "%s"}}', '<add key="private_key" value="%s"/>',
    'x.setPassphrase("%s")', 'props.put("private_key", "%s")', 'private_key = k\nk = "%s"\n', 'k = "%s"\nj = k\ncredential = j',
    'var credential string = "%s"', 'config["private_key"] = "%s"', "'credential' => '%s'", "<passphrase>%s</passphrase>",
    'credential: Optional[str] = "%s"', "export PRIVATE_KEY=%s", "private_key := `%s`", 'self.k = "%s"\ncredential = self.k',
    'f(credential="%s")', 'private-key: "%s" # c', 'credential = other = "%s"', 'a = b\nb = a\nb = "%s"\ncredential = b',
]
CLEAN = [
    "token = get_token()", 'api_key = os.environ["X_KEY_LONG9"]', "private_key = load_pem_key(path)", "secret_key = config.SECRET_KEY_BASE",
    "password = ${DB_PASSWORD}", "token: word", "The key: it was the secret of the password.", 'if password == "aB3xZ9qLm2wQ": pass',
    'password = input("Give the Passw0rd now")', 'passphrase = f"{load9A}"', "auth_token = next_token", 'title = "aB3xZ9qLm2wQ"',
    'credential:\n  user: x\ntitle: "aB3xZ9qLm2wQ"', 'k = "aB3xZ9qLm2wQ"\nk = make()\ncredential = k', 'setTitle("aB3xZ9qLm2wQ") # password',
]


def test_precision_and_recall_on_labelled_texts():
    found = [[t[a:b] for _, a, b in S.literal_spans(t)] for t in (x % LITERAL for x in LABELLED)]
    assert found == [[LITERAL]] * len(LABELLED)
    assert [S.literal_spans(t) for t in CLEAN] == [[]] * len(CLEAN)
    joined = 'credential = ("aB3xZ9" +\n "qLm2wQ")\nprivate_key = ("aB3xZ9"\n  "qLm2wQ")'
    assert [joined[a:b] for _, a, b in S.literal_spans(joined)] == ["aB3xZ9", "qLm2wQ"] * 2


@pytest.mark.parametrize("part", ['\\"', "a:b[", "a:b<", "`\\`", "x=(", "a=b=", "<key>", '"""\'', "{a:", "a:\n ", "key=k;k=key\n", "a=a+\n", "x.set("])
def test_lexing_takes_linear_time(part):
    started = time.process_time()
    S.literal_spans("password " + part * 40_000)
    assert time.process_time() - started < 8


def test_secrets_of_any_length(spark):
    body = "".join(map(chr, np.random.default_rng(2).choice([*range(48, 58), *range(65, 91), *range(97, 123)], 9000)))
    for literal in (f'"{body}"', f"'{body}'", body):
        for name in ("private_key", "credentials", "x" * 300 + "_passphrase"):
            for blanks in ("", " " * 100):
                text = f"first line\n{name}{blanks}={blanks}{literal}\nlast line"
                at = text.index(body)
                assert S.literal_spans(text) == [("literal", at, at + len(body))]
                docs = spark.createDataFrame([(1, text)], "doc_id long, text string") if blanks and name == "private_key" else None
                assert docs is None or S.redact(docs).first().text == text.replace(body, "[REDACTED]")
    for text in ("a=" * 200_000, 'a="' * 100_000, "a " * 200_000, ("a" + " " * 50) * 5_000, 'a="' + "\\x" * 200_000, "a" * 400_000 + " = ", "'" * 200_000):
        started = time.process_time()
        S.literal_spans(text)
        assert time.process_time() - started < 5


def test_secrets_of_odd_documents(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "password=abcdef", 3), (3, "x " * 200_000 + "token: 123456", 4), (3, "é password=abcdef \U0001f600 AKIA" + "B" * 16, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets int")
    found = [[(s.kind, s.start, s.end) for s in r.secrets if s.kind != "literal"] for r in S.scan(docs).collect()]
    assert found == [[], [], [("assign", 0, 15)], [("assign", 400_000, 400_013)], [("assign", 2, 17), ("access", 20, 40)]]
    texts = [r.text for r in S.redact(docs).collect()]
    assert texts[:3] == [None, "", "[REDACTED]"] and texts[4] == "é [REDACTED] \U0001f600 [REDACTED]"
    assert S.redact(docs).columns == docs.columns and S.scan(docs.limit(0)).collect() == []


# --- scores ------------------------------------------------------------------------------------


def plain_losses(text, corpus):
    """Means per token under both models, from counts in plain Python."""
    counts = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for other, flag in corpus:
        words = (other or "").encode().lower().split()
        for pair, word, before in counts if flag else counts[1:]:
            pair.update(zip([None, *words], words))
            word.update(words)
            before.update([None, *words][:-1] if words else [])
    every = counts[1][1]
    shared = lambda w: max(every[w], 1) / (every.total() + 1)

    def loss(pair, word, before, b, w):
        single = (word[w] + M.PRIOR * shared(w)) / (word.total() + M.PRIOR)
        return -math.log((pair[b, w] + M.PSEUDO * single) / (before[b] + M.PSEUDO))

    words = (text or "").encode().lower().split()
    return [np.mean([loss(*model, b, w) for b, w in zip([None, *words], words)]) for model in counts] if words else None


def check_scores(out, scored, corpus):
    assert len(out) == len(scored)
    by = {}
    for doc, text in scored:
        by.setdefault((doc, text), plain_losses(text, corpus))
    for r in out:
        expected = by[r.doc_id, r.text]
        assert r.n_tokens == len((r.text or "").encode().split()) and (r.difference is None) == (r.target_loss is None) == (expected is None)
        if expected:
            assert math.isclose(r.target_loss, expected[0], rel_tol=1e-9) and math.isclose(r.background_loss, expected[1], rel_tol=1e-9)
            assert math.isclose(r.difference, expected[0] - expected[1], rel_tol=1e-6, abs_tol=1e-9)


BOUNDS = [{}, {"shares": (1, 1), "bucket_entries": 100, "part_entries": 20}, {"shares": (200, 50), "bucket_entries": 1000, "part_entries": 30}, {"shares": (8, 64)}]


@pytest.mark.parametrize("bounds", BOUNDS)
def test_scores_against_plain_counts(spark, bounds):
    """Frequent and rare words and pairs, words that stand last, and more words than any fixed table has symbols."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.2, 300) % 9000) for _ in range(40)]
    rows = [(k, t, k % 4 == 0) for k, t in enumerate(texts)] + [(50, None, True), (51, " ", None), (3, texts[3], None), (None, "b " * 3000, False), (52, "A b a c", True), (53, "a b\tb", False)]
    docs = tuning.materialize(spark.createDataFrame(rows, "doc_id long, text string, target boolean").withColumn("difference", F.lit("clash")).withColumn("_t", F.lit(1)))
    out = M.score(docs, **bounds)
    assert out.columns == ["doc_id", "text", "target", "_t", "n_tokens", "target_loss", "background_loss", "difference"]
    corpus = [r[1:] for r in rows]
    check_scores(out.collect(), [r[:2] for r in rows], corpus)
    others = [(60, "W1 never seen w2"), (61, texts[0] + " w1 w1 unseen"), (61, "unseen"), (None, None), (62, "")]
    others = [*others, *others[:1]]
    frame = tuning.materialize(spark.createDataFrame(others, "doc_id long, text string"))
    check_scores(M.score(frame, docs, **bounds).collect(), others, corpus)


def test_scores_of_nothing(spark):
    docs = tuning.materialize(spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string"))
    none = tuning.materialize(spark.createDataFrame([], "doc_id long, text string, target boolean"))
    assert M.score(none).collect() == []
    check_scores(M.score(docs, none).collect(), [(1, "a b a"), (2, None)], [])


def test_target_documents_score_lower(spark):
    rows = [(r.doc_id, r.text, r.lang == "de") for r in documents(spark)]
    docs = tuning.materialize(spark.createDataFrame(rows, "doc_id long, text string, target boolean"))
    out = M.score(docs).where("n_tokens >= 50").collect()
    german, other = ([r.difference for r in out if r.target == t] for t in (True, False))
    assert max(german) < min(other)


def test_score_query(spark):
    """All rows of the query against plain counts."""
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    rows = documents(spark)
    corpus = [(r.text, r.doc_id in good) for r in rows]
    some = [r for r in rows if r.doc_id % 5 == 0]
    found = {r.doc_id: r for r in M.op3_cross_entropy_difference(spark, SF).collect()}
    assert len(found) == len(rows) and all((r.difference is None) == (r.n_tokens == 0) for r in found.values())
    for r in some[:12]:
        expected = plain_losses(r.text, corpus)
        assert expected is None or math.isclose(found[r.doc_id].target_loss, expected[0], rel_tol=1e-9)
        assert expected is None or math.isclose(found[r.doc_id].background_loss, expected[1], rel_tol=1e-9)
