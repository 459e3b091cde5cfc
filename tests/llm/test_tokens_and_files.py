"""Packing (1) and token-id files (10) against whole-text tokenization in plain Python."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from skyledger.llm import idfiles as I, packing as P, tokens as T
from skyledger.tuning import scratch_folder

SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  a", "a  b   c\n \n d \t\n", "it's a <|endoftext|> b", "ñandú 　 日本語 テスト  x\x1c y", "a\xa0 b \xa0c",
    "A  ́b é ́x", "x\r\n y ", "\n\n", "x\n\ny a\n\nb.c d.\ne", "Straße ÆON İstanbul ĳs × ÷a a×b", "don'T it's'x",
    "a_b c-d (e) f) 12ab3 x2y", "ſo Kelvin K ﬁ",
]
DOCS = "doc_id long, text string, piece string, START int"


def whole(name):
    t = Tokenizer.from_file(T.vocabulary(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)]
    rows += [(50, None, None, None), (None, "no id", "", 2), (51, "word " * 30_000, "", 3), (3, ODD[3], "", 1), (3, ODD[3], "", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aB 'é.\n\t<|1", max_size=40)), max_size=6))
def test_encoder_gives_the_ids_of_whole_texts(name, spaced, texts):
    own = T.encoder(T.vocabulary(name), spaced)
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.whole.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(pieces, documents):
    encode = whole("byte_bpe_50k.json")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces)
    expected = []
    for doc, text in documents:
        ids = [*encode(text), 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, len(ids)] if len(ids) <= 2048 else [0, *range(first, len(ids) + 1, 2048)]
        expected += [(-1 if doc is None else doc, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert got == sorted(expected)
    bins = defaultdict(list)
    for r in pieces:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) == naive_best_fit([r.length for r in pieces], 2048)


def naive_best_fit(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_packing_of_all_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    check_pieces(P.op1_best_fit_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_packing_of_odd_documents(spark, odd):
    check_pieces(P.packed_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert P.packed_documents(odd.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30)))
def test_plan_is_best_fit_decreasing(counts):
    plan = P.best_fit(counts, 40)
    assert sum(plan[:, 3] >= 1) == len(plan)
    bins = defaultdict(int)
    ends = {n: sorted(r for l, r, *_ in plan.tolist() if l == n) + [counts[n]] for n in counts}
    for length, rank, first, fit, offset in sorted(plan.tolist()):
        for k in range(ends[length][ends[length].index(rank) + 1] - rank):
            bins[first + k // fit] += length
            assert offset + (k % fit + 1) * length <= 40
    assert len(bins) == naive_best_fit([n for n, c in counts.items() for _ in range(c)], 40)
    assert max(bins.values(), default=0) <= 40


def test_pack_keeps_columns_and_skips_lengths_without_meaning(spark):
    rows = spark.createDataFrame([(5, "a"), (None, "b"), (0, "c"), (7, "d")], "length int, offset string")
    out = {r.length: (r.sequence_id, r.offset) for r in P.pack(rows, 12).collect()}
    assert out[None] == out[0] == (None, None) and out[7] == (0, 0) and out[5] == (0, 7)
    with pytest.raises(ValueError):
        P.pack(rows, 6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.booleans())
def test_planes_round_trip(ids, bits):
    x = np.array(ids, "<u4")
    assert I.from_planes(I.to_planes(x, bits), len(x), bits).tolist() == ids


@pytest.mark.parametrize("bits", [False, True])
def test_file_round_trip_and_random_access(tmp_path, bits):
    docs = [(None, [1]), (7, list(range(100))), (8, []), (9, [2**32 - 1] * 33)]
    out = I.PlaneWriter(str(tmp_path / "x.planes"), bits, 16)
    for doc, ids in docs:
        out.add(doc, np.array(ids, "<u4").tobytes())
    out.close()
    back = I.PlaneReader(str(tmp_path / "x.planes"))
    assert [(d, np.frombuffer(i, "<u4").tolist()) for d, _, i in back.documents()] == docs
    every = [i for _, ids in docs for i in ids]
    assert back.ids(0, 999).tolist() == every and back.ids(15, 50).tolist() == every[15:50] and back.ids(5, 5).tolist() == []
    whole_file = (tmp_path / "x.planes").read_bytes()
    (tmp_path / "cut.planes").write_bytes(whole_file[:-5])
    with pytest.raises(ValueError):
        I.PlaneReader(str(tmp_path / "cut.planes"))


def check_files(rows, documents):
    encode = whole("word_bpe_49k.json")
    expected, start = [], 0
    for doc, text in documents:
        ids = [*encode(text), 2]
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(rows, key=lambda r: r.start) == expected


def test_id_files_of_all_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    check_files(I.op10_token_id_files(spark, SF).collect(), [(r.doc_id, r.text) for r in documents])


@pytest.mark.parametrize("bits", [False, True])
def test_id_files_of_odd_documents(spark, odd, bits):
    manifest = I.write_ids(odd, scratch_folder(spark), bits=bits, block_ids=1000)
    rows = [(r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in I.read_ids(manifest).collect()]
    ordered = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    check_files([type("R", (tuple,), {"start": property(lambda s: s[1])})(r) for r in rows], [(r.doc_id, r.text) for r in ordered])
    assert I.read_ids(I.write_ids(odd.limit(0), scratch_folder(spark))).collect() == []


def test_a_full_cache_keeps_frequent_chunks_and_the_ids(monkeypatch):
    from skyledger.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_BYTES", 3_000)
    path = tokens.vocabulary("byte_bpe_50k.json")
    own = tokens.Encoder(path, True)
    for k in range(4):
        texts = [f"the {k}{n} word the {'x' * 300}{n} end" for n in range(20)] + ["", "the"]
        expected = own._each(set(texts))
        assert own.encode(texts) == [expected[t] for t in texts]
        assert "the" in own.known and own.held == sum(tokens.ENTRY_BYTES + len(c) + len(d) for c, d in own.known.items()) <= 3_000


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_are_not_taken_apart_again(name, spaced, monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    made = T.Encoder(T.vocabulary(name), spaced)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    texts = ["the river ran, ran on; and the Bridge held", "a river  held on\nto the 3rd bridge", ""]
    first, seen = made.encode(texts), []

    class Watched:
        def fullmatch(self, chunk):
            seen.append(chunk)
            return plain.fullmatch(chunk)

    plain = T._PLAIN
    monkeypatch.setattr(T, "_PLAIN", Watched())
    made.rest()
    assert made.encode(texts) == first and seen and not set(seen) & set(made.words)
    assert made.held == sum(T.ENTRY_BYTES + len(c) + len(d) for c, d in made.known.items())


def test_words_around_a_line_end_are_not_taken_apart_again(monkeypatch):
    made = T.Encoder(T.vocabulary("byte_bpe_50k.json"), True)
    made.encode(["a river.\nThe bridge,\nHeld on!\nTo"])
    texts = ["a bridge,\nThe river.\nHeld on!\nThe bridge,\nHeld, on.\n\nTo river \nThe on\r\nTo it's.\n'tis 3.\nTo on.\n"]
    expected, seen, each = [made.whole.encode(t, add_special_tokens=False).ids for t in texts], [], made._each

    def watched(some):
        seen.extend(some)
        return each(some)

    monkeypatch.setattr(made, "_each", watched)
    assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == expected
    assert not {" bridge,\nThe", " river.\nHeld", " on!\nThe"} & set(seen)


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_worker_keeps_words_in_arrays_and_only_chunks_that_come_again(name, spaced, monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 300)
    made = T.Encoder(T.vocabulary(name), spaced)
    for k in range(3):
        once = ["".join(chr(97 + n // 26**i % 26) for i in range(4)) + "q" * k for n in range(1000)]
        texts = [" ".join(f"{w}, often" for w in once), "z" * 5000, " x" + "y" * 300]
        expected = [made.whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == expected
        assert set(made.known) == {"often"} and len(made.words) <= 300
        assert made.words.strings.nbytes < 300 * 40


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_plain_chunks_are_taken_apart_and_joined_without_a_step_for_each(name, spaced, monkeypatch):
    made = T.Encoder(T.vocabulary(name), spaced)
    taken = []

    class Watched:
        def fullmatch(self, chunk):
            taken.append(chunk)
            return plain.fullmatch(chunk)

    plain = T._PLAIN
    monkeypatch.setattr(T, "_PLAIN", Watched())
    monkeypatch.setattr(T, "_BLOCK", 3, raising=False)  # chunks joined at a time
    texts = ["One, two; (three) é-four a1 3rd it's Ω", "", "two; two; two; two; new\nline", *ODD, "x  y\n\nz", "two; New, new"]
    for _ in range(2):
        expected = [made.whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == expected
        assert made.encode([]) == []
    assert "3rd" in taken and not {"two;", "New,", "new", "a1"} & set(taken)
