"""The corpus pipeline stage by stage against plain Python."""

import zlib

import pytest
from pyspark.sql import functions as F
from test_pairs import plain_components
from test_rows import plain_base, plain_languages, plain_passages
from test_tokens_and_files import check_pieces

import corpus_pipeline as P
from skyledger.llm import langid, secretscan as S
from skyledger.tuning import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9001, None), (9002, "123 !!"), (9003, ""), (9004, "A clean text of some words here."), (9005, "password=abcdef12 is here, and more"), (9006, "ᚠᚢᚦᚨᚱᚲ ᚷᚹᚺᚾᛁᛃ ᛇᛈᛉᛊ " * 20)]
    more = spark.createDataFrame(extra, "doc_id long, text string").selectExpr("doc_id", "text", "cast(null as string) lang", "'src0' source", "length(text) n_chars")
    docs = docs.unionByName(more.select([more[c].cast(t).alias(c) for c, t in docs.dtypes]))
    docs = materialize(docs.unionByName(docs.where("doc_id in (5, 9004)")))
    frames = [docs]
    for _, stage in P.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF)))
    return frames


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_columns_stay_until_the_last_stage(stages):
    assert all(f.dtypes == stages[0].dtypes for f in stages[:-1])


def test_texts_of_no_known_language_go(spark, stages):
    before = rows(stages[0])
    train = [(r.text, r.lang) for r in stages[0].collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    found = plain_languages(train, [t for _, t in before])
    known = [r for r, (lang, score) in zip(before, found) if lang != "und" and score >= langid.LEAST_SCORE]
    assert rows(stages[1]) == known
    lost = {d for d, _ in before} - {d for d, _ in known}
    assert lost == {9001, 9002, 9003, 9006}  # the last one has letters of no language in the labels


def test_rows_of_repeated_and_null_ids_are_documents(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    all_rows = [(1, a), (1, b), (1, b), (2, b), (None, a), (None, c), (None, c), (3, None), (3, None), (4, ""), (None, "")]
    docs = materialize(spark.createDataFrame(all_rows, "doc_id long, text string").withColumn("_row", F.lit("clash")))
    out = P.one_of_each(spark, docs, SF)
    assert out.columns == docs.columns
    assert rows(out) == sorted([(1, a), (1, b), (None, c), (3, None), (3, None), (4, ""), (None, "")], key=str)
    assert rows(P.one_of_each(spark, docs.where("doc_id = 2 or text = ''").where("doc_id is not null"), SF)) == sorted([(2, b), (4, "")], key=str)


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[1])
    keep = {c for d, _, c in plain_components(before) if d == c}
    assert rows(stages[2]) == sorted({(d, t) for d, t in before if d in keep}, key=str) and len(keep) < len(before)


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in plain_passages(rows(stages[2]), items) if r[5]}
    assert bad and rows(stages[3]) == [r for r in rows(stages[2]) if r[0] not in bad]


def test_secrets_are_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert [d for d, _ in before] == [d for d, _ in after]
    for (_, old), (_, new) in zip(before, after):
        assert plain_base(new) == [] and ((new == old) == (not plain_base(old) and not S.literal_spans(old)))
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_what_is_left_is_packed(stages):
    check_pieces(stages[5].collect(), rows(stages[4]))


def test_run_gives_the_last_stage(spark):
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_stages_take_an_empty_table(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0
