"""From raw documents to packed training sequences, a stage after another.

Every stage but the last returns the columns of `documents`; `run` writes each result to the shared
folder as Parquet and reads it again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import contamination, jaccard, langid, packing, secretscan
from skyledger.llm.common import table
from skyledger.tuning import materialize, small_side


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go: a null text, one without a letter, or one with hardly an n-gram of any.

    The filter learns from the labelled documents of its input; without any, a letter is enough. Repeated
    rows stay or go together.
    """
    model = langid.trained(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.of_known_language(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by similarity the one with the smallest doc_id stays, of equal ids one row.

    Every row is a document, also where ids repeat or are null: rows of one id with unlike texts all stay,
    equal ones are copies. A null id comes after all others. Texts that are null or without words link with
    nothing and stay.
    """
    ids = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if ids.isEmpty():
        linked = jaccard.link_components(docs)
        gone = linked.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
        return docs.join(small_side(materialize(gone)), "doc_id", "left_anti").select(docs.columns)
    row, least = (next(n for n in (name + "_" * k for k in range(99)) if n not in docs.columns) for name in ("_row", "_least"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    linked = jaccard.link_components(numbered.select(F.col(row).alias("doc_id"), "text"))
    linked = linked.select(F.col("doc_id").alias(row), "component_id")
    members = materialize(numbered.select(row, "doc_id").join(linked, row))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    groups = members.groupBy("component_id").agg(first[row].alias(least), F.count("*").alias("n")).where("n > 1")
    gone = members.join(small_side(materialize(groups)), "component_id").where(F.col(row) != F.col(least)).select(row)
    return numbered.join(small_side(materialize(gone)), row, "left_anti").select(docs.columns)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go.

    A null or wordless text is clean; repeated rows stay or go together; an empty benchmark takes none.
    """
    kept = contamination.find_passages(docs, table(spark, sf_dir, "benchmark")).where(~contamination.contaminated())
    return kept.select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all rows stay, with null and empty texts as they are. `n_chars` follows the text."""
    docs = secretscan.redact(docs)
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences.

    A null text is packed as an empty one, repeated rows each; an empty table gives no pieces.
    """
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Language filters, components and packing are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
