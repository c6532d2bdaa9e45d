"""From raw documents to packed tokens: five stages, each written as Parquet and read again by the next.

Each stage works on all that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.llm import bpe, lines, minhash, quality, queries
from chalkline.session import materialized


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, from a score of 0.3 on."""
    scored = quality.classify(docs, queries.table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; a document whose every line stands in others goes."""
    return lines.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, from a similarity of 0.8 on, the one with the least doc_id stays."""
    return minhash.without_near_duplicates(docs, percent=80)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights; one that two epochs take is there twice."""
    return queries.mixed(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document, and whether they decode to its text."""
    encoded = bpe.encode_documents(docs, queries.vocabulary_path(), keep=("text",), decode=True)
    return encoded.select("doc_id", "n_tokens", "ids", F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("MinHash near-dedup", distinct_documents),
    ("mixing sources to target weights", target_mix),
    ("BPE encoding and decoding", tokens),
]

# A trained classifier and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
