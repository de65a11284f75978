"""From raw documents to packed training sequences, one stored stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm.common import let_workers_import, table
from meterlake.llm.hilbert import pack_documents
from meterlake.llm.neardup import keep_one
from meterlake.llm.quality import keep_good
from meterlake.llm.radix import keep_first
from meterlake.llm.secrets import redact
from meterlake.staging import new_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    let_workers_import(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    let_workers_import(spark)
    return keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    let_workers_import(spark)
    return pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: No SQL: the stages are trained, iterate, or use a tokenizer; a test runs them by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next.

    A null or empty text, or one of white space alone, is a document like any other: of those
    that the classifier keeps the least id stays and is packed as the end id alone. Of rows
    that repeat id and text one stays; rows with one id and different texts are different
    documents. A null id stays only where no document with the same or a similar text has
    one. Texts of any length are used whole. Other columns are carried along but not
    returned. Empty ``documents`` give no rows, empty ``labels`` a classifier that keeps all.
    """
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage_{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
