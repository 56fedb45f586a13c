"""Corpus pipeline: five stages over the documents table, each on all that its predecessor kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. The first four return rows of ``documents``, the last one the
packed pieces. ``run`` writes each stage as Parquet to the shared folder and reads
it back as the next one's documents, so a stage never re-runs its predecessors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, langid, ngram_join, packing, quality
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources.tables import read_table

LIMIT = 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told (a letter in the text, posterior of one half or more, n-grams that the language
    explains); learnt from all labelled rows."""
    return langid.keep_known(docs, langid.train(docs), least_score=0.5)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stay within their script's fertility bands."""
    return quality.keep_good(docs, cache_entries=200_000)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets with Jaccard similarity of 0.8 or more."""
    return ngram_join.keep_representatives(docs, n=5, num=80, den=100)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of ``LIMIT`` tokens."""
    # workers and heap come grown from four other stages: smaller slices and cache than packing alone would take
    return packing.pack_documents(docs, limit=LIMIT, slice_bytes=2_000_000, cache_entries=200_000).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

# Tokens, trained probabilities and packing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``sf_dir``'s documents; the result is the last stage's."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            _drop(spark, f"{folder}/{k - 1}")
    return docs


def _drop(spark: SparkSession, path: str) -> None:
    """Remove a stage that the next one has replaced."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
