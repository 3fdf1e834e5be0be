"""A training corpus from ``documents``: drop toxic texts, exact copies and near copies, then pack the rest into bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netloom.llm import exact_dedup, ngram_join, packing, toxicity
from netloom.queries.registry import Query
from netloom.session import materialize

CAPACITY = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network fitted on ``labels`` does not hold to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets with a Jaccard coefficient of at least 0.8."""
    return ngram_join.drop_near_copies(docs, size=5, percent=80)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's stretches with their bins; no bin holds two documents of one source or one duplicate cluster."""
    return packing.pack_documents(docs, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_bins),
]

# Fitting a network and packing greedily are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline{n}")
    return docs


QUERY = Query(lambda t: run(t.spark, t.folder), ORACLE_SQL)
