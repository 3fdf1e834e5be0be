"""Annotations to prediction table. Each stage is written once and read by the stages after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netloom.config import JobConfig
from netloom.operators import scoring
from netloom.operators.annotate import annotate, document_text, filter_categories
from netloom.session import apply_settings, releases_stages
from netloom.sources.spec import read_table, write_table


@releases_stages
def build_annotations(
    spark: SparkSession, cfg: JobConfig, documents: DataFrame, dictionary: DataFrame, categories: DataFrame
) -> DataFrame:
    """Annotate documents (PMID, Title, Abstract) and keep the allowed categories."""
    apply_settings(spark)
    text = documents.select(
        F.col("PMID").alias("pmid"), document_text(F.col("Title"), F.col("Abstract")).alias("text")
    )
    found = annotate(text, dictionary, cfg.epsilon)
    path = write_table(filter_categories(found, categories), cfg.table("annotations"))
    return read_table(spark, path)


@releases_stages
def build_scores(spark: SparkSession, cfg: JobConfig, annotations: DataFrame) -> dict[str, DataFrame]:
    """Counts, pairs, projection, relatedness, evidence, surface forms and the prediction table."""
    apply_settings(spark)

    def store(name: str, df: DataFrame, range_by: tuple[str, ...] = ()) -> DataFrame:
        return read_table(spark, write_table(df, cfg.table(name), range_by=range_by))

    counts = store("counts", scoring.mention_counts(annotations, cfg.weight))
    profiles = store("profiles", scoring.weighted_profiles(counts))
    pairs = store("pairs", scoring.pair_table(profiles, cfg.block))
    n_docs = scoring.corpus_size(counts)
    return {
        "counts": counts,
        "profiles": profiles,
        "pairs": pairs,
        "w_matrix": store("w_matrix", scoring.dt_hybrid(profiles, pairs, cfg.alpha), ("wid1",)),
        "pair_freq": store("pair_freq", scoring.pair_freq(pairs)),
        "pair_evidence": store("pair_evidence", scoring.pair_evidence(counts, cfg.evidence, cfg.block)),
        "relatedness": store("relatedness", scoring.relatedness(pairs, n_docs)),
        "surface_forms": store("surface_forms", scoring.surface_forms(annotations)),
        "prediction": store(
            "prediction", scoring.predict_from_pairs(profiles, pairs, n_docs, cfg.alpha, cfg.top), ("wid1",)
        ),
    }
