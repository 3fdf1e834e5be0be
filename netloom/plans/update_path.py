"""New articles to merged state. State is laid out in key buckets; an update reads and writes those that its batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netloom.config import JobConfig
from netloom.operators import incremental, scoring
from netloom.operators.projection import Projection
from netloom.operators.setops import union_all
from netloom.session import apply_settings, materialize, releases_stages
from netloom.sources.buckets import BucketTable
from netloom.sources.spec import read_table, write_table

ANNOTATION = "pmid bigint, wiki_id bigint, spot string, rho double, title string"


class ScoreState:
    """The state tables of a network; pair tables are kept by the bucket of their first entity."""

    def __init__(self, cfg: JobConfig):
        def table(name: str, schema: str, key: str) -> BucketTable:
            return BucketTable(cfg.root, name, schema, key, cfg.buckets)

        self.projection = Projection(cfg.root, "bigint", cfg.alpha, cfg.block, cfg.buckets)
        self.annotations = table("state_annotations", ANNOTATION, "pmid")
        self.forms = table("state_forms", "wiki_id bigint, spot string", "wiki_id")
        self.evidence = table("state_evidence", "wid1 bigint, wid2 bigint, pmid bigint", "wid1")
        self.relatedness = table("state_relatedness", "wid1 bigint, wid2 bigint, relatedness double", "wid1")
        self.prediction = table("state_prediction", "wid1 bigint, wid2 bigint, score double", "wid1")
        self.size = cfg.table("state_size", "{}")

    def documents(self, spark: SparkSession, run: str) -> int:
        return read_table(spark, self.size.format(run)).first()["documents"]

    def put_documents(self, spark: SparkSession, run: str, number: int) -> None:
        write_table(spark.createDataFrame([(number,)], "documents bigint"), self.size.format(run))

    def tables(self, spark: SparkSession, run: str) -> dict[str, DataFrame]:
        """The tables as of ``run``; weights and counts of pairs are views of the projection."""
        return {
            "annotations": self.annotations.read(spark, run),
            "pair_freq": self.projection.pair_freq(spark, run),
            "surface_forms": self.forms.read(spark, run),
            "pair_evidence": self.evidence.read(spark, run),
            "relatedness": self.relatedness.read(spark, run),
            "w_matrix": self.projection.weights(spark, run).drop("freq"),
            "prediction": self.prediction.read(spark, run),
        }


def _predictions(spark: SparkSession, cfg: JobConfig, state: ScoreState, run: str, rows: DataFrame | None = None) -> DataFrame:
    """Best partners of all entities, or of those in ``rows`` (wid1), by weight, relatedness and number of documents."""
    weights = state.projection.weights(spark, run, rows)
    related = state.relatedness.read(spark, run)
    # A pair is stored once, in the bucket of its smaller entity.
    key = [F.least("wid1", "wid2").alias("low"), F.greatest("wid1", "wid2").alias("high")]
    scored = weights.select("*", *key).join(related.toDF("low", "high", "relatedness"), ["low", "high"])
    return scoring.best(
        scored.select("wid1", "wid2", (F.col("w_norm") * F.col("relatedness") * F.col("freq")).alias("score")), F.col("score"), cfg.top
    )


@releases_stages
def start_state(spark: SparkSession, cfg: JobConfig, annotations: DataFrame) -> dict[str, DataFrame]:
    """State of ``cfg.run`` from all filtered annotations (pmid, wiki_id, spot, rho, title)."""
    apply_settings(spark)
    state, run = ScoreState(cfg), cfg.run
    state.annotations.write(annotations, run)
    stored = state.annotations.read(spark, run)
    counts = scoring.stored_counts(stored, cfg.weight)
    state.projection.build(spark, counts, run)
    number = counts.select(F.count_distinct("pmid")).first()[0]
    state.put_documents(spark, run, number)
    state.forms.write(scoring.surface_forms(stored), run)
    state.evidence.write(scoring.pair_evidence(counts, cfg.evidence, cfg.block), run)
    pairs = state.projection.pairs.read(spark, run).where("wid1 < wid2")
    state.relatedness.write(_related(spark, state, run, pairs, number), run)
    state.prediction.write(_predictions(spark, cfg, state, run), run)
    return state.tables(spark, run)


def _related(spark: SparkSession, state: ScoreState, run: str, pairs: DataFrame, number: int) -> DataFrame:
    """Relatedness of ``pairs`` (wid1, wid2, freq) in a corpus of ``number`` documents."""
    degrees = state.projection.entities.read(spark, run).select("wiki_id", "docs")
    known = pairs.select("wid1", "wid2", "freq").join(degrees.toDF("wid1", "docs1"), "wid1").join(degrees.toDF("wid2", "docs2"), "wid2")
    return scoring.relatedness(known, F.lit(number))


@releases_stages
def update_scores(spark: SparkSession, cfg: JobConfig, batch: DataFrame, run: str) -> dict[str, DataFrame]:
    """Merge a batch of filtered annotations into the state of ``cfg.run``; the result is the state of ``run``.

    Only the documents of the batch are looked up, only pairs of their entities change, and relatedness is added for pairs
    that have none; pairs keep the relatedness that they were given first. Predictions are ranked again in the rows where a weight has
    changed. The state of ``cfg.run`` stays as it is.
    """
    apply_settings(spark)
    state, before = ScoreState(cfg), cfg.run
    batch = materialize(batch.select("pmid", "wiki_id", "spot", "rho", "title"), "batch")
    documents = batch.select("pmid").distinct()
    history = state.annotations.read(spark, before, state.annotations.buckets_of(documents)).join(documents, "pmid", "left_semi")
    history = materialize(history, "history")
    delta = materialize(incremental.new_annotations(batch, history), "delta")
    touched = materialize(incremental.touched_documents(history, delta), "touched")
    state.annotations.update(spark, before, run, delta.select("pmid").distinct(), lambda rows: union_all([rows, delta]))
    old = scoring.stored_counts(touched, cfg.weight)
    new = scoring.stored_counts(union_all([touched, delta]), cfg.weight)
    grown = new.select(F.count_distinct("pmid")).first()[0] - old.select(F.count_distinct("pmid")).first()[0]
    number = state.documents(spark, before) + grown
    state.put_documents(spark, run, number)

    changes, moved = state.projection.update(spark, before, run, old, new)

    forms = materialize(scoring.surface_forms(delta), "forms")
    state.forms.update(
        spark, before, run, forms.select("wiki_id"), lambda rows: union_all([rows, incremental.new_surface_forms(forms, rows)])
    )
    evidence = materialize(scoring.pair_evidence(new, cfg.evidence, cfg.block), "evidence")
    state.evidence.update(
        spark, before, run, evidence.select("wid1"), lambda rows: incremental.add_evidence(rows, evidence, cfg.evidence)
    )
    gained = changes.where("wid1 < wid2").select("wid1", "wid2")
    known = state.relatedness.read(spark, before, state.relatedness.buckets_of(gained))
    unseen = scoring.unscored_pairs(gained, known)
    own = state.projection.pairs.read(spark, run, state.projection.pairs.buckets_of(gained))
    fresh = materialize(_related(spark, state, run, own.join(unseen, ["wid1", "wid2"], "left_semi"), number), "related")
    state.relatedness.update(spark, before, run, fresh.select("wid1"), lambda rows: union_all([rows, fresh]))

    def ranked(rows: DataFrame) -> DataFrame:
        return union_all([rows.join(moved, "wid1", "left_anti"), _predictions(spark, cfg, state, run, moved)])

    state.prediction.update(spark, before, run, moved, ranked)
    return state.tables(spark, run)
