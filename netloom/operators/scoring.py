"""Document-entity graph to weighted entity pairs.

Input is an annotation table with ``pmid`` (document) and ``wiki_id`` (entity); each output is an edge
table on ``wid1``, ``wid2``.

Every pair that is emitted below is a cell of the result, so the pair count is set by the data. Three
things keep that work small and even:

* repeated mentions are counted before any join (``mention_counts``);
* documents with the same entities and counts are paired once and weighted by their number
  (``document_profiles``), so a large group of copies costs as much as one document;
* a document with many entities is cut into a grid of cells (``profile_pairs``), so that no task holds
  more than ``block`` x ``block`` combinations of one document.

Only ordered pairs ``wid1 < wid2`` are aggregated; the mirrored half is derived from them afterwards.

The stages are ``mention_counts`` -> ``weighted_profiles`` -> ``pair_table``. Each result is read several times, by plans that
keep different columns and so cannot share a shuffle; the ``stored_`` forms write it once to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.operators.setops import symmetrize
from netloom.operators.windows import top_n
from netloom.session import materialize

# Ranking compares the logarithm of a score to this many decimals. The last bits of a floating-point sum depend on the
# order of partitions; without this they could change which rows are kept.
RANK_DIGITS = 11


def mention_counts(annotations: DataFrame, weight: str = "mentions") -> DataFrame:
    """(pmid, wiki_id, mentions): how often each document names each entity.

    ``weight="distinct"`` counts every entity once per document.
    """
    rows = annotations.select("pmid", "wiki_id").where("pmid is not null and wiki_id is not null")
    if weight == "distinct":
        return rows.distinct().withColumn("mentions", F.lit(1).cast("bigint"))
    if weight != "mentions":
        raise ValueError(f"unknown weight {weight!r}")
    return rows.groupBy("pmid", "wiki_id").agg(F.count(F.lit(1)).alias("mentions"))


def stored_counts(annotations: DataFrame, weight: str = "mentions") -> DataFrame:
    return materialize(mention_counts(annotations, weight), "counts")


def document_profiles(counts: DataFrame) -> DataFrame:
    """(pmid, degree, rep): the degree of each document and the representative of its profile.

    Two documents share a profile when they name the same entities equally often. Profiles
    are told apart by the degree, the first and last entity, the number of mentions and a
    128-bit order-free signature.
    """
    signature = ["degree", "total", "first", "last", "sig1", "sig2"]
    per_doc = counts.groupBy("pmid").agg(
        F.count(F.lit(1)).alias("degree"),
        F.sum("mentions").alias("total"),
        F.min("wiki_id").alias("first"),
        F.max("wiki_id").alias("last"),
        F.bit_xor(F.xxhash64("wiki_id", "mentions")).alias("sig1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "mentions", "wiki_id")).alias("sig2"),
    )
    reps = per_doc.groupBy(*signature).agg(F.min("pmid").alias("pmid"), F.count(F.lit(1)).alias("copies"))
    return reps.select("pmid", "degree", "copies", *signature[1:])


def document_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(pmid, wiki_id, was, now, degree, degree0, degree1, copies): documents before and after a change, given their counts.

    ``was`` and ``now`` are the mentions, 0 where a document does not name the entity; ``degree`` counts the entities of both, ``degree0`` and ``degree1``
    those of each. One document stands for all that change alike, so a pair of a document is formed once for both states.
    """
    none = F.lit(0).cast("bigint")
    rows = before.select("pmid", "wiki_id", F.col("mentions").alias("was"), none.alias("now")).unionByName(
        after.select("pmid", "wiki_id", none.alias("was"), F.col("mentions").alias("now"))
    )
    both = materialize(rows.groupBy("pmid", "wiki_id").agg(F.sum("was").alias("was"), F.sum("now").alias("now")), "both")
    signature = ["degree", "degree0", "degree1", "first", "last", "sig1", "sig2"]
    per_doc = both.groupBy("pmid").agg(
        F.count(F.lit(1)).alias("degree"), F.count_if(F.col("was") > 0).alias("degree0"), F.count_if(F.col("now") > 0).alias("degree1"),
        F.min("wiki_id").alias("first"), F.max("wiki_id").alias("last"),
        F.bit_xor(F.xxhash64("wiki_id", "was", "now")).alias("sig1"), F.bit_xor(F.xxhash64(F.lit("second"), "now", "was", "wiki_id")).alias("sig2"),
    )
    reps = per_doc.groupBy(*signature).agg(F.min("pmid").alias("pmid"), F.count(F.lit(1)).alias("copies"))
    return both.join(reps.select("pmid", "degree", "degree0", "degree1", "copies"), "pmid")


def changed_pairs(changes: DataFrame, block: int = 4096) -> DataFrame:
    """(wid1 < wid2, degree0, degree1, copies, was1, now1, was2, now2): all pairs of the documents in ``changes`` (``document_changes``)."""
    rows = changes.withColumns({"mentions": F.struct("was", "now"), "copies": F.struct("copies", "degree0", "degree1"), "docs": F.lit(1)})
    return profile_pairs(rows, block).select(
        "wid1", "wid2", "copies.*", F.col("m1.was").alias("was1"), F.col("m1.now").alias("now1"), F.col("m2.was").alias("was2"), F.col("m2.now").alias("now2")
    )


def entity_degrees(counts: DataFrame) -> DataFrame:
    """(wiki_id, docs): number of documents per entity."""
    return counts.groupBy("wiki_id").agg(F.count(F.lit(1)).alias("docs"))


def weighted_profiles(counts: DataFrame) -> DataFrame:
    """(pmid, wiki_id, mentions, degree, copies, docs) for one document of each profile."""
    reps = document_profiles(counts).select("pmid", "degree", "copies")
    return counts.join(reps, "pmid").join(entity_degrees(counts), "wiki_id")


def stored_profiles(counts: DataFrame) -> DataFrame:
    return materialize(weighted_profiles(counts), "profiles")


def profile_pairs(profiles: DataFrame, block: int = 4096) -> DataFrame:
    """All pairs wid1 < wid2 inside each document, with the columns of both ends.

    A document of degree d is laid out as a grid of ceil(d / block) x ceil(d / block) cells: the left copy of
    an entity goes to its row of cells, the right copy to its column of cells, and the
    equi-join on (pmid, cell) meets every pair exactly once.
    """
    blocks = F.ceil(F.col("degree") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("wiki_id"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    left = profiles.select(
        "pmid", "degree", "copies", F.col("wiki_id").alias("wid1"), F.col("mentions").alias("m1"),
        F.col("docs").alias("docs1"), own.alias("_i"), other.alias("_j"),
    )
    right = profiles.select(
        "pmid", F.col("wiki_id").alias("wid2"), F.col("mentions").alias("m2"),
        F.col("docs").alias("docs2"), own.alias("_j"), other.alias("_i"),
    )
    return left.join(right, ["pmid", "_i", "_j"]).where(F.col("wid1") < F.col("wid2")).drop("_i", "_j")


def pair_table(profiles: DataFrame, block: int = 4096) -> DataFrame:
    """(wid1 < wid2, shared, freq, docs1, docs2): everything the scores need about a pair.

    ``shared`` sums mentions1 * mentions2 / degree over the common documents, ``freq`` is the number of common
    documents, ``docs1`` and ``docs2`` the degrees of the two entities. The degrees travel with
    the rows of the (smaller) document-entity table, so the pair table is shuffled once.
    """
    return profile_pairs(profiles, block).groupBy("wid1", "wid2").agg(
        F.sum(F.col("copies") * F.col("m1") * F.col("m2") / F.col("degree")).alias("shared"),
        F.sum("copies").alias("freq"),
        F.max("docs1").alias("docs1"),
        F.max("docs2").alias("docs2"),
    )


def stored_pairs(profiles: DataFrame, block: int = 4096) -> DataFrame:
    return materialize(pair_table(profiles, block), "pairs")


def _projection(shared: Column, docs_from: Column, docs_to: Column, alpha: float) -> Column:
    return shared * F.pow(F.lit(1.0) / docs_from, F.lit(alpha)) * F.pow(F.lit(1.0) / docs_to, F.lit(1.0 - alpha))


def _directed(pairs: DataFrame, alpha: float, *extra: str) -> DataFrame:
    """Both directions of every pair with the projection weight ``w``."""
    shared, docs1, docs2 = F.col("shared"), F.col("docs1"), F.col("docs2")
    forward = F.struct(
        F.col("wid1").alias("wid1"), F.col("wid2").alias("wid2"), _projection(shared, docs1, docs2, alpha).alias("w")
    )
    backward = F.struct(
        F.col("wid2").alias("wid1"), F.col("wid1").alias("wid2"), _projection(shared, docs2, docs1, alpha).alias("w")
    )
    return pairs.select(F.inline(F.array(forward, backward)), *extra)


def _own_weights(profiles: DataFrame, alpha: float) -> DataFrame:
    """(wid1, w): each entity's weight with itself."""
    square = F.col("copies") * F.col("mentions") * F.col("mentions") / F.col("degree")
    return (
        profiles.groupBy("wiki_id")
        .agg(F.sum(square).alias("shared"), F.max("docs").alias("docs"))
        .select(
            F.col("wiki_id").alias("wid1"),
            _projection(F.col("shared"), F.col("docs"), F.col("docs"), alpha).alias("w"),
        )
    )


def _row_maxima(profiles: DataFrame, pairs: DataFrame, alpha: float) -> DataFrame:
    """(wid1, w_max): the largest weight of each row, the entity's weight with itself included."""
    own = _own_weights(profiles, alpha)
    others = _directed(pairs, alpha).select("wid1", "w")
    return own.unionByName(others).groupBy("wid1").agg(F.max("w").alias("w_max"))


def _with_row_maxima(profiles: DataFrame, pairs: DataFrame, alpha: float, *extra: str) -> DataFrame:
    """Both directions of every pair with ``w``, ``extra`` and ``w_max``, the largest weight of row wid1, the entity's weight with itself included.

    Rows go to the task of their wid1 once, where the maximum is found and where a ranking within wid1 can follow. A row has one cell per
    entity at most, whatever the number of documents.
    """
    rows = _directed(pairs, alpha, *extra).unionByName(_own_weights(profiles, alpha), allowMissingColumns=True)
    top = F.max("w").over(Window.partitionBy("wid1"))
    return rows.withColumn("w_max", top).where(F.col("wid2").isNotNull())


def dt_hybrid(profiles: DataFrame, pairs: DataFrame, alpha: float = 0.5) -> DataFrame:
    """(wid1, wid2, w_norm): degree-normalised bipartite projection, both directions, no diagonal.

    W(i, j) = shared(i, j) * docs(i)^-alpha * docs(j)^(alpha - 1), divided by the largest W of row i
    (diagonal included). ``pairs`` is the pair table of ``profiles``.
    """
    return _with_row_maxima(profiles, pairs, alpha).select("wid1", "wid2", (F.col("w") / F.col("w_max")).alias("w_norm"))


def edge_scores(profiles: DataFrame, pairs: DataFrame, n_docs: Column, alpha: float = 0.5) -> DataFrame:
    """(wid1, wid2, w_norm, relatedness, freq), both directions: the three scores of each edge in one table."""
    scored = pairs.withColumn("relatedness", _relatedness(n_docs))
    return _with_row_maxima(profiles, scored, alpha, "relatedness", "freq").select(
        "wid1", "wid2", (F.col("w") / F.col("w_max")).alias("w_norm"), "relatedness", "freq"
    )


def pair_freq(pairs: DataFrame) -> DataFrame:
    """(wid1 < wid2, freq): number of documents naming both entities."""
    return pairs.select("wid1", "wid2", "freq")


def pair_evidence(counts: DataFrame, n: int = 10, block: int = 4096) -> DataFrame:
    """(wid1, wid2, pmid): the ``n`` newest documents of each pair, newest meaning the largest pmid.

    Documents with the same entity set support the same pairs, so only the ``n`` newest of each set are paired.
    """
    signature = ["degree", "first", "last", "sig1", "sig2"]
    per_doc = counts.groupBy("pmid").agg(
        F.count(F.lit(1)).alias("degree"),
        F.min("wiki_id").alias("first"),
        F.max("wiki_id").alias("last"),
        F.bit_xor(F.xxhash64("wiki_id")).alias("sig1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "wiki_id")).alias("sig2"),
    )
    newest = top_n(per_doc, signature, [F.desc("pmid")], n)
    rows = counts.join(newest.select("pmid", "degree"), "pmid").select(
        "pmid", "wiki_id", "mentions", "degree", F.lit(1).alias("copies"), F.lit(1).alias("docs")
    )
    pairs = profile_pairs(rows, block).select("wid1", "wid2", "pmid")
    return top_n(pairs, ["wid1", "wid2"], [F.desc("pmid")], n)


def surface_forms(annotations: DataFrame) -> DataFrame:
    """(wiki_id, spot): the distinct surface forms of each entity."""
    return annotations.select("wiki_id", "spot").distinct()


def corpus_size(counts: DataFrame) -> Column:
    """Number of documents, as a scalar subquery."""
    return counts.select(F.count_distinct("pmid")).scalar()


def _relatedness(total: Column) -> Column:
    larger, smaller = F.greatest("docs1", "docs2"), F.least("docs1", "docs2")
    spread = F.ln(total) - F.ln(smaller)
    distance = (F.ln(larger) - F.ln("freq")) / spread
    return F.when(spread == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - distance))


def relatedness(pairs: DataFrame, n_docs: Column) -> DataFrame:
    """(wid1, wid2, relatedness): link-based relatedness of each co-occurring pair, in [0, 1].

    With document sets A and B in a corpus of N documents (Milne and Witten 2008):
    1 - (ln max(|A|, |B|) - ln |A and B|) / (ln N - ln min(|A|, |B|)), not below 0, and 1 when the
    rarer entity is in every document. ``n_docs`` is N, a literal or ``corpus_size(...)``.
    """
    return pairs.select("wid1", "wid2", _relatedness(n_docs).alias("relatedness"))


def document_pair_freq(counts: DataFrame, block: int = 4096) -> DataFrame:
    """``pair_freq`` straight from stored ``counts``: without weights, entities need not meet their degrees first."""
    reps = document_profiles(counts).select("pmid", "degree", "copies")
    rows = materialize(counts.join(reps, "pmid").withColumn("docs", F.lit(1)), "profiles")
    return profile_pairs(rows, block).groupBy("wid1", "wid2").agg(F.sum("copies").alias("freq"))


def unscored_pairs(pairs: DataFrame, scored: DataFrame) -> DataFrame:
    """Pairs that have no relatedness yet."""
    return pairs.join(scored.select("wid1", "wid2"), ["wid1", "wid2"], "left_anti")


def best(scores: DataFrame, score: Column, n: int) -> DataFrame:
    """Best ``n`` rows per wid1; scores equal to RANK_DIGITS digits are ties, won by the smaller wid2."""
    key = F.when(score > 0, F.floor(F.ln(score) * F.lit(10.0**RANK_DIGITS) + F.lit(0.5)))
    ranked = scores.withColumn("_key", key)
    return top_n(ranked, ["wid1"], [F.col("_key").desc_nulls_last(), F.col("wid2")], n).drop("_key")


def predict(w_norm: DataFrame, rel: DataFrame, freq: DataFrame, n: int = 500) -> DataFrame:
    """(wid1, wid2, score): product of the three stored scores, best ``n`` per wid1.

    ``w_norm`` is directed; ``rel`` and ``freq`` are half matrices and are mirrored here, after they
    have met.
    """
    evidence = symmetrize(rel.join(freq, ["wid1", "wid2"]), "wid1", "wid2")
    score = F.col("w_norm") * F.col("relatedness") * F.col("freq")
    scored = w_norm.join(evidence, ["wid1", "wid2"]).select("wid1", "wid2", score.alias("score"))
    return best(scored, F.col("score"), n)


def predict_from_pairs(
    profiles: DataFrame, pairs: DataFrame, n_docs: Column, alpha: float = 0.5, n: int = 500
) -> DataFrame:
    """Same result as ``predict`` straight from the pair table, without joining three edge tables.

    The row maximum is one number per wid1, so the order inside a row is known before the division:
    the cut to ``n`` happens in the map tasks and only the kept rows meet the maxima.
    """
    evidence = pairs.withColumn("evidence", _relatedness(n_docs) * F.col("freq"))
    raw = _directed(evidence, alpha, "evidence").select(
        "wid1", "wid2", (F.col("w") * F.col("evidence")).alias("raw")
    )
    return (
        best(raw, F.col("raw"), n)
        .join(_row_maxima(profiles, pairs, alpha), "wid1")
        .select("wid1", "wid2", (F.col("raw") / F.col("w_max")).alias("score"))
    )


def predict_edges(edges: DataFrame, n: int = 500) -> DataFrame:
    """Same result as ``predict`` from the one table of ``edge_scores``."""
    score = F.col("w_norm") * F.col("relatedness") * F.col("freq")
    return best(edges.select("wid1", "wid2", score.alias("score")), F.col("score"), n)
