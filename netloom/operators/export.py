"""Node, edge, alias, title and evidence tables for graph and relational stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from netloom.operators.joins import full_join
from netloom.operators.setops import union_all, union_distinct

NODE_KEY = ["IDX", "NAME", "TYPE"]


def merge_nodes(node_tables: Sequence[DataFrame]) -> DataFrame:
    """(id, name, label): every node of every table, once.

    A full join on all three columns keeps exactly their distinct combinations.
    """
    nodes = union_distinct([t.select(*NODE_KEY) for t in node_tables])
    return nodes.select(F.col("IDX").alias("id"), F.col("NAME").alias("name"), F.col("TYPE").alias("label"))


def node_entities(node_tables: Sequence[DataFrame], matches: DataFrame) -> DataFrame:
    """(id, wiki_id): the matched entities of each node; null for a node without a match.

    Nodes without a match are found by an anti-join on distinct nodes, so a node with very many matches stays spread.
    """
    nodes = union_distinct([t.select(*NODE_KEY) for t in node_tables])
    matched = matches.select(*NODE_KEY, "wiki_id").join(nodes, NODE_KEY, "left_semi")
    alone = nodes.join(matches.select(*NODE_KEY).distinct(), NODE_KEY, "left_anti")
    rows = union_all([matched, alone], allow_missing=True)
    return rows.select(F.col("IDX").alias("id"), "wiki_id").distinct()


def merge_edges(predicted: DataFrame, interactions: DataFrame, literature: DataFrame) -> DataFrame:
    """(IDX1, IDX2, prediction_score, interaction_score, literature): all edges, missing evidence as 0."""
    key = ["IDX1", "IDX2"]
    joined = full_join(
        [
            predicted.select(*key, F.col("score").cast("double").alias("prediction_score")),
            interactions.select(*key, F.col("score").cast("double").alias("interaction_score")),
            literature.select(*key, F.lit(1).alias("literature")),
        ],
        key,
    )
    return joined.select(
        *key,
        F.coalesce("prediction_score", F.lit(0.0)).alias("prediction_score"),
        F.coalesce("interaction_score", F.lit(0.0)).alias("interaction_score"),
        F.coalesce("literature", F.lit(0)).alias("literature"),
    )


def name_aliases(alias_tables: Sequence[DataFrame], nodes: DataFrame) -> DataFrame:
    """(id, alias, label): aliases of the exported nodes."""
    aliases = union_all([t.select(F.col("IDX").alias("id"), "alias") for t in alias_tables]).distinct()
    return aliases.join(nodes.select("id", "label").distinct(), "id").select("id", "alias", "label").distinct()


def entity_titles(annotations: DataFrame) -> DataFrame:
    """(wiki_id, title), distinct."""
    return annotations.select("wiki_id", "title").distinct()
