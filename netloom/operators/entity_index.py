"""One index per entity type from several sources that share aliases or cross-references.

An index is kept in long form: one row per (entity, alias) and one per (entity, source id). That is the form every
later join needs, and it has no cell that grows with the data. ``nested`` gives the one-row-per-entity
table with arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.functions.ids import ID_PREFIX, entity_id, lengthened, packed, shortened, unpacked
from netloom.operators.setops import union_all
from netloom.session import materialize


@dataclass(frozen=True)
class EntityIndex:
    """``aliases``: IDX, NAME, TYPE, alias. ``source_ids``: IDX, NAME, TYPE, SOURCE_ID. Ids that follow from ``prefix``, the type and a name are
    shuffled without their digest; others are possible."""

    type_name: str
    aliases: DataFrame
    source_ids: DataFrame
    prefix: str = ID_PREFIX

    def nested(self) -> DataFrame:
        """(IDX, <type>_name, other_name, SOURCE_ID) with sorted arrays of distinct values.

        Both long tables are distinct already; an array cell holds one entity's values.
        """
        keys = ["IDX", "NAME"]
        both = union_all(
            [self.aliases.select(*keys, "alias"), self.source_ids.select(*keys, "SOURCE_ID")], allow_missing=True
        )
        return both.groupBy(*keys).agg(
            F.sort_array(F.collect_list("alias")).alias("other_name"),
            F.sort_array(F.collect_list("SOURCE_ID")).alias("SOURCE_ID"),
        ).select("IDX", F.col("NAME").alias(f"{self.type_name.lower()}_name"), "other_name", "SOURCE_ID")

    @staticmethod
    def from_nested(df: DataFrame, type_name: str) -> EntityIndex:
        """Long form of a stored nested index."""
        base = df.select(
            "IDX", F.col(f"{type_name.lower()}_name").alias("NAME"), F.lit(type_name).alias("TYPE"),
            "other_name", "SOURCE_ID",
        )
        keys = ["IDX", "NAME", "TYPE"]
        return EntityIndex(
            type_name,
            base.select(*keys, F.explode("other_name").alias("alias")),
            base.select(*keys, F.explode("SOURCE_ID").alias("SOURCE_ID")),
        )

    def stored(self) -> EntityIndex:
        """The index read from stored tables, in which an id that follows from its name is left out."""
        def kept(rows: DataFrame, label: str) -> DataFrame:
            short = materialize(rows.withColumn("IDX", shortened(F.col("IDX"), self.type_name, F.col("NAME"), self.prefix)), label)
            return short.withColumn("IDX", lengthened(F.col("IDX"), self.type_name, F.col("NAME"), self.prefix))

        return EntityIndex(self.type_name, kept(self.aliases, "aliases"), kept(self.source_ids, "source-ids"), self.prefix)


def _source_rows(sources: Sequence[DataFrame]) -> DataFrame:
    """(src, id, name, alias) of all sources; each source has columns id, name, other_name in this order. Ids are packed."""
    frames = []
    for number, df in enumerate(sources):
        id_col, name, alias = df.columns[:3]
        frames.append(
            df.select(
                F.lit(number).alias("src"),
                F.col(id_col).cast("string").alias("id"),
                F.col(name).alias("name"),
                F.col(alias).alias("alias"),
            )
        )
    return union_all(frames).where(F.col("id").isNotNull()).withColumn("id", packed(F.col("id"))).distinct()


def _memberships(rows: DataFrame, n_sources: int) -> DataFrame:
    """(src, id, lead_src, lead_id): which leading ids each source id belongs to.

    The sources are taken in order. In its round, every id of a source that is not attached yet leads a
    cluster, and the ids of later sources that are not attached yet and share an alias with it
    join that cluster: one hop, no closure. An id can join several clusters.
    """
    rounds: list[DataFrame] = []
    for lead in range(n_sources):
        free = rows.where(F.col("src") >= lead).select("src", "id", "alias")
        if rounds:
            free = free.join(union_all(rounds).select("src", "id").distinct(), ["src", "id"], "left_anti")
        leaders = free.where(F.col("src") == lead)
        found = leaders.select(
            "src", "id", F.col("src").alias("lead_src"), F.col("id").alias("lead_id")
        ).distinct()
        if lead < n_sources - 1:
            followers = free.where(F.col("src") > lead)
            attached = (
                leaders.select("alias", F.col("id").alias("lead_id")).distinct().join(followers, "alias")
                .select("src", "id", F.lit(lead).alias("lead_src"), "lead_id")
                .distinct()
            )
            found = materialize(found.unionByName(attached), "members")
        rounds.append(found)
    return union_all(rounds)


def unnamed(source: str, id_col: str) -> Column:
    """Key of a cluster without a name: its leading id. Null for one with a name."""
    return F.when(F.col("NAME").isNull(), F.concat_ws(":", F.col(source).cast("string"), unpacked(F.col(id_col))))


def build_index(type_name: str, sources: Sequence[DataFrame], prefix: str = ID_PREFIX) -> EntityIndex:
    """Resolve the aliases of several sources into one index.

    Each source is a frame of (id, name, other_name). A cluster takes the smallest of its names; clusters
    with the same name become one entity, whose id is derived from that name. A cluster without a name is an entity of its
    own, with an id from its leading id.
    Names are settled before aliases are attached, so merged clusters are expanded once.
    """
    rows = materialize(_source_rows(sources), "source-rows")
    names = rows.groupBy("src", "id").agg(F.min("name").alias("NAME"))
    if len(sources) > 1:
        member = _memberships(rows, len(sources))
        cluster_names = (
            member.join(names, ["src", "id"]).groupBy("lead_src", "lead_id").agg(F.min("NAME").alias("NAME"))
        )
        names = member.join(cluster_names, ["lead_src", "lead_id"]).select(
            "NAME", unnamed("lead_src", "lead_id").alias("_lead"), "src", "id"
        ).distinct()
        names = materialize(names, "entities")
    else:
        names = names.withColumn("_lead", unnamed("src", "id"))
    by_name, by_lead = (
        entity_id(type_name, *parts, prefix=prefix) for parts in ([F.col("NAME")], [F.lit(""), F.col("_lead")])
    )
    # The id follows from the name or the leading id, so rows are made distinct without it.
    keys = [
        F.when(F.col("NAME").isNotNull(), by_name).otherwise(by_lead).alias("IDX"), F.col("NAME"), F.lit(type_name).alias("TYPE")
    ]
    known = rows.where(F.col("alias").isNotNull()).select("src", "id", "alias")
    return EntityIndex(
        type_name,
        known.join(names, ["src", "id"]).select("NAME", "_lead", "alias").distinct().select(*keys, "alias"),
        names.select("NAME", "_lead", "id").distinct().select(*keys, unpacked(F.col("id")).alias("SOURCE_ID")),
        prefix,
    )


def cross_reference_pairs(
    left_ids: DataFrame, right_ids: DataFrame, left_refs: DataFrame, right_refs: DataFrame
) -> DataFrame:
    """(left_id, right_id): pairs asserted by either source, plus the ids neither source pairs."""
    key = ["left_id", "right_id"]
    # Read three times; without this the references would be put together each time.
    asserted = materialize(left_refs.select(*key).unionByName(right_refs.select(*key)).distinct(), "asserted")
    alone = [
        ids.select(own).distinct().join(asserted.select(own).distinct(), own, "left_anti")
        for ids, own in ((left_ids, "left_id"), (right_ids, "right_id"))
    ]
    # The same rows as two full joins, but an id with very many references is never joined on its pairs.
    return union_all([asserted, *alone], allow_missing=True).select(*key)


def _same_id(pairs: DataFrame, idx: Column) -> DataFrame:
    """``pairs`` (left_id, right_id, NAME, ...) with ``_clash``: whether another pair has the same id; such pairs take the smallest of their names.

    An id is made of the text of its pair. That of two ids that are neither empty nor hold the separator is its own; only the
    others, of which most are ids without a counterpart, are compared.
    """
    own = F.lit(True)
    for side in ("left_id", "right_id"):
        text = F.col(side).cast("string")
        own = own & F.coalesce((text != "") & ~text.contains("|"), F.lit(False))
    same = Window.partitionBy("_idx")
    others = pairs.where(~own).withColumn("_idx", idx).withColumns(
        {"NAME": F.min("NAME").over(same), "_clash": F.count(F.lit(1)).over(same) > 1}
    ).drop("_idx")
    return pairs.where(own).withColumn("_clash", F.lit(False)).unionByName(others)


def build_index_by_xref(
    type_name: str,
    left: DataFrame,
    right: DataFrame,
    left_refs: DataFrame,
    right_refs: DataFrame,
    prefix: str = ID_PREFIX,
) -> EntityIndex:
    """Index of two sources that reference each other's ids.

    ``left`` and ``right`` are (id, name, other_name); the reference tables are (left_id, right_id). Every pair is an
    entity of its own, so an id with several counterparts is part of several entities.

    What an id has to give is settled per id, before it meets the pairs: the name of an entity is the smaller of two, and
    an alias can only repeat in an entity if both sources know it.
    """
    pairs = cross_reference_pairs(
        left.select(F.col(left.columns[0]).alias("left_id")),
        right.select(F.col(right.columns[0]).alias("right_id")),
        left_refs,
        right_refs,
    )
    aliases = {}
    for df, key in ((left, "left_id"), (right, "right_id")):
        id_col, name, alias = df.columns[:3]
        own = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(key), F.col(name).alias(f"_{key}_name"), F.col(alias).alias("alias"))
        names = own.groupBy(key).agg(F.min(f"_{key}_name").alias(f"_{key}_name")).withColumn(f"_{key}_known", F.lit(True))
        pairs = pairs.join(names, key, "left")
        aliases[key] = own.select(key, "alias").where(F.col("alias").isNotNull()).distinct()
    named = pairs.select(
        "left_id", "right_id", F.least("_left_id_name", "_right_id_name").alias("NAME"),
        *[F.coalesce(F.col(f"_{key}_known"), F.lit(False)).alias(f"_{key}_known") for key in aliases],
    ).where(F.col("_left_id_known") | F.col("_right_id_known"))
    # The id of an entity is derived from its pair where it is read, so that it is neither written nor shuffled.
    idx = entity_id(type_name, F.col("left_id"), F.col("right_id"), prefix=prefix)
    named = materialize(_same_id(named, idx), "xref")
    entity = [idx.alias("IDX"), F.col("NAME"), F.lit(type_name).alias("TYPE")]

    shared = aliases["left_id"].select("alias").distinct().join(aliases["right_id"], "alias", "left_semi").withColumn("_shared", F.lit(True))
    rows = []
    for key, own in aliases.items():
        own = materialize(own.join(shared, "alias", "left").withColumn("_shared", F.coalesce("_shared", F.lit(False))), "xref-aliases")
        # A sum, so that the condition stays behind the join and all its readers share the exchange of the pairs.
        repeats = F.col("_shared").cast("int") + F.col("_clash").cast("int") > 0
        rows.append(named.where(F.col(f"_{key}_known")).join(own, key).select(*entity, "alias", repeats.alias("_repeats")))
    found = union_all(rows)
    known = [F.when(F.col(f"_{key}_known"), F.col(key)) for key in aliases]
    second = F.when(known[1].eqNullSafe(known[0]), F.lit(None)).otherwise(known[1])
    ids = named.select(*entity, F.explode(F.array(known[0], second)).alias("SOURCE_ID"), "_clash").where(F.col("SOURCE_ID").isNotNull())
    return EntityIndex(
        type_name,
        found.where(~F.col("_repeats")).drop("_repeats").unionByName(found.where("_repeats").drop("_repeats").distinct()),
        ids.where(~F.col("_clash")).drop("_clash").unionByName(ids.where("_clash").drop("_clash").distinct()),
    )
