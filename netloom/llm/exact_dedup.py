"""Exact duplicates by deterministic block naming.

The normal form of a text (all ASCII white space deleted) is cut into blocks of a fixed number of code points. The distinct
blocks are sorted and numbered, so equal blocks, and only they, share an integer name. Then adjacent names of a document
are paired, the distinct pairs are sorted and numbered, and so on, until each document has one name. Two texts are equal
exactly when they end on the same level with the same name.

The sort key of a block is a 128-bit hash with the content behind it: the contents are shuffled once, each distinct content
once per map task, and counted per key. If two contents ever shared a key, the pass is repeated with another seed, so the
names never rest on a hash being free of collisions. All other steps move integers.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.llm.columns import SPACE, column, whole_text
from netloom.session import Stages

# Names are numbered in so many ranges of the sort key at once.
RANGES_LOG2 = 12


def normal_form(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+", "")


def text_blocks(text: Column, block: int) -> Column:
    """The text cut into blocks of ``block`` code points; the last one may be shorter, an empty text has none."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))


def block_key(seed: int):
    """Function from a block to its 128-bit sort key. It takes one argument: a second one would be given the block's place."""
    return lambda b: F.struct(F.xxhash64(F.lit(seed), b).alias("k1"), F.xxhash64(b, F.lit(seed)).alias("k2"))


def numbered(stages: Stages, name: str, keys: DataFrame, columns: list[str], leading: Column) -> DataFrame:
    """``keys`` (distinct) with their 1-based rank in the order of (range of ``leading``, columns) as ``name``.

    Every range is sorted on its own; the ranges' sizes, at most 2 ** RANGES_LOG2 rows, give the offsets.
    """
    cut = F.shiftright(leading, 64 - RANGES_LOG2)
    ranked = stages.store(
        name,
        keys.withColumn("_range", cut).withColumn(
            "_rank", F.row_number().over(Window.partitionBy("_range").orderBy(*columns))
        ),
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return ranked.join(F.broadcast(offsets), "_range").select(
        *columns, (F.col("_offset") + F.col("_rank")).alias("name")
    )


def named_rows(rows: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """(rid, names) with each document's names in order. Only the join sees a hot key, and it can be split."""
    return rows.join(names, on).groupBy("rid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 2048) -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and whether it is the one that stays.

    Columns: ``id_col``, ``keep_id``, ``group_size`` long, ``kept`` boolean, ``text_sha256`` of the normal form, ``original_sha256``
    of the text as it is, ``n_chars``, ``level`` and ``name`` (the identity of the text).

    Texts are equal when identical after deleting all ASCII white space. The row with the most code points stays, then the
    smallest id (null last), then the smallest digest of the original text; of fully equal rows exactly one stays.
    Null and empty texts, and texts of white space only, are one group with identity (0, 0). An empty table gives an
    empty result. Other columns of ``docs``, whatever their names, are not read.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "exact")
    raw = docs.select(column(docs, id_col).alias("id"), whole_text(docs, text_col).alias("text"))
    cut = raw.select("id", "text", normal_form(F.col("text")).alias("norm"))

    for seed in count():
        key = block_key(seed)
        base = stages.store(
            "base",
            cut.select(
                F.monotonically_increasing_id().alias("rid"), "id", F.char_length("text").cast("long").alias("n_chars"),
                F.sha2("norm", 256).alias("text_sha256"), F.sha2("text", 256).alias("original_sha256"),
                F.transform(text_blocks(F.col("norm"), block), key).alias("keys"),
            ),
        )
        contents = cut.select(F.explode(text_blocks(F.col("norm"), block)).alias("block"))
        contents = contents.select(key(F.col("block")).alias("key"), "block").select("key.k1", "key.k2", "block").distinct()
        keys = stages.store("keys", contents.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("contents")))
        if keys.where("contents > 1").isEmpty():
            break

    names = numbered(stages, "ranked", keys.select("k1", "k2"), ["k1", "k2"], F.col("k1"))
    blocks = base.select("rid", F.posexplode("keys").alias("pos", "key")).select("rid", "pos", "key.k1", "key.k2")
    longest = base.agg(F.max(F.size("keys"))).first()[0] or 0
    finished = [base.where(F.size("keys") == 0).select("rid", F.lit(0).alias("level"), F.lit(0).cast("long").alias("name"))]
    open_rows = stages.store("open0", named_rows(blocks, names, ["k1", "k2"]))
    level = 0
    while True:
        finished.append(
            open_rows.where(F.size("names") == 1)
            .select("rid", F.lit(level + 1).alias("level"), F.element_at("names", 1).alias("name"))
        )
        if longest <= 1 << level:
            break
        level += 1
        pairs = open_rows.where(F.size("names") > 1).select(
            "rid",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.size("names"), F.lit(2)),
                    lambda i: F.struct(
                        F.element_at("names", i).alias("a"), F.coalesce(F.get("names", i), F.lit(0)).alias("b")
                    ),
                )
            ).alias("pos", "pair"),
        ).select("rid", "pos", "pair.a", "pair.b")
        names = numbered(stages, "ranked", pairs.select("a", "b").distinct(), ["a", "b"], F.xxhash64("a", "b"))
        open_rows = stages.store(f"open{level}", named_rows(pairs, names, ["a", "b"]))

    identity = finished[0]
    for part in finished[1:]:
        identity = identity.unionByName(part)
    rows = stages.store("rows", base.drop("keys").join(identity, "rid"))
    stages.drop("base", "keys", "ranked", *[f"open{n}" for n in range(level + 1)])
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("none"), "id", "original_sha256", "rid")
    groups = stages.store(
        "groups",
        rows.groupBy("level", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("level", "name", "group_size", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid")),
    )
    return rows.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        "text_sha256", "original_sha256", "n_chars", "level", "name",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, exact_groups(docs, id_col, text_col), id_col, text_col)


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (``id_col``, ``original_sha256``, ``kept``; one row per row of ``docs``) keeps.

    Rows that agree in id and text can't be told apart; where there are any, one of those that agree is kept.
    """
    keys = decided.select(F.col(id_col).alias("_id"), F.col("original_sha256").alias("_sha"), "kept")
    repeated = not keys.groupBy("_id", "_sha").count().where("count > 1").isEmpty()
    names = [f"c{n}" for n in range(len(docs.columns))]
    inner = docs.toDF(*names)
    id_inner, text_inner = (names[docs.columns.index(c)] for c in (id_col, text_col))
    kept = keys.where("kept").select(F.col("_id").alias("_kept_id"), F.col("_sha").alias("_kept_sha"))
    found = inner.withColumn("_sha", F.sha2(F.coalesce(F.col(text_inner).cast("string"), F.lit("")), 256)).join(
        kept, F.col(id_inner).eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi"
    )
    if repeated:
        found = found.dropDuplicates([id_inner, "_sha"])
    return found.select(*names).toDF(*docs.columns)
