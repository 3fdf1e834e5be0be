"""Document fingerprints from spot signatures, and the likeness of documents by them.

A spot is a common word (the anchor). Its signature is the anchor with the chain of the next content words behind it, other common
words left out. A long stretch of words without an anchor has its runs of words as signatures, whatever else is in the text, so a stretch
that two texts share has the same signatures in both. A document's fingerprint is its set of signatures as sorted 64-bit hashes. The likeness of two
fingerprints is their Jaccard coefficient; where only likenesses of at least some bound count, it is pruned by the sets' lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.llm.columns import column, let, whole_text
from netloom.session import Stages

# Common words of English, German, French and Spanish that serve as anchors.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were will with "
    "als auf das dem den der des die ein eine für im ist mit nicht sich sie und von zu "
    "au avec ce dans de du elle en est et il la le les ne par pas pour que qui sur un une "
    "como con del el es la las lo los no para por se su una y"
).split()
CHAIN = 2
# Words in a row without an anchor from which on a stretch has signatures of its own.
STRETCH = 32


def signatures(text: Column) -> Column:
    """Sorted distinct hashes of a text's spot signatures.

    A stretch of at least ``STRETCH`` words without an anchor adds the runs of words inside it. A shorter text without anchors before
    content words has all its runs of words as signatures, a text without words the text itself.
    """
    words = F.split(F.regexp_replace(F.lower(text), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), r"[^\p{L}\p{N}]+")

    def of_words(w: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.get(w, i).isin(ANCHORS))

        def of_places(p: Column) -> Column:
            def spots(at: Column, n: Column) -> Column:
                before = F.coalesce(F.get(p, n - 1), F.lit(-1))
                chain = [F.get(w, F.get(p, n + k)) for k in range(CHAIN)]
                return F.when(
                    at - before > 1, F.transform(F.sequence(before + 1, at - 1), lambda a: F.xxhash64(F.get(w, a), *chain))
                )

            # The n-th content word and the STRETCH - 1 behind it, none left out between, are in a long stretch, and so are their runs.
            def long_from(n: Column) -> Column:
                return F.coalesce(F.get(p, n + STRETCH - 1) - F.get(p, n) == STRETCH - 1, F.lit(False))

            def stretches(at: Column, n: Column) -> Column:
                first = F.when(n == 0, F.lit(True)).otherwise(~long_from(n - 1))
                length = F.when(first, F.lit(STRETCH - CHAIN)).otherwise(F.lit(1))
                return F.when(long_from(n), F.transform(
                    F.sequence(at + STRETCH - CHAIN - length, at + STRETCH - CHAIN - 1),
                    lambda a: F.xxhash64(*[F.get(w, a + k) for k in range(CHAIN + 1)]),
                ))

            def known(parts: Column) -> Column:
                return F.flatten(F.filter(parts, lambda x: x.isNotNull()))

            # Without spots all runs are taken, and those of the long stretches are among them.
            return let(known(F.transform(p, spots)), lambda s: F.when(F.size(s) > 0, F.concat(s, known(F.transform(p, stretches)))).otherwise(s))

        runs = F.transform(w, lambda x, n: F.xxhash64(x, *[F.get(w, n + k) for k in range(1, CHAIN + 1)]))
        return let(places, of_places), runs

    def chosen(w: Column) -> Column:
        spots, runs = of_words(w)
        return let(spots, lambda s: F.when(F.size(s) > 0, s).when(F.get(w, F.lit(0)) != "", runs).otherwise(F.array(F.xxhash64(text))))

    return F.array_sort(F.array_distinct(let(words, chosen)))


def as_string(values: Column) -> Column:
    """A fingerprint as text: its hashes in hexadecimal, in order."""
    return F.array_join(F.transform(values, F.hex), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard coefficient of two sets; 0 where the lengths alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(small < large * F.lit(least), F.lit(0.0)).otherwise(shared / (small + large - shared))


def next_keys(rows: DataFrame, stages: Stages) -> DataFrame:
    """(key, n_chars, next_key) of distinct ``rows`` (id, key, n_chars) by descending id; the first follows the last.

    Ordered by one range exchange of the keys; inside a task's run the next row is looked up by a window over that run, and the
    first rows of the runs, one per task, link the runs.
    """
    order = [F.col("id").desc_nulls_last(), F.col("key")]
    placed = stages.store(
        "order",
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        .withColumn("run", F.shiftright("at", 33)),
    )
    runs = placed.groupBy("run").agg(F.min(F.struct("at", "key"))["key"].alias("head"))
    following = Window.orderBy("run")
    whole = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.select("run", F.coalesce(F.lead("head").over(following), F.first("head").over(whole)).alias("after"))
    return placed.withColumn("next", F.lead("key").over(Window.partitionBy("run").orderBy("at"))).join(
        F.broadcast(runs), "run"  # one row per task of the range exchange
    ).select("key", "n_chars", F.coalesce("next", "after").alias("next_key"))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key) of every row of ``docs``; the key tells (id, text) apart."""
    rows = docs.select(column(docs, id_col).alias("id"), whole_text(docs, text_col).alias("text"))
    name = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("-")), F.lit(":"), "text")
    return rows.select("id", "text", F.sha2(name, 256).alias("key"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, text, signatures) of every row of ``docs``."""
    rows = keyed_texts(docs, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), "text", signatures(F.col("text")).alias("signatures"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and its likeness to that and to the next document.

    Edited: the last floor(n_chars / 3) code points give way to the first as many of the next document by descending id. Rows that
    agree in id and text take one place in that order and have the same results. A null id comes last; null texts
    count as empty. A single document is its own next. An empty table gives an empty result; other columns are not read.
    """
    stages = Stages(docs.sparkSession, "spots")
    light = stages.store(
        "keys", keyed_texts(docs, id_col, text_col).select("id", "key", F.char_length("text").cast("long").alias("n_chars"))
    )
    distinct = light.distinct()
    repeated = light.count() > distinct.count()
    following = stages.store("next", next_keys(distinct, stages))
    stages.drop("keys", "order")

    # Both joins below shuffle the same rows by the same key, which Spark does once.
    rows = keyed_texts(docs, id_col, text_col)
    sources = rows.dropDuplicates(["key"]) if repeated else rows
    heads = sources.join(following.withColumnRenamed("key", "own_key"), F.col("key") == F.col("next_key")).select(
        F.col("own_key").alias("own"), F.col("id").alias("next_id"),
        F.left("text", F.floor(F.col("n_chars") / 3).cast("int")).alias("head"), signatures(F.col("text")).alias("next_signatures"),
    )
    length = F.char_length("text")
    both = rows.join(heads, F.col("key") == F.col("own")).select(
        "id", "next_id", length.cast("long").alias("n_chars"), "next_signatures", signatures(F.col("text")).alias("signatures"),
        F.concat(F.left("text", (length - F.floor(length / 3)).cast("int")), "head").alias("edited"),
    )
    both = both.withColumn("edited_signatures", signatures(F.col("edited")))
    return both.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("signatures")).alias("fingerprint"), as_string(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"), "next_id",
    )
