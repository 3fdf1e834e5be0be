"""Dictionary annotation of documents and the category filter.

Spot matching follows the published method for tagging short text with encyclopedia entities (Ferragina and
Scaiella 2010): find dictionary spots, keep the longest on overlap, score by link probability and by
the coherence of an entity with the other entities of the document. Entries may have any number of words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.operators.scoring import mention_counts, profile_pairs
from netloom.operators.setops import union_all
from netloom.session import delete_at_exit, materialize, new_path

WORD = r"[\p{L}\p{N}]+"
STEP = 8  # words that a token position carries at a time


def document_text(title: Column, abstract: Column) -> Column:
    """Title and abstract on separate lines; null if either is missing."""
    return F.concat(title, F.lit("\n"), abstract)


def tokens(text: Column) -> Column:
    """Lower-case words and numbers of the whole text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def ngrams(docs: DataFrame, max_words: int, key: str = "pmid", text: str = "text") -> DataFrame:
    """(key, start, words, spot): every run of 1 to ``max_words`` tokens."""
    # Each length is built from the one before by pairing neighbours, and all are exploded once: no row carries
    # the whole text along.
    runs = docs.select(key, tokens(F.col(text)).alias("_n1"))
    for n in range(2, max_words + 1):
        shorter = F.col(f"_n{n - 1}")
        first = F.slice(shorter, 1, F.greatest(F.size(shorter) - 1, F.lit(0)))
        rest = F.slice("_n1", n, F.size("_n1"))
        runs = runs.withColumn(f"_n{n}", F.zip_with(first, rest, lambda a, b: F.concat(a, F.lit(" "), b)))

    def numbered(n: int):
        return F.transform(
            f"_n{n}", lambda w, i: F.struct(i.alias("start"), F.lit(n).alias("words"), w.alias("spot"))
        )

    return runs.select(key, F.inline(F.concat(*[numbered(n) for n in range(1, max_words + 1)])))


def best_senses(dictionary: DataFrame) -> DataFrame:
    """One entity per spot: the most common one, the smaller wiki_id on a tie."""
    sense = F.struct("wiki_id", "title", "link_probability", "categories")
    best = dictionary.groupBy("spot").agg(
        F.max_by(sense, F.struct(F.col("commonness"), -F.col("wiki_id"))).alias("_s")
    )
    return best.select("spot", "_s.*")


def entry_prefixes(dictionary: DataFrame) -> DataFrame:
    """(hash, words, entry, longer): every distinct prefix of an entry's words, whether it is an entry itself, and whether an
    entry goes on behind it. A prefix goes by its hash; what is found by it is compared as text later."""
    words = F.split("spot", " ")
    running = F.aggregate(
        words, F.array().cast("array<bigint>"),
        lambda hashes, w: F.concat(hashes, F.array(F.xxhash64(F.coalesce(F.get(hashes, F.size(hashes) - 1), F.lit(0).cast("bigint")), w))),
    )
    each = dictionary.select(F.size(words).alias("_size"), F.posexplode(running).alias("_nth", "hash"))
    size = F.col("_nth") + 1
    return each.groupBy("hash", size.alias("words")).agg(F.max(size == F.col("_size")).alias("entry"), F.max(size < F.col("_size")).alias("longer"))


def candidate_runs(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(pmid, start, words, spot): the runs of tokens that are entries, but for hash collisions.

    The dictionary is a trie laid out as tables, one per number of words. All token positions meet the first table; a position goes on to
    the next one only while the words from it on are the beginning of an entry. A table is broadcast where it is small, and joined
    otherwise. A position carries ``STEP`` words at most; the few that get past these fetch the next ones.
    """
    spark = docs.sparkSession
    path = new_path(spark, "prefixes")
    entry_prefixes(dictionary).repartitionByRange("words", "hash").write.partitionBy("words").parquet(path)
    delete_at_exit(spark, path)
    schema = "hash bigint, entry boolean, longer boolean, words int"
    trie = spark.read.schema(schema).parquet(path)
    longest = trie.agg(F.max("words")).first()[0] or 0
    # Looking up a document's positions takes far longer than moving its text, so documents are dealt evenly first.
    words = docs.select("pmid", "text").repartition(F.xxhash64("pmid", "text")).select("pmid", tokens(F.col("text")).alias("_t"))
    if longest > STEP:
        words = materialize(words.withColumn("_doc", F.monotonically_increasing_id()), "tokens")
    else:
        words = words.withColumn("_doc", F.lit(None).cast("bigint"))
    ahead = max(min(STEP, longest), 1)
    at = words.select("pmid", "_doc", F.posexplode(F.transform("_t", lambda w, i: F.slice("_t", i + 1, ahead))).alias("start", "_run"))
    open_ = at.select("*", F.lit("").alias("_head"), F.lit(0).cast("bigint").alias("_hash"))
    found = []
    for base in range(0, longest, STEP):
        steps = min(STEP, longest - base)
        met = _descend(open_, trie, base, steps)
        if longest > STEP:
            met = materialize(met, "positions")
        spot = F.concat(F.col("_head"), F.array_join(F.slice("_run", F.lit(1), F.col("_hit")), " "))
        found.append(met.select("pmid", "start", "_head", "_run", F.explode("_hits").alias("_hit")).select(
            "pmid", "start", (F.col("_hit") + base).alias("words"), spot.alias("spot")
        ))
        if base + steps == longest or met.where("_open").isEmpty():
            break
        # The words behind those that have been read.
        head = F.concat(F.col("_head"), F.array_join("_run", " "), F.lit(" "))
        open_ = met.where("_open").select("pmid", "_doc", "start", head.alias("_head"), "_hash").join(words.select("_doc", "_t"), "_doc").select(
            "pmid", "_doc", "start", F.slice("_t", F.col("start") + base + steps + 1, STEP).alias("_run"), "_head", "_hash"
        )
    return union_all(found) if found else at.select("pmid", "start", F.lit(0).alias("words"), F.lit("").alias("spot")).limit(0)


def _descend(positions: DataFrame, trie: DataFrame, base: int, steps: int) -> DataFrame:
    """Positions that meet an entry of ``base`` + 1 to ``base`` + ``steps`` words, in ``_hits``, or a prefix of all of them, ``_open``."""
    rows = positions.select("*", F.lit(True).alias("_open"), F.array().cast("array<int>").alias("_hits"))
    # A position that is done meets nothing; its key is spread, so that no partition gathers them.
    idle = F.xxhash64("pmid", "start", "_run")
    for k in range(1, steps + 1):
        word = F.get("_run", F.lit(k - 1))
        step = rows.withColumn("_open", F.col("_open") & word.isNotNull()).withColumn(
            "_hash", F.when(F.col("_open"), F.xxhash64("_hash", word)).otherwise(idle)
        )
        level = trie.where(F.col("words") == base + k).select(F.col("hash").alias("_hash"), "entry", "longer")
        joined = step.join(level, "_hash", "left")
        hit = F.col("_open") & F.coalesce("entry", F.lit(False))
        rows = joined.withColumn("_hits", F.when(hit, F.concat("_hits", F.array(F.lit(k)))).otherwise(F.col("_hits"))).withColumn(
            "_open", F.col("_open") & F.coalesce("longer", F.lit(False))
        ).drop("entry", "longer").where(F.col("_open") | (F.size("_hits") > 0))
    return rows


def longest_matches(matches: DataFrame, key: str = "pmid") -> DataFrame:
    """Distinct (key, start, words) of the matches that stay: the longest first, the earlier of equal length, and
    each only if it overlaps none that stays already.

    Documents are cut where no match spans, and each stretch of overlapping matches is settled by itself.
    """
    return _settled(matches.select(key, "start", "words"), key, F.collect_set)


def _settled(matches: DataFrame, key: str, collect: Callable[[Column], Column]) -> DataFrame:
    """The rows of ``matches`` (key, start, words, ...) that stay, collected per stretch; what else a row has is carried along, so that nothing
    is joined back. Rows at one place stay or go together."""
    more = [c for c in matches.columns if c not in (key, "start", "words")]
    before = Window.partitionBy(key).orderBy("start", "words").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy(key).orderBy("start", "words").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.col("start") + F.col("words")).over(before)
    stretches = matches.withColumn("_opens", F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int")).withColumn(
        "_stretch", F.sum("_opens").over(up_to)
    )
    order = F.struct((-F.col("words")).alias("shorter"), "start", "words", *more)

    def settle(kept: Column, m: Column) -> Column:
        there = (F.element_at(kept, -1)["start"] == m["start"]) & (F.element_at(kept, -1)["words"] == m["words"])
        clash = F.exists(kept, lambda k: (k["start"] < m["start"] + m["words"]) & (m["start"] < k["start"] + k["words"]))
        return F.when((F.size(kept) > 0) & ~there & clash, kept).otherwise(F.concat(kept, F.array(m)))

    ordered = F.sort_array(collect(order))
    chosen = F.aggregate(ordered, F.slice(ordered, 1, 0), settle)
    return stretches.groupBy(key, "_stretch").agg(chosen.alias("_kept")).select(key, F.explode("_kept").alias("_m")).select(
        key, "_m.start", "_m.words", *[f"_m.{c}" for c in more]
    )


def settled_spots(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(pmid, start, words, spot, alike): the runs of tokens of ``docs`` that ``annotate`` takes for spots, stored; ``alike`` counts the rows of a place.

    They depend on the spots of the dictionary alone, not on its senses, so annotations of the same documents can share them.
    """
    found = candidate_runs(docs.where("pmid is not null"), dictionary).join(dictionary.select("spot").distinct(), "spot", "left_semi")
    place = Window.partitionBy("pmid", "start", "words")
    return materialize(
        _settled(found.select("pmid", "start", "words", "spot"), "pmid", F.collect_list).withColumn("alike", F.count(F.lit(1)).over(place)), "spots"
    )


def annotate(
    docs: DataFrame, dictionary: DataFrame, epsilon: float = 0.0, related: DataFrame | None = None, spots: DataFrame | None = None
) -> DataFrame:
    """(pmid, start, end, spot, wiki_id, title, link_probability, rho, categories) for ``docs`` (pmid, text).

    ``dictionary`` has spot, wiki_id, title, link_probability, commonness, categories. ``start`` and ``end`` count
    tokens. With ``related`` (wid1, wid2, relatedness) rho is the mean of link probability and coherence: a spot takes the
    sense that has the highest rho among all senses of the document, and is scored among the senses taken. Without it
    the coherence is 0 and a spot takes its most common sense. Ties go to the more common sense, then to the smaller wiki_id. Rows without a title or with rho below ``epsilon`` are dropped.
    ``spots``: ``settled_spots`` of the same documents and spots, where they are known already.
    """
    spots = settled_spots(docs, dictionary) if spots is None else spots
    if related is None:
        scored = spots.join(best_senses(dictionary), "spot").withColumn("rho", F.col("link_probability") / 2)
    else:
        senses = dictionary.withColumn("_senses", F.count(F.lit(1)).over(Window.partitionBy("spot")))
        kept = spots.join(senses, "spot").withColumn("_choice", (F.col("alike") > 1) | (F.col("_senses") > 1)).drop("alike", "_senses")
        scored = rated(_chosen(materialize(kept, "matches"), related), related)
    return scored.where(F.col("title").isNotNull() & (F.col("rho") >= F.lit(epsilon))).select(
        "pmid", "start", (F.col("start") + F.col("words")).alias("end"), "spot", "wiki_id", "title",
        "link_probability", "rho", "categories",
    )


def _chosen(kept: DataFrame, related: DataFrame) -> DataFrame:
    """One sense for each place of ``kept``, whose ``_choice`` tells where there are several rows to choose from.

    Only documents with such a place are rated for it, with all their rows, on which the coherence of the senses rests.
    """
    open_ = materialize(kept.where("_choice").select("pmid").distinct(), "open")
    if open_.isEmpty():
        return kept.drop("_choice")
    first = Window.partitionBy("pmid", "start", "words").orderBy(F.desc("rho"), F.desc("commonness"), "wiki_id")
    weighed = rated(kept.join(open_, "pmid", "left_semi"), related)
    chosen = weighed.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth", "rho")
    return materialize(chosen.unionByName(kept.join(open_, "pmid", "left_anti")).drop("_choice"), "senses")


def rated(matches: DataFrame, related: DataFrame) -> DataFrame:
    """``matches`` with ``rho``, the mean of link probability and coherence."""
    return matches.join(coherence(matches, related), ["pmid", "wiki_id"], "left").withColumn(
        "rho", (F.col("link_probability") + F.coalesce("coherence", F.lit(0.0))) / 2
    ).drop("coherence")


def coherence(matches: DataFrame, related: DataFrame) -> DataFrame:
    """(pmid, wiki_id, coherence): mean relatedness of an entity to the other entities of its document.

    Entity pairs without a relatedness count as 0. Pairs are formed inside a document first, as ``profile_pairs`` lays them out, and each
    meets its relatedness: the neighbours that an entity has elsewhere are never listed. What a document's pairs give is
    added up in the task that forms them, and only the sums are shuffled.
    """
    counts = mention_counts(matches, "distinct")
    sizes = counts.groupBy("pmid").agg(F.count(F.lit(1)).alias("degree"))
    own = materialize(counts.join(sizes, "pmid"), "entities").withColumns({"copies": F.lit(1), "docs": F.lit(1)})
    near = related.where("relatedness <> 0 and wid1 <> wid2").select(
        F.least("wid1", "wid2").alias("wid1"), F.greatest("wid1", "wid2").alias("wid2"), "relatedness"
    )
    known = profile_pairs(own).select("pmid", "degree", "wid1", "wid2").join(near, ["wid1", "wid2"])
    ends = F.explode(F.array("wid1", "wid2")).alias("wiki_id")
    return known.select("pmid", "degree", "relatedness", ends).groupBy("pmid", "wiki_id").agg(
        (F.sum("relatedness") / (F.max("degree") - 1)).alias("coherence")
    )


def filter_categories(annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct (pmid, wiki_id, spot, rho, title) of annotations in one of the allowed categories.

    ``annotations.categories`` is an array; ``categories`` has one column ``category``.
    """
    exploded = annotations.withColumn("category", F.explode("categories"))
    allowed = categories.select("category").distinct()
    return (
        exploded.join(allowed, ["category"], "left_semi")
        .select("pmid", "wiki_id", "spot", "rho", "title")
        .distinct()
    )
