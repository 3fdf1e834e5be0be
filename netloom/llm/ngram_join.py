"""Similarity join on the Jaccard coefficient of word n-gram sets.

Rare-first prefix filtering: every set is ordered by how many sets have its n-grams, rarest first, by exact counts (``ngram_ranks``). Two
sets that reach the threshold share an n-gram in their prefixes, so only prefixes are joined, and a set whose prefix nobody shares is
done. Pairs are pruned by length, by the positions of the shared n-grams, by a parity mask and, before the full comparison, by probing
the suffixes. Each surviving pair is compared once. The mask has a bit for each of 1024 cells that tells whether the set has an odd
number of n-grams there, so two sets differ in at least as many n-grams as their masks differ in bits; near copies that just miss the
threshold are told apart by it inside the join.

Texts with equal sets are one class; only classes are joined. ``ngram_join`` gives every link: the pairs of classes that link, and the
rows with their class, number of links and component. Its work grows with the number of links, which is the result.

``ngram_classes`` gives membership (class and component) only, so a pair whose ends are known to be connected need not be compared: in a
round, every class meets one class that is drawn among those it shares prefix n-grams with, and after ``ROUNDS`` rounds
every remaining pair of different components is compared. A group of near copies costs a multiple of its size that way,
not its square, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.components import components
from netloom.llm.exact_dedup import keep_rows
from netloom.llm.ngram_ranks import ranked_prefixes
from netloom.llm.words import set_digest, shingle_sets, small_batches
from netloom.session import Stages

BITMAP_LOG2 = 26
ROUNDS = 2
AHEAD = 8  # n-grams before a shared one that tell whether a pair has met
_U = np.uint64
_PROFILE = ["id", "sha", "n", "cls", "mask"]
_MASK_LOG2 = 10


def need(n_a, n_b, percent: int):
    """Smallest intersection with which two sets of these sizes link."""
    return -(-(n_a + n_b) * percent // (100 + percent))


def parity_mask(values: np.ndarray) -> np.ndarray:
    odd = np.bincount((values & _U((1 << _MASK_LOG2) - 1)).astype(np.int64), minlength=1 << _MASK_LOG2) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _profile(size: int):
    """Rows (id, sha, n, cls, mask) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([parity_mask(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=_PROFILE,
            )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, salt, cls): each class once, and only n-grams that more than one class has or may have."""

    def chosen(rows: pa.Table, before: tuple | None, after: tuple | None):
        token, salt = rows["token"].to_numpy(), rows["salt"].to_numpy()
        cls = np.frombuffer(b"".join(rows["cls"].to_pylist()), dtype="V16")
        same_key = np.zeros(len(token) + 1, dtype=bool)
        same_key[1:-1] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        repeat = np.zeros(len(token), dtype=bool)
        repeat[1:] = same_key[1:-1] & (cls[1:] == cls[:-1])
        if before is not None:
            same_key[0] = before[:2] == (token[0], salt[0])
            repeat[0] = same_key[0] and before[2] == cls[0].tobytes()
        if after is not None:
            same_key[-1] = after[:2] == (token[-1], salt[-1])
        other = same_key[:-1] | same_key[1:] | rows["hot"].to_numpy(zero_copy_only=False)
        return rows.filter(pa.array(other & ~repeat)).drop(["salt", "hot"])

    def edge(rows: pa.Table, at: int) -> tuple:
        return rows["token"][at].as_py(), rows["salt"][at].as_py(), rows["cls"][at].as_py()

    held, before = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not len(rows):
            continue
        if held is not None:
            yield from chosen(held, before, edge(rows, 0)).to_batches()
            before = edge(held, len(held) - 1)
        held = rows
    if held is not None:
        yield from chosen(held, before, None).to_batches()


def _sets_of(size: int, wanted):
    """Rows (cls, values) of the classes in the bitmap, once per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, done = wanted.value, set()
        for batch in batches:
            classes, found = [], []
            for values in shingle_sets(batch.column(0), size):
                cls = set_digest(values)
                at = int.from_bytes(cls[:8], "little") >> (64 - BITMAP_LOG2)
                if len(values) and bits[at >> 3] >> (at & 7) & 1 and cls not in done:
                    if len(done) < 1 << 18:
                        done.add(cls)
                    classes.append(cls)
                    found.append(values.view(np.int64))
            if classes:
                at = np.concatenate([[0], np.cumsum([len(v) for v in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), lists], names=["cls", "values"])

    return run


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int) -> int:
    """Upper bound of the intersection of two sorted sets, from probes of the middle of one in the other."""
    if not len(a) or not len(b):
        return 0
    if not depth:
        return min(len(a), len(b))
    middle = len(b) // 2
    at = int(np.searchsorted(a, b[middle]))
    hit = at < len(a) and a[at] == b[middle]
    return int(hit) + suffix_bound(a[:at], b[:middle], depth - 1) + suffix_bound(a[at + hit :], b[middle + 1 :], depth - 1)


def _linked(percent: int):
    """The pairs that link, of rows (a, b, set of a, set of b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                left, right = left.values.to_numpy().view(_U), right.values.to_numpy().view(_U)
                least = need(len(left), len(right), percent)
                ok = suffix_bound(left, right, 3) >= least
                if ok:
                    ok = len(np.intersect1d(left, right, assume_unique=True)) >= least
                keep.append(ok)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, bits): the non-zero 64-bit words of this task's bitmap of the classes."""
    words = np.zeros(1 << (BITMAP_LOG2 - 6), dtype=np.int64)
    for batch in batches:
        if len(batch):
            at = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u8")[::2] >> _U(64 - BITMAP_LOG2)
            np.bitwise_or.at(words, (at >> _U(6)).astype(np.int64), np.left_shift(1, (at & _U(63)).astype(np.int64)))
    used = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], names=["word", "bits"])


def _gathered(rows: DataFrame, length: int) -> np.ndarray:
    """An array of fixed length from (index, value) rows."""
    out = np.zeros(length, dtype=np.int64)
    found = rows.toArrow()
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


class _Verifier:
    """Compares pairs of classes, each pair once. Sets are read from the texts, for the classes of a round's pairs only."""

    def __init__(self, texts: DataFrame, masks: DataFrame, size: int, percent: int, stages: Stages):
        self.texts, self.masks, self.size, self.percent, self.stages = texts.select("text"), masks, size, percent, stages
        self.turn, self.done = 0, None

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """(cls, values) of the classes in ``pairs``, and of few others that share a bit with them."""
        spark = self.texts.sparkSession
        classes = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        words = classes.mapInArrow(_bits, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits"))
        bitmap = spark.sparkContext.broadcast(_gathered(words, 1 << (BITMAP_LOG2 - 6)).view(np.uint8).tobytes())
        found = self.texts.mapInArrow(_sets_of(self.size, bitmap), "cls binary, values array<bigint>")
        return self.stages.store("sets", found.dropDuplicates(["cls"]))

    def __call__(self, matches: DataFrame) -> DataFrame:
        """Links among the pairs of ``matches`` (a, b, least, total, bound) that pass the filters and are new."""
        self.turn += 1
        pairs = matches.groupBy("a", "b", "least", "total").agg(F.min("bound").alias("bound")).where("bound >= least")
        pairs = _masked(pairs, self.masks).select("a", "b")
        if self.done is not None:
            pairs = pairs.join(self.done, ["a", "b"], "left_anti")
        pairs = self.stages.store(f"pairs{self.turn}", pairs)
        self.done = pairs if self.done is None else self.done.unionByName(pairs)
        if pairs.isEmpty():
            return pairs
        sets = self._sets(pairs)
        left = sets.select(F.col("cls").alias("a"), F.col("values").alias("left"))
        right = sets.select(F.col("cls").alias("b"), F.col("values").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        links = self.stages.store(f"links{self.turn}", both.mapInArrow(_linked(self.percent), "a binary, b binary"))
        self.stages.drop("sets")
        return links


def _like(total: str, least: str, words: int = 1 << (_MASK_LOG2 - 6)):
    """Whether the masks allow an intersection of ``least``: bits that differ stand for at least as many n-grams that differ."""
    apart = F.lit(0)
    for n in range(words):
        apart = apart + F.bit_count(F.get("mask", F.lit(n)).bitwiseXOR(F.get("mask2", F.lit(n))))
    return apart <= F.expr(total) - 2 * F.expr(least)


def _masked(pairs: DataFrame, masks: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, least, total) that the masks of both ends allow."""
    both = pairs.join(masks.select(F.col("cls").alias("a"), "mask"), "a").join(masks.select(F.col("cls").alias("b"), F.col("mask").alias("mask2")), "b")
    return both.where(_like("total", "least")).drop("mask", "mask2")


def _matches(pairs: DataFrame, percent: int, centre: str | None = None) -> DataFrame:
    """(a, b, least, total, bound) of rows (cls, n, s, pos, cls2, n2, s2, pos2) that pass the length filter; ``a`` is the smaller class.

    ``bound``: the largest intersection that the place of this shared n-gram among the n-grams that others have allows.
    """
    first = F.col("cls") < F.col("cls2")
    bound = F.least("pos", "pos2") + F.least(F.col("s") - F.col("pos"), F.col("s2") - F.col("pos2"))
    least = F.ceil((F.col("n") + F.col("n2")) * percent / (100 + percent))
    return pairs.where(
        (F.col("cls") != F.col("cls2")) & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent) & (bound >= least)
    ).select(
        F.when(first, F.col("cls")).otherwise(F.col("cls2")).alias("a"),
        F.when(first, F.col("cls2")).otherwise(F.col("cls")).alias("b"), least.alias("least"), (F.col("n") + F.col("n2")).alias("total"),
        bound.alias("bound"), *([F.col(centre).alias("centre")] if centre else []),
    )


def _star(shared: DataFrame, masks: DataFrame, percent: int, turn: int, roots: DataFrame | None = None) -> DataFrame:
    """One match per class, with the centre of one of its prefix n-grams, of another component if ``roots`` are known.

    The centre of an n-gram is one of its sets of like length, drawn anew in every ``turn``: most members of a group of near copies link with any
    of them, but not with an extreme one.
    """
    band = F.floor(F.log("n") / -np.log(percent / 100)) if percent < 100 else F.col("n")
    rows = shared.withColumn("band", band)
    if roots is None:
        rows = rows.withColumn("root", F.col("cls"))
    else:
        rows = rows.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    centres = rows.groupBy("token", "band").agg(
        F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("draw"), "n", "cls", "s", "pos", "root")).alias("c"), F.count(F.lit(1)).alias("m")
    )
    centres = centres.where("m > 1").select("token", "band", *[F.col(f"c.{c}").alias(f"{c}2") for c in ("n", "cls", "s", "pos", "root")])
    met = _matches(rows.join(centres, ["token", "band"]).where("root <> root2"), percent, "cls2")
    # Of the sets that a class meets and that its mask allows, the one with which it shares most of its prefix.
    each = met.groupBy("a", "b", "least", "total", "centre").agg(F.count(F.lit(1)).alias("c"), F.min("bound").alias("bound"))
    each = _masked(each.where("bound >= least"), masks)
    own = F.when(F.col("a") == F.col("centre"), F.col("b")).otherwise(F.col("a"))
    best = each.groupBy(own.alias("own")).agg(F.max(F.struct("c", "bound", "a", "b", "least", "total")).alias("m"))
    return best.select("m.a", "m.b", "m.least", "m.total", "m.bound")


def _twos(shared: DataFrame, percent: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """The matches of the n-grams that two classes share, which are most, and the rows of the n-grams that more share."""
    row = F.struct("n", "cls", "s", "pos")
    sizes = stages.store(
        "sizes", shared.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min(row).alias("c"), F.max(row).alias("d"))
    )
    two = sizes.where("m = 2").select("c.*", *[F.col(f"d.{c}").alias(f"{c}2") for c in ("n", "cls", "s", "pos")])
    larger = stages.store("larger", shared.join(sizes.where("m > 2").select("token"), "token", "left_semi"))
    return _matches(two, percent), larger


def _ahead(rows: DataFrame) -> DataFrame:
    """``rows`` (token, cls) with ``before``: the last ``AHEAD`` n-grams of the class's own rows that are smaller than this one."""
    return rows.withColumn("before", F.collect_list("token").over(Window.partitionBy("cls").orderBy("token").rowsBetween(-AHEAD, -1)))


def _met_here(percent: int, words: int):
    """Whether the lengths and the folded masks allow a pair, and it has not met at a smaller n-gram for certain.

    Near copies share most of their prefixes, so a pair would meet again at each of these n-grams. It meets at the smallest one that it shares in any case,
    since nothing before that is common. Elsewhere it is left out if one of the n-grams just before is common, where it has met.
    """
    return (
        (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent) & _like("n + n2", f"ceil((n + n2) * {percent} / {100 + percent})", words)
        & ~F.arrays_overlap("before", "before2")
    )


def _rest(shared: DataFrame, roots: DataFrame, masks: DataFrame, percent: int, stages: Stages) -> DataFrame:
    """All matches across components: each n-gram's rows outside its largest component, with all rows outside their own.

    Rows are joined with masks folded to half their size, which is a parity mask of half as many cells. Only n-grams that several
    components have take part.
    """
    half = 1 << (_MASK_LOG2 - 7)
    folded = F.array(*[F.get("mask", F.lit(n)).bitwiseXOR(F.get("mask", F.lit(n + half))) for n in range(half)])
    classes = masks.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), folded.alias("mask")
    )
    rows = stages.store("labelled", shared.join(classes, "cls").select("token", "cls", "n", "s", "pos", "root", "mask"))
    sizes = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
    top = F.max(F.struct("m", "root"))["root"].alias("top")
    largest = stages.store(
        "largest", sizes.groupBy("token").agg(top, F.count(F.lit(1)).alias("r")).where("r > 1").select(F.col("token").alias("at"), "top")
    )
    met = stages.store("met", _ahead(rows.join(largest, F.col("token") == F.col("at")).drop("at")))
    outside = met.where("root <> top").select(*[F.col(c).alias(f"{c}2") for c in ("token", "cls", "n", "s", "pos", "root", "mask", "before")])
    # Two rows outside the largest component meet in one direction.
    once = (F.col("root") == F.col("top")) | (F.col("cls") < F.col("cls2"))
    pairs = met.join(outside, (F.col("token") == F.col("token2")) & (F.col("root") != F.col("root2")) & once & _met_here(percent, half))
    return _matches(pairs, percent)


def _all(shared: DataFrame, masks: DataFrame, percent: int, stages: Stages) -> DataFrame:
    """All matches: each n-gram's rows with all other rows of it, once, that the length and the folded masks allow."""
    half = 1 << (_MASK_LOG2 - 7)
    folded = F.array(*[F.get("mask", F.lit(n)).bitwiseXOR(F.get("mask", F.lit(n + half))) for n in range(half)])
    rows = stages.store(
        "labelled", _ahead(shared.join(masks.select("cls", folded.alias("mask")), "cls").select("token", "cls", "n", "s", "pos", "mask"))
    )
    other = rows.select(*[F.col(c).alias(f"{c}2") for c in ("token", "cls", "n", "s", "pos", "mask", "before")])
    return _matches(rows.join(other, (F.col("token") == F.col("token2")) & (F.col("cls") < F.col("cls2")) & _met_here(percent, half)), percent)


def _counted(rows: DataFrame, links: DataFrame, stages: Stages) -> DataFrame:
    """(cls, n_links, linked): to how many other rows a row of each class links, its class's rows included, and the smallest other class."""
    members = stages.store("members", rows.where("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("m")))
    both = links.select(F.col("a").alias("own"), F.col("b").alias("cls")).unionByName(links.select(F.col("b").alias("own"), F.col("a").alias("cls")))
    others = both.join(members, "cls").groupBy(F.col("own").alias("cls")).agg(F.sum("m").alias("others"), F.min("cls").alias("linked"))
    return members.join(others, "cls", "left").select("cls", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "linked")


def ngram_join(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(links, rows) of ``docs``, all links listed.

    ``links``: each pair (a, b), a < b, of classes whose sets link, once; a class is the rows with one set. ``rows``: those of
    ``ngram_classes`` with ``n_links``, the number of other rows that a row links to; ``linked`` is the smallest class of them but the row's own. Two rows link when
    they are of one class or their classes are in ``links``, so the pairs of rows are ``links`` joined with ``rows`` on both ends. The components
    are those of ``links``.
    """
    return _joined(docs, size, percent, id_col, text_col, True)


def ngram_classes(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``, ``original_sha256``, ``kept``, ``class``, ``linked``.

    A text's set: the distinct ``size``-word shingles of its words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; with fewer words, the
    whole sequence. Two rows link when 100 * intersection >= ``percent`` * union. ``component_id`` is the smallest id reachable
    by links; ``kept`` marks the rows that have it. ``class`` is the identity of a row's set, and ``linked`` that of another set which it
    was found to link with (null without one), so every component hangs together by links that were verified. Null, empty and blank texts have no set, are linked with nothing and are
    kept. A null id is larger than all others. Repeated rows are rows of their own with the same results. An
    empty table gives an empty result; other columns of ``docs`` are not read.
    """
    return _joined(docs, size, percent, id_col, text_col, False)[1]


def _joined(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, every: bool) -> tuple[DataFrame, DataFrame]:
    """(links, rows); unless ``every``, only as many links as the components take, and rows with one of them and without their number."""
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "ngrams")
    texts = docs.select(column(docs, id_col).alias("id"), whole_text(docs, text_col).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    schema = T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("sha", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("cls", T.BinaryType()), T.StructField("mask", T.ArrayType(T.LongType())),
    ])
    profile = stages.store("profile", texts.select("id", "sha", "text").mapInArrow(_profile(size), schema))
    rows = profile.select("id", "sha", "n", "cls")
    total = profile.agg(F.sum("n")).first()[0] or 0
    prefixes = ranked_prefixes(texts, size, percent, total)
    shared = stages.store(
        "shared",
        prefixes.repartition("token", "salt").sortWithinPartitions("token", "salt", "cls")
        .mapInArrow(_shared, "token bigint, cls binary, n bigint, s bigint, pos bigint"),
    )
    masks = stages.store("masks", profile.where("cls is not null").select("cls", "mask").dropDuplicates(["cls"]))
    verified = _Verifier(texts, masks, size, percent, stages)
    if every:
        twos, shared = _twos(shared, percent, stages)
        links = verified(twos.unionByName(_all(shared, masks, percent, stages)))
    else:
        links = verified(_star(shared, masks, percent, 0))
        for turn in range(1, ROUNDS):
            links = links.unionByName(verified(_star(shared, masks, percent, turn, components(links, stages))))
        links = links.unionByName(verified(_rest(shared, components(links, stages), masks, percent, stages)))
    roots = components(links, stages)

    order = F.struct(F.col("id").isNull().alias("none"), "id", "sha")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min(order).alias("first"))
    classes = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    classes = stages.store("classes", classes)
    tops = stages.store("tops", classes.groupBy("root").agg(F.min("first").alias("first")))
    classes = stages.store("places", classes.drop("first").join(tops, "root").select("cls", "first"))
    own = F.coalesce(F.col("first"), order)
    if every:
        classes = classes.join(_counted(rows, links, stages), "cls")
        more = [F.col("linked"), F.coalesce("n_links", F.lit(0)).alias("n_links")]
    else:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        classes = classes.join(ends.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("linked")), "cls", "left")
        more = [F.col("linked")]
    out = stages.store(
        "rows",
        rows.join(classes, "cls", "left").select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own["id"].alias("component_id"),
            F.col("sha").alias("original_sha256"), (F.col("id").eqNullSafe(own["id"]) & (F.col("sha") == own["sha"])).alias("kept"),
            F.col("cls").alias("class"), *more,
        ),
    )
    stages.drop(*[name for name in stages.paths if name not in ("rows", "links1")])
    return links, out


def drop_near_copies(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component of ``docs``, with all columns."""
    return keep_rows(docs, ngram_classes(docs, size, percent, id_col, text_col), id_col, text_col)
