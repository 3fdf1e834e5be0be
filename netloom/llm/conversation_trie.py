"""The trie of all conversations: one node per distinct sequence of first turns.

Turns are dictionary-encoded, so a conversation is a row of numbers. Equal conversations are counted first; the distinct ones are
dealt by range into shards. A task builds a ternary search tree of its shard, sequences inserted by the median of what is left so
that the tree of siblings is balanced, and adds up members, leaves and savings from the last node to the first. A node on the border of
shards gets a row from each; how long neighbouring shards agree is known before, so these rows add up without counting a child, a
leaf or a turn twice.

What one task holds is bounded by the shard size, but for one conversation's numbers (not its texts), which are one array, and the
digest over the ids of equal conversations, which is sequential: their ids pass one task as a stream of packed blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from netloom.llm.columns import column
from netloom.session import Stages

SHARD_TURNS = 500_000  # turns of the distinct conversations of one shard, on average
BLOCK_BYTES = 1 << 16  # packed ids handed on at a time
NOBODY = hashlib.sha256(b"").hexdigest()


def encode_turns(
    conversations: DataFrame, stages: Stages, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, nth, id, chars) of every turn: its place in the conversation from 1, a number of its own per distinct
    (role, text), and the code points of its text.

    Null roles and texts count as empty, null turns come first, equal turn numbers go by the digest of (role, text). Rows
    without a conversation id belong to none and are left out; repeated rows are turns of their own.
    """
    role = F.coalesce(column(conversations, role_col).cast("string"), F.lit(""))
    text = F.coalesce(column(conversations, text_col).cast("string"), F.lit(""))
    # The role's length keeps apart ("a", "bc") and ("ab", "c").
    key = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where(column(conversations, conv_col).isNotNull()).select(
        column(conversations, conv_col).alias("conv"), column(conversations, turn_col).alias("turn"), key.alias("key"),
        F.char_length(text).cast("long").alias("chars"),
    )
    rows = stages.store("rows", rows)
    dictionary = stages.store("dictionary", rows.select("key").distinct().withColumn("id", F.monotonically_increasing_id()))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "key")
    numbered = rows.withColumn("nth", F.row_number().over(order).cast("long"))
    turns = stages.store("turns", numbered.join(dictionary, "key").select("conv", "nth", "id", "chars"))
    stages.drop("rows", "dictionary")
    return turns


def graft(turns: DataFrame, base: Column, first: Column, most: int) -> DataFrame:
    """(conv, nth, id, chars) of conversations whose first ``first`` turns are those of conversation ``base`` (as many as it has),
    followed by their own turns after their first ``first``; nth 0 marks each conversation, so that none is lost.

    ``base`` and ``first`` are expressions of ``conv``; ``first`` is at most ``most``.
    """
    convs = turns.select("conv").distinct()
    wanted = convs.select("conv", base.alias("base"), first.cast("long").alias("first")).where("first > 0")
    source = turns.where(F.col("nth") <= most).select(F.col("conv").alias("base"), "nth", "id", "chars")
    taken = wanted.join(source, "base").where("nth <= first").select("conv", "nth", "id", "chars")
    own = turns.where(F.col("nth") > first.cast("long"))
    none = F.lit(None).cast("long")
    return own.unionByName(taken).unionByName(convs.select("conv", F.lit(0).cast("long").alias("nth"), none.alias("id"), none.alias("chars")))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv, ids, chars) per conversation, in the order of nth; nth 0 is a mark and no turn."""
    gathered = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "chars"))).alias("all"))
    real = F.filter("all", lambda t: t["nth"] > 0)
    return gathered.select("conv", F.transform(real, lambda t: t["id"]).alias("ids"), F.transform(real, lambda t: t["chars"]).alias("chars"))


def _rows_of(lists: pa.Array) -> list[np.ndarray]:
    at = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.astype(np.int64), pa.int64()))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (ids, chars, conv) sorted by (ids, conv) to blocks (ids, chars, least conv, n, block): the decimal ids of equal
    sequences, comma-joined, up to ``BLOCK_BYTES`` a block."""
    held, out = None, []

    def emit() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [_lists([b[0] for b in out]), _lists([b[1] for b in out]), pa.array([b[2][0] for b in out]), pa.array([len(b[2]) for b in out], pa.int64()),
             pa.array([",".join(map(str, b[2])) for b in out], pa.string())],
            names=["ids", "chars", "least", "n", "block"],
        )
        out.clear()
        return batch

    for batch in batches:
        convs = batch.column(2).to_pylist()
        for ids, chars, conv in zip(_rows_of(batch.column(0)), _rows_of(batch.column(1)), convs):
            if held is not None and len(held[2]) * 8 < BLOCK_BYTES and len(ids) == len(held[0]) and (ids == held[0]).all():
                held[2].append(conv)
                continue
            if held is not None:
                out.append(held)
            held = (ids, chars, [conv])
        if out:
            yield emit()
    if held is not None:
        out.append(held)
        yield emit()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (ids, least conv) to one row per distinct sequence: (ids, chars, conv, n, ends)."""
    held, out = None, []

    def emit() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [_lists([h[0] for h in out]), _lists([h[1] for h in out]), pa.array([h[2] for h in out]), pa.array([h[3] for h in out], pa.int64()),
             pa.array([h[4].hexdigest() for h in out], pa.string())],
            names=["ids", "chars", "conv", "n", "ends"],
        )
        out.clear()
        return batch

    for batch in batches:
        rest = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4))
        for ids, chars, (least, n, block) in zip(_rows_of(batch.column(0)), _rows_of(batch.column(1)), rest):
            if held is not None and len(ids) == len(held[0]) and (ids == held[0]).all():
                held[3] += n
                held[4].update(b"," + block.as_buffer().to_pybytes())
                continue
            if held is not None:
                out.append(held)
            held = [ids, chars, least, n, hashlib.sha256(block.as_buffer().to_pybytes())]
        if out:
            yield emit()
    if held is not None:
        out.append(held)
        yield emit()


def count_equal(rows: DataFrame, conv_type: T.DataType) -> DataFrame:
    """(ids, chars, conv, n, ends) of each distinct sequence of ``rows`` (conv, ids, chars): smallest conversation, number of them, and the
    SHA-256 of their ids. A group of any size is sorted over many tasks."""
    lists = [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("chars", T.ArrayType(T.LongType()))]
    blocks = rows.select("ids", "chars", "conv").repartitionByRange("ids", "conv").sortWithinPartitions("ids", "conv").mapInArrow(
        _pack, T.StructType([*lists, T.StructField("least", conv_type), T.StructField("n", T.LongType()), T.StructField("block", T.StringType())])
    )
    return blocks.repartition("ids").sortWithinPartitions("ids", "least").mapInArrow(
        _digest, T.StructType([*lists, T.StructField("conv", conv_type), T.StructField("n", T.LongType()), T.StructField("ends", T.StringType())])
    )


class TernaryTree:
    """A ternary search tree of sequences of numbers; node 0 is the root, and a node's number is larger than its parent's."""

    def __init__(self):
        self.turn, self.chars, self.parent, self.depth = [-1], [0], [-1], [0]
        self.low, self.high, self.middle = [-1], [-1], [-1]
        self.n, self.conv, self.ends = [0], [None], [None]

    def insert(self, ids: list[int], chars: list[int], n: int, conv, ends: str) -> None:
        at = 0
        for turn, size in zip(ids, chars):
            at = self._below(at, turn, size)
        self.n[at], self.conv[at], self.ends[at] = n, conv, ends

    def _below(self, at: int, turn: int, size: int) -> int:
        here, links, place = self.middle[at], self.middle, at
        while here >= 0:
            if self.turn[here] == turn:
                return here
            links, place = (self.low if turn < self.turn[here] else self.high), here
            here = links[here]
        links[place] = new = len(self.turn)
        for values, value in (
            (self.turn, turn), (self.chars, size), (self.parent, at), (self.depth, self.depth[at] + 1), (self.low, -1), (self.high, -1),
            (self.middle, -1), (self.n, 0), (self.conv, None), (self.ends, None),
        ):
            values.append(value)
        return new

    def path(self, ids: list[int]) -> list[int]:
        """Nodes from the root to the end of an inserted sequence."""
        out = [0]
        for turn in ids:
            here = self.middle[out[-1]]
            while self.turn[here] != turn:
                here = self.low[here] if turn < self.turn[here] else self.high[here]
            out.append(here)
        return out


def by_medians(n: int) -> Iterator[int]:
    """0 to n - 1: the middle one first, then the middles of both halves, and so on."""
    open_ = [(0, n)]
    while open_:
        low, high = open_.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            open_ += [(middle + 1, high), (low, middle)]


@dataclass(frozen=True)
class Border:
    """How a shard meets its neighbours. ``before``: turns that its first sequence shares with the last one of the shard before (-1:
    there is none), ``after``: the same behind it; ``extended``: its last sequence goes on in the next shard; ``heads``: (depth, shard) steps, by
    rising depth: the first shard with the node at a depth up to it on the path of the first sequence."""

    before: int
    after: int
    extended: bool
    heads: tuple[tuple[int, int], ...]

    def head(self, depth: int, own: int) -> int:
        return next((shard for limit, shard in self.heads if depth <= limit), own)


def borders(rows: list[tuple[int, int, int, int]]) -> dict[int, Border]:
    """From (shard, turns shared by its first and last sequence, turns its last one shares with the next shard's first one or -1, length of the
    last one), in order of the shards."""
    out, heads, before = {}, [], -1
    for n, (shard, own, after, length) in enumerate(rows):
        out[shard] = Border(before, after, after == length, tuple(heads))
        # Nodes at most ``after`` deep go on in the next shard. Those that span this whole shard began where they began for it.
        # Depths rise along the list while the shards they began in come later.
        steps = [(min(limit, own, after), head) for limit, head in heads] + [(after, shard)]
        heads, top = [], -1
        for limit, head in steps:
            if limit > top:
                heads.append((limit, head))
                top = limit
        before = after
    return out


def shard_nodes(shard: int, border: Border, rows: list[tuple]) -> dict[str, list]:
    """Node rows of one shard from its sorted distinct sequences (ids, chars, conv, n, ends).

    ``head`` is the first shard of a node that spans several (null: the row is the whole node), ``parent_head`` the same of its
    parent, whose smallest member is then not known here.
    """
    tree = TernaryTree()
    for at in by_medians(len(rows)):
        tree.insert(*rows[at][:2], rows[at][3], rows[at][2], rows[at][4])
    size = len(tree.turn)
    first, last = tree.path(rows[0][0]), tree.path(rows[-1][0])
    joined = set(first[: border.before + 1])  # counted in the shard before as well
    open_ = set(last[: border.after + 1])
    children, leaves = [0] * size, [0] * size
    saved = [0] * size
    n, conv = tree.n, tree.conv
    for at in range(size - 1, -1, -1):
        if tree.middle[at] < 0 and not (border.extended and at == last[-1]):
            leaves[at] = 1
        saved[at] += n[at] * tree.chars[at] - (0 if at in joined else tree.chars[at])
        up = tree.parent[at]
        if up >= 0:
            n[up] += n[at]
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            children[up] += at not in joined
            if conv[up] is None or conv[at] < conv[up]:
                conv[up] = conv[at]
    heads: list = [None] * size
    for at in joined:
        heads[at] = border.head(tree.depth[at], shard)
    for at in open_ - joined:
        heads[at] = shard
    above = [None if up < 0 else heads[up] for up in tree.parent]
    parents = [None if up < 0 or heads[up] is not None else conv[up] for up in tree.parent]
    return {
        "conv": conv, "depth": tree.depth, "parent_conv": parents, "n_convs": n, "n_children": children, "n_leaves": leaves,
        "saved_tokens": saved, "ends": tree.ends, "head": heads, "parent_head": above,
    }


def _agreement(a: Column, b: Column) -> Column:
    """Number of items at the beginning in which two arrays agree."""
    both = F.least(F.size(a), F.size(b))
    differs = F.transform(F.slice(F.arrays_zip(a.alias("x"), b.alias("y")), F.lit(1), both), lambda t: t["x"] != t["y"])
    place = F.array_position(differs, F.lit(True))
    return F.when(place > 0, place - 1).otherwise(both).cast("long")


def trie_nodes(turns: DataFrame, stages: Stages, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of the conversations in ``turns`` (conv, nth, id, chars): conv_id (smallest member), depth,
    parent_conv_id (its parent's, null at the root), n_convs (members), n_children, n_leaves, saved_tokens and ends_sha256.

    No conversations, no rows. ``shard_turns`` changes no result.
    """
    spark = turns.sparkSession
    conv_type = turns.schema["conv"].dataType
    rows = stages.store("sequences", sequences(turns))
    distinct = stages.store("distinct", count_equal(rows, conv_type))
    stages.drop("sequences")
    total = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    dealt = distinct.repartitionByRange(number, "ids").sortWithinPartitions("ids")
    shards = stages.store(
        "shards", dealt.withColumn("shard", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    )
    stages.drop("distinct")
    found = borders(_shard_ends(shards, stages))
    shared = spark.sparkContext.broadcast(found)  # a few numbers per shard
    longs = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    fields = [
        T.StructField("conv", conv_type), T.StructField("depth", T.LongType()), T.StructField("parent_conv", conv_type),
        *[T.StructField(c, T.LongType()) for c in longs], T.StructField("ends", T.StringType()), T.StructField("head", T.LongType()),
        T.StructField("parent_head", T.LongType()),
    ]
    arrow = {"conv": None, "parent_conv": None, "ends": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = None, []

        def emit():
            table = shard_nodes(held, shared.value[held], rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, arrow.get(k, pa.int64()) or conv_arrow) for k, v in table.items()], names=list(table))

        conv_arrow = None
        for batch in batches:
            conv_arrow = batch.column(2).type
            ids, chars = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rest = [batch.column(k).to_pylist() for k in (2, 3, 4, 5)]
            for row in zip(ids, chars, *rest):
                if held is not None and row[5] != held:
                    yield emit()
                held = row[5]
                rows.append(row[:5])
        if rows:
            yield emit()

    ordered = shards.repartitionByRange(number, "shard").sortWithinPartitions("shard", "place")
    nodes = stages.store("nodes", ordered.select("ids", "chars", "conv", "n", "ends", "shard").mapInArrow(run, T.StructType(fields)))
    stages.drop("shards")
    merged = nodes.where(F.col("head").isNotNull()).groupBy("head", "depth").agg(
        F.min("conv").alias("conv"), F.min("parent_conv").alias("parent_conv"), *[F.sum(c).alias(c) for c in longs],
        F.max("ends").alias("ends"), F.min("parent_head").alias("parent_head"),
    )
    merged = stages.store("merged", merged)
    every = nodes.where(F.col("head").isNull()).unionByName(merged)
    # At most two paths a shard; the engine broadcasts the stored table where its files are small.
    parents = merged.select(F.col("head").alias("parent_head"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("of_border"))
    return every.join(parents, ["parent_head", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent_conv", "of_border").alias("parent_conv_id"), *longs,
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )


def _shard_ends(shards: DataFrame, stages: Stages) -> list[tuple[int, int, int, int]]:
    """What ``borders`` needs; four numbers per shard reach the driver, sequences do not."""
    ends = stages.store("ends", shards.groupBy("shard").agg(F.min("ids").alias("low"), F.max("ids").alias("high")))
    numbers = sorted(r[0] for r in ends.select("shard").collect())
    if not numbers:
        return []
    following = shards.sparkSession.createDataFrame(list(zip(numbers, [*numbers[1:], -1])), "shard int, next int")
    after = ends.select(F.col("shard").alias("next"), F.col("low").alias("next_low"))
    met = ends.join(following, "shard").join(after, "next", "left").select(
        "shard", _agreement(F.col("low"), F.col("high")).alias("own"),
        F.when(F.col("next_low").isNull(), F.lit(-1)).otherwise(_agreement(F.col("high"), F.col("next_low"))).alias("after"),
        F.size("high").alias("length"),
    )
    return sorted(tuple(r) for r in met.collect())


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """The nodes (see ``trie_nodes``) of the trie of ``conversations``; see ``encode_turns`` for nulls, ties and repeated rows."""
    stages = Stages(conversations.sparkSession, "trie")
    return trie_nodes(encode_turns(conversations, stages, conv_col, turn_col, role_col, text_col), stages, shard_turns)
