"""Shards of near-equal size by histogram sort.

Rows are ordered by a list of 64-bit keys. In every round one aggregate counts the exact bytes between probes inside the
intervals that still hold a wanted splitter; each interval is then narrowed to the stretch between the two probes around it. A
round narrows an interval 64 times; a key value that alone holds too many bytes is refined by the next key. When all splitters
are within the tolerance, the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.llm.columns import column, whole_text
from netloom.session import Stages

PROBE_BITS = 6
FULL = 64


@dataclass(frozen=True)
class Interval:
    """Values [low, low + 2 ** bits) of the key after those fixed in ``prefix``."""

    prefix: tuple[int, ...]
    low: int
    bits: int

    @property
    def shift(self) -> int:
        return max(0, self.bits - PROBE_BITS)

    def holds(self, keys: list[str]) -> Column:
        test = F.lit(True)
        for name, value in zip(keys, self.prefix):
            test = test & (F.col(name) == F.lit(value).cast("long"))
        key = F.col(keys[len(self.prefix)])
        if self.bits < FULL:
            test = test & (F.shiftright(key, self.bits) == F.lit(self.low >> self.bits).cast("long"))
        return test

    def stretch(self, keys: list[str]) -> Column:
        return F.shiftright(F.col(keys[len(self.prefix)]), self.shift)


START = Interval((), -(1 << 63), FULL)


@dataclass(frozen=True)
class Stretch:
    """Rows between two neighbouring probes: exact bytes, number, smallest and largest key."""

    held: int
    rows: int
    least: int
    most: int


def histogram(rows: DataFrame, keys: list[str], size: str, intervals: list[Interval]) -> dict[Interval, list[Stretch]]:
    """The non-empty stretches of each interval in key order; at most 64 per interval reach the driver."""
    which, stretch, key = [], [], []
    for n, interval in enumerate(intervals):
        inside = interval.holds(keys)
        which.append(F.when(inside, F.lit(n)))
        stretch.append(F.when(inside, interval.stretch(keys)))
        key.append(F.when(inside, F.col(keys[len(interval.prefix)])))
    counted = (
        rows.select(
            F.coalesce(*which).alias("i"), F.coalesce(*stretch).alias("s"), F.coalesce(*key).alias("k"), F.col(size).alias("b")
        )
        .where("i is not null")
        .groupBy("i", "s").agg(F.sum("b"), F.count(F.lit(1)), F.min("k"), F.max("k")).collect()
    )
    found: dict[Interval, list[Stretch]] = {interval: [] for interval in intervals}
    for i, _, *numbers in sorted(counted, key=lambda r: (r[0], r[1])):
        found[intervals[i]].append(Stretch(*numbers))
    return found


def find_splitters(
    rows: DataFrame, keys: list[str], size: str, shards: int, tolerance: float
) -> list[tuple[int, ...]]:
    """For each inner border the smallest key tuple of the upper side; the bytes below it are within ``tolerance`` of a
    shard's share from their wanted number, or as near as the row there allows."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / shards
    wanted = [total * n / shards for n in range(1, shards)]
    found: dict[int, tuple[int, ...]] = {}
    open_at = {n: (START, 0) for n in range(len(wanted))}
    while open_at:
        counts = histogram(rows, keys, size, sorted({i for i, _ in open_at.values()}, key=lambda i: (i.prefix, i.low)))
        for n, (interval, below) in list(open_at.items()):
            for part in counts[interval]:
                if below + part.held >= wanted[n]:
                    break
                below += part.held
            under, over = wanted[n] - below, below + part.held - wanted[n]
            last = len(interval.prefix) + 1 == len(keys)
            if min(under, over) <= slack or part.rows == 1 or (last and part.least == part.most):
                found[n] = (*interval.prefix, part.least if under <= over else part.most + 1)
                del open_at[n]
            elif part.least == part.most:
                open_at[n] = (Interval((*interval.prefix, part.least), START.low, FULL), below)
            else:
                # Keys of one sign share their leading bits; the next probes lie between the smallest and the largest.
                bits = FULL if part.least < 0 <= part.most else (part.least ^ part.most).bit_length()
                low = START.low if bits == FULL else part.least >> bits << bits
                open_at[n] = (Interval(interval.prefix, low, bits), below)
    return [found[n] for n in sorted(found)]


def at_or_above(keys: list[str], border: tuple[int, ...]) -> Column:
    """Whether a row's keys are at or above the border, compared as tuples."""
    *head, last = border
    end = F.lit(False) if last > (1 << 63) - 1 else F.col(keys[len(head)]) >= F.lit(last).cast("long")
    for name, value in reversed(list(zip(keys, head))):
        here = F.col(name)
        end = (here > F.lit(value).cast("long")) | ((here == F.lit(value).cast("long")) & end)
    return end


def shard_rows(rows: DataFrame, keys: list[str], size: str, shards: int, stages: Stages, tolerance: float = 0.001) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard, in key order).

    ``rows`` is a stored table; ``keys`` are long columns without nulls that tell all rows apart; ``size`` is positive.
    One exchange brings the rows into order. Its tasks are cut by Spark's range partitioner, so a shard may be many tasks.
    """
    shard = F.lit(0)
    for border in find_splitters(rows, keys, size, shards, tolerance):
        shard = shard + at_or_above(keys, border).cast("int")
    order = ["shard", *keys]
    placed = stages.store(
        "placed",
        rows.withColumn("shard", shard).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", 33)),
    )
    runs = placed.groupBy("shard", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and shard: its length is the number of tasks plus the number of shards at most.
    runs = runs.select("shard", "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(runs), ["shard", "_task"])
        .withColumn("slot", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_task", "_first", "_before", "_at")
    )


def shard_texts(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.001
) -> DataFrame:
    """Shards of near-equal bytes: ``id_col``, ``size``, ``text_crc32``, ``shard``, ``slot``, one row per row of ``docs``.

    The size is the UTF-8 length of the text (null: none) plus 1. Rows are ordered by a hash of the text, then id, then place in
    the input, so equal texts lie together, and a group larger than a shard is cut by id. A null id sorts first. Repeated
    rows are rows of their own. An empty table gives an empty result. Other columns are not read.
    """
    stages = Stages(docs.sparkSession, "shards")
    text = whole_text(docs, text_col)
    rows = stages.store(
        "rows",
        docs.select(
            column(docs, id_col).alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("rid"),
        ).withColumn("id_key", F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63)).cast("long"))),
    )
    return shard_rows(rows, ["key", "id_key", "rid"], "size", shards, stages, tolerance).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )
