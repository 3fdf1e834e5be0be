"""Best-fit packing of token sequences into bins of a fixed capacity, under conflicts.

Bins are kept in the order of their residual capacity and carry two bitmaps, of the sources and of the duplicate clusters
inside. A sequence goes to the tightest bin that fits and shares neither with it; when the tightest conflicts, the search goes
on to its successors until one is compatible, else a new bin is opened. Sequences come longest first.

A sequence longer than a bin is cut: every full stretch is a bin of its own, the rest is packed. Sequences are dealt by a hash
into groups of a bounded expected size, and each group is packed by one task, so the number of groups grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.exact_dedup import normal_form
from netloom.llm.token_counts import count_tokens
from netloom.session import Stages

GROUP_ROWS = 4096


class Bins:
    """Open bins of one group by residual; every bin is (number, sources, clusters) with bitmaps as integers."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_residual: dict[int, list[int]] = {}
        self.filled = 0  # bit r is set when some bin has residual r
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the offset in it of a sequence with these bits; a bit of 0 conflicts with nothing."""
        residual = self._successor(length)
        while residual:
            row = self.by_residual[residual]
            for at, number in enumerate(row):
                if not (self.sources[number] & source or self.clusters[number] & cluster):
                    row.pop(at)
                    if not row:
                        self.filled ^= 1 << residual
                    self._put(number, residual - length, source, cluster)
                    return number, self.capacity - residual
            residual = self._successor(residual + 1)
        number = len(self.sources)
        self.sources.append(0)
        self.clusters.append(0)
        self._put(number, self.capacity - length, source, cluster)
        return number, 0

    def _successor(self, least: int) -> int:
        """The smallest residual of at least ``least`` that a bin has; 0 if none."""
        above = self.filled >> least
        return least + (above & -above).bit_length() - 1 if above else 0

    def _put(self, number: int, residual: int, source: int, cluster: int) -> None:
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if residual:
            self.by_residual.setdefault(residual, []).append(number)
            self.filled |= 1 << residual


def best_fit(lengths: Iterable[int], sources: Iterable, clusters: Iterable, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each sequence of one group, given longest first; a length of 0 takes a place without room."""
    bins, source_bits, cluster_bits, out = Bins(capacity), {}, {}, []
    for length, source, cluster in zip(lengths, sources, clusters):
        s = 0 if source is None else source_bits.setdefault(source, 1 << len(source_bits))
        c = 0 if cluster is None else cluster_bits.setdefault(cluster, 1 << len(cluster_bits))
        out.append(bins.place(max(length, 1), s, c))
    return out


def _packed(capacity: int):
    """Packs the groups of rows sorted by (group, length descending, ...); a group is handed on when the next one begins."""

    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        placed = best_fit(
            table["length"].to_pylist(), table["source"].to_pylist(), table["cluster"].to_pylist(), capacity
        )
        return pa.RecordBatch.from_arrays(
            [table["group"].combine_chunks(), table["rid"].combine_chunks(), table["piece"].combine_chunks(),
             pa.array([b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
            names=["group", "rid", "piece", "number", "offset"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(batch)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if held and held[0].column(0)[0].as_py() != groups[start]:
                    yield flush(held)
                    held = []
                held.append(batch.slice(start, stop - start))
        if held:
            yield flush(held)

    return run


def pack(
    rows: DataFrame, length_col: str, source_col: str, cluster_col: str, id_col: str = "doc_id", capacity: int = 2048,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per stretch of each row of ``rows``: ``id_col``, ``piece`` (from 0), ``start`` in the sequence, ``length``,
    ``bin`` (long, unique over all groups), ``offset`` in the bin.

    No two rows of one bin share a source or a cluster; a null source or cluster conflicts with nothing. Full stretches fill a bin
    alone. A null or negative length counts as 0; such a row is placed like one of length 1. Ties in length go by a hash
    of the id, the place in the input and the piece. Repeated rows and null ids are rows of their own; an empty table gives an empty result; other
    columns are not read.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "packing")
    light = stages.store(
        "rows",
        rows.select(
            column(rows, id_col).alias("id"), F.greatest(F.coalesce(column(rows, length_col), F.lit(0)), F.lit(0)).cast("long").alias("total"),
            column(rows, source_col).cast("string").alias("source"), column(rows, cluster_col).cast("string").alias("cluster"),
            F.monotonically_increasing_id().alias("rid"),
        ),
    )
    groups = max(1, -(-light.count() // group_rows))
    # The last stretch of a sequence; a whole number of bins leaves none.
    rest = light.where((F.col("total") % capacity > 0) | (F.col("total") == 0)).select(
        F.pmod(F.xxhash64("id", "rid"), F.lit(groups)).alias("group"), "rid",
        F.floor(F.col("total") / capacity).cast("long").alias("piece"), (F.col("total") % capacity).alias("length"),
        "source", "cluster", F.xxhash64("id", "rid").alias("tie"),
    )
    ordered = rest.repartition("group").sortWithinPartitions("group", F.desc("length"), "tie", "rid")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("group", "rid", "piece", "number", "offset")])
    placed = stages.store(
        "placed",
        ordered.select("group", "rid", "piece", "length", "source", "cluster").mapInArrow(_packed(capacity), schema),
    )
    # Bins of a group are numbered apart from those of others, full ones after the shared ones.
    shared = light.join(placed.select("rid", "piece", "group", "number", "offset"), "rid").select(
        F.col("id").alias(id_col), "piece", (F.col("piece") * capacity).alias("start"), (F.col("total") % capacity).alias("length"),
        (F.col("number") * groups + F.col("group")).alias("bin"), "offset",
    )
    most = (placed.agg(F.max("number")).first()[0] or 0) + 1
    full = light.where(F.col("total") >= capacity).select(
        "id", "rid", F.explode(F.sequence(F.lit(0), F.floor(F.col("total") / capacity).cast("long") - 1)).alias("piece")
    ).withColumn("at", F.monotonically_increasing_id())
    full = full.select(
        F.col("id").alias(id_col), "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        (F.lit(most * groups) + F.col("at")).alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    return shared.unionByName(full)


def pack_documents(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pack ``docs`` (doc_id, text, source) by their word-piece counts; texts equal but for white space are one cluster."""
    keyed = docs.select(
        "doc_id", column(docs, "source").alias("source"), whole_text(docs, "text").alias("text"),
        F.sha2(normal_form(whole_text(docs, "text")), 256).alias("cluster"),
    )
    counted = count_tokens(keyed, keep=("doc_id", "source", "cluster"))
    return pack(counted, "n_tokens", "source", "cluster", capacity=capacity)
