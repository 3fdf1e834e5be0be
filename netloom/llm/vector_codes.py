"""Product codes of vectors, fitted and assigned in exact integers with pivot bounds.

A vector's components become integers and are cut into equal parts; every part position has a codebook of at most 256 entries. The
nearest entry is searched in the way of LAESA: distances from each part to a few fixed pivots are computed once and stored with
the part; a round computes only the distances from its entries to the pivots. The largest difference of two such distances is a lower
bound of the distance between part and entry, so entries are visited by ascending bound, compared in exact integers, and the
visit ends at the first bound above the best distance found.

Rows never meet: each round is one pass over the stored parts, and only sums per entry (one row per task and entry) are exchanged. What
the driver holds is the codebooks, whose size does not depend on the number of rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from netloom.llm.columns import column
from netloom.session import Stages

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
PIVOTS = 6
_VISITS = (8, 16, 32, 64)  # entries visited per step, the rest in the last one
_ROWS = 2048  # parts compared at a time


@dataclass
class Codebooks:
    """Entries per part position: (parts, entries, width) integers."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, in integers."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def choose_pivots(entries: np.ndarray, number: int = PIVOTS) -> np.ndarray:
    """Entries that lie far from one another: the first one, then always the one farthest from those chosen."""
    chosen = [0]
    reach = squared(entries, entries[0])
    while len(chosen) < min(number, len(entries)):
        chosen.append(int(reach.argmax()))
        reach = np.minimum(reach, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(parts, pivots) distances."""
    return np.sqrt(squared(parts[:, None, :], pivots[None, :, :]).astype(np.float64))


def nearest(parts: np.ndarray, book: np.ndarray, to_pivots: np.ndarray, book_to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (ties: the lower index) and the squared distance to it."""
    bound = np.zeros((len(parts), len(book)))
    for a, b in zip(to_pivots.T, book_to_pivots.T):
        np.maximum(bound, np.abs(a[:, None] - b[None, :]), out=bound)
    # Roots are rounded: give way by more than that, so that no entry is passed over that could be as near.
    bound -= 1e-12 * (to_pivots.max(axis=1, initial=0)[:, None] + book_to_pivots.max(axis=1, initial=0)[None, :])
    order = np.argsort(bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index = np.zeros(len(parts), dtype=np.int64)
    rows, at = np.arange(len(parts)), 0
    for step in (*_VISITS, len(book)):
        if at >= len(book) or not len(rows):
            break
        seen = order[rows, at : at + step]
        far = squared(parts[rows][:, None, :], book[seen])
        low = far.min(axis=1)
        entry = np.where(far == low[:, None], seen, len(book)).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = low[better], entry[better]
        at += step
        if at < len(book):
            rows = rows[bound[rows, at] <= np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-12)]
    return index, best


def _matrix(values: pa.Array, *shape: int) -> np.ndarray:
    """An array column whose rows all have the same number of items."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), *shape)


def _assigned(batch: pa.RecordBatch, books: Codebooks, reach: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts, entry indexes and squared distances (rows, parts) of a batch with ``vec`` and ``far`` in columns 1 and 2."""
    number, _, width = books.entries.shape
    vec = _matrix(batch.column(1), number, width)
    far = _matrix(batch.column(2), number, -1)
    index = np.empty((len(vec), number), dtype=np.int64)
    away = np.empty((len(vec), number), dtype=np.int64)
    for at in range(0, len(vec), _ROWS):
        rows = slice(at, at + _ROWS)
        for p in range(number):
            index[rows, p], away[rows, p] = nearest(vec[rows, p], books.entries[p], far[rows, p], reach[p])
    return vec, index, away


def _whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def fit_books(
    spark, rows: DataFrame, stages: Stages, parts: int, entries: int, rounds: int,
) -> tuple[Codebooks, DataFrame, list[np.ndarray]] | None:
    """Codebooks after ``rounds`` rounds, the stored rows with their pivot distances, and the pivots; None without rows."""
    first = rows.where(F.col("id").isNotNull()).orderBy("id", "vec").limit(entries).select("vec").toArrow()
    if not first.num_rows:
        return None
    start = _matrix(first.column(0).combine_chunks(), parts, -1).astype(np.int64)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    pivots = [choose_pivots(e) for e in books.entries]
    width = start.shape[2]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = _matrix(batch.column(1), parts, width)
            far = [pivot_distances(vec[at : at + _ROWS, p], pivots[p]) for at in range(0, len(vec), _ROWS) for p in range(parts)]
            blocks = [np.concatenate(far[n : n + parts], axis=1) for n in range(0, len(far), parts)]
            far = np.concatenate(blocks) if blocks else np.zeros((0, parts))
            at = pa.array(np.arange(len(vec) + 1, dtype=np.int32) * far.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, pa.array(far.reshape(-1))), batch.column(2)],
                names=["id", "vec", "far", "label"],
            )

    schema = T.StructType([
        rows.schema["id"], T.StructField("vec", T.ArrayType(T.LongType())), T.StructField("far", T.ArrayType(T.DoubleType())),
        rows.schema["label"],
    ])
    measured = stages.store("measured", rows.select("id", "vec", "label").mapInArrow(measure, schema))
    stages.drop("rows")
    sums = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "entry", "n")] + [T.StructField("sums", T.ArrayType(T.LongType()))])
    for _ in range(rounds):
        totals = measured.select("id", "vec", "far").mapInArrow(_entry_sums(spark.sparkContext.broadcast((books, pivots))), sums)
        exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        grouped = totals.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact)
        # One row per entry of the codebooks, whatever the number of vectors.
        for row in grouped.collect():
            books.entries[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return books, measured, pivots


def _reach(books: Codebooks, pivots: list[np.ndarray]) -> list[np.ndarray]:
    return [pivot_distances(e, p) for e, p in zip(books.entries, pivots)]


def _entry_sums(shared):
    """Numbers and sums of the parts next to each entry, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, pivots = shared.value
        reach = _reach(books, pivots)
        number, size, width = books.entries.shape
        n, sums = np.zeros((number, size), dtype=np.int64), np.zeros((number, size, width), dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            vec, index, _ = _assigned(batch, books, reach)
            for p in range(number):
                n[p] += np.bincount(index[:, p], minlength=size)
                np.add.at(sums[p], index[:, p], vec[:, p])
        part, entry = np.nonzero(n)
        at = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.ListArray.from_arrays(at, pa.array(sums[part, entry].reshape(-1)))],
            names=["part", "entry", "n", "sums"],
        )

    return run


def compress_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """(``id_col``, code, error, label_error) of every usable row of ``vectors``, and the fitted codebooks.

    A component x counts as floor(``scale`` * x). The codebook of a part position starts as that part of the rows with the ``entries``
    smallest ids (equal ids by their components). Each of ``rounds`` rounds assigns all parts and replaces each entry by the rounded-down
    mean of its parts; unused entries stay. ``code`` has two hex digits per part, ``error`` is the sum of the squared distances, and
    ``label_error`` the sum of the errors of all rows with the same label, nulls together.

    Rows whose vector is null or has null or non-finite components are left out. The length of vectors is that of the usable row
    of the smallest id whose length is a positive multiple of ``parts``; rows of other lengths, and rows with a component so large that a squared
    distance may not fit a long (beyond 2**30 / sqrt(length) after scaling), stay in the result with a null code and error, and take no part in the fit.
    Repeated rows count once each. A row without an id is encoded, but starts no entry; if all are without, or the table is empty,
    there are no codebooks and codes are null.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    stages = Stages(spark, "codes")
    vector = column(vectors, vector_col).cast("array<double>")
    rows = vectors.select(column(vectors, id_col).alias("id"), vector.alias("raw"), column(vectors, label_col).alias("label"))
    rows = rows.where(usable(F.col("raw"))).select("id", "label", "raw")
    lengths = rows.where(F.col("id").isNotNull() & (F.size("raw") > 0) & (F.size("raw") % parts == 0))
    first = lengths.orderBy("id", F.size("raw")).select(F.size("raw")).first()
    length = first[0] if first else 0
    largest = 2**30 / math.sqrt(length or 1) / scale
    fits = (F.size("raw") == length) & F.forall("raw", lambda x: F.abs(x) <= F.lit(largest)) & F.lit(length > 0)
    vec = F.when(fits, _whole_numbers(F.col("raw"), scale))
    light = rows.select("id", "label", vec.alias("vec"))
    other = light.where(F.col("vec").isNull()).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    fitted = fit_books(spark, stages.store("rows", light.where(F.col("vec").isNotNull())), stages, parts, entries, rounds) if length else None
    if fitted is None:
        books, coded = None, other
    else:
        books, measured, pivots = fitted
        shared = spark.sparkContext.broadcast((books, pivots))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reach = _reach(*shared.value)
            for batch in batches:
                if not len(batch):
                    continue
                _, index, away = _assigned(batch, shared.value[0], reach)
                codes = [bytes(row).hex() for row in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(3), pa.array(codes, pa.string()), pa.array(away.sum(axis=1), pa.int64())],
                    names=["id", "label", "code", "error"],
                )

        schema = T.StructType([
            measured.schema["id"], measured.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
        ])
        coded = stages.store("coded", measured.mapInArrow(run, schema).unionByName(other))
        stages.drop("measured")
    # The labels' sums are a stored table: it is broadcast if its file is small, and otherwise joined by label.
    totals = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    totals = stages.store("totals", totals.withColumnRenamed("label", "of"))
    found = coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
    return found.select(F.col("id").alias(id_col), "code", "error", "label_error"), books
