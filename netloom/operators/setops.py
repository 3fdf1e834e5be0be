"""Unions, differences and edge symmetry."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name over any number of frames; missing columns become null on request."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def symmetrize(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each edge in both directions, in one pass over the table."""
    rest = [c for c in edges.columns if c not in (a, b)]
    forward = F.struct(F.col(a).alias(a), F.col(b).alias(b))
    backward = F.struct(F.col(b).alias(a), F.col(a).alias(b))
    return edges.select(F.inline(F.array(forward, backward)), *rest).select(*edges.columns)


def swap_ends(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each edge in the other direction only."""
    swapped = {a: F.col(b).alias(a), b: F.col(a).alias(b)}
    return edges.select(*[swapped.get(c, F.col(c)) for c in edges.columns])


def new_rows(new: DataFrame, old: DataFrame, keys: Sequence[str], new_is_small: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``old``.

    With ``new_is_small`` the history is first reduced to the keys present in ``new`` (a
    semi-join whose build side is the small delta), so the long history is scanned
    but not shuffled; the anti-join then runs against that remainder.
    """
    keys = list(keys)
    seen = old.select(*keys)
    if new_is_small:
        seen = seen.join(new.select(*keys).distinct(), keys, "left_semi")
    # Distinct keys: a key that fills the history is one row here. The join reuses this partitioning.
    return new.join(seen.distinct(), keys, "left_anti")


def unpivot_references(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Wide cross-reference table to (id, ref_db, ref_id), nulls dropped, in one pass."""
    wide = df.select(F.col(id_col), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return wide.unpivot([id_col], list(columns), "ref_db", "ref_id").where(F.col("ref_id").isNotNull())
