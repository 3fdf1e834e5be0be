"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ID_PREFIX = "KN"


def entity_id(type_name: str, *parts: Column, prefix: str = ID_PREFIX) -> Column:
    """``<prefix>_<TYPE>:<md5>``: depends on the entity alone, not on partitions or earlier runs."""
    text = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_{type_name}:"), F.md5(text))


def row_id(prefix: str, *columns: str) -> Column:
    """``<prefix>:<md5 of the columns>`` for sources without identifiers of their own."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.concat(F.lit(f"{prefix}:"), F.md5(text))


def packed(idx: Column) -> Column:
    """An id as (head, digest): its digest in 16 bytes in place of 32 digits, for rows that are shuffled. An id that does not end in a
    digest is the head as a whole; ``unpacked`` gives every id back."""
    tail = F.right(idx, F.lit(32))
    digest = F.unhex(tail)
    fits = F.coalesce(F.lower(F.hex(digest)) == tail, F.lit(False)) & (F.length(tail) == 32)
    return F.struct(
        F.when(fits, F.substring(idx, F.lit(1), F.length(idx) - 32)).otherwise(idx).alias("head"), F.when(fits, digest).alias("digest")
    )


def unpacked(pack: Column) -> Column:
    """Inverse of ``packed``."""
    return F.concat(pack["head"], F.coalesce(F.lower(F.hex(pack["digest"])), F.lit("")))


def shortened(idx: Column, type_name: str, name: Column, prefix: str = ID_PREFIX) -> Column:
    """``packed``, or null for the id that ``entity_id`` makes of ``name``: rows that are shuffled with the name need not carry it."""
    derived = F.coalesce(idx == entity_id(type_name, name, prefix=prefix), F.lit(False))
    return F.when(~derived, packed(idx))


def lengthened(pack: Column, type_name: str, name: Column, prefix: str = ID_PREFIX) -> Column:
    """Inverse of ``shortened``, for the same name."""
    return F.when(pack.isNull(), entity_id(type_name, name, prefix=prefix)).otherwise(unpacked(pack))


def entity_type(idx: Column) -> Column:
    """Type part of an entity id: the second token between ``_`` and ``:``."""
    return F.upper(F.get(F.split(idx, "_|:"), F.lit(1)))
