"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The six ASCII white-space characters that separate words and are dropped by the normal form of a text.
SPACE = r"\x20\x09-\x0D"


def column(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` by its exact name, dots and back-ticks included."""
    return df[f"`{name.replace('`', '``')}`"]


def whole_text(df: DataFrame, name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)
