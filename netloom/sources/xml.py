"""Records of XML files that are read in splits, also where a record holds elements of its own name.

The beginning of the record's end tag is the delimiter of a text scan, so a piece begins with the rest of an end tag. Depths add up: each
split is summed up by its net depth and its lowest point, a running sum over the splits of a file gives the depth at which
each split begins, and within a split the pieces are added on from there. A record ends where an end tag leads to depth 0. Text is
shuffled once, by split; only the pieces of records that cross splits meet once more.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SPLIT = ("file", "block")
# What is left of an end tag at the beginning of a piece; other names that begin alike leave something else.
TAG_END = r"^\s*>"


def _start_tag(name: str) -> str:
    """Pattern of a start tag that is not empty (``<name/>``); quoted attribute values may hold anything but their quote."""
    return rf"""<{re.escape(name)}(?=[\s>/])(?:"[^"]*+"|'[^']*+'|[^"'<>])*+(?<!/)>"""


def _visible(text: Column) -> Column:
    """Text without comments and literal sections, in which tags do not count."""
    return F.regexp_replace(text, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")


def _pieces(spark: SparkSession, path: str | Sequence[str], name: str) -> DataFrame:
    """(file, block, at, value, closes, opens): pieces in the order of ``at`` within a split; each closes one element or none and then
    opens some."""
    starts = F.regexp_count(_visible(F.col("value")), F.lit(_start_tag(name)))
    return spark.read.option("lineSep", f"</{name}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", F.col("value").rlike(TAG_END).cast("int").alias("closes"), starts.alias("opens"),
    )


def _in_split() -> Column:
    """Change of depth from the beginning of the split to right after a piece's end tag."""
    return F.sum(F.col("opens") - F.col("closes")).over(Window.partitionBy(*SPLIT).orderBy("at")) - F.col("opens")


def _beginnings(pieces: DataFrame) -> DataFrame:
    """(file, block, depth, ending, since): the depth at the beginning of each split, whether a record ends in it, and the split
    in which the record open at its beginning began.

    Only numbers are shuffled, and one row per split meets the others of its file.
    """
    numbers = pieces.select(*SPLIT, "at", "closes", "opens").withColumn("then", _in_split())
    splits = numbers.groupBy(*SPLIT).agg(
        F.sum(F.col("opens") - F.col("closes")).alias("net"), F.min(F.when(F.col("closes") == 1, F.col("then"))).alias("lowest")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    deep = splits.withColumn("depth", F.coalesce(F.sum("net").over(before), F.lit(0)))
    ending = deep.withColumn("ending", F.coalesce(F.col("depth") + F.col("lowest") <= 0, F.lit(False)))
    # A split in which no record is open at some point goes on with one that began before it.
    own = F.when((F.col("depth") == 0) | F.col("ending"), F.col("block"))
    return ending.select(*SPLIT, "depth", "ending", F.last(own, ignorenulls=True).over(before).alias("since"))


def record_texts(spark: SparkSession, path: str | Sequence[str], name: str) -> DataFrame:
    """(value): the text of each outermost element ``name``, from its start tag to its end tag.

    Comments and literal sections (CDATA) may hold start tags, but no end tag of the element. An empty element ``<name/>`` is no
    record, and neither is one whose end is missing.
    """
    pieces = _pieces(spark, path, name)
    # The summary reads the files once more, numbers only; its rows are broadcast or joined as their number allows.
    beginnings = _beginnings(pieces)
    order = Window.partitionBy(*SPLIT).orderBy("at")
    ends = ((F.col("closes") == 1) & (F.col("depth") + _in_split() == 0)).cast("int")
    # The piece behind the end of a record begins the next one.
    # A window holds the text of a split, so there are two of them only: whether a record ends is read off the piece behind.
    numbered = pieces.join(beginnings, [*SPLIT]).withColumn("ends", ends).withColumns(
        {"nth": F.sum("ends").over(order), "behind": F.lead("ends", 1, 0).over(order)}
    )
    rest = F.when(F.col("ends") == 1, F.regexp_replace("value", TAG_END, "")).otherwise(F.col("value"))
    ordered = F.array_sort(F.collect_list(F.struct("at", rest.alias("value"))))
    records = numbered.groupBy(*SPLIT, "nth", "depth", "since").agg(
        F.transform(ordered, lambda p: p["value"]).alias("values"), F.max("behind").alias("behind")
    )
    begun = (F.col("nth") > 0) | (F.col("depth") == 0)
    ended = F.col("behind") == 1
    whole = records.where(begun & ended).select("values")
    none = F.array().cast("array<string>")
    crossing = records.where(~(begun & ended)).select(
        "file", F.when(begun, F.col("block")).otherwise(F.col("since")).alias("since"), "block", "values", F.lit(False).alias("ended")
    ).unionByName(
        beginnings.where((F.col("depth") > 0) & F.col("ending")).select("file", "since", "block", none.alias("values"), F.lit(True).alias("ended"))
    )
    joined = crossing.groupBy("file", "since").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "values"))), lambda p: p["values"])).alias("values"),
        F.max("ended").alias("ended"),
    )
    text = F.concat(F.array_join("values", f"</{name}"), F.lit(f"</{name}>"))
    texts = whole.unionByName(joined.where("ended").select("values")).select(text.alias("value"))
    return texts.select(from_start_tag(F.col("value"), name).alias("value")).where("value <> ''")


def from_start_tag(text: Column, name: str) -> Column:
    """The text from the first start tag of ``name`` that is not in a comment; empty without one."""
    skipped = r"(?:(?!<!--)(?!" + _start_tag(name) + r").|<!--.*?-->)*+"
    return F.regexp_extract(text, rf"(?s)^{skipped}({_start_tag(name)}.*)$", 1)
