"""Declarative source specs and the readers and writers built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from netloom.sources.xml import from_start_tag, record_texts


@dataclass(frozen=True)
class Field:
    """One column of a source: where it is in the file and what it is called here.

    ``raw`` is a header name, or a position in a file without header. Values stay strings unless ``cast`` names a
    type; a value that does not parse becomes null.
    """

    raw: str | int
    name: str
    lower: bool = False
    cast: str | None = None

    def column(self) -> Column:
        raw = f"_c{self.raw}" if isinstance(self.raw, int) else self.raw
        col = F.col(f"`{raw}`")
        if self.lower:
            col = F.lower(col)
        if self.cast:
            col = col.try_cast(self.cast)
        return col.alias(self.name)


@dataclass(frozen=True)
class SourceSpec:
    """Delimited text source."""

    name: str
    fields: tuple[Field, ...]
    sep: str = "\t"
    header: bool = True


@dataclass(frozen=True)
class ChildTable:
    """A list of child elements of a record as a table: where the list is, and which field of a child each column takes."""

    path: str
    columns: Mapping[str, str]


def fields(*items: tuple) -> tuple[Field, ...]:
    """Fields from (raw, name), (raw, name, "lower") or (raw, name, type)."""
    made = []
    for raw, name, *option in items:
        lower = option == ["lower"]
        made.append(Field(raw, name, lower, None if lower or not option else option[0]))
    return tuple(made)


def _delimited(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool) -> DataFrame:
    # Every value is read as a string: one pass, and ids of different sources have one type.
    return spark.read.option("sep", sep).option("header", header).option("inferSchema", False).csv(path)


def read_source(spark: SparkSession, spec: SourceSpec, path: str | Sequence[str]) -> DataFrame:
    """The projected columns of a delimited source."""
    raw = _delimited(spark, path, spec.sep, spec.header)
    return raw.select(*[f.column() for f in spec.fields])


def read_tsv(
    spark: SparkSession,
    path: str | Sequence[str],
    select: Sequence[str] | None = None,
    drop: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """Tab-separated scan, then either a list of expressions to keep or a list of columns to drop."""
    df = _delimited(spark, path, "\t", header)
    return df.drop(*drop) if drop else df.selectExpr(*(select or ["*"]))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    select: Sequence[str] | None = None,
    drop: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """Comma-separated scan, same contract as ``read_tsv``."""
    df = _delimited(spark, path, ",", header)
    return df.drop(*drop) if drop else df.selectExpr(*(select or ["*"]))


def read_positional(spark: SparkSession, path: str | Sequence[str], names: Mapping[int, str], sep: str = "\t") -> DataFrame:
    """Headerless scan; ``names`` maps positions to column names."""
    df = _delimited(spark, path, sep, False)
    return df.select(*[F.col(f"_c{i}").alias(n) for i, n in names.items()])


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, line_no, value): one row per non-empty line.

    (file, block, line_no) orders the lines of a file, however many splits it was read in: a split is read in
    order by one task, and ``block`` is where the split starts.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_no"),
            "value",
        )
        .where(F.length("value") > 0)
    )


def read_stanzas(spark: SparkSession, path: str | Sequence[str], separator: str) -> DataFrame:
    """(file, block, line_no, value): one row per stanza of a text file cut at ``separator``.

    The separator is the record delimiter of the scan, so large files are split and no window over lines is needed.
    """
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def read_xml(
    spark: SparkSession, path: str | Sequence[str], row_tag: str, schema: StructType | str | None = None, nests: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """One row per outermost element ``row_tag``; attributes are ``_name``, mixed text is ``_VALUE``.

    With a schema a large file is split among tasks at end tags. ``nests=False`` promises that no element inside
    ``row_tag`` has the same name; records are then cut without counting depths, in one pass. A record that does not parse is an
    error; with ``mode="PERMISSIVE"`` it is a row of nulls. Without a schema the files are read whole to find the schema.
    """
    if schema is None:
        return spark.read.format("xml").option("rowTag", row_tag).load(path)
    if nests:
        records = record_texts(spark, path, row_tag)
    else:
        chunks = spark.read.option("lineSep", f"</{row_tag}>").text(path)
        records = chunks.select(from_start_tag(F.col("value"), row_tag).alias("value")).where("value <> ''").select(
            F.concat("value", F.lit(f"</{row_tag}>")).alias("value")
        )
    return records.select(F.from_xml("value", schema, {"rowTag": row_tag, "mode": mode}).alias("_x")).select("_x.*")


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", range_by: Sequence[str] = ()
) -> str:
    """Write a table; ``range_by`` lays the files out by key ranges, so readers can skip them."""
    if range_by:
        df = df.repartitionByRange(*range_by)
    df.write.mode(mode).format(fmt).save(path)
    return path


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Headered tab-separated export; one part file only on request, since that is one task."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    return path
