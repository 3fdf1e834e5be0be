"""Semi-structured text to tables: SQL dumps, ontologies, flat files, GTF, FASTA, nested XML."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from netloom.functions.parsing import (
    attribute, fasta_fields, first_value, insert_columns, insert_tuples, quoted_text, stanza_values, tuple_values,
)
from netloom.functions.text import proteins_of_species, quoted_items
from netloom.sources.spec import ChildTable

# Column types of the dump's data definition language by family, and the Spark types that hold all their values.
WHOLE = {"tinyint": "smallint", "smallint": "int", "mediumint": "int", "int": "int", "integer": "int", "bigint": "bigint"}
BROKEN = ("decimal", "dec", "numeric", "fixed", "float", "double", "real")
MOMENTS = {"date": "date", "datetime": "timestamp", "timestamp": "timestamp"}
# Unsigned numbers may need the next wider type.
WIDER = {"int": "bigint", "bigint": "decimal(20,0)"}


def spark_type(declared: str) -> str:
    """Spark type of a declared column such as ``bigint(20) unsigned NOT NULL``; what is no number or moment is text."""
    word = re.match(r"\s*([a-z]*)", declared.lower())[1]
    if word in WHOLE:
        # The families below ``int`` have a type with room to spare already.
        return WIDER.get(WHOLE[word], WHOLE[word]) if "unsigned" in declared.lower() and word in ("int", "integer", "bigint") else WHOLE[word]
    if word in ("bool", "boolean"):
        return "smallint"
    return "double" if word in BROKEN else MOMENTS.get(word, "string")


# --- SQL dump ---------------------------------------------------------------------------------


def dump_columns(lines: DataFrame) -> DataFrame:
    """(file, block, line_no, table, name, declared): columns of the CREATE TABLE statements of a SQL dump.

    ``lines`` comes from ``read_lines``. Only comment and DDL lines are ordered; the data lines, nearly
    all of a dump, are filtered out in the scan.
    """
    value = F.col("value")
    ddl = lines.where(
        ~value.contains("INSERT INTO")
        & (value.startswith("--") | value.contains("CREATE TABLE") | value.contains("`"))
    )
    creates = value.contains("CREATE TABLE")
    parts = F.split(value, "`")
    state = F.when(value.startswith("--"), F.lit("")).when(creates, F.get(parts, F.lit(1)))
    before = Window.partitionBy("file").orderBy("block", "line_no").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        ddl.withColumn("table", F.last(state, ignorenulls=True).over(before))
        .where((F.col("table") != "") & ~creates & value.rlike("^\\s*`"))
        .select("file", "block", "line_no", "table", F.get(parts, F.lit(1)).alias("name"), F.get(parts, F.lit(2)).alias("declared"))
    )


def dump_schema(lines: DataFrame, table: str | None = None) -> list[tuple[str, str]]:
    """(name, type) of a table of a dump, in order; ``table`` may be left out when the dump has one.

    Files of one dump each define the table; their definitions must agree and count once. The driver reads the different
    definitions, two at most.
    """
    columns = dump_columns(lines)
    if table is not None:
        columns = columns.where(F.col("table") == table)
    ordered = F.sort_array(F.collect_list(F.struct("block", "line_no", "name", "declared")))
    found = (
        columns.groupBy("file", "table").agg(F.transform(ordered, lambda c: F.struct(c["name"], c["declared"])).alias("columns"))
        .select("table", "columns").distinct().limit(2).collect()
    )
    if len(found) > 1:
        raise ValueError(f"the dump defines {' and '.join(sorted({r['table'] for r in found}))}, not one table in one way")
    return [(c["name"], spark_type(c["declared"])) for r in found for c in r["columns"]]


def dump_rows(lines: DataFrame, schema: Sequence[tuple[str, str]], table: str | None = None) -> DataFrame:
    """Typed rows of the INSERT statements of a dump, one statement a line; rows whose first value is not a number are dropped.

    Values go to the columns that the statement lists, or else to those of ``schema`` by their place. NULL and missing values, and values that do not
    fit their column's type, are null.
    """
    value = F.col("value")
    named = "[^`]+" if table is None else re.escape(table)
    inserts = lines.where(value.rlike(rf"(?i)^\s*INSERT(?:\s+IGNORE)?\s+INTO\s+`{named}`"))
    rows = inserts.select(insert_columns(value).alias("_c"), F.explode(insert_tuples(value)).alias("_v"))
    cells = rows.select("_c", tuple_values(F.col("_v")).alias("_f"))

    def cell(i: int) -> Column:
        name, kind = schema[i]
        listed = F.get("_f", F.nullif(F.array_position("_c", name), F.lit(0)).cast("int") - 1)
        field = F.when(F.size("_c") == 0, F.get("_f", F.lit(i))).otherwise(listed)
        return field.try_cast(kind).alias(name)

    typed = cells.where(F.get("_f", F.lit(0)).try_cast("decimal(38,0)").isNotNull())
    return typed.select(*[cell(i) for i in range(len(schema))])


def sentences_to_documents(
    sentences: DataFrame, title: str = "ti", abstract: str = "ab"
) -> DataFrame:
    """(PMID, Title, Abstract) from sentence rows (PMID, TYPE, NUMBER, SENTENCE), sentences in NUMBER order, null ones left out.

    One shuffle; a cell holds the sentences of one document.
    """
    def text(kind: str):
        part = F.collect_list(F.when((F.col("TYPE") == kind) & F.col("SENTENCE").isNotNull(), F.struct("NUMBER", "SENTENCE")))
        ordered = F.transform(F.sort_array(part), lambda x: x["SENTENCE"])
        return F.when(F.size(part) > 0, F.array_join(ordered, " "))

    return (
        sentences.select("PMID", "TYPE", "NUMBER", "SENTENCE")
        .groupBy("PMID")
        .agg(text(title).alias("Title"), text(abstract).alias("Abstract"))
        .withColumn("PMID", F.col("PMID").cast("string").try_cast("bigint"))
    )


# --- ontology stanzas -------------------------------------------------------------------------


def ontology_terms(stanzas: DataFrame) -> DataFrame:
    """(id, name, alt_ids, synonyms, parent_ids, parent_names) from stanzas cut at a line-starting ``[``.

    ``stanzas`` comes from ``read_stanzas(..., "\\n[")``. The first ``[Typedef]`` ends a file: only its
    position is compared, so no stanza has to be carried to another task. Obsolete and nameless terms
    are dropped.
    """
    value = F.col("value")
    position = F.struct("block", "line_no")
    ends = (
        stanzas.where(value.startswith("Typedef]") | value.startswith("[Typedef]"))
        .groupBy("file")
        .agg(F.min(position).alias("_end"))
    )
    parents = stanza_values(value, "is_a", ": ")
    terms = (
        stanzas.where(value.startswith("Term]") | value.startswith("[Term]"))
        .join(ends, "file", "left")
        .where(F.col("_end").isNull() | (position < F.col("_end")))
        .select(
            first_value(stanza_values(value, "id", ": ")).alias("id"),
            first_value(stanza_values(value, "name", ": ")).alias("name"),
            stanza_values(value, "alt_id", ": ").alias("alt_ids"),
            F.transform(stanza_values(value, "synonym", ": "), quoted_text).alias("synonyms"),
            F.transform(parents, lambda x: F.substring_index(x, " ! ", 1)).alias("parent_ids"),
            F.transform(parents, lambda x: F.lower(F.get(F.split(x, " ! "), F.lit(1)))).alias("parent_names"),
        )
    )
    return terms.where(F.col("name").isNotNull() & ~F.col("name").contains("obsolete"))


def ontology_aliases(terms: DataFrame) -> DataFrame:
    """(id, name, other_name), lower case: the name of each term and each synonym."""
    names = F.concat(F.array("name"), F.coalesce("synonyms", F.array().cast("array<string>")))
    return (
        terms.select("id", F.lower("name").alias("name"), F.explode(names).alias("other_name"))
        .withColumn("other_name", F.lower("other_name"))
        .distinct()
    )


def ontology_edges(terms: DataFrame) -> DataFrame:
    """(id1, id2): term and parent term."""
    return terms.select(F.col("id").alias("id1"), F.explode("parent_ids").alias("id2"))


# --- enzyme flat file -------------------------------------------------------------------------


def enzyme_records(stanzas: DataFrame, species: str = "Homo sapiens") -> DataFrame:
    """(enzyme_id, enzyme_name, proteins, synonyms) from stanzas cut at a line-starting ``ID`` key.

    ``stanzas`` comes from ``read_stanzas(..., "\\nID\\t")``. Enzymes without a protein line of the species, without a
    name, or transferred to another number are dropped.
    """
    value = F.concat(F.lit("ID\t"), F.regexp_replace("value", "^ID\t", ""))
    keyed = stanzas.select(value.alias("_s"))

    def values(key: str):
        # The value ends at the next tab.
        return F.transform(stanza_values(F.col("_s"), key, "\t"), lambda x: F.trim(F.substring_index(x, "\t", 1)))

    proteins = F.filter(values("PR"), lambda x: F.lower(x).contains(species.lower()))
    names = F.filter(values("SY"), lambda x: ~x.startswith("#"))
    records = keyed.select(
        F.substring_index(first_value(values("ID")), " (", 1).alias("enzyme_id"),
        first_value(values("ID")).alias("_id"),
        first_value(values("RN")).alias("enzyme_name"),
        proteins.alias("_lines"),
        names.alias("synonyms"),
    )
    return records.where(
        (F.size("_lines") > 0) & F.col("enzyme_name").isNotNull() & ~F.col("enzyme_id").contains("transferred to")
    ).select("enzyme_id", "enzyme_name", proteins_of_species(F.col("_lines"), species).alias("proteins"), "synonyms")


# --- GTF, FASTA -------------------------------------------------------------------------------


def gtf_rows(lines: DataFrame) -> DataFrame:
    """(type, info) of annotation lines: third and ninth tab-separated column."""
    parts = F.split("value", "\t")
    return lines.select(F.get(parts, F.lit(2)).alias("type"), F.get(parts, F.lit(8)).alias("info"))


def gtf_attributes(rows: DataFrame, plain: Sequence[str], repeated: Sequence[str] = ()) -> DataFrame:
    """(type, one column per attribute), distinct. Repeated and numbered attributes are joined with ``;``."""
    info = F.col("info")
    return rows.select(
        "type",
        *[attribute(info, k).alias(k) for k in plain],
        *[attribute(info, k, numbered=True).alias(k) for k in repeated],
    ).distinct()


def lncrna_transcripts(lines: DataFrame) -> DataFrame:
    """(type, gene_id, transcript_id, gene_alias, transcript_alias) of the chromosome lines of a GTF file."""
    rows = gtf_rows(lines.where(F.col("value").contains("chr")))
    return gtf_attributes(rows, ["gene_id", "transcript_id"], ["gene_alias", "transcript_alias"])


def lncrna_genes(lines: DataFrame) -> DataFrame:
    """Gene and transcript rows of the second GTF layout, with gene and transcript types."""
    rows = gtf_rows(lines).where(F.col("type").isin("gene", "transcript"))
    parsed = gtf_attributes(
        rows, ["gene_id", "gene_type", "transcript_id", "transcript_type"], ["transcript_alias"]
    )
    return parsed.select(
        "gene_id", F.replace("gene_type", F.lit(";"), F.lit("")).alias("gene_type"), "transcript_id",
        "transcript_type", F.col("transcript_alias").alias("transcript_aliases"),
    ).distinct()


def transcripts(lines: DataFrame, rna_type: str = "mRNA", species: str = "Homo sapiens") -> DataFrame:
    """(RNA_id, RNA_name, gene_name, variant, type) from FASTA headers of one RNA type and species.

    Predicted transcripts and headers without a gene are dropped; the version suffix is cut from the id.
    """
    value = F.col("value")
    headers = lines.where(value.contains(">") & value.contains(rna_type) & value.contains(species))
    parsed = headers.select(*[c.alias(n) for n, c in fasta_fields(value, species).items()])
    return parsed.where(F.col("gene_name").isNotNull() & ~F.col("RNA_id").contains("PREDICTED")).withColumn(
        "RNA_id", F.substring_index("RNA_id", ".", 1)
    )


# --- nested records ---------------------------------------------------------------------------

ARTICLE_SCHEMA = (
    "MedlineCitation struct<"
    "PMID: struct<_VALUE: bigint, _Version: string>, "
    "Article: struct<ArticleTitle: string, Abstract: struct<AbstractText: array<string>>>>"
)


def articles(records: DataFrame) -> DataFrame:
    """(PMID, Title, Abstract) from article records: paragraphs joined with a space, missing text empty.

    A text field with inline markup comes as its inner XML and is reduced to plain text.
    """
    article = "MedlineCitation.Article"
    return records.select(
        F.col("MedlineCitation.PMID._VALUE").alias("PMID"),
        F.coalesce(plain_text(F.col(f"{article}.ArticleTitle")), F.lit("")).alias("Title"),
        F.coalesce(
            F.array_join(F.transform(f"{article}.Abstract.AbstractText", plain_text), " "), F.lit("")
        ).alias("Abstract"),
    )


def plain_text(markup: Column) -> Column:
    """Text of a field with inline tags: the tags go.

    Only names of elements in use for inline markup count as tags, so a "<" of the text itself stays.
    """
    return F.regexp_replace(markup, r"</?(?:i|b|u|sub|sup|sc|em|strong|mml:[a-z]+)(?:\s[^<>]*)?/?>", "")


def child_rows(records: DataFrame, keys: Mapping[str, str], table: ChildTable) -> DataFrame:
    """(keys, columns of ``table``): one distinct row per child; records without children have none."""
    children = F.expr(".".join(f"`{name}`" for name in table.path.split(".")))
    found = records.select(*[F.expr(source).alias(key) for key, source in keys.items()], F.explode(children).alias("child"))
    return found.select(*keys, *[F.col("child").getField(field).alias(name) for name, field in table.columns.items()]).distinct()


def component_parts(records: DataFrame, keys: dict[str, str], path: str, organism: str = "Humans") -> DataFrame:
    """(keys, component, component_name, part, part_name, source, gene, synonyms, references): a row per polypeptide.

    Components of other organisms are dropped. The lists of a polypeptide stay in its row, so that none multiplies another;
    ``part_synonyms`` and ``part_references`` make child tables of them.
    """
    field = ".".join(f"`{p}`" for p in path.split("."))
    components = records.select(*[F.expr(e).alias(n) for n, e in keys.items()], F.explode(F.expr(field)).alias("c"))
    return components.where(F.col("c.organism").contains(organism)).select(
        *keys, F.col("c.id").alias("component"), F.col("c.name").alias("component_name"), F.explode("c.polypeptide").alias("p")
    ).select(
        *keys, "component", "component_name", F.col("p._id").alias("part"), F.col("p.name").alias("part_name"),
        F.col("p._source").alias("source"), F.col("p.`gene-name`").alias("gene"), F.col("p.synonyms.synonym").alias("synonyms"),
        F.col("p.`external-identifiers`.`external-identifier`").alias("references"),
    )


def part_synonyms(parts: DataFrame) -> DataFrame:
    """(component, part, synonym), distinct."""
    return parts.select("component", "part", F.explode("synonyms").alias("synonym")).distinct()


def part_references(parts: DataFrame) -> DataFrame:
    """(component, part, resource, identifier), distinct."""
    return parts.select("component", "part", F.explode("references").alias("r")).select(
        "component", "part", "r.resource", "r.identifier"
    ).distinct()


def explode_quoted(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One row per item of a quoted list column; rows without a list are dropped."""
    rows = df.where(F.col(column).isNotNull())
    return rows.select(*keys, F.explode(quoted_items(F.col(column))).alias(column))
