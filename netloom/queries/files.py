"""Sources and sinks: the tables are written in a source format to the shared folder and read back by the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from netloom.operators import textjobs
from netloom.plans import databases
from netloom.queries.entities import relations_of, text
from netloom.queries.registry import Registry, Tables
from netloom.queries.sqltext import same_type_relation, typed_relation, with_ctes
from netloom.session import delete_at_exit, delete_now, materialize, new_path
from netloom.sources import catalog
from netloom.sources.spec import (
    SourceSpec, fields, read_csv, read_json, read_lines, read_positional, read_source, read_stanzas, read_table,
    read_tsv, read_xml, write_table, write_tsv,
)
from netloom.streaming.intake import article_stream, start_intake, table_stream

QUERIES = Registry()
register = QUERIES.register


def put_delimited(t: Tables, df: DataFrame, label: str, sep: str, header: bool = True) -> str:
    path = new_path(t.spark, label)
    df.write.option("sep", sep).option("header", header).csv(path)
    return delete_at_exit(t.spark, path)


def put_text(t: Tables, values: DataFrame, label: str) -> str:
    path = new_path(t.spark, label)
    values.write.text(path)
    return delete_at_exit(t.spark, path)


# --- delimited, JSON, parquet ---------------------------------------------------------------------


@register("select cast(p_partkey as varchar) as id, lower(p_name) as name, p_size as size from part")
def tsv_scan(t: Tables) -> DataFrame:
    spec = SourceSpec("parts", fields(("p_partkey", "id"), ("p_name", "name", "lower"), ("p_size", "size", "int")))
    return read_source(t.spark, spec, put_delimited(t, t.part, "tsv", "\t"))


@register("select cast(p_partkey as varchar) as p_partkey, p_brand, p_type from part")
def tsv_scan_dropping_columns(t: Tables) -> DataFrame:
    path = put_delimited(t, t.part.select("p_partkey", "p_name", "p_brand", "p_type"), "tsv", "\t")
    return read_tsv(t.spark, path, drop=["p_name"])


@register("select cast(c_custkey as varchar) as id, upper(c_name) as name from customer")
def csv_scan(t: Tables) -> DataFrame:
    path = put_delimited(t, t.customer.select("c_custkey", "c_name"), "csv", ",")
    return read_csv(t.spark, path, select=["c_custkey as id", "upper(c_name) as name"])


@register("select cast(o_orderkey as varchar) as id, o_orderpriority as priority from orders")
def headerless_scan(t: Tables) -> DataFrame:
    path = put_delimited(t, t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), "plain", "\t", header=False)
    return read_positional(t.spark, path, {0: "id", 2: "priority"})


@register(
    "select cast(l_orderkey as varchar) as protein1, cast(l_partkey as varchar) as protein2, cast(l_quantity as integer) as score "
    "from lineitem"
)
def space_separated_scan(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("protein1"), F.col("l_partkey").alias("protein2"),
        F.col("l_quantity").cast("int").alias("combined_score"),
    )
    return read_source(t.spark, catalog.NETWORK_PROTEIN_LINKS, put_delimited(t, rows, "links", " "))


@register("select doc_id, lang, md5(text) as digest from documents")
def json_scan(t: Tables) -> DataFrame:
    path = write_table(t.documents, new_path(t.spark, "json"), fmt="json")
    found = read_json(t.spark, path, "doc_id bigint, lang string, text string")
    return found.select("doc_id", "lang", F.md5("text").alias("digest"))


@register("select l_orderkey, l_partkey from lineitem")
def parquet_scan(t: Tables) -> DataFrame:
    path = write_table(t.lineitem, new_path(t.spark, "ranges"), range_by=["l_partkey"])
    return read_table(t.spark, path, ["l_orderkey", "l_partkey"])


@register("select cast(n_nationkey as varchar) as id, n_name as name from nation")
def tsv_export(t: Tables) -> DataFrame:
    """Single-file export, read back."""
    rows = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return read_tsv(t.spark, write_tsv(rows, new_path(t.spark, "export"), single_file=True))


@register(
    "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from documents) d "
    "where length(line) > 0 group by all"
)
def line_scan(t: Tables) -> DataFrame:
    path = put_text(t, t.documents.select(F.col("text").alias("value")), "lines")
    return read_lines(t.spark, path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


# --- SQL dump -------------------------------------------------------------------------------------

DUMP_HEADER = (
    "-- Table structure",
    "DROP TABLE IF EXISTS `SENTENCE`;",
    "CREATE TABLE `SENTENCE` (",
    "  `SENTENCE_ID` bigint(20) NOT NULL,",
    "  `PMID` varchar(20) NOT NULL,",
    "  `TYPE` varchar(2) NOT NULL,",
    "  `NUMBER` int(10) unsigned NOT NULL,",
    "  `SENTENCE` text,",
    "  PRIMARY KEY (`SENTENCE_ID`),",
    ") ENGINE=InnoDB;",
    "-- Dumping data",
)


ODD_TEXT = "it's a 'quote'),(1,'2"


def dump_parts(t: Tables) -> list[str]:
    """The conversations as a SQL dump: the definition of the table beside data files, a statement per turn and a tuple per line of text.

    Empty lines are NULL, every fifth conversation lists its columns in another order, and its lines end in a text that looks like SQL.
    """
    kind = F.when(F.col("role") == "user", "ti").otherwise("ab")
    listed = F.pmod("conv_id", F.lit(5)) == 0

    def written(line: Column) -> Column:
        whole = F.when(listed, F.concat(line, F.lit(ODD_TEXT))).otherwise(line)
        escaped = F.replace(F.replace(whole, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
        return F.when(whole == "", F.lit("NULL")).otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))

    def as_tuple(line: Column, i: Column) -> Column:
        number = F.lit(3000000000) + F.col("turn") * 1000000 + i
        values = [number.cast("string"), F.concat(F.lit("'"), "conv_id", F.lit("'")), F.concat(F.lit("'"), kind, F.lit("'")), number.cast("string"), written(line)]
        other = [*values[:1], *values[:0:-1]]
        return F.concat(F.lit("("), F.when(listed, F.concat_ws(",", *other)).otherwise(F.concat_ws(",", *values)), F.lit(")"))

    tuples = F.array_join(F.transform(F.split("text", "\n"), as_tuple), ",")
    columns = F.when(listed, " (`SENTENCE_ID`, `SENTENCE`, `NUMBER`, `TYPE`, `PMID`)").otherwise("")
    data = t.conversations.select(F.concat(F.lit("INSERT INTO `SENTENCE`"), columns, F.lit(" VALUES "), tuples, F.lit(";")).alias("value"))
    definition = t.spark.createDataFrame([(line,) for line in DUMP_HEADER], "value string").coalesce(1)
    return [put_text(t, definition, "dump-definition"), put_text(t, data, "dump-data")]


@register(
    "with s as (select conv_id, role, turn * 1000000 + i as n, nullif(line || case when conv_id % 5 = 0 then "
    f"""'{ODD_TEXT.replace("'", "''")}' else '' end, '') as line from (select conv_id, role, """
    "turn, unnest(generate_series(0, len(l) - 1)) as i, unnest(l) as line from (select conv_id, role, turn, "
    "string_split(text, chr(10)) as l from conversations) c) q) "
    "select conv_id as pmid, string_agg(case when role = 'user' then line end, ' ' order by n) as title, "
    "string_agg(case when role <> 'user' then line end, ' ' order by n) as abstract from s group by all"
)
def sql_dump_sentences(t: Tables) -> DataFrame:
    """A dump whose definition and data are files of their own, with nulls, quotes and numbers beyond 31 bits."""
    lines = read_lines(t.spark, dump_parts(t))
    rows = textjobs.dump_rows(lines, textjobs.dump_schema(lines, "SENTENCE"), "SENTENCE")
    found = textjobs.sentences_to_documents(rows)
    return found.toDF(*[c.lower() for c in found.columns])


# --- stanza files ---------------------------------------------------------------------------------


def ontology_file(t: Tables) -> str:
    name = F.when(F.col("p_size") == 1, F.concat(F.lit("obsolete "), F.col("p_name"))).otherwise(F.col("p_name"))
    stanza = F.concat(
        F.lit("[Term]\nid: PART:"), F.col("p_partkey"), F.lit("\nname: "), name,
        F.lit("\nalt_id: OLD:"), F.col("p_size"), F.lit('\nsynonym: "'), F.col("p_brand"), F.lit('" EXACT []\nsynonym: "'),
        F.col("p_type"), F.lit('" RELATED []\nis_a: TYPE:'), F.col("p_type"), F.lit(" ! "), F.col("p_type"), F.lit("\n"),
    )
    return put_text(t, t.part.select(stanza.alias("value")), "ontology")


def _ontology(t: Tables) -> DataFrame:
    return textjobs.ontology_terms(read_stanzas(t.spark, ontology_file(t), "\n["))


@register(
    "select 'PART:' || p_partkey as id, p_name as name, 'OLD:' || p_size as alt_ids, p_brand || '|' || p_type as synonyms, "
    "'TYPE:' || p_type as parent_ids, lower(p_type) as parent_names from part where p_size <> 1"
)
def stanza_terms(t: Tables) -> DataFrame:
    lists = [F.array_join(c, "|").alias(c) for c in ("alt_ids", "synonyms", "parent_ids", "parent_names")]
    return _ontology(t).select("id", "name", *lists)


@register(
    "select distinct 'PART:' || p_partkey as id, lower(p_name) as name, lower(unnest([p_name, p_brand, p_type])) as other_name "
    "from part where p_size <> 1"
)
def stanza_aliases(t: Tables) -> DataFrame:
    return textjobs.ontology_aliases(_ontology(t))


@register("select 'PART:' || p_partkey as id1, 'TYPE:' || p_type as id2 from part where p_size <> 1")
def stanza_edges(t: Tables) -> DataFrame:
    return textjobs.ontology_edges(_ontology(t))


@register(
    "select '1.1.' || p_partkey as enzyme_id, p_name as enzyme_name, 'P' || p_partkey as proteins, p_brand as synonyms "
    "from part where p_size > 10 and p_size <> 50"
)
def enzyme_stanzas(t: Tables) -> DataFrame:
    moved = F.when(F.col("p_size") == 50, "transferred to EC 9.9 (x)").otherwise(F.concat(F.lit("1.1."), F.col("p_partkey"), F.lit(" (x)")))
    species = F.when(F.col("p_size") > 10, "Homo sapiens").otherwise("Mus musculus")
    stanza = F.concat(
        F.lit("ID\t"), moved, F.lit("\n***\n\nPROTEIN\nPR\t#1# "), species, F.lit(" P"), F.col("p_partkey"),
        F.lit(" UniProt <1,2>\nPR\t#2# Bos taurus Q1 UniProt <3>\n\nRECOMMENDED_NAME\nRN\t"), F.col("p_name"),
        F.lit("\nSYNONYMS\nSY\t"), F.col("p_brand"), F.lit("\nSY\t#1# "), F.col("p_type"), F.lit("\n"),
    )
    path = put_text(t, t.part.select(stanza.alias("value")), "enzymes")
    found = textjobs.enzyme_records(read_stanzas(t.spark, path, "\nID\t"))
    return found.select(
        "enzyme_id", "enzyme_name", F.array_join("proteins", "|").alias("proteins"), F.array_join("synonyms", "|").alias("synonyms")
    )


# --- XML ------------------------------------------------------------------------------------------


def xml_file(t: Tables, df: DataFrame, label: str, root: str, row: str) -> str:
    path = new_path(t.spark, label)
    df.write.format("xml").option("rootTag", root).option("rowTag", row).save(path)
    return delete_at_exit(t.spark, path)


ARTICLE_TEXT = "md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), ' '))"


def article_record(pmid: Column, title: Column, abstract: Column) -> Column:
    return F.concat(
        F.lit('<PubmedArticle><MedlineCitation><PMID Version="1">'), pmid.cast("string"), F.lit("</PMID><Article><ArticleTitle>"), title,
        F.lit("</ArticleTitle>"), abstract, F.lit("</Article></MedlineCitation></PubmedArticle>"),
    ).alias("value")


def article_records(documents: DataFrame) -> DataFrame:
    """(value): an article record per document, its source and language as title."""
    def escaped(c: Column) -> Column:
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    paragraphs = F.transform(
        F.split("text", "\n"), lambda x: F.concat(F.lit("<AbstractText>"), escaped(x), F.lit("</AbstractText>"))
    )
    return documents.select(article_record(
        F.col("doc_id"), F.concat(F.lit("<i>"), "source", F.lit("</i> "), "lang"),
        F.concat(F.lit("<Abstract>"), F.array_join(paragraphs, ""), F.lit("</Abstract>")),
    ))


@register(
    f"select doc_id as pmid, md5(source || ' ' || lang) as title, {ARTICLE_TEXT} as abstract from documents "
    "union all select -1 - nation.n_nationkey, md5(n_name || ' in vivo'), md5('') from nation"
)
def xml_articles(t: Tables) -> DataFrame:
    """Documents as article records, a paragraph per line and inline tags in the title; the nations have no abstract."""
    written = article_records(t.documents).unionByName(t.nation.select(article_record(
        -1 - F.col("n_nationkey"), F.concat("n_name", F.lit(' <i class="x">in vivo</i>')), F.lit("")
    )))
    # An article record holds no other one.
    records = read_xml(t.spark, put_text(t, written, "articles"), "PubmedArticle", textjobs.ARTICLE_SCHEMA, nests=False)
    found = textjobs.articles(records)
    return found.select(F.col("PMID").alias("pmid"), F.md5("Title").alias("title"), F.md5("Abstract").alias("abstract"))


DRUG_KEYS = {"drug_id": "get(`drugbank-id`, 0)._VALUE", "drug_name": "name"}


def drug_records(t: Tables, *wanted: str) -> DataFrame:
    """Parts as nested drug records, written as XML and read back; with ``wanted``, only these elements of a record are parsed."""
    key, brand, kind, size = (F.col(c) for c in ("p_partkey", "p_brand", "p_type", "p_size"))
    drug_id = F.concat(F.lit("DB"), key)

    def ref(resource: str, value: Column) -> Column:
        return F.struct(F.lit(resource).alias("resource"), value.alias("identifier"))

    polypeptide = F.struct(
        F.concat(F.lit("P"), key).alias("_id"), F.lit("Swiss").alias("_source"), F.col("p_name").alias("name"),
        brand.alias("gene-name"),
        F.struct(F.array(ref("HGNC", F.concat(F.lit("H"), key)), ref("GB", F.concat(F.lit("G"), key))).alias("external-identifier"))
        .alias("external-identifiers"),
        F.struct(F.array(kind, brand).alias("synonym")).alias("synonyms"),
    )

    def target(number: int, organism: Column) -> Column:
        return F.struct(
            F.concat(F.lit(f"BE{number}-"), key).alias("id"), F.concat(F.lit(f"t{number} "), kind).alias("name"),
            organism.alias("organism"), F.array(polypeptide).alias("polypeptide"),
        )

    def pathway(number: int) -> Column:
        inner = F.struct(F.array(F.struct(F.concat(F.lit("DB"), key + number).alias("_VALUE"))).alias("drugbank-id"), F.lit("inner").alias("name"))
        return F.struct(F.lit(f"w{number}").alias("name"), F.struct(F.array(inner, inner).alias("drug")).alias("drugs"))

    organism = F.when(size > 25, "Humans").otherwise("Yeast")
    interactions = F.array(
        F.struct(F.concat(F.lit("DB"), key + 1).alias("drugbank-id"), F.col("p_name").alias("name")),
        F.struct(F.concat(F.lit("DB"), key + 2).alias("drugbank-id"), F.col("p_name").alias("name")),
    )
    records = t.part.select(
        F.array(F.struct(drug_id.alias("_VALUE"), F.lit("true").alias("_primary")), F.struct(F.lit("old").alias("_VALUE"), F.lit("false").alias("_primary"))).alias("drugbank-id"),
        F.col("p_name").alias("name"),
        F.struct(F.array(*[F.struct(c.alias("_VALUE"), F.lit("en").alias("_language")) for c in (brand, kind)]).alias("synonym")).alias("synonyms"),
        F.when(size > 10, F.struct(interactions.alias("drug-interaction"))).alias("drug-interactions"),
        F.struct(F.array(target(1, F.lit("Humans")), target(2, organism)).alias("target")).alias("targets"),
        # Drugs inside a drug: what they hold belongs to no record.
        F.when(size > 5, F.struct(F.array(pathway(1), pathway(2)).alias("pathway"))).alias("pathways"),
    )
    schema = StructType.fromDDL(catalog.DRUG_XML_SCHEMA)
    parsed = StructType([f for f in schema if not wanted or f.name in wanted])
    return read_xml(t.spark, xml_file(t, records, "drugs", "drugbank", "drug"), catalog.DRUG_XML_ROW, parsed)


@register("select distinct 'DB' || p_partkey as drug_id, p_name as drug_name, unnest([p_brand, p_type]) as other_name from part")
def nested_flatten(t: Tables) -> DataFrame:
    return textjobs.child_rows(drug_records(t, "drugbank-id", "name", "synonyms"), DRUG_KEYS, catalog.DRUG_SYNONYMS)


@register(
    "select distinct 'DB' || p_partkey as drug_id, p_name as drug_name, 'DB' || (p_partkey + n) as partner_id, "
    "p_name as partner_name from part, (select unnest([1, 2]) as n) k where p_size > 10"
)
def nested_flatten_optional(t: Tables) -> DataFrame:
    """Records without children have no rows."""
    return textjobs.child_rows(drug_records(t, "drugbank-id", "name", "drug-interactions"), DRUG_KEYS, catalog.DRUG_INTERACTIONS)


@register(
    "select distinct 'DB' || p_partkey as drug_id, p_name as drug_name, 'BE' || n || '-' || p_partkey as component, "
    "'t' || n || ' ' || p_type as component_name, 'P' || p_partkey as part, p_brand as gene, kind, value from part, "
    "(select unnest([1, 2]) as n) k, lateral (select unnest(['synonym', 'synonym', 'HGNC', 'GB']) as kind, "
    "unnest([p_type, p_brand, 'H' || p_partkey, 'G' || p_partkey]) as value) c where n = 1 or p_size > 25"
)
def nested_polypeptides(t: Tables) -> DataFrame:
    """Three nested levels, the innermost as child tables; components of other organisms are dropped."""
    records = drug_records(t, "drugbank-id", "name", "targets")
    # Three tables are made of the parts; the records are read and parsed once.
    parts = materialize(textjobs.component_parts(records, DRUG_KEYS, catalog.DRUG_TARGETS), "parts")
    synonyms = textjobs.part_synonyms(parts).select("component", "part", F.lit("synonym").alias("kind"), F.col("synonym").alias("value"))
    references = textjobs.part_references(parts).toDF("component", "part", "kind", "value")
    own = parts.select("drug_id", "drug_name", "component", "component_name", "part", "gene").distinct()
    return own.join(synonyms.unionByName(references), ["component", "part"])


DRUG_CTES = [
    "rec as (select 'DB' || p_partkey as id, p_name as name, p_partkey as k, p_type, p_brand, p_size from part)",
    "ph as (select 'PA' || s_suppkey as id, s_name as name, 'DB' || s_suppkey as ref from supplier)",
    "pairs as (select ref as l, id as r from ph union all select id, null from rec where id not in (select ref from ph))",
    "ids as (select l, r, 'KN_DRUG:' || md5(coalesce(l, '') || '|' || coalesce(r, '')) as idx from pairs)",
    "named as (select idx, l as id, name from ids join rec on l = rec.id union select idx, r, name from ids join ph on r = ph.id)",
    "i_source as (select distinct idx, min(name) over (partition by idx) as name, id from named)",
    "tg as (select rec.*, n, 'target:BE' || n || '-' || k as ref from rec, (select unnest([1, 2]) as n) where n = 1 or p_size > 25)",
]


@register(with_ctes(DRUG_CTES, " union ".join([
    same_type_relation(
        "i", "select id as id1, 'DB' || (k + n) as id2 from rec, (select unnest([1, 2]) as n) where p_size > 10", "drug"
    ),
    typed_relation("i", "select id, 't' || n || ' ' || p_type as name2, ref as reference from tg", "drug-target"),
    typed_relation("i", "select id, p_brand as name2, '' as reference from tg", "drug-gene"),
])))
def drug_database(t: Tables) -> DataFrame:
    """Parts as XML records and suppliers as a table with quoted lists, which names its counterpart among the records."""
    pharma = t.supplier.select(
        text("PA{}", "s_suppkey").alias("PGKB_ID"), F.col("s_name").alias("DRUG_NAME"),
        text('"generic {}", "{}"', "s_suppkey", "s_name").alias("Generic_Name"), F.lit(None).cast("string").alias("Trade_Names"),
        text('"{}"', "s_name").alias("Brand_Mixtures"), text('"DrugBank:DB{}", "Web:x"', "s_suppkey").alias("Cross_references"),
        F.lit("Drug").alias("Type"),
    )
    return relations_of(databases.drugs(materialize(drug_records(t), "drugs"), pharma))


# --- streaming ------------------------------------------------------------------------------------


@register("select md5(text) as pmid, min(doc_id) as doc_id from documents group by all")
def stream_intake(t: Tables) -> DataFrame:
    """The documents file as a stream, appended to an empty corpus once per distinct text."""
    schema = t.documents.schema
    # A pattern finds the table whether it is one file or a folder of files.
    stream = table_stream(t.spark, f"{t.folder}/documents.parque[t]", schema).select(F.md5("text").alias("pmid"), "doc_id")
    corpus, checkpoint = new_path(t.spark, "corpus"), new_path(t.spark, "intake-checkpoint")
    query = start_intake(stream, corpus, checkpoint, buckets=16)
    query.awaitTermination()
    delete_now(t.spark, checkpoint)
    return read_table(t.spark, delete_at_exit(t.spark, corpus), ["pmid", "doc_id"])


@register(
    f"select doc_id as pmid, md5(source || ' ' || lang) as title, {ARTICLE_TEXT} as abstract from documents where doc_id is not null"
)
def stream_articles(t: Tables) -> DataFrame:
    """All documents as article files that arrive one by one, some again in a later file; known before are none."""
    inbox = new_path(t.spark, "inbox")
    half = F.pmod("doc_id", F.lit(2))
    for arriving in (t.documents.where(half == 0), t.documents.where((half == 1) | (F.pmod("doc_id", F.lit(3)) == 0))):
        article_records(arriving).write.mode("append").text(inbox)
    delete_at_exit(t.spark, inbox)
    corpus, checkpoint = new_path(t.spark, "corpus"), new_path(t.spark, "intake-checkpoint")
    stream = article_stream(t.spark, inbox, files_per_batch=8).withColumnRenamed("PMID", "pmid")
    start_intake(stream, corpus, checkpoint, buckets=8).awaitTermination()
    delete_now(t.spark, checkpoint)
    found = read_table(t.spark, delete_at_exit(t.spark, corpus))
    return found.select("pmid", F.md5("Title").alias("title"), F.md5("Abstract").alias("abstract"))
