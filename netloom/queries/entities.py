"""Entity indexes, relations and the nine entity databases, with the supplied tables in the place of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netloom.operators import textjobs
from netloom.operators.entity_index import EntityIndex, build_index, build_index_by_xref
from netloom.operators.networks import match_proteins, without_taxon
from netloom.operators.relations import Far, consolidate, same_type_relations, typed_relations
from netloom.plans import databases
from netloom.queries.registry import Registry, Tables
from netloom.queries.sqltext import LONG_INDEX, index_ctes, same_type_relation, typed_relation, with_ctes
from netloom.session import delete_at_exit, materialize, new_path
from netloom.sources import catalog
from netloom.sources.spec import read_lines, read_source, read_stanzas

QUERIES = Registry()
register = QUERIES.register


def long_index(index: EntityIndex) -> DataFrame:
    key = [F.col("IDX").alias("idx"), F.col("NAME").alias("name")]
    return index.aliases.select(*key, F.lit("alias").alias("kind"), F.col("alias").alias("value")).unionByName(
        index.source_ids.select(*key, F.lit("source").alias("kind"), F.col("SOURCE_ID").alias("value"))
    )


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def text(value: str, *columns: str) -> Column:
    """``value`` with each {} replaced by a column."""
    return F.format_string(value.replace("{}", "%s"), *[F.col(c) for c in columns])


def text_file(t: Tables, value: Column, rows: DataFrame, label: str) -> str:
    """Compressed text files with one record per row; none is so large that the one task which reads it falls behind."""
    path = new_path(t.spark, label)
    rows.select(value.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", 100_000).text(path)
    return delete_at_exit(t.spark, path)


# --- alias indexes --------------------------------------------------------------------------------

PARTS_SOURCE = (
    "select p_partkey as id, p_name as name, unnest([p_brand, p_type]) as alias from part"
)


def part_source(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.explode(F.array("p_brand", "p_type")).alias("other_name"),
    )


@register(with_ctes([index_ctes("i", "PART", [PARTS_SOURCE])], LONG_INDEX.format(p="i")))
def alias_index_one_source(t: Tables) -> DataFrame:
    """Parts with the same name are one entity."""
    return long_index(build_index("PART", [part_source(t)]))


@register(
    "with c as (select cast(c_custkey as varchar) as id, nullif(c_mktsegment, 'BUILDING') as name, c_name as alias from customer), "
    "e as (select id, name, alias, 'KN_BUYER:' || md5(coalesce(name, '|0:' || id)) as idx from c) "
    "select idx, name, 'alias' as kind, alias as value from e union all select idx, name, 'source', id from e"
)
def alias_index_unnamed(t: Tables) -> DataFrame:
    """Customers of a segment are one entity; those without a name are entities of their own."""
    source = t.customer.select(
        F.col("c_custkey").alias("id"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("name"), F.col("c_name").alias("other_name")
    )
    return long_index(build_index("BUYER", [source]))


def line_source_sql(table: str, key: str, tag: str) -> str:
    return (
        f"select '{tag}' || {key} as id, md5(text) as name, unnest(string_split(text, chr(10))) as alias from {table}"
    )


def line_source(df: DataFrame, key: str, tag: str) -> DataFrame:
    return df.select(
        F.concat(F.lit(tag), F.col(key)).alias("id"), F.md5("text").alias("name"),
        F.explode(F.split("text", "\n")).alias("other_name"),
    )


@register(
    with_ctes(
        [index_ctes("i", "TEXT", [line_source_sql("benchmark", "item_id", "B"), line_source_sql("documents", "doc_id", "D")])],
        LONG_INDEX.format(p="i"),
    )
)
def alias_index_two_sources(t: Tables) -> DataFrame:
    """Benchmark passages and documents that share a line; copies of a text are one entity."""
    return long_index(
        build_index("TEXT", [line_source(t.benchmark, "item_id", "B"), line_source(t.documents, "doc_id", "D")])
    )


LINE_ALIAS_SQL = "l_partkey || '/' || cast(l_quantity as integer)"
THREE_SOURCES_SQL = [
    f"select 'S' || l_suppkey as id, s_name as name, {LINE_ALIAS_SQL} as alias from lineitem "
    "join supplier on l_suppkey = s_suppkey where l_returnflag = 'R'",
    f"select 'O' || l_orderkey as id, 'order ' || l_orderkey as name, {LINE_ALIAS_SQL} as alias from lineitem "
    "where l_returnflag = 'A'",
    f"select 'L' || l_orderkey || '-' || l_linenumber as id, 'line ' || l_orderkey || '-' || l_linenumber as name, "
    f"{LINE_ALIAS_SQL} as alias from lineitem where l_returnflag = 'N'",
]


def three_sources(t: Tables) -> list[DataFrame]:
    alias = F.concat_ws("/", F.col("l_partkey"), F.col("l_quantity").cast("int")).alias("other_name")
    flag = F.col("l_returnflag")
    suppliers = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return [
        suppliers.where(flag == "R").select(text("S{}", "l_suppkey").alias("id"), F.col("s_name").alias("name"), alias),
        t.lineitem.where(flag == "A").select(
            text("O{}", "l_orderkey").alias("id"), text("order {}", "l_orderkey").alias("name"), alias
        ),
        t.lineitem.where(flag == "N").select(
            text("L{}-{}", "l_orderkey", "l_linenumber").alias("id"),
            text("line {}-{}", "l_orderkey", "l_linenumber").alias("name"), alias,
        ),
    ]


@register(with_ctes([index_ctes("i", "ORDERED", THREE_SOURCES_SQL)], LONG_INDEX.format(p="i")))
def alias_index_three_sources(t: Tables) -> DataFrame:
    """Suppliers of returned lines, orders of accepted lines and the open lines, by part and quantity."""
    return long_index(build_index("ORDERED", three_sources(t)))


@register(
    with_ctes(
        [index_ctes("i", "CUSTOMER", ["select o_orderkey as id, c_name as name, o_orderpriority as alias "
                                      "from orders join customer on o_custkey = c_custkey"])],
        "select idx, name, (select string_agg(alias, ',' order by alias) from i_alias a where a.idx = e.idx) as other_name, "
        "(select string_agg(id, ',' order by id) from i_source s where s.idx = e.idx) as source_id "
        "from (select distinct idx, name from i_source) e",
    )
)
def alias_index_nested(t: Tables) -> DataFrame:
    """The stored form of an index: one row per customer with the orders and their priorities as arrays."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("c_name").alias("name"), F.col("o_orderpriority").alias("other_name")
    )
    return build_index("CUSTOMER", [rows]).nested().select(
        F.col("IDX").alias("idx"), F.col("customer_name").alias("name"),
        F.array_join("other_name", ",").alias("other_name"), F.array_join("SOURCE_ID", ",").alias("source_id"),
    )


XREF_SQL = """with pr as (select o_custkey as l, l_suppkey as r, l_returnflag as f from lineitem join orders on l_orderkey = o_orderkey),
refs as (select distinct 'C' || l as l, 'S' || r as r from pr),
a as (select coalesce(refs.l, c.l) as l, refs.r from refs full join (select 'C' || c_custkey as l from customer) c using (l)),
b as (select a.l, coalesce(a.r, s.r) as r from a full join (select 'S' || s_suppkey as r from supplier) s on a.r = s.r),
ids as (select distinct l, r, 'KN_PARTY:' || md5(coalesce(l, '') || '|' || coalesce(r, '')) as idx from b),
rows as (select idx, l as source_id, c_name as name, c_mktsegment as alias from ids join customer on l = 'C' || c_custkey
  union select idx, r, s_name, n_name from ids join supplier on r = 'S' || s_suppkey join nation on s_nationkey = n_nationkey),
nm as (select idx, min(name) as name from rows group by idx)
select distinct idx, nm.name, 'alias' as kind, alias as value from rows join nm using (idx)
union all select distinct idx, nm.name, 'source' as kind, source_id as value from rows join nm using (idx)"""


@register(XREF_SQL)
def xref_index_full_join(t: Tables) -> DataFrame:
    """Customers and suppliers; returned lines assert pairs from one side, all others from the other."""
    customer = t.customer.select(text("C{}", "c_custkey").alias("id"), F.col("c_name"), F.col("c_mktsegment"))
    supplier = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        text("S{}", "s_suppkey").alias("id"), F.col("s_name"), F.col("n_name")
    )
    pairs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        text("C{}", "o_custkey").alias("left_id"), text("S{}", "l_suppkey").alias("right_id"), "l_returnflag"
    )

    def refs(returned: bool) -> DataFrame:
        return pairs.where((F.col("l_returnflag") == "R") == returned).select("left_id", "right_id").distinct()

    return long_index(build_index_by_xref("PARTY", customer, supplier, refs(True), refs(False)))


# --- relations ------------------------------------------------------------------------------------

SUPPLIER_SOURCE = "select s_suppkey as id, s_name as name, s_name as alias from supplier"
RELATION_SQL = "select name1, idx1, name2, idx2, reference, type from ({}) x"


def supplier_index(t: Tables) -> EntityIndex:
    return build_index(
        "SUPPLIER", [t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_name").alias("other_name"))]
    )


SUPPLIER_PARTS = (
    "select l_suppkey as id, p_name as name2, 'part:' || l_partkey as reference from lineitem "
    "join part on l_partkey = p_partkey"
)


@register(
    with_ctes(
        [index_ctes("i", "SUPPLIER", [SUPPLIER_SOURCE])], typed_relation("i", SUPPLIER_PARTS, "supplier-part")
    )
)
def typed_relations_by_name_and_reference(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", "p_name", F.col("l_partkey").alias("part_key")
    )
    return lower_columns(
        typed_relations(rows, "l_suppkey", supplier_index(t), [Far("supplier-part", name="p_name", ref="part_key")]).distinct()
    )


PART_EDGES = (
    "select a.l_partkey as id1, b.l_partkey as id2 from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey "
    "and b.l_linenumber = a.l_linenumber + 1"
)


def part_edges(t: Tables) -> DataFrame:
    """Parts on consecutive lines of an order."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    following = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("id2"))
    return lines.withColumnRenamed("l_partkey", "id1").join(following, ["l_orderkey", "l_linenumber"]).select("id1", "id2")


@register(
    with_ctes(
        [index_ctes("i", "PART", ["select p_partkey as id, p_brand || ' ' || p_name as name, p_type as alias from part"])],
        same_type_relation("i", PART_EDGES, "part"),
    )
)
def same_type_relations_both_ends(t: Tables) -> DataFrame:
    source = t.part.select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_name").alias("name"), F.col("p_type").alias("other_name")
    )
    return lower_columns(same_type_relations(build_index("PART", [source]), part_edges(t), "part").distinct())


@register(
    "with r as (select distinct s_name as name1, p_type as name2, 'order:' || l_orderkey as reference from lineitem "
    "join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey), "
    "n as (select *, (row_number() over (partition by name1, name2 order by reference) - 1) // 3 as chunk from r) "
    "select name1, name2, chunk, string_agg(reference, ',' order by reference) as reference from n group by all"
)
def consolidate_references(t: Tables) -> DataFrame:
    """Orders of each supplier and part type, three to a cell."""
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    relations = rows.select(
        F.col("s_name").alias("NAME1"), F.col("s_suppkey").alias("IDX1"), F.col("p_type").alias("NAME2"),
        F.lit("").alias("IDX2"), text("order:{}", "l_orderkey").alias("REFERENCE"), F.lit("supplier-part").alias("TYPE"),
    )
    return consolidate(relations, 3).select(
        F.col("NAME1").alias("name1"), F.col("NAME2").alias("name2"), F.col("CHUNK").alias("chunk"), F.array_join("REFERENCE", ",").alias("reference")
    )


# --- entity databases -----------------------------------------------------------------------------
# Each query feeds the whole tables to the database job under the column names of its sources and returns
# the relations, which depend on the index as well.


def relations_of(tables: databases.EntityTables) -> DataFrame:
    return lower_columns(tables.relations.select("NAME1", "IDX1", "NAME2", "IDX2", "REFERENCE", "TYPE"))


GENES_OF_DISEASE = (
    "select 'D' || l_partkey as id, lower(p_name) || ' ' || l_partkey as name, s_name as gene, "
    "case l_linestatus when 'F' then 'phenotype' else 'disease' end as kind from lineitem "
    "join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey"
)
DISEASE_CTES = [
    f"gd as (select distinct id, name, gene from ({GENES_OF_DISEASE}) q where kind <> 'phenotype')",
    "vd as (select distinct 'D' || p_partkey as id, lower(p_name) || ' ' || p_partkey as name from part)",
    "known as (select id from gd union select id from vd)",
    f"dd as (select distinct 'D' || id1 as id1, 'D' || id2 as id2 from ({PART_EDGES}) e "
    "where 'D' || id1 in (select id from known) and 'D' || id2 in (select id from known))",
    "ddn as (select id1, id2, lower(a.p_name) || ' ' || a.p_partkey as n1, lower(b.p_name) || ' ' || b.p_partkey as n2 "
    "from dd join part a on id1 = 'D' || a.p_partkey join part b on id2 = 'D' || b.p_partkey)",
    "terms as (select 'T' || p_partkey as id, p_name || ' ' || p_partkey as name, p_brand as parent, "
    "p_type || ' ' || p_partkey as synonym from part)",
    "enh as (select distinct 'DE:' || md5(s_name || '|' || lower(p_name) || ' ' || l_partkey) as id, s_name as gene, "
    "lower(p_name) || ' ' || l_partkey as name from lineitem join part on l_partkey = p_partkey "
    "join supplier on l_suppkey = s_suppkey)",
    index_ctes("i", "DISEASE", [
        "select id, lower(name) as name, lower(unnest([name, synonym])) as alias from terms",
        "select id, name, name as alias from (select id1 as id, n1 as name from ddn union select id2, n2 from ddn "
        "union select id, name from gd union select id, name from vd) k",
        "select id, name, name as alias from enh",
    ]),
]


@register(
    with_ctes(
        DISEASE_CTES,
        same_type_relation("i", "select id1, id2 from dd", "disease")
        + " union " + same_type_relation("i", "select id as id1, parent as id2 from terms", "disease")
        + " union " + typed_relation("i", "select id, gene as name2, '' as reference from gd", "disease-gene")
        + " union " + typed_relation("i", "select id, gene as name2, '' as reference from enh", "disease-gene"),
    )
)
def disease_database(t: Tables) -> DataFrame:
    """The ontology comes from a stanza file."""
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    name = F.concat_ws(" ", F.lower("p_name"), F.col("p_partkey"))
    disease_id = text("D{}", "p_partkey")
    gene_disease = named.select(
        F.col("s_name").alias("gene_name"), disease_id.alias("disease_dgn_id"), name.alias("disease_name"),
        F.when(F.col("l_linestatus") == "F", "phenotype").otherwise("disease").alias("diseaseType"),
    )
    variants = t.part.select(
        F.col("p_brand").alias("snp_id"), disease_id.alias("disease_dgn_id"), name.alias("disease_name"),
        F.col("p_type").alias("source"), F.lit("disease").alias("diseaseType"),
    )
    names = t.part.select("p_partkey", name.alias("n"))
    edges = part_edges(t).join(names.toDF("id1", "disease_name1"), "id1").join(names.toDF("id2", "disease_name2"), "id2")
    edges = edges.select(
        text("D{}", "id1").alias("disease_dgn_id1"), text("D{}", "id2").alias("disease_dgn_id2"),
        "disease_name1", "disease_name2",
    )
    stanza = text('[Term]\nid: T{}\nname: {} {}\nsynonym: "{} {}" EXACT []\nis_a: {} ! parent\n', "p_partkey", "p_name", "p_partkey", "p_type", "p_partkey", "p_brand")
    terms = textjobs.ontology_terms(read_stanzas(t.spark, text_file(t, stanza, t.part, "ontology"), "\n["))
    enhancer = named.select(F.col("s_name").alias("gene_name"), name.alias("disease_name"))
    return relations_of(databases.diseases(gene_disease, variants, edges, terms, enhancer))


GENE_CTES = [
    "ens as (select 'E' || p_partkey as id, p_brand || p_partkey as name, p_name as syn from part)",
    "hg as (select 'H' || c_custkey as id, c_name as sym, c_mktsegment || ' ' || c_custkey as nm, "
    "'Brand#' || (c_nationkey + 1) || c_custkey || '|' || c_mktsegment as al, c_custkey as k, "
    "case when c_acctbal > 0 then 'Approved' else 'Withdrawn' end as st from customer)",
    "hga as (select * from hg where st = 'Approved')",
    "civ as (select s_suppkey as id, s_name as name, lower(n_name) as dis, lower(r_name) || ',' || lower(n_name) as drugs "
    "from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)",
    index_ctes("i", "GENE", [
        "select id, name, unnest([name, syn]) as alias from ens",
        "select id, sym as name, unnest(string_split(sym || '|' || nm || '|' || al, '|')) as alias from hga",
        "select id, name, name as alias from civ",
    ]),
]


@register(
    with_ctes(
        GENE_CTES,
        " union ".join([
            typed_relation("i", "select id, '' as name2, 'RefSeq:R' || substr(id, 2) as reference from ens", "gene-RNA"),
            typed_relation("i", "select id, '' as name2, 'miRBase:' || syn as reference from ens", "gene-miRNA"),
            typed_relation("i", "select id, '' as name2, 'miRBase:' || name as reference from ens", "gene-miRNA"),
            typed_relation("i", "select id, '' as name2, 'RefSeq:NM' || k as reference from hga", "gene-mRNA"),
            typed_relation("i", "select id, '' as name2, 'UniProtKB:P' || k as reference from hga", "gene-protein"),
            typed_relation("i", "select id, 'mir' || k as name2, '' as reference from hga", "gene-miRNA"),
            typed_relation("i", "select id, 'lnc' || k as name2, '' as reference from hga", "gene-lnc"),
            typed_relation("i", "select id, dis as name2, '' as reference from civ", "gene-disease"),
            typed_relation("i", "select id, unnest(string_split(drugs, ',')) as name2, '' as reference from civ", "gene-drug"),
        ]),
    )
)
def gene_database(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    browser = t.part.select(
        text("E{}", "p_partkey").alias("Ensembl_gene_id"), F.concat(F.col("p_brand"), key).alias("gene_name"),
        F.col("p_name").alias("gene_synonym"),
    )
    cust = F.col("c_custkey")
    nomenclature = t.customer.select(
        text("H{}", "c_custkey").alias("hgnc_id"), F.col("c_name").alias("gene_symbol"),
        F.concat_ws(" ", "c_mktsegment", "c_custkey").alias("gene_name"),
        F.when(F.col("c_acctbal") > 0, "Approved").otherwise("Withdrawn").alias("status"),
        F.concat(F.lit("Brand#"), F.col("c_nationkey") + 1, cust, F.lit("|"), F.col("c_mktsegment")).alias("alias_symbol"),
        F.lit(None).cast("string").alias("alias_name"),
        text("NM{}", "c_custkey").alias("RefSeq_mRNA_ID"), text("P{}", "c_custkey").alias("UniProtKB_Gene_Name_ID"),
        text("mir{}", "c_custkey").alias("mirbase"), text("lnc{}", "c_custkey").alias("lncipedia"),
    )
    place = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    evidence = place.select(
        F.col("s_suppkey").cast("string").alias("civic_id"), F.col("s_name").alias("gene_name"),
        F.lower("n_name").alias("disease_name"), F.lower(F.concat_ws(",", "r_name", "n_name")).alias("drugs_name"),
    )
    wide = {
        "refseq": t.part.select(text("E{}", "p_partkey").alias("Gene stable ID"), text("R{}", "p_partkey").alias("RefSeq mRNA")),
        "miRNA": t.part.select(
            text("E{}", "p_partkey").alias("Gene stable ID"), F.col("p_name").alias("miRBase accession"),
            F.concat(F.col("p_brand"), key).alias("miRBase ID"),
        ),
    }
    return relations_of(databases.genes(browser, nomenclature, evidence, wide))


LNC_CTES = [
    "lp as (select distinct 'lnc-' || l_partkey as gene, 'A' || l_suppkey || ';B' || l_quantity::int as al from lineitem "
    "where l_linestatus = 'O' union select distinct 'lnc-' || l_partkey, 'C' || l_suppkey from lineitem where l_linestatus = 'F')",
    "mc as (select 'lnc-' || p_partkey as sym, 'EN' || p_partkey as gid, 'miR-' || p_size || '/' || (p_size + 1) as mir "
    "from part where p_type like '%A%')",
    index_ctes("i", "LNC", [
        "select distinct 'LNCp:' || md5(gene) as id, gene as name, gene as alias from lp",
        "select distinct 'mrCode:' || md5(sym) as id, sym as name, sym as alias from mc",
    ]),
]


@register(
    with_ctes(
        LNC_CTES,
        " union ".join([
            typed_relation("i", "select 'LNCp:' || md5(gene) as id, '' as name2, 'gene:' || unnest(string_split(al, ';')) as reference from lp", "LNC-gene"),
            typed_relation("i", "select 'mrCode:' || md5(sym) as id, sym as name2, 'gene:' || gid as reference from mc", "LNC-gene"),
            typed_relation("i", "select 'mrCode:' || md5(sym) as id, '' as name2, 'miRNA:hsa-mir-' || "
                           "unnest(string_split(substr(mir, 5), '/')) as reference from mc", "LNC-miRNA"),
        ]),
    )
)
def lncrna_database(t: Tables) -> DataFrame:
    """Two annotation files; a gene has one or two numbered aliases."""
    lines = t.lineitem.withColumn("quantity", F.col("l_quantity").cast("int"))
    start = 'chr1\tsource\ttranscript\t1\t2\t.\t+\t.\tgene_id "lnc-{}"; transcript_id "t{}"; '
    layouts = {
        "O": text(start + 'gene_alias_1 "A{}"; gene_alias_2 "B{}";', "l_partkey", "l_orderkey", "l_suppkey", "quantity"),
        "F": text(start + 'gene_alias_1 "C{}";', "l_partkey", "l_orderkey", "l_suppkey"),
    }
    builds = [
        textjobs.lncrna_transcripts(read_lines(t.spark, text_file(t, line, lines.where(F.col("l_linestatus") == status), "gtf")))
        for status, line in layouts.items()
    ]
    targets = t.part.select(
        text("EN{}", "p_partkey").alias("gene_id"), text("lnc-{}", "p_partkey").alias("gene_symbol"),
        F.when(F.col("p_type").contains("A"), "lncRNA").otherwise("coding").alias("gene_class"),
        F.concat(F.lit("miR-"), F.col("p_size"), F.lit("/"), F.col("p_size") + 1).alias("microrna"),
    )
    return relations_of(databases.lncrnas([materialize(b, "transcripts") for b in builds], targets))


MIRNA_CTES = [
    "base as (select 'MI' || p_partkey as id, 'hsa-mir-' || p_partkey as name, lower(p_name) || ' ' || p_partkey as old "
    "from part where p_size > 10)",
    "can as (select distinct 'mirCancer:' || md5('hsa-mir-' || l_partkey || '|' || lower(l_returnflag)) as id, "
    "'hsa-mir-' || l_partkey as name, lower(l_returnflag) as dis from lineitem)",
    "tar as (select distinct 'MT' || l_orderkey as id, 'hsa-mir-' || l_partkey as name, s_name as gene from lineitem "
    "join supplier on l_suppkey = s_suppkey where l_linestatus = 'O')",
    "hm as (select distinct 'HMDDB:' || md5(name || '|' || dis) as id, name, dis from (select 'hsa-mir-' || p_partkey as name, "
    "lower(p_type) as dis from part) q)",
    index_ctes("i", "MIRNA", [
        "select id, name, unnest(case when old like '%ring%' then [name] else [name, old] end) as alias from base",
        "select id, name, name as alias from can",
        "select id, name, name as alias from tar",
        "select id, name, name as alias from hm",
    ]),
]


@register(
    with_ctes(
        MIRNA_CTES,
        " union ".join([
            typed_relation("i", "select id, dis as name2, '' as reference from can", "miRNA-disease"),
            typed_relation("i", "select id, dis as name2, '' as reference from hm", "miRNA-disease"),
            typed_relation("i", "select id, gene as name2, '' as reference from tar", "miRNA-gene"),
        ]),
    )
)
def mirna_database(t: Tables) -> DataFrame:
    name = text("hsa-mir-{}", "p_partkey").alias("miRNA_name")
    old = F.when(F.col("p_name").contains("ring"), "null").otherwise(F.concat_ws(" ", F.lower("p_name"), F.col("p_partkey")))
    hairpin = t.part.select(
        text("MI{}", "p_partkey").alias("miRNA_id"), name, old.alias("miRNA_old_name"),
        (F.col("p_size") <= 10).cast("int").alias("is_dead"),
    )
    mature = t.part.select(
        text("MA{}", "p_partkey").alias("miRNA_id"), text("mmu-mir-{}", "p_partkey").alias("miRNA_name"),
        F.lit("null").alias("miRNA_old_name"), F.lit(0).alias("is_dead"),
    )
    species = t.region.select(
        F.col("r_regionkey").cast("string").alias("species_id"),
        F.when(F.col("r_regionkey") == 0, "hsa").otherwise("mmu").alias("species_symbol"),
        F.when(F.col("r_regionkey") == 0, "Homo sapiens").otherwise(F.col("r_name")).alias("species_name"),
    )
    mir = text("hsa-mir-{}", "l_partkey").alias("miRNA_name")
    cancer = t.lineitem.select(mir, F.lower("l_returnflag").alias("disease_name"))
    targets = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        text("MT{}", "l_orderkey").alias("mirTarBase_ID"), mir,
        F.when(F.col("l_linestatus") == "O", "homo sapiens").otherwise("mouse").alias("miRNA_species"),
        F.col("s_name").alias("gene_name"), F.lit("Homo sapiens").alias("target_species"),
    )
    disease = t.part.select(name, F.lower("p_type").alias("disease_name"))
    return relations_of(databases.mirnas(hairpin, mature, species, cancer, targets, disease))


MRNA_CTES = [
    "tr as (select 'NM_' || p_partkey as id, p_brand || ' ' || p_type || ' ' || p_partkey as rna, p_name as gene from part)",
    index_ctes("i", "MRNA", ["select id, gene as name, lower(unnest([rna, gene])) as alias from tr"]),
]


@register(
    with_ctes(MRNA_CTES, typed_relation("i", "select id, gene as name2, '' as reference from tr", "mRNA-gene"))
)
def mrna_database(t: Tables) -> DataFrame:
    """Transcripts from the header lines of a sequence file."""
    header = text(
        ">NM_{}.2 Homo sapiens {} {} {} ({}), transcript variant 1, mRNA\nACGT", "p_partkey", "p_brand", "p_type", "p_partkey", "p_name"
    )
    rows = textjobs.transcripts(read_lines(t.spark, text_file(t, header, t.part, "fasta")))
    return relations_of(databases.mrnas(materialize(rows, "transcripts")))


PATHWAY_CTES = [
    "bank as (select 'SMP' || l_orderkey as id, lower(c_name) || ' (' || lower(c_mktsegment) || ')' as name, s_name as gene, "
    "'U' || l_suppkey as uni, 'HM' || l_suppkey as hm, 'DB' || l_partkey as db from lineitem "
    "join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey "
    "where l_linestatus = 'F')",
    "rea as (select 'R' || c_custkey as id, lower(c_name) as name from customer where c_mktsegment <> 'MACHINERY')",
    "hier as (select 'R' || c_nationkey as id1, 'R' || c_custkey as id2 from customer)",
    "el as (select 'R' || o_custkey as id, 'U' || o_orderkey as ref, o_orderpriority as name from orders)",
    "pan as (select 'PA' || s_suppkey as id, lower(s_name) as name, s_name as gene, 'HGNC=' || s_suppkey as gid, "
    "'P' || s_suppkey as uni from supplier)",
    index_ctes("i", "PATHWAY", [
        "select id, name, string_split(name, ' (')[1] as alias from bank",
        "select id, name, name as alias from rea",
        "select id, name, name as alias from pan",
    ]),
]


@register(
    with_ctes(
        PATHWAY_CTES,
        " union ".join([
            typed_relation("i", "select id, gene as name2, '' as reference from bank", "pathway-gene"),
            typed_relation("i", "select id, '' as name2, 'UniProt:' || uni as reference from bank", "pathway-protein"),
            typed_relation("i", "select id, '' as name2, 'HMDBP:' || hm as reference from bank", "pathway-protein"),
            typed_relation("i", "select id, '' as name2, 'DrugBank:' || db as reference from bank", "pathway-drug"),
            typed_relation("i", "select id, name as name2, 'UniProt:' || ref as reference from el", "pathway-protein"),
            typed_relation("i", "select id, gene as name2, 'Gene:' || gid as reference from pan", "pathway-gene"),
            typed_relation("i", "select id, '' as name2, 'UniProt:' || uni as reference from pan", "pathway-protein"),
            same_type_relation("i", "select id1, id2 from hier", "pathway"),
        ]),
    )
)
def pathway_database(t: Tables) -> DataFrame:
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    elements = rows.select(
        text("SMP{}", "l_orderkey").alias("SMPDB_ID"), F.lower(text("{} ({})", "c_name", "c_mktsegment")).alias("Pathway_name"),
        F.when(F.col("l_linestatus") == "F", "homo sapiens").otherwise("other").alias("species"),
        text("U{}", "l_suppkey").alias("UniProt_ID"), text("HM{}", "l_suppkey").alias("HMDBP_ID"),
        text("DB{}", "l_partkey").alias("DrugBank_ID"), F.col("s_name").alias("gene_name"),
    )
    reactions = t.customer.select(
        text("R{}", "c_custkey").alias("Reactome_ID"), F.lower("c_name").alias("Pathway_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "other").otherwise("Homo sapiens").alias("species"),
    )
    hierarchy = t.customer.select(text("R{}", "c_nationkey").alias("Reactome_ID1"), text("R{}", "c_custkey").alias("Reactome_ID2"))
    found = t.orders.select(
        text("U{}", "o_orderkey").alias("element_id"), F.col("o_orderpriority").alias("Element_name"),
        text("R{}", "o_custkey").alias("Reactome_ID"), F.lit("Homo sapiens").alias("species"),
    )
    sets = t.supplier.select(
        text("PA{}", "s_suppkey").alias("Panther_ID"), F.lower("s_name").alias("Pathway_name"), F.col("s_name").alias("gene_name"),
        text("HUMAN|HGNC={}|UniProtKB=P{}", "s_suppkey", "s_suppkey").alias("gen_prot_ID"), F.col("s_name").alias("protein_name"),
    )
    return relations_of(databases.pathways(elements, reactions, hierarchy, {"UniProt": found}, sets))


PROTEIN_CTES = [
    "pr as (select 'P' || p_partkey as id, p_name || ' ' || p_partkey as name, p_brand as b, p_type as ty, p_partkey as k, "
    "'G' || p_size as gene from part where p_size > 5)",
    index_ctes("i", "PROTEIN", [
        "select id, name, lower(unnest([name, b, ty, gene, 'S' || k])) as alias from pr",
    ]),
]


def _protein_reference(prefix: str, value: str) -> str:
    return f"select id, '' as name2, '{prefix}:' || unnest([{value}]) as reference from pr"


@register(
    with_ctes(
        PROTEIN_CTES,
        " union ".join([
            typed_relation("i", _protein_reference("RefSeq", "'NP_' || k, 'NP_' || (k + 1)"), "protein-mRNA"),
            typed_relation("i", _protein_reference("STRING", "'9606.' || k"), "protein-string"),
            typed_relation("i", _protein_reference("DrugBank", "'DB' || k"), "protein-drug"),
            typed_relation("i", "select id, gene as name2, 'Ensembl:ENST' || k as reference from pr", "protein-gene"),
            typed_relation("i", _protein_reference("DisGenNet", "'C' || lpad(cast(k as varchar), 7, '0')"), "protein-disease"),
            typed_relation("i", "select id, gene as name2, 'HGNC:HGNC:' || k as reference from pr", "protein-gene"),
            typed_relation("i", _protein_reference("BRENDA", "'1.1.' || k"), "protein-enzyme"),
        ]),
    )
)
def protein_database(t: Tables) -> DataFrame:
    rows = t.part.select(
        text("P{}", "p_partkey").alias("UniProt_ID"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey"), F.lit(" ("), F.col("p_brand"), F.lit(") ("), F.col("p_type"), F.lit(")")).alias("protein_names"),
        F.when(F.col("p_size") > 5, "reviewed").otherwise("unreviewed").alias("Status"),
        F.lit("Homo sapiens (Human)").alias("Organism"), text("G{}", "p_size").alias("gene_name"),
        text("S{}", "p_partkey").alias("gene_synonyms"),
        F.concat(F.lit("NP_"), F.col("p_partkey"), F.lit(";NP_"), F.col("p_partkey") + 1, F.lit(";")).alias("RefSeq_id"),
        text("9606.{};", "p_partkey").alias("STRING_id"), text("DB{};", "p_partkey").alias("DrugBank_id"),
        text("ENST{} [P1];", "p_partkey").alias("Ensembl_id"), text("{};", "p_partkey").alias("DisGenNet_id"),
        text("HGNC:{};", "p_partkey").alias("HGNC_id"), text("1.1.{};", "p_partkey").alias("BRENDA_id"),
    )
    return relations_of(databases.proteins(rows))


ENZYME_CTES = [
    "en as (select '1.' || p_partkey as id, p_name as name, p_brand as syn, 'P' || p_partkey as prot from part)",
    index_ctes("i", "ENZYME", ["select id, name, lower(unnest([name, syn])) as alias from en"]),
]


@register(
    with_ctes(
        ENZYME_CTES, typed_relation("i", "select id, '' as name2, 'UniProtKB:' || prot as reference from en", "enzyme-protein")
    )
)
def enzyme_database(t: Tables) -> DataFrame:
    """Enzymes from a flat file, with proteins of two species."""
    stanza = text(
        "ID\t1.{} (x)\nPR\t#1# Homo sapiens P{} UniProt <1,2>\nPR\t#2# Bos taurus Q1 UniProt <3>\nRN\t{}\nSY\t{}\nSY\t#1# other\n",
        "p_partkey", "p_partkey", "p_name", "p_brand",
    )
    rows = textjobs.enzyme_records(read_stanzas(t.spark, text_file(t, stanza, t.part, "enzymes"), "\nID\t"))
    return relations_of(databases.enzymes(materialize(rows, "enzymes")))


@register(
    "select p_partkey as a_id, s_suppkey as b_id from lineitem join part on l_partkey = p_partkey "
    "join supplier on l_suppkey = s_suppkey where p_type = 'PROMO' and l_returnflag = 'R'"
)
def protein_interaction_filter(t: Tables) -> DataFrame:
    """An interaction file; both organisms must match."""
    human, mouse = F.lit("Homo sapiens"), F.lit("Mus musculus")
    path = new_path(t.spark, "interactions")
    t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("Official Symbol Interactor A"), F.col("l_suppkey").alias("Official Symbol Interactor B"),
        F.when(F.col("p_type") == "PROMO", human).otherwise(mouse).alias("Organism Name Interactor A"),
        F.when(F.col("l_returnflag") == "R", human).otherwise(mouse).alias("Organism Name Interactor B"),
    ).write.option("sep", catalog.PROTEIN_INTERACTIONS.sep).option("header", True).csv(path)
    rows = read_source(t.spark, catalog.PROTEIN_INTERACTIONS, delete_at_exit(t.spark, path))
    ids = [F.col(f"symbol_{end}").cast("bigint").alias(f"{end}_id") for end in "ab"]
    return databases.protein_interactions(rows).select(*ids)


@register(
    with_ctes(
        [index_ctes("i", "CUSTOMER", ["select c_custkey as id, c_name as name, c_name as alias from customer"])],
        "select s.idx, s.name, cast(o_orderkey as varchar) as string_id from i_source s "
        "join orders on s.id = cast(o_custkey as varchar)",
    )
)
def external_protein_match(t: Tables) -> DataFrame:
    """External ids matched to index entities by lower-case alias, taxon prefix removed."""
    index = build_index(
        "CUSTOMER",
        [t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_name").alias("other_name"))],
    )
    info = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        without_taxon(text("9606.{}", "o_orderkey")).alias("string_id"), F.lower("c_name").alias("other_name")
    )
    lowered = index.aliases.withColumn("alias", F.lower("alias"))
    return lower_columns(match_proteins(lowered, info).select("IDX", "NAME", "string_id"))
