"""Annotation of documents, the category filter, and the text functions on columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netloom.functions import text as fn
from netloom.functions.parsing import attribute
from netloom.operators import scoring, textjobs
from netloom.operators.annotate import annotate, document_text, filter_categories, ngrams, settled_spots, tokens
from netloom.queries.entities import text
from netloom.queries.registry import Registry, Tables
from netloom.queries.sqltext import pair_ctes
from netloom.session import materialize

QUERIES = Registry()
register = QUERIES.register

# --- annotation -----------------------------------------------------------------------------------

TOKENS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
GRAMS = (
    "{name}_t as materialized (select {key} as pmid, {tokens} as t from {table}), "
    "{name}_p as (select pmid, t, unnest(generate_series(1, len(t))) as s from {name}_t), "
    "{name} as (select pmid, s - 1 as start, n as words, array_to_string(t[s:s + n - 1], ' ') as spot "
    "from {name}_p, (select unnest(generate_series(1, 6)) as n) k where s + n - 1 <= len(t))"
)


def grams_sql(name: str, table: str, key: str) -> str:
    return GRAMS.format(name=name, table=table, key=key, tokens=TOKENS.format("text"))


ANNOTATE_CTES = (
    f"{grams_sql('bg', 'benchmark', 'item_id')}, {grams_sql('dg', 'documents', 'doc_id')}, "
    "dict as (select spot, min(pmid) as wiki_id, spot || '.' as title, "
    "cast(count(distinct pmid) as double) / cast(count(*) as double) as lp from bg group by spot), "
    "f as (select dg.pmid, dg.start, dg.words, dg.spot, wiki_id, title, lp from dg join dict using (spot)), "
    "a as (select distinct pmid, start, words from f), "
    # Greedy: the longest match first, each if it overlaps none that is kept.
    "l as (select pmid, list([{'start': start, 'words': words}] order by words desc, start) as l from a group by pmid), "
    "g as (select pmid, list_reduce(l, lambda k, m: case when len(list_filter(k, lambda o: o.start < m[1].start + m[1].words "
    "and m[1].start < o.start + o.words)) > 0 then k else list_concat(k, m) end) as l from l), "
    "kept as (select pmid, unnest(l).start as start, unnest(l).words as words from g)"
)


def dictionary(t: Tables) -> DataFrame:
    """Runs of one to six words of the benchmark passages."""
    grams = ngrams(t.benchmark.withColumnRenamed("item_id", "pmid"), 6)
    return grams.groupBy("spot").agg(
        F.min("pmid").alias("wiki_id"),
        (F.count_distinct("pmid").cast("double") / F.count(F.lit(1)).cast("double")).alias("link_probability"),
    ).select(
        "spot", "wiki_id", F.concat("spot", F.lit(".")).alias("title"), "link_probability", F.lit(1.0).alias("commonness"),
        F.array(F.col("spot")).alias("categories"),
    )


def annotations(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("pmid"), "text")
    return annotate(docs, materialize(dictionary(t), "dictionary"))


@register(
    f"with {ANNOTATE_CTES} select f.pmid, cast(f.start as bigint) as start, cast(f.start + f.words as bigint) as stop, "
    "spot, wiki_id, title, lp / 2 as rho from kept join f using (pmid, start, words)"
)
def annotate_dictionary(t: Tables) -> DataFrame:
    return annotations(t).select(
        "pmid", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("stop"), "spot", "wiki_id",
        "title", "rho",
    )


@register(
    f"with {ANNOTATE_CTES}, k as materialized (select f.pmid, f.start, f.spot, wiki_id, lp from kept join f using (pmid, start, words)), "
    f"{pair_ctes('select pmid, wiki_id as wid from k', 'distinct')}, "
    "two as (select wid1, wid2, relatedness as r from rel union all select wid2, wid1, relatedness from rel), "
    "deg as (select pmid, count(*) as n from d group by all), "
    "coh as (select a.pmid, a.wid, sum(two.r) / (max(deg.n) - 1) as c from d a join d b on a.pmid = b.pmid and a.wid <> b.wid "
    "join two on two.wid1 = a.wid and two.wid2 = b.wid join deg on deg.pmid = a.pmid group by all) "
    "select k.pmid, cast(k.start as bigint) as start, spot, wiki_id, round((lp + coalesce(c, 0.0e0)) / 2 + 1e-12, 6) as rho "
    "from k left join coh on coh.pmid = k.pmid and coh.wid = k.wiki_id"
)
def annotate_coherence(t: Tables) -> DataFrame:
    """Annotations scored with the relatedness that the annotations themselves give."""
    docs = t.documents.select(F.col("doc_id").alias("pmid"), "text")
    words = materialize(dictionary(t), "dictionary")
    spots = settled_spots(docs, words)
    counts = scoring.stored_counts(annotate(docs, words, spots=spots), "distinct")
    pairs = scoring.stored_pairs(scoring.stored_profiles(counts))
    related = scoring.relatedness(pairs, scoring.corpus_size(counts))
    found = annotate(docs, words, related=related, spots=spots)
    return found.select(
        "pmid", F.col("start").cast("bigint").alias("start"), "spot", "wiki_id", F.round(F.col("rho") + F.lit(1e-12), 6).alias("rho")
    )


@register(
    "with d as (select doc_id, string_split(text, chr(10)) as l from documents) "
    "select doc_id, md5(case when len(l) > 1 then l[1] || chr(10) || array_to_string(l[2:], chr(10)) end) as digest from d"
)
def annotate_text_concat(t: Tables) -> DataFrame:
    """First line as title, the rest as abstract; a document of one line has no text."""
    lines = F.split("text", "\n")
    abstract = F.when(F.size(lines) > 1, F.array_join(F.slice(lines, 2, F.size(lines)), "\n"))
    return t.documents.select("doc_id", F.md5(document_text(F.get(lines, F.lit(0)), abstract)).alias("digest"))


@register(
    f"select doc_id, cast(len({TOKENS.format('text')}) as integer) as n_tokens, "
    f"md5(array_to_string({TOKENS.format('text')}, ' ')) as digest from documents"
)
def tokenize_documents(t: Tables) -> DataFrame:
    words = tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(words).alias("n_tokens"), F.md5(F.array_join(words, " ")).alias("digest"))


@register(
    "with a as (select user_id as pmid, event_id as wiki_id, event_type as spot, value as rho, event_type as title, "
    "unnest([regexp_extract(props, '(\\d+)', 1), event_type]) as category from events) "
    "select distinct pmid, wiki_id, spot, rho, title from a where category in "
    "(select cast(cast(l_quantity as integer) as varchar) from lineitem union select lower(o_orderstatus) from orders)"
)
def category_filter(t: Tables) -> DataFrame:
    found = t.events.select(
        F.col("user_id").alias("pmid"), F.col("event_id").alias("wiki_id"), F.col("event_type").alias("spot"),
        F.col("value").alias("rho"), F.col("event_type").alias("title"),
        F.array(F.regexp_extract("props", r"(\d+)", 1), "event_type").alias("categories"),
    )
    allowed = t.lineitem.select(F.col("l_quantity").cast("int").cast("string").alias("category")).unionByName(
        t.orders.select(F.lower("o_orderstatus").alias("category"))
    )
    return filter_categories(found, allowed.distinct())


# --- text functions -------------------------------------------------------------------------------


@register(
    "select distinct o_orderkey as id, 'x=' || o_custkey || ':' || o_orderpriority as ref, "
    "replace('x=' || o_custkey || ':' || o_orderpriority, '=', ':') as cleaned from orders"
)
def reference_clean(t: Tables) -> DataFrame:
    ref = F.concat(F.lit("x="), F.col("o_custkey"), F.lit(":"), F.col("o_orderpriority"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"), ref.alias("ref"), fn.clean_reference(F.concat(F.lit("db:"), ref)).alias("cleaned")
    )


@register(
    "select p_partkey as id, unnest(['DB:' || p_brand, 'DB:' || p_type]) as item from part "
    "union all select p_partkey, 'disgenet:C' || case when length(cast(p_partkey as varchar)) < 7 "
    "then lpad(cast(p_partkey as varchar), 7, '0') else cast(p_partkey as varchar) end from part"
)
def accession_list(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    plain = F.concat(F.lit("DB:"), F.col("p_brand"), F.lit(" [x];"), F.col("p_type"), F.lit(";"))
    padded = F.concat(F.lit("disgenet:"), key, F.lit(";"))
    items = F.concat(fn.accession_list(plain), fn.accession_list(padded))
    return t.part.select(key.alias("id"), F.explode(items).alias("item"))


@register(
    "select p_partkey as id, 'miR-' || unnest([cast(p_size as varchar), p_size || '-5p']) as name from part "
    "union all select p_partkey, p_name from part where p_name not like '%-%'"
)
def family_expand(t: Tables) -> DataFrame:
    family = F.concat(F.lit("miR-"), F.col("p_size"), F.lit("/"), F.col("p_size"), F.lit("-5p"))
    names = F.concat(fn.expand_family(family), fn.expand_family(F.col("p_name")))
    return t.part.select(F.col("p_partkey").alias("id"), F.explode(names).alias("name"))


@register(
    "select o_orderkey as id, unnest([o_orderstatus || ' ' || o_orderpriority, o_orderpriority || ', ' || o_orderstatus]) as name "
    "from orders union all select o_orderkey, unnest([o_orderstatus || ' type ' || o_custkey, "
    "o_orderstatus || ', type ' || o_custkey]) from orders union all select o_orderkey, 'sand, ' || o_orderstatus from orders"
)
def name_inversion(t: Tables) -> DataFrame:
    """Plain names are inverted, a last part with a number stays last, names with "and" are kept."""
    status = F.col("o_orderstatus")
    names = F.concat(
        fn.inverted_names(F.concat_ws(", ", F.col("o_orderpriority"), status)),
        fn.inverted_names(F.concat(status, F.lit(", type "), F.col("o_custkey"))),
        fn.inverted_names(F.concat(F.lit("sand, "), status)),
    )
    return t.orders.select(F.col("o_orderkey").alias("id"), F.explode(names).alias("name"))


@register("select c_custkey as id, 'C' || lpad(cast(c_custkey as varchar), 7, '0') as padded from customer where c_custkey < 10000000 "
          "union all select c_custkey, 'C' || c_custkey from customer where c_custkey >= 10000000")
def lpad_id(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"), fn.pad_disease_id(F.col("c_custkey").cast("string")).alias("padded")
    )


@register(
    "select item_id, pos, nullif(lower(regexp_replace(case when (line like '%hsa%' or line like '%lnc%') and line like '%-%' "
    "then regexp_replace(line, '^[^-]*-', '') else line end, '[^\\w+]+', '', 'g')), '') as term from "
    "(select item_id, cast(unnest(generate_series(0, len(l) - 1)) as integer) as pos, unnest(l) as line from "
    "(select item_id, string_split(text, chr(10)) as l from benchmark) b) q"
)
def term_normalize(t: Tables) -> DataFrame:
    lines = t.benchmark.select("item_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("item_id", "pos", fn.matching_key(F.col("line")).alias("term"))


@register(
    "select l_orderkey, l_linenumber, case when l_returnflag = 'R' then 'miRNA:hsa-mir-' || l_partkey "
    "else 'gene:miR-' || l_partkey end as reference from lineitem"
)
def mirna_references(t: Tables) -> DataFrame:
    prefix = F.when(F.col("l_returnflag") == "R", "miRNA").otherwise("gene")
    ref = F.concat(prefix, F.lit(":miR-"), F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.human_mirna_reference(ref).alias("reference"))


# --- semi-structured text -------------------------------------------------------------------------


@register(
    "select distinct 'transcript' as type, 'G' || l_partkey as gene_id, 'T' || l_orderkey as transcript_id, "
    "'A' || l_suppkey || ';B' || l_linenumber as gene_alias, cast(null as varchar) as transcript_alias from lineitem"
)
def attribute_parse(t: Tables) -> DataFrame:
    info = text(
        'gene_id "G{}"; transcript_id "T{}"; gene_alias_1 "A{}"; gene_alias_2 "B{}";',
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber",
    )
    line = F.concat_ws("\t", F.lit("chr1"), F.lit("x"), F.lit("transcript"), F.lit("1"), F.lit("2"), F.lit("."), F.lit("+"), F.lit("."), info)
    return textjobs.lncrna_transcripts(t.lineitem.select(line.alias("value")))


@register(
    "select distinct 'G' || p_partkey as gene_id, p_type as gene_type, 'T' || p_partkey as transcript_id, "
    "'mRNA' as transcript_type, p_brand || ';' || p_size as transcript_aliases from part where p_size > 25"
)
def attribute_parse_second_format(t: Tables) -> DataFrame:
    info = text(
        'gene_id "G{}"; gene_type "{};"; transcript_id "T{}"; transcript_type "mRNA"; transcript_alias_1 "{}"; '
        'transcript_alias_2 "{}"', "p_partkey", "p_type", "p_partkey", "p_brand", "p_size",
    )
    kind = F.when(F.col("p_size") > 25, "gene").otherwise("exon")
    line = F.concat_ws("\t", F.lit("chr1"), F.lit("x"), kind, *[F.lit(".")] * 5, info)
    return textjobs.lncrna_genes(t.part.select(line.alias("value")))


@register("select event_id, regexp_extract(props, '\"k\": (\\d+)', 1) as k from events")
def attribute_of_properties(t: Tables) -> DataFrame:
    quoted = F.regexp_replace("props", r'"(\w+)": (\d+)', '$1 "$2";')
    return t.events.select("event_id", attribute(F.regexp_replace(quoted, r"[{}]", ""), "k").alias("k"))


@register(
    "select 'NM_' || p_partkey as rna_id, p_name as rna_name, p_brand as gene_name, 'transcript variant ' || p_size as variant, "
    "'mRNA' as type from part where p_size <= 40"
)
def header_parse(t: Tables) -> DataFrame:
    """Transcript headers of the parts; other species and predicted ones are dropped."""
    line = text(
        ">NM_{}.{} {} {} ({}), transcript variant {}, mRNA", "p_partkey", "p_size", "species", "p_name", "p_brand", "p_size"
    )
    rows = t.part.withColumn(
        "species", F.when(F.col("p_size") <= 40, "Homo sapiens").otherwise("Mus musculus")
    ).select(line.alias("value"))
    found = textjobs.transcripts(rows)
    return found.toDF(*[c.lower() for c in found.columns])


@register("select p_partkey as id, unnest([p_name, p_brand, p_type]) as alias from part")
def protein_name_aliases(t: Tables) -> DataFrame:
    names = text("{} ({}) ({})", "p_name", "p_brand", "p_type")
    return t.part.select(F.col("p_partkey").alias("id"), F.explode(fn.protein_aliases(names)).alias("alias"))


@register(
    "select doc_id, replace(unnest(string_split(text, chr(10))), '\"', '') as item from documents"
)
def quoted_list_explode(t: Tables) -> DataFrame:
    listed = F.concat(F.lit('"'), F.replace("text", F.lit("\n"), F.lit('", "')), F.lit('"'))
    return textjobs.explode_quoted(t.documents.withColumn("item", listed), ["doc_id"], "item")
