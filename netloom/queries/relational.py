"""Filters, joins, aggregates and set operations the jobs are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netloom.functions.text import missing_to_null, same_text
from netloom.operators.joins import full_join, left_cascade, members, translate_ends
from netloom.operators.setops import (
    new_rows, swap_ends, symmetrize, union_all, union_distinct, unpivot_references,
)
from netloom.operators.windows import top_n
from netloom.queries.registry import Registry, Tables

QUERIES = Registry()
register = QUERIES.register

# --- filters and projections ----------------------------------------------------------------------


@register("select c_custkey, c_name from customer where lower(c_mktsegment) = 'building'")
def species_filter(t: Tables) -> DataFrame:
    return t.customer.where(same_text(F.col("c_mktsegment"), "Building")).select("c_custkey", "c_name")


@register("select o_orderkey, o_orderstatus from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus <> 'F'")
def isin_filter(t: Tables) -> DataFrame:
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") != "F")
    return t.orders.where(wanted).select("o_orderkey", "o_orderstatus")


@register("select p_partkey, p_name from part where p_name like '%ring%' or p_brand like 'Brand#1%'")
def substring_filter(t: Tables) -> DataFrame:
    kept = F.col("p_name").contains("ring") | F.col("p_brand").startswith("Brand#1")
    return t.part.where(kept).select("p_partkey", "p_name")


@register(
    "select event_id, nullif(case event_type when 'error' then 'null' when 'view' then '' else event_type end, 'null') as kind "
    "from events where event_type not in ('error', 'view')"
)
def null_sentinel(t: Tables) -> DataFrame:
    """Empty text and the word null both count as missing and are filtered out."""
    kind = F.when(F.col("event_type") == "error", "null").when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    rows = t.events.select("event_id", missing_to_null(kind).alias("kind"))
    return rows.where(F.col("kind").isNotNull())


@register(
    "select o_orderkey, case when o_orderstatus = 'F' then 1 else 0 end as finished, "
    "case when o_totalprice > 200000 then 'large' when o_totalprice > 100000 then 'medium' else 'small' end as size from orders"
)
def case_when_flag(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished"),
        F.when(price > 200000, "large").when(price > 100000, "medium").otherwise("small").alias("size"),
    )


@register("select distinct l_partkey, l_suppkey from lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@register("select n_nationkey as id, lower(n_name) as name, '' as reference, 'nation' as type from nation")
def project_rename_literal(t: Tables) -> DataFrame:
    rows = t.nation.selectExpr("n_nationkey as id", "lower(n_name) as name", "n_regionkey")
    return rows.drop("n_regionkey").withColumn("reference", F.lit("")).withColumn("type", F.lit("nation"))


# --- joins ----------------------------------------------------------------------------------------


@register(
    "select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey and n_regionkey <> 0 "
    "left join region on n_regionkey = r_regionkey"
)
def left_cascade_join(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", F.col("c_nationkey").alias("k"))
    nations = t.nation.where("n_regionkey <> 0").select(F.col("n_nationkey").alias("k"), "n_name", "n_regionkey")
    joined = left_cascade(base, [nations], ["k"]).select("c_custkey", "n_name", F.col("n_regionkey").alias("k"))
    return left_cascade(joined, [t.region.select(F.col("r_regionkey").alias("k"), "r_name")], ["k"]).select(
        "c_custkey", "n_name", "r_name"
    )


@register(
    "with r as (select l_partkey, l_suppkey, count(*) as n_returned from lineitem where l_returnflag = 'R' group by all), "
    "a as (select l_partkey, l_suppkey, count(*) as n_kept from lineitem where l_returnflag <> 'R' group by all) "
    "select l_partkey, l_suppkey, n_returned, n_kept from r full join a using (l_partkey, l_suppkey)"
)
def full_outer_two_key(t: Tables) -> DataFrame:
    def counted(returned: bool, out: str) -> DataFrame:
        rows = t.lineitem.where((F.col("l_returnflag") == "R") == returned)
        return rows.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias(out))

    return full_join([counted(True, "n_returned"), counted(False, "n_kept")], ["l_partkey", "l_suppkey"])


@register(
    "select l_orderkey, l_linenumber from lineitem n where l_returnflag <> 'R' and not exists (select 1 from lineitem o "
    "where o.l_returnflag = 'R' and o.l_partkey = n.l_partkey and o.l_suppkey = n.l_suppkey)"
)
def left_anti_two_key(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    new, old = rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'")
    return new_rows(new, old, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@register("select l_orderkey, l_linenumber, s_name from lineitem join supplier on l_suppkey = s_suppkey")
def broadcast_dim(t: Tables) -> DataFrame:
    """Lookup join; adaptive execution broadcasts the lookup when it turns out small."""
    lookup = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(lookup, "l_suppkey").drop("l_suppkey")


@register(
    "select p_partkey, n_nationkey from (select p_partkey, unnest([p_size, p_size % 25]) as k from part) p "
    "join nation on k = n_nationkey"
)
def array_membership_join(t: Tables) -> DataFrame:
    listed = t.part.select("p_partkey", F.array(F.col("p_size"), F.col("p_size") % 25).alias("ks"))
    return members(listed, "ks", "n_nationkey").join(t.nation.select("n_nationkey"), "n_nationkey").select(
        "p_partkey", "n_nationkey"
    )


@register(
    "select l_orderkey, l_linenumber, p_brand as idx1, s_name as idx2 from lineitem join part on l_partkey = p_partkey "
    "join supplier on l_suppkey = s_suppkey"
)
def two_sided_translation(t: Tables) -> DataFrame:
    """Both ends of an edge looked up in one table of ids."""
    ids = t.part.select(F.concat(F.lit("P"), "p_partkey").alias("key"), F.col("p_brand").alias("value")).unionByName(
        t.supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("key"), F.col("s_name").alias("value"))
    )
    edges = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("P"), "l_partkey").alias("a"), F.concat(F.lit("S"), "l_suppkey").alias("b")
    )
    found = translate_ends(edges, ids, [("a", "idx1"), ("b", "idx2")], "key", "value")
    return found.select("l_orderkey", "l_linenumber", "idx1", "idx2")


@register(
    "select a.n_name as name1, b.n_name as name2 from nation a join nation b on a.n_regionkey = b.n_regionkey "
    "and a.n_nationkey < b.n_nationkey"
)
def half_matrix_self_join(t: Tables) -> DataFrame:
    a = t.nation.select(F.col("n_name").alias("name1"), F.col("n_nationkey").alias("k1"), "n_regionkey")
    b = t.nation.select(F.col("n_name").alias("name2"), F.col("n_nationkey").alias("k2"), "n_regionkey")
    return a.join(b, "n_regionkey").where("k1 < k2").select("name1", "name2")


# --- aggregates -----------------------------------------------------------------------------------


@register(
    "select l_partkey, count(distinct l_orderkey) as orders, count(distinct l_suppkey) as suppliers from lineitem group by all"
)
def count_distinct_degree(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@register(
    "select l_partkey, avg(q) as mean from (select distinct l_partkey, cast(l_quantity as bigint) as q from lineitem) d group by all"
)
def avg_distinct(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", F.col("l_quantity").cast("bigint").alias("q")).distinct()
    return rows.groupBy("l_partkey").agg(F.avg("q").alias("mean"))


@register(
    "select l_orderkey, string_agg(distinct l_returnflag, ',' order by l_returnflag) as flags, min(l_shipdate)::date as first_day "
    "from lineitem group by all"
)
def collect_set_sorted(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"),
        F.min("l_shipdate").cast("date").alias("first_day"),
    )


@register(
    "select conv_id, string_agg(role || ':' || length(text), ' ' order by turn) as shape from conversations group by all"
)
def ordered_concat(t: Tables) -> DataFrame:
    part = F.struct("turn", F.concat("role", F.lit(":"), F.length("text")).alias("v"))
    ordered = F.transform(F.sort_array(F.collect_list(part)), lambda x: x["v"])
    return t.conversations.groupBy("conv_id").agg(F.array_join(ordered, " ").alias("shape"))


@register(
    "with g as (select conv_id, role, count(*) as n from conversations group by all) "
    "select conv_id, string_agg(role || '=' || n, ',' order by role) as roles from g group by all"
)
def group_to_map(t: Tables) -> DataFrame:
    """Two-level grouping into a map, shown as sorted key=value text."""
    counted = t.conversations.groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("n"))
    mapped = counted.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("m"))
    entries = F.transform(F.sort_array(F.map_keys("m")), lambda k: F.concat(k, F.lit("="), F.col("m")[k]))
    return mapped.select("conv_id", F.array_join(entries, ",").alias("roles"))


@register(
    "with a as (select distinct c_nationkey, unnest(['s:' || c_mktsegment, 'b:' || (c_acctbal > 0)]) as v from customer) "
    "select c_nationkey, string_agg(v, ',' order by v) as merged from a group by all"
)
def merged_arrays(t: Tables) -> DataFrame:
    """Union of the arrays of a group: exploded, made distinct, then gathered."""
    listed = t.customer.select(
        "c_nationkey",
        F.array(F.concat(F.lit("s:"), "c_mktsegment"), F.concat(F.lit("b:"), (F.col("c_acctbal") > 0).cast("string"))).alias("a"),
    )
    values = members(listed, "a", "v").select("c_nationkey", "v").distinct()
    return values.groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_list("v")), ",").alias("merged"))


@register(
    "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey "
    "order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3"
)
def top_n_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n(rows, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


# --- set operations -------------------------------------------------------------------------------


@register(
    "select n_nationkey as id, n_name as name from nation union all select r_regionkey, r_name from region "
    "union all select cast(s_suppkey as integer), s_name from supplier"
)
def union_fold(t: Tables) -> DataFrame:
    return union_all(
        [
            t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
            t.region.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("id")),
            t.supplier.select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name")),
        ]
    )


@register("select n_name as name, n_regionkey as region from nation union all select r_name, null from region")
def union_null_pad(t: Tables) -> DataFrame:
    return union_all(
        [t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), t.region.select(F.col("r_name").alias("name"))],
        allow_missing=True,
    )


@register("select l_partkey as id from lineitem union select p_partkey from part union select s_suppkey from supplier")
def union_distinct_keys(t: Tables) -> DataFrame:
    return union_distinct(
        [t.lineitem.select(F.col("l_partkey").alias("id")), t.part.select(F.col("p_partkey").alias("id")), t.supplier.select(F.col("s_suppkey").alias("id"))]
    )


@register(
    "with e as (select distinct l_partkey as a, l_suppkey as b from lineitem) select a, b from e union all select b, a from e"
)
def symmetrize_edges(t: Tables) -> DataFrame:
    edges = t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    return symmetrize(edges, "a", "b")


@register("select distinct l_suppkey as a, l_partkey as b from lineitem")
def swap_edge_ends(t: Tables) -> DataFrame:
    edges = t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    return swap_ends(edges, "a", "b")


@register(
    "select o_orderkey as id, 'o_custkey' as ref_db, cast(o_custkey as varchar) as ref_id from orders "
    "union all select o_orderkey, 'o_orderstatus', o_orderstatus from orders "
    "union all select o_orderkey, 'o_orderpriority', o_orderpriority from orders"
)
def unpivot_wide(t: Tables) -> DataFrame:
    return unpivot_references(
        t.orders.withColumnRenamed("o_orderkey", "id"), "id", ["o_custkey", "o_orderstatus", "o_orderpriority"]
    )
