"""SQL text of the composite operators, for the comparison engine."""

from __future__ import annotations

from collections.abc import Sequence

LONG_INDEX = (
    "select idx, name, 'alias' as kind, alias as value from {p}_alias "
    "union all select idx, name, 'source' as kind, id as value from {p}_source"
)


def index_ctes(p: str, type_name: str, sources: Sequence[str]) -> str:
    """CTEs ``<p>_alias(idx, name, alias)`` and ``<p>_source(idx, name, id)`` of an alias index.

    Each source is a select of id, name, alias.
    """
    n = len(sources)
    rows = " union all ".join(
        f"select distinct {i} as src, cast(id as varchar) as id, name, alias from ({s}) q{i} where id is not null"
        for i, s in enumerate(sources)
    )
    ctes = [f"{p}_rows as materialized ({rows})"]
    for i in range(n):
        seen = " and ".join(
            f"not exists (select 1 from {p}_m{k} m where m.src = r.src and m.id = r.id)" for k in range(i)
        ) or "true"
        ctes.append(f"{p}_free{i} as materialized (select * from {p}_rows r where src >= {i} and {seen})")
        ctes.append(
            f"{p}_m{i} as materialized (select distinct src, id, {i} as lsrc, id as lid from {p}_free{i} where src = {i} "
            f"union select f.src, f.id, {i} as lsrc, l.id as lid from {p}_free{i} l join {p}_free{i} f "
            f"on l.alias = f.alias where l.src = {i} and f.src > {i})"
        )
    members = " union all ".join(f"select * from {p}_m{i}" for i in range(n))
    ctes += [
        f"{p}_m as ({members})",
        f"{p}_name as (select lsrc, lid, min(name) as name from {p}_m join {p}_rows using (src, id) group by all)",
        f"{p}_ent as (select distinct n.name, m.src, m.id, 'KN_{type_name}:' || md5(coalesce(n.name, '')) as idx "
        f"from {p}_m m join {p}_name n using (lsrc, lid))",
        f"{p}_alias as (select distinct idx, e.name, r.alias from {p}_ent e join {p}_rows r using (src, id) "
        "where r.alias is not null)",
        f"{p}_source as (select distinct idx, name, id from {p}_ent)",
    ]
    return ", ".join(ctes)


def typed_relation(p: str, rows: str, relation: str) -> str:
    """Relations of an index; ``rows`` is a select of id, name2, reference."""
    return (
        f"select distinct s.name as name1, s.idx as idx1, q.name2, '' as idx2, q.reference, '{relation}' as type "
        f"from ({rows}) q join {p}_source s on s.id = cast(q.id as varchar) "
        "where q.name2 is not null and q.reference is not null"
    )


def same_type_relation(p: str, edges: str, type_name: str) -> str:
    """Relations inside one index; ``edges`` is a select of id1, id2."""
    return (
        f"select distinct a.name as name1, a.idx as idx1, b.name as name2, b.idx as idx2, '' as reference, "
        f"'{type_name}-{type_name}' as type from ({edges}) q "
        f"join {p}_source a on a.id = cast(q.id1 as varchar) join {p}_source b on b.id = cast(q.id2 as varchar)"
    )


def with_ctes(ctes: Sequence[str], body: str) -> str:
    return f"with {', '.join(ctes)} {body}"


def pair_ctes(annotations: str, weight: str = "mentions") -> str:
    """CTEs ``p``, ``gp``, ``gw``, ``w`` (with the diagonal), ``wn`` (normalised), ``freq``, ``rel``."""
    distinct = "distinct " if weight == "distinct" else ""
    return f"""p as materialized (select {distinct}pmid, wid from ({annotations}) a),
d as materialized (select distinct pmid, wid from p),
gp as (select pmid, 1.0e0 / count(*) as g from d group by pmid),
gw as materialized (select wid, count(*) as docs, 1.0e0 / count(*) as g from d group by wid),
s as materialized (select a.wid as wid1, b.wid as wid2, sum(gp.g) as s from p a join p b on a.pmid = b.pmid
  join gp on gp.pmid = a.pmid group by all),
w as materialized (select wid1, wid2, s * pow(g1.g, 0.5e0) * pow(g2.g, 0.5e0) as w
  from s join gw g1 on g1.wid = wid1 join gw g2 on g2.wid = wid2),
wn as materialized (select * from (
  select wid1, wid2, w, w / max(w) over (partition by wid1) as w_norm from w) where wid1 <> wid2),
freq as materialized (select a.wid as wid1, b.wid as wid2, count(*) as freq from d a join d b on a.pmid = b.pmid
  and a.wid < b.wid group by all),
n as (select count(distinct pmid) as n from d),
rel as materialized (select wid1, wid2, case when ln(n.n) = ln(least(a.docs, b.docs)) then 1.0e0
  else greatest(0.0e0, 1.0e0 - (ln(greatest(a.docs, b.docs)) - ln(freq)) / (ln(n.n) - ln(least(a.docs, b.docs)))) end
  as relatedness from freq join gw a on a.wid = wid1 join gw b on b.wid = wid2, n)"""
