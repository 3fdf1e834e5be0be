import random
import re
from collections import defaultdict
from hashlib import md5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netloom.operators.entity_index import EntityIndex, build_index, build_index_by_xref
from netloom.operators.relations import Far, consolidate, reference_rows, same_type_relations, typed_relations
from netloom.plans import databases


def source(spark, data):
    return spark.createDataFrame(data, "id string, name string, other_name string")


def contents(index):
    return sorted(
        (r[1], tuple(r.other_name), tuple(r.SOURCE_ID)) for r in index.nested().collect()
    )


def brute_index(sources):
    """The rounds, cluster by cluster."""
    member = set()
    for lead in range(len(sources)):
        attached = {(s, i) for s, i, _, _ in member}
        leaders = [(i, a) for i, _, a in sources[lead] if (lead, i) not in attached]
        found = {(lead, i, lead, i) for i, _ in leaders}
        for later in range(lead + 1, len(sources)):
            for j, _, b in sources[later]:
                if (later, j) not in attached:
                    found |= {(later, j, lead, i) for i, a in leaders if a is not None and a == b}
        member |= found
    clusters = defaultdict(set)
    for s, i, ls, li in member:
        clusters[ls, li].add((s, i))
    merged = defaultdict(lambda: (set(), set()))
    for ids in clusters.values():
        rows = [(s, i, n, a) for s, i in ids for j, n, a in sources[s] if j == i]
        name = min(n for _, _, n, _ in rows)
        merged[name][0].update(a for *_, a in rows if a is not None)
        merged[name][1].update(i for _, i, _, _ in rows)
    return sorted((n, tuple(sorted(a)), tuple(sorted(i))) for n, (a, i) in merged.items())


A = [("A1", "alpha", "x"), ("A1", "alpha", "y"), ("A2", "beta", "z")]
B = [("B1", "Alfa", "x"), ("B1", "Alfa", "z"), ("B2", "gamma", "w")]


def test_hand_made_index(spark):
    index = build_index("T", [source(spark, A), source(spark, B)])
    assert contents(index) == [("Alfa", ("x", "y", "z"), ("A1", "A2", "B1")), ("gamma", ("w",), ("B2",))]


def test_null_aliases_never_match(spark):
    index = build_index("T", [source(spark, [("A1", "a", None)]), source(spark, [("B1", "b", None)])])
    assert contents(index) == [("a", (), ("A1",)), ("b", (), ("B1",))]


def test_one_source_merges_equal_names(spark):
    index = build_index("T", [source(spark, [("1", "n", "a"), ("2", "n", "b"), ("3", "m", "a")])])
    assert contents(index) == [("m", ("a",), ("3",)), ("n", ("a", "b"), ("1", "2"))]


def test_equal_ids_of_two_sources_stay_apart(spark):
    index = build_index("T", [source(spark, [("1", "a", "x")]), source(spark, [("1", "b", "y")])])
    assert contents(index) == [("a", ("x",), ("1",)), ("b", ("y",), ("1",))]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_random_index_equals_brute_force(spark, seed):
    """One alias is much more frequent than the others."""
    rng = random.Random(seed)

    def some(tag, n):
        return [
            (f"{tag}{rng.randrange(n)}", f"n{rng.randrange(30):02d}", rng.choice(["hot", None] + [f"a{k}" for k in range(30)]))
            for _ in range(25)
        ]

    sources = [some("A", 12), some("B", 12), some("C", 8)]
    index = build_index("T", [source(spark, s) for s in sources])
    assert contents(index) == brute_index(sources)


def test_index_does_not_depend_on_order(spark):
    shuffled = [source(spark, s).orderBy(F.rand(3)).repartition(3) for s in (A, B)]
    first = build_index("T", [source(spark, A), source(spark, B)])
    second = build_index("T", shuffled)
    assert sorted(first.nested().collect()) == sorted(second.nested().collect())


def test_nested_form_round_trips(spark, rows):
    index = build_index("T", [source(spark, A), source(spark, B)])
    back = EntityIndex.from_nested(index.nested(), "T")
    assert rows(back.aliases, *index.aliases.columns) == rows(index.aliases)
    assert rows(back.source_ids, *index.source_ids.columns) == rows(index.source_ids)


def test_numeric_ids_become_strings(spark):
    numeric = spark.createDataFrame([(7, "n", "a")], "id int, name string, other_name string")
    assert contents(build_index("T", [source(spark, [("X", "m", "b")]), numeric])) == [
        ("m", ("b",), ("X",)), ("n", ("a",), ("7",)),
    ]


def test_cross_reference_index(spark):
    left = source(spark, [("D1", "aspirin", "asa"), ("D2", "caffeine", "coffee")])
    right = source(spark, [("P1", "Aspirin", "bayer"), ("P3", "new", "new")])
    refs = "left_id string, right_id string"
    index = build_index_by_xref(
        "DRUG", left, right, spark.createDataFrame([("D1", "P1")], refs), spark.createDataFrame([("D1", "P1"), ("D1", "P9")], refs)
    )
    assert contents(index) == [
        ("Aspirin", ("asa", "bayer"), ("D1", "P1")), ("aspirin", ("asa",), ("D1",)),
        ("caffeine", ("coffee",), ("D2",)), ("new", ("new",), ("P3",)),
    ]


def test_typed_relations(spark, rows):
    index = build_index("T", [source(spark, [("1", "n", "a")])])
    df = spark.createDataFrame(
        [("1", "far", "r1"), ("1", None, "r2"), ("1", "far", None), ("9", "far", "r")], "id string, far string, DB_ref string"
    )
    cols = ["NAME1", "NAME2", "IDX2", "REFERENCE", "TYPE"]
    assert rows(typed_relations(df, "id", index, [Far("t-u", "far", "DB_ref")]), *cols) == [("n", "far", "", "DB:r1", "t-u")]
    assert rows(typed_relations(df, "id", index, [Far("t-u", "far")]), *cols) == [("n", "far", "", "", "t-u")]
    assert rows(typed_relations(df, "id", index, [Far("t-u", ref="DB_ref", prefix="X")]), *cols) == [
        ("n", "", "", "X:r1", "t-u"), ("n", "", "", "X:r2", "t-u"),
    ]


def test_ids_that_follow_from_a_name_are_not_shuffled(spark, rows):
    from pyspark.sql import functions as F

    from netloom.functions.ids import entity_id, lengthened, packed, shortened, unpacked
    from netloom.operators import relations as module

    made = entity_id("T", F.col("name"), prefix="Q")
    ids = spark.createDataFrame([("n", None), ("", None), (None, None), ("n", "KN_T:x"), ("n", ""), ("n", "Q_T:" + "0" * 32)], "name string, own string")
    whole = ids.withColumn("idx", F.coalesce("own", made)).unionByName(ids.limit(1).withColumn("idx", F.lit(None).cast("string")))
    short = whole.withColumn("pack", shortened(F.col("idx"), "T", F.col("name"), "Q"))
    assert short.where("pack is null").count() == 3
    assert short.where(~lengthened(F.col("pack"), "T", F.col("name"), "Q").eqNullSafe(F.col("idx"))).count() == 0

    index = build_index("T", [source(spark, [("1", "n", "a"), ("2", "n", "b"), ("3", None, "c"), ("4", "m", None)])], "Q").stored()
    found = spark.createDataFrame([("1", "x", "", "t-u"), ("2", "x", "", "t-u"), ("3", "x", "r", "t-u"), ("9", "x", "", "t-u")], "SOURCE_ID string, NAME2 string, REFERENCE string, TYPE string")
    edges = spark.createDataFrame([("1", "4"), ("2", "4"), ("3", "3")], "a string, b string")
    got = module.index_relations(index, [found], [(edges, "t")])
    want = module.near_ends(found, index).unionByName(same_type_relations(index, edges, "t")).distinct()
    assert rows(got) == rows(want) and len(rows(got)) == 4
    idx = {r.NAME1: r.IDX1 for r in got.collect()}
    assert idx["n"] == "Q_T:7b8b965ad4bca0e41ab51de7b31363a1" and idx[None] != idx["n"]
    assert [r.NAME1 for r in module._near(found, index).where("IDX1 is not null").collect()] == [None]
    assert rows(index.aliases.select("IDX").where("NAME = 'n'").distinct()) == [(idx["n"],)]


def test_input_files_are_compressed(spark, rows):
    import glob

    from pyspark.sql import functions as F

    from netloom.queries.entities import text_file
    from netloom.queries.registry import Tables
    from netloom.sources.spec import read_lines

    lines = spark.createDataFrame([("a",), ("b c",)], "v string")
    path = text_file(Tables(spark, ""), F.col("v"), lines, "lines")
    assert glob.glob(f"{path.removeprefix('file:')}/*.txt.gz")
    assert rows(read_lines(spark, path), "value") == [("a",), ("b c",)]


def test_same_type_relations_and_consolidation(spark, rows):
    index = build_index("T", [source(spark, [("1", "n", "a"), ("2", "m", "b")])])
    edges = spark.createDataFrame([("1", "2"), ("1", "2"), ("1", "9")], "a string, b string")
    found = same_type_relations(index, edges, "t")
    assert rows(found, "NAME1", "NAME2", "TYPE") == [("n", "m", "t-t")]
    relations = spark.createDataFrame(
        [("n", "i", "m", "", "r2", "t"), ("n", "i", "m", "", "r1", "t"), ("n", "i", "m", "", "r1", "t")],
        "NAME1 string, IDX1 string, NAME2 string, IDX2 string, REFERENCE string, TYPE string",
    )
    nested = consolidate(relations)
    assert [(r.REFERENCE, r.CHUNK) for r in nested.collect()] == [(["r1", "r2"], 0)]
    assert reference_rows(nested).count() == 2
    single = consolidate(relations, 1)
    assert sorted((r.CHUNK, r.REFERENCE) for r in single.collect()) == [(0, ["r1"]), (1, ["r2"])]
    assert rows(reference_rows(single)) == rows(reference_rows(nested))


# --- entity databases -----------------------------------------------------------------------------


def names_of(tables):
    return sorted((r.NAME1, r.NAME2, r.REFERENCE, r.TYPE) for r in tables.relations.collect())


def test_phenotypes_are_removed_from_edges(spark, rows):
    genes = spark.createDataFrame(
        [("g1", "C1", "flu", "disease"), ("g2", "C2", "tall", "phenotype")],
        "gene_name string, disease_dgn_id string, disease_name string, diseaseType string",
    )
    variants = spark.createDataFrame(
        [("rs1", "C3", "cold", "s", "group")],
        "snp_id string, disease_dgn_id string, disease_name string, source string, diseaseType string",
    )
    edges = spark.createDataFrame(
        [("C1", "C3", "flu", "cold"), ("C1", "C2", "flu", "tall")],
        "disease_dgn_id1 string, disease_dgn_id2 string, disease_name1 string, disease_name2 string",
    )
    terms = spark.createDataFrame(
        [("D:1", "Flu", ["influenza"], ["D:2"]), ("D:2", "Infection", [], [])],
        "id string, name string, synonyms array<string>, parent_ids array<string>",
    )
    enhancer = spark.createDataFrame([("g9", "influenza")], "gene_name string, disease_name string")
    made = databases.diseases(genes, variants, edges, terms, enhancer)
    assert contents(made.index)[1][0] == "flu"
    assert names_of(made) == [
        ("flu", "cold", "", "disease-disease"), ("flu", "g1", "", "disease-gene"), ("flu", "g9", "", "disease-gene"),
        ("flu", "infection", "", "disease-disease"),
    ]


def test_gene_aliases(spark):
    approved = spark.createDataFrame(
        [("H1", "GENE1", "gene one", "a|b", None), ("H2", "GENE2", "gene two", None, "long name")],
        "hgnc_id string, gene_symbol string, gene_name string, alias_symbol string, alias_name string",
    )
    found = databases.nomenclature_aliases(approved).collect()
    assert sorted((r.id, r.name, r.other_name) for r in found) == [
        ("H1", "GENE1", "GENE1"), ("H1", "GENE1", "a"), ("H1", "GENE1", "b"), ("H1", "GENE1", "gene one"),
        ("H2", "GENE2", "GENE2"), ("H2", "GENE2", "gene two"), ("H2", "GENE2", "long name"),
    ]


def test_living_mirnas_of_one_species(spark, rows):
    mirnas = spark.createDataFrame(
        [("M1", "hsa-mir-1", "null", 0), ("M2", "hsa-mir-2", "mir-2a", 0), ("M3", "hsa-mir-3", "x", 1), ("M4", "mmu-mir-1", "y", 0)],
        "miRNA_id string, miRNA_name string, miRNA_old_name string, is_dead int",
    )
    species = spark.createDataFrame(
        [("1", "hsa", "homo sapiens"), ("2", "mmu", "Mus musculus")], "species_id string, species_symbol string, species_name string"
    )
    living = databases.living_mirnas(mirnas, species)
    assert rows(living, "miRNA_id") == [("M1",), ("M2",)]
    assert rows(databases.mirna_aliases([living])) == [
        ("M1", "hsa-mir-1", "hsa-mir-1"), ("M2", "hsa-mir-2", "hsa-mir-2"), ("M2", "hsa-mir-2", "mir-2a"),
    ]


def test_pathway_gene_triples(spark, rows):
    df = spark.createDataFrame(
        [("P1", "path", "g", "HUMAN|HGNC=1|UniProtKB=P9", "prot"), ("P2", "path", "g", "MOUSE|MGI=1|UniProtKB=P8", "prot"), ("P3", "p", "g", "HUMAN", "x"), ("P4", "p", "g", "HUMAN|HUMAN|UniProtKB=P7", "x")],
        "Panther_ID string, Pathway_name string, gene_name string, gen_prot_ID string, protein_name string",
    )
    assert rows(databases.pathway_genes(df)) == [("P1", "path", "g", "HGNC=1", "P9"), ("P3", "p", "g", None, None), ("P4", "p", "g", "HUMAN", "P7")]


def test_unreviewed_proteins_are_dropped(spark, rows):
    df = spark.createDataFrame(
        [("P1", "reviewed", "Homo sapiens (Human)"), ("P2", "unreviewed", "Homo sapiens (Human)"), ("P3", "reviewed", "Mouse")],
        "UniProt_ID string, Status string, Organism string",
    )
    assert rows(databases.reviewed_proteins(df), "UniProt_ID") == [("P1",)]


def test_every_relation_starts_at_an_indexed_entity(spark):
    transcripts = spark.createDataFrame([("NM_1", "long name", "G1"), ("NM_2", "other", "G2")], "RNA_id string, RNA_name string, gene_name string")
    made = databases.mrnas(transcripts)
    ids = {r.IDX for r in made.index.source_ids.collect()}
    assert {r.IDX1 for r in made.relations.collect()} <= ids and len(ids) == 2


def folder_size(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return sum(f.stat().st_size for f in root.rglob("*") if f.is_file())


def test_xref_index_stores_little_per_pair(spark):
    # Entity ids and names were written and shuffled per alias and id of every pair: 717 MB on 3.5 million pairs.
    pairs = spark.range(20000).selectExpr("concat('L', id) as left_id", "concat('R', id % 100) as right_id")
    left = pairs.selectExpr("left_id as id", "concat('name ', left_id) as name", "left_id as other_name")
    right = pairs.selectExpr("right_id as id", "concat('a ', right_id) as name", "right_id as other_name").distinct()
    before = folder_size(spark)
    index = build_index_by_xref("DRUG", left, right, pairs, pairs.limit(0))
    assert folder_size(spark) - before < 50 * 20000
    assert index.aliases.count() == index.source_ids.count() == 40000


def test_xref_index_merges_pairs_of_the_same_id(spark, rows):
    # ("a", "b|c") and ("a|b", "c") have one id, as have (null, "z") and ("", "z"); "both" is an alias and an id on both sides.
    schema = "id string, name string, other_name string"
    left = spark.createDataFrame([("a", "n1", "both"), ("a|b", "n2", "x"), ("", "n3", None), ("s", None, "s"), ("k", "n5", "y")], schema)
    right = spark.createDataFrame([("b|c", "n0", "both"), ("c", "n9", "x"), ("z", "n4", "w"), ("s", "n6", "s")], schema)
    refs = spark.createDataFrame(
        [("a", "b|c"), ("a|b", "c"), ("", "z"), (None, "z"), ("s", "s"), ("k", "gone"), ("gone", "gone")], "left_id string, right_id string"
    )
    index = build_index_by_xref("D", left, right, refs, refs.limit(0))
    idx = {pair: entity_hash(*pair) for pair in [("a", "b|c"), ("", "z"), ("s", "s"), ("k", "gone")]}
    assert rows(index.aliases, "IDX", "NAME", "alias") == sorted([
        (idx["a", "b|c"], "n0", "both"), (idx["a", "b|c"], "n0", "x"), (idx["", "z"], "n3", "w"), (idx["s", "s"], "n6", "s"), (idx["k", "gone"], "n5", "y"),
    ], key=repr)
    assert rows(index.source_ids, "IDX", "NAME", "SOURCE_ID") == sorted(
        [(idx["a", "b|c"], "n0", i) for i in ("a", "a|b", "b|c", "c")] + [(idx["", "z"], "n3", i) for i in ("", "z")]
        + [(idx["s", "s"], "n6", "s"), (idx["k", "gone"], "n5", "k")], key=repr
    )


def entity_hash(left, right):
    return "KN_D:" + md5(f"{left}|{right}".encode()).hexdigest()


def test_index_makes_rows_distinct_without_ids(spark):
    # The digests of entity ids and of generated source ids were shuffled as text.
    index = build_index("T", [source(spark, [("DE:" + "ab" * 16, "n", "a")]), source(spark, [("y", "m", "a"), ("z", None, "b")])])
    assert index.source_ids.where("NAME = 'm'").select("SOURCE_ID").orderBy("SOURCE_ID").collect() == [("DE:" + "ab" * 16,), ("y",)]
    assert index.source_ids.where("NAME is null").select("SOURCE_ID").collect() == [("z",)]
    for table in (index.aliases, index.source_ids):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        keys = re.findall(r"Aggregate \[([^\]]*)\]", plan)
        assert keys and not any("IDX" in k for k in keys)


def test_disease_inputs_are_stored_once(spark):
    # Associations, edges and enhancers were put together anew by every reader.
    genes = spark.createDataFrame([("g", "D1", "flu", "disease")], "gene_name string, disease_dgn_id string, disease_name string, diseaseType string")
    edges = spark.createDataFrame([("D1", "D1", "flu", "flu")], "disease_dgn_id1 string, disease_dgn_id2 string, disease_name1 string, disease_name2 string")
    kept = databases.keep_known_diseases(edges, [genes], ["disease_dgn_id1", "disease_dgn_id2"])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 1 and "Aggregate" not in plan
