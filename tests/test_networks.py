import random
import re

import pytest
from pyspark.sql import functions as F

from netloom.functions.ids import packed, unpacked
from netloom.operators import export, networks
from netloom.operators.annotate import annotate, candidate_runs, document_text, filter_categories, longest_matches, settled_spots

RELATION = "NAME1 string, IDX1 string, NAME2 string, IDX2 string, REFERENCE string, TYPE string"
ALIAS = "IDX string, NAME string, TYPE string, alias string"


def test_nodes_match_normalised_names(spark, rows):
    annotations = spark.createDataFrame(
        [(1, "IL-2", "Interleukin 2"), (2, "p53", "TP53 (gene)"), (3, "--", "--")], "wiki_id int, spot string, title string"
    )
    aliases = spark.createDataFrame(
        [("KN_GENE:1", "IL2", "GENE", "il2"), ("KN_GENE:1", "IL2", "GENE", "interleukin-2"), ("KN_GENE:2", "TP53", "GENE", "TP53 gene"),
         ("KN_GENE:3", "none", "GENE", "..")], ALIAS,
    )
    found = networks.match_nodes(annotations, aliases)
    assert rows(found) == [("KN_GENE:1", "IL2", "GENE", 1), ("KN_GENE:2", "TP53", "GENE", 2)]
    assert rows(networks.node_table(found)) == [("KN_GENE:1", "IL2", [1], "GENE"), ("KN_GENE:2", "TP53", [2], "GENE")]


def test_matches_are_shuffled_with_packed_ids(spark, rows):
    long = "KN_GENE:" + "0123456789abcdef" * 2
    annotations = spark.createDataFrame([(1, "ab", "AB"), (1, "ab", "c"), (2, "c", None)], "wiki_id bigint, spot string, title string")
    aliases = spark.createDataFrame([(long, "n", "gene", "Ab"), (long, "n", "gene", "C"), ("own", "m", "drug", "c")], "IDX string, NAME string, TYPE string, alias string")
    found = networks.match_nodes(annotations, aliases)
    assert rows(found) == [(long, "n", "GENE", 1), (long, "n", "GENE", 2), ("own", "m", "DRUG", 1), ("own", "m", "DRUG", 2)]
    assert found.columns == ["IDX", "NAME", "TYPE", "wiki_id"]
    # The ids become whole in the last step only, after the matches are distinct.
    last = found._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert ".digest" in last


def test_entity_network_averages_distinct_scores(spark, rows):
    prediction = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5), (4, 2, 1.0), (1, 4, 9.0)], "wid1 int, wid2 int, score double")
    bridge = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3), ("A", 4)], "IDX string, wiki_id int")
    assert rows(networks.entity_network(prediction, bridge)) == [("A", "B", 0.75)]


def test_interaction_network_averages_all_rows(spark, rows):
    links = spark.createDataFrame([("p", "q", 1), ("p", "q", 1), ("p", "r", 4), ("p", "p", 9)], "protein1 string, protein2 string, score int")
    proteins = spark.createDataFrame([("A", "p"), ("B", "q"), ("B", "r")], "IDX string, string_id string")
    assert rows(networks.interaction_network(links, proteins)) == [("A", "B", 2.0)]


def test_taxon_prefix(spark):
    df = spark.createDataFrame([("9606.ENSP1",), ("none",)], "s string")
    assert [r[0] for r in df.select(networks.without_taxon(F.col("s"))).collect()] == ["ENSP1", None]


def test_literature_links_of_all_type_pairs(spark, rows):
    relations = spark.createDataFrame(
        [
            ("flu", "KN_DISEASE:1", "TP53", "", "", "disease-gene"),
            ("gene1", "KN_GENE:1", "", "", "MIM:DrugBank=7", "gene-drug"),
            ("flu", "KN_DISEASE:1", "cold", "KN_DISEASE:2", "", "disease-disease"),
            ("x", "KN_DRUG:1", "tp53", "", "", "drug-target"),
            ("x", "KN_GENE:2", "flu", "", "", "gene-rna"),
        ],
        RELATION,
    )
    aliases = spark.createDataFrame(
        [("KN_GENE:9", "TP53", "GENE", "tp53"), ("KN_PROTEIN:9", "TP53", "PROTEIN", "tp53")], ALIAS
    )
    ids = spark.createDataFrame([("KN_DRUG:7", "seven", "DRUG", "DrugBank:7")], "IDX string, NAME string, TYPE string, SOURCE_ID string")
    links = networks.literature_links(relations, aliases, ids)
    assert rows(networks.literature_edges(links)) == [
        ("KN_DISEASE:1", "KN_DISEASE:2"), ("KN_GENE:1", "KN_DRUG:7"), ("KN_GENE:9", "KN_DISEASE:1"),
    ]
    assert ("KN_DRUG:7", "seven", "DRUG") in rows(networks.literature_nodes(links))


def test_merged_edges_fill_missing_evidence(spark, rows):
    score = "IDX1 string, IDX2 string, score double"
    merged = export.merge_edges(
        spark.createDataFrame([("a", "b", 0.5)], score),
        spark.createDataFrame([("a", "b", 700.0), ("b", "c", 1.0)], score),
        spark.createDataFrame([("c", "d")], "IDX1 string, IDX2 string"),
    )
    assert rows(merged) == [("a", "b", 0.5, 700.0, 0), ("b", "c", 0.0, 1.0, 0), ("c", "d", 0.0, 0.0, 1)]


def test_merged_nodes_and_their_entities(spark, rows):
    node = "IDX string, NAME string, TYPE string"
    matched = spark.createDataFrame([("a", "A", "GENE", 7), ("a", "A", "GENE", 8)], node + ", wiki_id int")
    other = spark.createDataFrame([("a", "A", "GENE"), ("b", "B", "DRUG")], node)
    nodes = export.merge_nodes([matched, other])
    assert rows(nodes) == [("a", "A", "GENE"), ("b", "B", "DRUG")]
    assert rows(export.node_entities([matched, other], matched)) == [("a", 7), ("a", 8), ("b", None)]
    aliases = spark.createDataFrame([("a", "al"), ("z", "no")], "IDX string, alias string")
    assert rows(export.name_aliases([aliases], nodes)) == [("a", "al", "GENE")]


DICTIONARY = "spot string, wiki_id int, title string, link_probability double, commonness double, categories array<string>"


def dictionary(spark):
    return spark.createDataFrame(
        [
            ("gene", 1, "Gene", 0.2, 0.9, ["bio"]), ("gene therapy", 2, "Gene therapy", 0.8, 1.0, ["bio", "med"]),
            ("therapy", 3, "Therapy", 0.4, 0.5, ["med"]), ("therapy", 4, "Therapy (film)", 0.4, 0.4, ["film"]),
            ("cell", 5, None, 0.9, 1.0, ["bio"]), ("new cell", 6, "New cell", 0.1, 1.0, ["bio"]),
        ],
        DICTIONARY,
    )


def test_longest_spot_wins(spark, rows):
    docs = spark.createDataFrame([(1, "Gene therapy, and a gene."), (2, "THERAPY cell"), (3, None)], "pmid int, text string")
    found = annotate(docs, dictionary(spark))
    assert rows(found, "pmid", "start", "end", "spot", "wiki_id", "rho") == [
        (1, 0, 2, "gene therapy", 2, 0.4), (1, 4, 5, "gene", 1, 0.1), (2, 0, 1, "therapy", 3, 0.2),
    ]
    assert rows(annotate(docs, dictionary(spark), epsilon=0.2), "wiki_id") == [(2,), (3,)]


def test_overlaps_are_settled_greedily(spark, rows):
    """The longest match first, each if it overlaps none that is kept."""
    rng = random.Random(4)
    matches = {(d, s, rng.randrange(1, 7)) for d in range(4) for s in rng.sample(range(80), 50)} | {(9, 0, 1), (9, 0, 2), (9, 1, 3)}
    want = []
    for d, s, n in sorted(matches, key=lambda m: (-m[2], m[1])):
        if all(e != d or t + m <= s or s + n <= t for e, t, m in want):
            want.append((d, s, n))
    df = spark.createDataFrame(list(matches), "pmid int, start int, words int")
    assert rows(longest_matches(df), "pmid", "start", "words") == sorted(want, key=repr)
    assert {m for m in want if m[0] == 9} == {(9, 0, 1), (9, 1, 3)}


def test_entries_of_any_length(spark, rows):
    entries = spark.createDataFrame(
        [("tumor necrosis factor alpha", 1, "TNF", 0.5, 1.0, ["bio"]), ("tumor", 2, "Tumor", 0.5, 1.0, ["bio"])], DICTIONARY
    )
    docs = spark.createDataFrame([(1, "the tumor necrosis factor alpha was high"), (2, "a tumor necrosis")], "pmid int, text string")
    assert rows(annotate(docs, entries), "pmid", "start", "end", "wiki_id") == [(1, 1, 5, 1), (2, 1, 2, 2)]


def test_coherence_chooses_the_sense(spark):
    docs = spark.createDataFrame([(1, "therapy of the gene")], "pmid int, text string")
    related = spark.createDataFrame([(1, 4, 0.9), (1, 3, 0.0)], "wid1 int, wid2 int, relatedness double")
    assert {r.wiki_id for r in annotate(docs, dictionary(spark)).collect()} == {1, 3}
    got = {r.wiki_id: round(r.rho, 6) for r in annotate(docs, dictionary(spark), related=related).collect()}
    assert got == {1: 0.55, 4: 0.65}


def test_coherence_raises_the_score(spark):
    docs = spark.createDataFrame([(1, "gene and therapy and gene therapy")], "pmid int, text string")
    related = spark.createDataFrame([(1, 2, 0.6), (2, 3, 0.2)], "wid1 int, wid2 int, relatedness double")
    got = {r.wiki_id: r.rho for r in annotate(docs, dictionary(spark), related=related).collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {1: 0.25, 2: 0.6, 3: 0.25}


def test_annotations_share_their_spots(spark, rows):
    """Spots are found once for several annotations; rows of documents with one key stay, a choice leaves one a place."""
    docs = spark.createDataFrame([(1, "therapy of the gene"), (1, "therapy of the gene"), (2, "Gene therapy"), (3, "a gene"), (None, "gene")], "pmid int, text string")
    related = spark.createDataFrame([(1, 4, 0.9)], "wid1 int, wid2 int, relatedness double")
    spots = settled_spots(docs, dictionary(spark))
    assert rows(spots) == [(1, 0, 1, "therapy", 2), (1, 0, 1, "therapy", 2), (1, 3, 1, "gene", 2), (1, 3, 1, "gene", 2), (2, 0, 2, "gene therapy", 1), (3, 1, 1, "gene", 1)]
    nothing = docs.limit(0)
    found = annotate(nothing, dictionary(spark), spots=spots)
    assert rows(found, "pmid", "start", "wiki_id") == [(1, 0, 3), (1, 0, 3), (1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 1, 1)]
    chosen = annotate(nothing, dictionary(spark), related=related, spots=spots)
    assert [(*r[:3], round(r[3], 6)) for r in rows(chosen, "pmid", "start", "wiki_id", "rho")] == [(1, 0, 4, 0.65), (1, 3, 1, 0.55), (2, 0, 2, 0.4), (3, 1, 1, 0.1)]


def test_the_coherence_query_finds_its_spots_once(spark, tmp_path, monkeypatch):
    from netloom.operators import annotate as module
    from netloom.queries.texts import QUERIES

    calls, whole = [], module.candidate_runs
    monkeypatch.setattr(module, "candidate_runs", lambda *args: calls.append(1) or whole(*args))
    spark.createDataFrame([(1, "a b c d"), (2, "c d e"), (3, "e a")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "x a b c d y c d e"), (2, "e a a"), (3, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {(r.pmid, r.start, r.spot) for r in QUERIES["annotate_coherence"](spark, str(tmp_path)).collect()} == {
        (1, 1, "a b c d"), (1, 6, "c d e"), (2, 0, "e a"), (2, 2, "a"),
    }
    assert len(calls) == 1


def test_text_is_null_without_abstract(spark):
    df = spark.createDataFrame([("T", "A"), ("T", None)], "t string, a string")
    assert [r[0] for r in df.select(document_text(F.col("t"), F.col("a"))).collect()] == ["T\nA", None]


def test_category_filter_is_distinct(spark, rows):
    annotations = spark.createDataFrame(
        [(1, 10, "s", 0.5, "t", ["bio", "med"]), (1, 11, "s", 0.5, "t", ["film"])],
        "pmid int, wiki_id int, spot string, rho double, title string, categories array<string>",
    )
    categories = spark.createDataFrame([("bio",), ("med",)], "category string")
    assert rows(filter_categories(annotations, categories)) == [(1, 10, "s", 0.5, "t")]


def brute_runs(docs, spots):
    """Every run of tokens that is an entry, by comparing all runs."""
    out = []
    for pmid, text in docs:
        words = re.findall(r"[^\W_]+", text.lower())
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if " ".join(words[i:j]) in spots:
                    out.append((pmid, i, j - i, " ".join(words[i:j])))
    return sorted(out)


@pytest.mark.parametrize("seed, longest", [(1, 3), (2, 8), (3, 9), (4, 30)])
def test_candidates_are_the_entries_and_nothing_else(spark, seed, longest):
    rng = random.Random(seed)
    docs = [(n // 2, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 40])))) for n in range(30)]
    docs.append((99, "a b " * 40))
    spots = {" ".join(rng.choice("abc") for _ in range(rng.randint(1, longest))) for _ in range(40)} | {" ".join("ab" * (longest // 2))}
    dictionary = spark.createDataFrame([(s,) for s in spots], "spot string")
    found = candidate_runs(spark.createDataFrame(docs, "pmid bigint, text string"), dictionary)
    assert sorted(tuple(r) for r in found.select("pmid", "start", "words", "spot").collect()) == brute_runs(docs, spots)


def test_one_endless_entry_costs_little(spark):
    """The levels of a very long entry are left as soon as no position is on its way through it."""
    docs = spark.createDataFrame([(1, "x y z " * 200), (2, "x y q")], "pmid bigint, text string")
    dictionary = spark.createDataFrame([("x y " + "w " * 500 + "w",), ("x y",)], "spot string")
    found = candidate_runs(docs, dictionary)
    assert found.count() == 201 and {r.words for r in found.collect()} == {2}


def test_nothing_to_look_up(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "pmid bigint, text string")
    assert candidate_runs(docs, spark.createDataFrame([], "spot string")).count() == 0
    assert candidate_runs(docs.limit(0), spark.createDataFrame([("x",)], "spot string")).count() == 0


def test_packed_ids_come_back(spark):
    ids = ["KN_GENE:" + "0123456789abcdef" * 2, "KN_GENE:" + "0123456789ABCDEF" * 2, "abcdef", "", None, "f" * 32, "x" * 40, "KN_Ä:" + "00" * 16]
    found = spark.createDataFrame([(i,) for i in ids], "i string").select("i", packed(F.col("i")).alias("p")).select("i", "p.head", unpacked(F.col("p")).alias("back"))
    assert [(r.i, r.back) for r in found.collect()] == [(i, i) for i in ids]
    assert [r["head"] for r in found.collect()][:2] == ["KN_GENE:", ids[1]]


def test_links_are_made_distinct_once(spark):
    # Relations, links by name, links by reference and all links were each made distinct, all with the ids in full.
    relations = spark.range(1).selectExpr(
        "'n' as NAME1", "'i' as IDX1", "concat('m', id) as NAME2", "'' as IDX2", "concat('db:', id) as REFERENCE", "concat('gene-', 'drug') as TYPE"
    )
    ids = spark.createDataFrame([("j", "m", "DRUG", "m0", "0")], "IDX string, NAME string, TYPE string, alias string, SOURCE_ID string")
    links = networks.literature_links(relations, ids.drop("SOURCE_ID"), ids.drop("alias"))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    # Terms, ids and links.
    assert plan.count("Aggregate") == 3
    assert [tuple(r) for r in links.collect()] == [("n", "i", "m", "j")]
