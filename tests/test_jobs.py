"""The three job paths on small files: scores, entities to exports, and an update."""

import pytest
from pyspark.sql import functions as F

from netloom.config import JobConfig
from netloom.operators import scoring
from netloom.operators.networks import TYPES
from netloom.plans import knowledge_path, score_path, update_path
from netloom.queries import all_queries
from netloom.sources.spec import read_tsv
from test_textjobs import DRUGS, ENZYMES, ONTOLOGY


def tsv(*lines):
    return "\n".join("\t".join(line) for line in lines) + "\n"


FILES = {
    "gene_disease": tsv(
        ("geneSymbol", "diseaseId", "diseaseName", "diseaseType"), ("PTGS1", "C1", "Influenza", "disease"), ("X", "C9", "Tall", "phenotype")
    ),
    "variant_disease": tsv(("snpId", "diseaseId", "diseaseName", "source", "diseaseType"), ("rs1", "C2", "Cold", "S", "group")),
    "disease_disease": tsv(("diseaseId1", "diseaseId2", "diseaseId1_name", "diseaseId2_name"), ("C1", "C2", "Influenza", "Cold")),
    "disease_ontology": ONTOLOGY,
    "disease_enhancer": tsv(("0", "1", "2", "3", "PTGS1", "Cold")),
    "drug_xml": DRUGS,
    "pharmacogenomics": tsv(
        ("PharmGKB Accession Id", "Name", "Generic Names", "Trade Names", "Brand Mixtures", "Cross-references", "InChI", "Type"),
        ("PA1", "Aspirin", '"gen1", "gen2"', "", "", '"DrugBank:DB1", "Web:x"', "", "Drug"),
    ),
    "gene_browser": tsv(
        ("Gene stable ID", "Transcript stable ID", "Gene name", "Transcript name", "Gene Synonym"), ("ENSG1", "ENST1", "PTGS1", "t", "COX1")
    ),
    "gene_browser_uniprot": tsv(("Gene stable ID", "UniProtKB ID"), ("ENSG1", "P1")),
    "gene_nomenclature": tsv(
        ("hgnc_id", "symbol", "name", "locus_group", "locus_type", "status", "alias_symbol", "alias_name", "prev_symbol", "prev_name",
         "gene_family", "gene_family_id", "entrez_id", "ensembl_gene_id", "refseq_accession", "uniprot_ids", "pubmed_id", "cosmic",
         "mirbase", "lncrnadb", "enzyme_id", "lncipedia"),
        ("HGNC:1", "PTGS1", "synthase", "", "", "Approved", "COX1|COX3", "", "", "", "", "", "", "", "NM_1", "P1", "", "", "", "", "", ""),
    ),
    "clinical_evidence": tsv(("gene_id", "gene", "disease", "drugs"), ("7", "PTGS1", "Cold", "Aspirin,B")),
    "lncrna_gtf_38": 'chr1\ts\ttranscript\t1\t2\t.\t+\t.\tgene_id "LNC1"; transcript_id "T1"; gene_alias_1 "ENSG1";\n',
    "lncrna_gtf_19": 'chr1\ts\ttranscript\t1\t2\t.\t+\t.\tgene_id "LNC2"; transcript_id "T2"; gene_alias_1 "ENSG2";\n',
    "lnc_mirna": tsv(("gene_id", "gene_symbol", "gene_class", "microrna", "tr_region"), ("ENSG5", "LNC1", "lncRNA", "miR-1/206", "x")),
    "mirna_hairpin": tsv(("1", "MI1", "hsa-mir-1", "null", "", "", "", "", "0")),
    "mirna_mature": tsv(("1", "hsa-miR-206", "mir-206a", "MIMAT1", "", "", "", "0")),
    "mirna_species": tsv(("1", "hsa", "HSA", "Homo sapiens")),
    "mirna_cancer": tsv(("mirId", "Cancer"), ("hsa-mir-1", "Cold")),
    "mirna_disease": tsv(("mir", "disease"), ("hsa-mir-1", "Influenza")),
    "mirna_target": "miRTarBase ID,miRNA,Species (miRNA),Target Gene,Species (Target Gene)\nMT1,hsa-miR-1,Homo sapiens,PTGS1,Homo sapiens\n",
    "transcript_fasta": ">NM_1.2 Homo sapiens synthase (PTGS1), transcript variant 1, mRNA\nACGT\n",
    "pathway_elements": (
        "PathBank ID,Pathway Name,Pathway Subject,species,Protein Name,Uniprot ID,HMDBP ID,DrugBank ID,GenBank ID,Gene Name\n"
        "SMP1,Aspirin Action (x),s,Homo sapiens,cox,P1,H1,DB1,G1,PTGS1\n"
    ),
    "reaction_pathways": tsv(("R1", "Aspirin Action", "Homo sapiens"), ("R2", "Other", "Homo sapiens")),
    "reaction_hierarchy": tsv(("R1", "R2")),
    "reaction_elements_UniProt": tsv(("P1", "x", "cox", "R1", "u", "Aspirin Action", "e", "Homo sapiens")),
    "pathway_genes": tsv(("PN1", "Aspirin path", "c", "PTGS1", "HUMAN|HGNC=1|UniProtKB=P1", "cox")),
    "proteins": tsv(
        ("Entry", "Entry name", "Status", "Protein names", "Organism", "Gene names  (synonym )", "Gene names  (primary )",
         "Cross-reference (RefSeq)", "Cross-reference (BioGrid)", "Cross-reference (STRING)", "Cross-reference (DrugBank)",
         "Ensembl transcript", "Cross-reference (KEGG)", "Cross-reference (DisGeNET)", "Cross-reference (HGNC)",
         "Cross-reference (BRENDA)", "Cross-reference (UniPathway)"),
        ("P1", "COX", "reviewed", "Synthase one (EC 1) (COX-1)", "Homo sapiens (Human)", "COX3", "PTGS1", "NM_1;", "", "9606.E1;", "DB1;",
         "ENST1 [P1];", "", "1;", "HGNC:1;", "1.1.1.1;", ""),
        ("P2", "CYP", "reviewed", "Cyp", "Homo sapiens (Human)", "", "CYP", "", "", "9606.E2;", "", "", "", "", "", "", ""),
    ),
    "enzyme_flat_file": ENZYMES,
    "network_protein_info": tsv(("protein_external_id", "preferred_name"), ("9606.E1", "PTGS1"), ("9606.E2", "CYP")),
    "network_protein_links": "protein1 protein2 combined_score\n9606.E1 9606.E2 700\n9606.E2 9606.E1 800\n",
}


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """All paths run once, in order."""
    folder = tmp_path_factory.mktemp("job")
    sources = {}
    for name, body in FILES.items():
        (folder / name).write_text(body)
        sources[name] = str(folder / name)
    cfg = JobConfig(root=str(folder / "out"), sources=sources, top=5)
    documents = spark.createDataFrame(
        [(1, "PTGS1 and aspirin", "The cold"), (2, "Aspirin", "PTGS1 with cold and aspirin"), (3, "No abstract", None), (4, "Cold", "CYP")],
        "PMID bigint, Title string, Abstract string",
    )
    words = ["ptgs1", "aspirin", "cold", "cyp"]
    dictionary = spark.createDataFrame(
        [(w, i + 1, w.upper(), 0.5, 1.0, ["bio"]) for i, w in enumerate(words)],
        "spot string, wiki_id bigint, title string, link_probability double, commonness double, categories array<string>",
    )
    categories = spark.createDataFrame([("bio",)], "category string")
    annotations = score_path.build_annotations(spark, cfg, documents, dictionary, categories)
    scores = score_path.build_scores(spark, cfg, annotations)
    knowledge_path.build_entities(spark, cfg, TYPES)
    entities = knowledge_path.read_entities(spark, cfg, TYPES)
    tables = knowledge_path.build_networks(spark, cfg, entities, annotations, scores["prediction"])
    exported = knowledge_path.export_tables(cfg, tables, entities, annotations, scores["pair_evidence"], single_file=True)
    return cfg, annotations, scores, entities, tables, exported


def test_jobs_leave_no_stages(spark, job):
    """What a job materialises is gone when its tables are stored; exports are read later and go at exit."""
    from netloom import session

    cfg, annotations, *_ = job
    before = list(session._written)
    score_path.build_scores(spark, JobConfig(root=cfg.root + "-again", top=5), annotations)
    knowledge_path.build_entities(spark, JobConfig(root=cfg.root + "-again", sources=cfg.sources), ["enzyme", "drug"])
    assert session._written == before


def test_annotations_and_scores(job, rows):
    _, annotations, scores, *_ = job
    assert rows(annotations.select("pmid", "wiki_id").distinct()) == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (4, 3), (4, 4),
    ]
    assert rows(scores["pair_freq"]) == [(1, 2, 2), (1, 3, 2), (2, 3, 2), (3, 4, 1)]
    assert scores["prediction"].count() == 8


def test_every_entity_type_is_built(job):
    _, _, _, entities, *_ = job
    for kind in TYPES:
        assert entities[kind].index.aliases.count() > 0 and entities[kind].relations.count() > 0, kind


def test_quoted_lists_survive_the_scan(job):
    _, _, _, entities, *_ = job
    names = {r.alias for r in entities["drug"].index.aliases.where("NAME = 'Aspirin'").collect()}
    assert {"gen1", "gen2", "asa", "aspirin"} <= names


def test_one_gene_from_three_sources(job):
    _, _, _, entities, *_ = job
    ids = {r.SOURCE_ID for r in entities["gene"].index.source_ids.where("NAME = 'PTGS1'").collect()}
    assert ids == {"ENSG1", "HGNC:1", "7"}


def test_networks(job, rows):
    *_, tables, _ = job
    links = rows(tables["literature_edges"].join(tables["literature_nodes"].selectExpr("IDX as IDX1", "NAME as a"), "IDX1")
                 .join(tables["literature_nodes"].selectExpr("IDX as IDX2", "NAME as b"), "IDX2"), "a", "b")
    assert ("PTGS1", "Synthase one") in links and ("PTGS1", "flu: seasonal") in links and ("PTGS1", "Aspirin") in links
    assert rows(tables["interaction_network"], "score") == [(700.0,), (800.0,)]
    assert rows(tables["interaction_nodes"], "NAME", "string_id") == [("Cyp", ["E2"]), ("Synthase one", ["E1"])]
    assert tables["entity_network"].count() > 0
    assert tables["entity_network"].where("IDX1 = IDX2").isEmpty()


def test_exports(spark, job):
    *_, exported = job
    found = {n: read_tsv(spark, p) for n, p in exported.items()}
    assert found["nodes"].columns == ["id", "name", "label"]
    assert found["edges"].columns == ["IDX1", "IDX2", "prediction_score", "interaction_score", "literature"]
    assert all(df.count() > 0 for df in found.values())
    assert found["node_entities"].join(found["nodes"], "id", "left_anti").isEmpty()


def test_update_equals_a_full_run(spark, job, rows):
    cfg, annotations, *_ = job
    batch = spark.createDataFrame(
        # The last one gives a stored document another entity.
        [(9, 1, "ptgs1", 0.25, "PTGS1"), (9, 4, "cyp", 0.25, "CYP"), (1, 1, "again", 0.25, "PTGS1"), (1, 44, "new", 0.25, "NEW")],
        "pmid bigint, wiki_id bigint, spot string, rho double, title string",
    )
    cfg = JobConfig(root=cfg.root + "-state", top=5, buckets=8)
    started = update_path.start_state(spark, cfg, annotations)
    plain = score_path.build_scores(spark, JobConfig(root=cfg.root + "-plain", top=5), annotations)
    rounded, score = F.round("w_norm", 9), F.round("score", 9)
    for name, columns in (("w_matrix", ("wid1", "wid2", rounded)), ("prediction", ("wid1", "wid2", score)), ("pair_freq", ("wid1", "wid2", "freq"))):
        assert rows(started[name], *columns) == rows(plain[name], *columns), name
    updated = update_path.update_scores(spark, cfg, batch, run="2")
    full = score_path.build_scores(spark, JobConfig(root=cfg.root + "-full", top=5), updated["annotations"])
    assert updated["annotations"].count() == annotations.count() + 3
    for name in ("pair_freq", "pair_evidence", "surface_forms"):
        assert rows(updated[name], *full[name].columns) == rows(full[name]), name
    assert rows(updated["w_matrix"], "wid1", "wid2", rounded) == rows(full["w_matrix"], "wid1", "wid2", rounded)
    assert rows(updated["relatedness"], "wid1", "wid2") == rows(full["relatedness"], "wid1", "wid2")
    # Stored relatedness stays; with it the prediction is that of the full tables.
    want = scoring.predict(full["w_matrix"], updated["relatedness"], full["pair_freq"], 5)
    assert rows(updated["prediction"], "wid1", "wid2", score) == rows(want, "wid1", "wid2", score)
    # The previous run is untouched.
    assert rows(update_path.ScoreState(cfg).tables(spark, "1")["pair_freq"]) == rows(plain["pair_freq"])


def test_a_batch_of_one_document_writes_one_bucket(spark, job):
    """One new document with one entity: one bucket of the tables that have a row for it."""
    cfg, annotations, *_ = job
    cfg = JobConfig(root=cfg.root + "-one", top=5, buckets=16)
    update_path.start_state(spark, cfg, annotations)
    batch = spark.createDataFrame([(77, 500, "s", 0.5, "T")], update_path.ANNOTATION)
    updated = update_path.update_scores(spark, cfg, batch, run="2")
    state = update_path.ScoreState(cfg)
    for table in (state.annotations, state.forms, state.projection.entities, state.projection.maxima):
        owners = table.owners(spark, "2")
        assert list(owners.values()).count("2") == 1, table.name
    for table in (state.evidence, state.relatedness, state.projection.pairs):
        assert "2" not in table.owners(spark, "2").values() and table.owners(spark, "1") == table.owners(spark, "2")
    assert updated["annotations"].count() == annotations.count() + 1
    assert state.documents(spark, "2") == state.documents(spark, "1") + 1


def test_stream_intake_reads_a_table_in_several_files(spark, tmp_path):
    # The stream looked for one file of the table's name and found nothing in a folder.
    rows = [(3, "a b"), (1, "a b"), (2, "c"), (5, "c"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    found = all_queries()["stream_intake"](spark, str(tmp_path / "folder"))
    assert sorted(r.doc_id for r in found.collect()) == [1, 2]
