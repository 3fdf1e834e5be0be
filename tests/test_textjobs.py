import shutil

import pytest
from pyspark.sql import functions as F

from netloom.operators import textjobs
from netloom.sources import catalog
from netloom.sources.spec import read_lines, read_source, read_stanzas, read_tsv, read_xml, write_table, write_tsv
from netloom.streaming.intake import article_stream, start_intake

DUMP = """-- Table structure
DROP TABLE IF EXISTS `SENTENCE`;
CREATE TABLE `SENTENCE` (
  `SENTENCE_ID` int(10) unsigned NOT NULL,
  `PMID` varchar(20) NOT NULL,
  `TYPE` varchar(2) NOT NULL,
  `NUMBER` decimal(10) unsigned NOT NULL,
  `SENTENCE` varchar(999) DEFAULT NULL,
  PRIMARY KEY (`SENTENCE_ID`),
  KEY `pmid_index` (`PMID`)
) ENGINE=InnoDB;

-- Dumping data
INSERT INTO `SENTENCE` VALUES (2,'7','ab',2,'Second, part'),(1,'7','ab',1,'First'),(3,'7','ti',1,'Title'),(x,'8','ti',1,'bad');
INSERT INTO `SENTENCE` VALUES (4,'9','ti',1,'Only a title'),(3000000000,'9','ab',1,NULL);
"""


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_sql_dump(spark, rows, tmp_path):
    lines = read_lines(spark, write(tmp_path, "sentences.sql", DUMP))
    schema = textjobs.dump_schema(lines)
    assert schema == [("SENTENCE_ID", "bigint"), ("PMID", "string"), ("TYPE", "string"), ("NUMBER", "double"), ("SENTENCE", "string")]
    sentences = textjobs.dump_rows(lines, schema)
    assert rows(sentences, "SENTENCE_ID", "SENTENCE") == [
        (1, "First"), (2, "Second, part"), (3, "Title"), (3000000000, None), (4, "Only a title"),
    ]
    assert rows(textjobs.sentences_to_documents(sentences)) == [
        (7, "Title", "First Second, part"), (9, "Only a title", None),
    ]


def test_dump_of_several_files_and_types(spark, rows, tmp_path):
    head = "CREATE TABLE `T` (\n  `ID` bigint(20) unsigned NOT NULL,\n  `DAY` datetime DEFAULT NULL,\n  `KEYWORD` char(3),\n  `TXT` longtext,\n  KEY `k` (`ID`)\n) ;\n"
    other = "CREATE TABLE `U` (\n  `X` int\n);\n-- data\nINSERT INTO `U` VALUES (7);\n"
    row = "-- data\nINSERT INTO `T` VALUES ({}, '2020-01-02 03:04:05','abc','hello, {}');\n"
    paths = [write(tmp_path, f"{n}.sql", head + row.format(18446744073709551615 - n, n) + other) for n in range(2)]
    lines = read_lines(spark, paths)
    schema = textjobs.dump_schema(lines, "T")
    assert schema == [("ID", "decimal(20,0)"), ("DAY", "timestamp"), ("KEYWORD", "string"), ("TXT", "string")]
    found = textjobs.dump_rows(lines, schema, "T").select("ID", F.col("DAY").cast("string"), "TXT")
    assert [(int(i), d, x) for i, d, x in rows(found)] == [
        (18446744073709551614, "2020-01-02 03:04:05", "hello, 1"), (18446744073709551615, "2020-01-02 03:04:05", "hello, 0"),
    ]
    with pytest.raises(ValueError, match="T and U"):
        textjobs.dump_schema(lines)


def test_dump_with_listed_columns_and_odd_values(spark, rows, tmp_path):
    head = "CREATE TABLE `T` (\n  `ID` int unsigned,\n  `N` smallint(5) unsigned,\n  `TXT` text,\n  `LAST` tinyint\n);\n"
    data = (
        "INSERT INTO `T` VALUES (1,65535,'a''),(9','1'),(2,NULL,'it\\'s',-1);\nINSERT INTO `T` (`ID`,`LAST`,`TXT`) VALUES (3,7,'x\\\\'),('y',1,'no');\n"
        "INSERT INTO `U` VALUES (4,4,'other',4);\n"
    )
    lines = read_lines(spark, write(tmp_path, "t.sql", head + data))
    found = textjobs.dump_rows(lines, textjobs.dump_schema(lines, "T"), "T")
    assert found.dtypes == [("ID", "bigint"), ("N", "int"), ("TXT", "string"), ("LAST", "smallint")]
    assert rows(found) == [(1, 65535, "a'),(9", 1), (2, None, "it's", -1), (3, None, "x\\", 7)]


def test_xml_files_are_split(spark, tmp_path):
    body = "".join(f'<a><r k="{n}"><v>x {n} &amp; <i>y</i></v></r></a>\n' for n in range(4000))
    path = write(tmp_path, "big.xml", f"<all>{body}</all>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert read_xml(spark, path, "r", "_k bigint, v string", nests=False).rdd.getNumPartitions() > 3
        for nests in (False, True):
            found = read_xml(spark, path, "r", "_k bigint, v string", nests=nests)
            got = {r._k: r.v for r in found.select("_k", textjobs.plain_text(F.col("v")).alias("v")).collect()}
            assert got == {n: f"x {n} & y" for n in range(4000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_keep_file_order_across_splits(spark, tmp_path):
    path = write(tmp_path, "long.txt", "\n".join(f"{i:05d}" for i in range(5000)) + "\n\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 3
        got = [r.value for r in lines.orderBy("file", "block", "line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{i:05d}" for i in range(5000)]


ONTOLOGY = """format-version: 1.2

[Term]
id: D:1
name: Flu: seasonal
alt_id: D:9
synonym: "Influenza" EXACT []
synonym: "grippe" RELATED []
is_a: D:2 ! Viral Infection

[Term]
id: D:3
name: obsolete thing

[Term]
id: D:2
name: Viral Infection

[Typedef]
id: part_of
name: part of

[Term]
id: D:4
name: after the typedef
"""


@pytest.mark.parametrize("split", [True, False])
def test_ontology(spark, rows, tmp_path, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        terms = textjobs.ontology_terms(read_stanzas(spark, write(tmp_path, "d.obo", ONTOLOGY), "\n["))
        assert rows(terms) == [
            ("D:1", "Flu: seasonal", ["D:9"], ["Influenza", "grippe"], ["D:2"], ["viral infection"]),
            ("D:2", "Viral Infection", [], [], [], []),
        ]
        assert rows(textjobs.ontology_aliases(terms), "id", "other_name") == [
            ("D:1", "flu: seasonal"), ("D:1", "grippe"), ("D:1", "influenza"), ("D:2", "viral infection"),
        ]
        assert rows(textjobs.ontology_edges(terms)) == [("D:1", "D:2")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


ENZYMES = """BR\theader
ID\t1.1.1.1 (moved)
****
PR\t#1# Homo sapiens P07327 UniProt <1,2>
\tcontinued
PR\t#2# Bos taurus Q1 UniProt <3>
RN\talcohol dehydrogenase
SY\tADH
SY\t#1# other <1>
ID\t1.1.1.2
PR\t#1# Mus musculus Q2 UniProt <1>
RN\tmouse only
ID\t1.1.1.3 transferred to EC 9
PR\t#1# Homo sapiens P2 UniProt <1>
RN\tmoved
"""


def test_enzyme_file(spark, rows, tmp_path):
    found = textjobs.enzyme_records(read_stanzas(spark, write(tmp_path, "e.txt", ENZYMES), "\nID\t"))
    assert rows(found) == [("1.1.1.1", "alcohol dehydrogenase", ["P07327"], ["ADH"])]


def test_gtf_layouts(spark, rows):
    line = 'chr1\ts\ttranscript\t1\t2\t.\t+\t.\tgene_id "G"; transcript_id "T"; gene_alias_1 "A"; gene_alias_2 "B";'
    df = spark.createDataFrame([(line,), (line,), ("#header",)], "value string")
    assert rows(textjobs.lncrna_transcripts(df)) == [("transcript", "G", "T", "A;B", None)]
    other = 'chr1\ts\tgene\t1\t2\t.\t+\t.\tgene_id "G"; gene_type "lnc;"; transcript_alias_1 "x"'
    df = spark.createDataFrame([(other,), (other.replace("\tgene\t", "\texon\t"),)], "value string")
    assert rows(textjobs.lncrna_genes(df)) == [("G", "lnc", None, None, "x")]


def test_transcripts(spark, rows):
    df = spark.createDataFrame(
        [(">NM_1.2 Homo sapiens kinase (PK), transcript variant 1, mRNA",), (">XM_1.1 PREDICTED: Homo sapiens x (Y), mRNA",),
         (">NM_2.1 Mus musculus x (Y), mRNA",), (">NR_1.1 Homo sapiens x (Y), long non-coding RNA",), ("ACGT mRNA Homo sapiens",)],
        "value string",
    )
    assert rows(textjobs.transcripts(df)) == [("NM_1", "kinase", "PK", "transcript variant 1", "mRNA")]


def test_quoted_lists(spark, rows):
    df = spark.createDataFrame([("P1", '"a b", "c"'), ("P2", None)], "id string, v string")
    assert rows(textjobs.explode_quoted(df, ["id"], "v")) == [("P1", "a b"), ("P1", "c")]


ARTICLES = """<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">11</PMID><Article><ArticleTitle>One</ArticleTitle>
<Abstract><AbstractText Label="A">first</AbstractText><AbstractText>second</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID Version="2">12</PMID><Article><ArticleTitle>Two</ArticleTitle></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>"""


def test_articles(spark, rows, tmp_path):
    found = textjobs.articles(read_xml(spark, write(tmp_path, "a.xml", ARTICLES), "PubmedArticle", textjobs.ARTICLE_SCHEMA))
    assert rows(found) == [(11, "One", "first second"), (12, "Two", "")]


def test_article_stream_adds_each_document_once(spark, rows, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    corpus, checkpoint = str(tmp_path / "corpus"), str(tmp_path / "checkpoint")
    known = spark.createDataFrame([(14,)], "pmid bigint")

    def run():
        stream = article_stream(spark, str(inbox)).withColumnRenamed("PMID", "pmid")
        start_intake(stream, corpus, checkpoint, known=known, buckets=4).awaitTermination(120)
        return rows(spark.read.parquet(corpus), "pmid", "Title")

    (inbox / "a.xml").write_text(ARTICLES)
    assert run() == [(11, "One"), (12, "Two")]
    (inbox / "b.xml").write_text(ARTICLES.replace(">12<", ">13<").replace("Two", "Three"))
    (inbox / "c.xml").write_text(ARTICLES.replace(">12<", ">14<"))
    assert run() == [(11, "One"), (12, "Two"), (13, "Three")]
    assert run() == [(11, "One"), (12, "Two"), (13, "Three")]


def test_a_batch_is_told_by_state_and_can_be_repeated(spark, rows, tmp_path, monkeypatch):
    """Neither the corpus nor buckets of other keys are read, and a batch that runs twice changes nothing."""
    from netloom.sources.buckets import BucketTable
    from netloom.streaming.intake import START, append_new_documents, known_keys

    def batch(*ids):
        return spark.createDataFrame([(i, f"t{i}") for i in ids], "pmid bigint, text string")

    corpus = str(tmp_path / "corpus")
    known = known_keys(corpus, batch(1).schema, "pmid", 16)
    known.write(batch().select("pmid"), START)
    add = append_new_documents(corpus, known)
    add(batch(1, 2, 3, None, 1), 0)
    shutil.rmtree(f"{corpus}/batch=0")  # known by state, not by the corpus
    asked = []
    plain = BucketTable.read
    monkeypatch.setattr(BucketTable, "read", lambda self, spark, run, buckets=None: (asked.append(list(buckets)), plain(self, spark, run, buckets))[1])
    for _ in range(2):
        add(batch(2, 9), 1)
        assert rows(spark.read.parquet(f"{corpus}/batch=1")) == [(9, "t9")]
    assert all(b == known.buckets_of(batch(2, 9)) for b in asked)
    assert sorted(r.pmid for r in plain(known, spark, "1").collect()) == [1, 2, 3, 9]


DRUGS = """<drugbank>
<drug><drugbank-id primary="true">DB1</drugbank-id><drugbank-id>OLD</drugbank-id><name>aspirin</name>
<synonyms><synonym language="en">asa</synonym></synonyms>
<external-identifiers><external-identifier><resource>PharmGKB</resource><identifier>PA1</identifier></external-identifier></external-identifiers>
<mixtures><mixture><name>mix</name></mixture></mixtures>
<international-brands><international-brand><name>brand</name></international-brand></international-brands>
<drug-interactions><drug-interaction><drugbank-id>DB2</drugbank-id><name>b</name></drug-interaction></drug-interactions>
<targets><target><id>BE1</id><name>COX</name><organism>Humans</organism>
<polypeptide id="P1" source="S"><name>cox</name><gene-name>PTGS1</gene-name>
<external-identifiers><external-identifier><resource>HGNC</resource><identifier>H1</identifier></external-identifier></external-identifiers>
<synonyms><synonym>c1</synonym><synonym>c2</synonym></synonyms></polypeptide></target>
<target><id>BE2</id><name>other</name><organism>Yeast</organism></target></targets>
<enzymes><enzyme><id>BE3</id><name>cyp</name><organism>Humans</organism>
<polypeptide id="P2" source="S"><name>cyp</name><gene-name>CYP</gene-name>
<external-identifiers><external-identifier><resource>HGNC</resource><identifier>H2</identifier></external-identifier></external-identifiers>
<synonyms><synonym>c</synonym></synonyms></polypeptide></enzyme></enzymes>
<transporters><transporter><id>BE4</id><name>abc</name><organism>Humans</organism>
<polypeptide id="P3" source="S"><name>abc</name><gene-name>ABC</gene-name>
<external-identifiers><external-identifier><resource>HGNC</resource><identifier>H3</identifier></external-identifier></external-identifiers>
<synonyms><synonym>c</synonym></synonyms></polypeptide></transporter></transporters>
</drug>
<drug><drugbank-id primary="true">DB2</drugbank-id><drugbank-id>OLD2</drugbank-id><name>b</name></drug>
</drugbank>"""


def test_drug_database(spark, rows, tmp_path):
    from netloom.plans import databases

    records = read_xml(spark, write(tmp_path, "d.xml", DRUGS), catalog.DRUG_XML_ROW, catalog.DRUG_XML_SCHEMA)
    parts = textjobs.component_parts(records, databases.DRUG_KEYS, catalog.DRUG_TARGETS)
    assert rows(textjobs.part_synonyms(parts), "component", "synonym") == [("BE1", "c1"), ("BE1", "c2")]
    assert rows(textjobs.part_references(parts), "component", "resource", "identifier") == [("BE1", "HGNC", "H1")]
    header = "PharmGKB Accession Id\tName\tGeneric Names\tTrade Names\tBrand Mixtures\tCross-references\tInChI\tType\n"
    body = 'PA1\tAspirin\t"gen1", "gen2"\t\t\t"DrugBank:DB1", "Web:x"\t\tDrug\nPA2\tgroup\t\t\t\t\t\tDrug Class\n'
    spec = catalog.PHARMACOGENOMICS
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(write(tmp_path, "p.tsv", header + body))
    pharma = raw.select(*[f.column() for f in spec.fields])
    made = databases.drugs(records, pharma)
    nested = made.index.nested().collect()
    assert sorted((r.drug_name, r.other_name, r.SOURCE_ID) for r in nested) == [
        ("Aspirin", ["Aspirin", "asa", "aspirin", "brand", "gen1", "gen2", "mix"], ["DB1", "PA1"]), ("b", ["b"], ["DB2"]),
    ]
    assert rows(made.relations, "NAME1", "NAME2", "REFERENCE", "TYPE") == [
        ("Aspirin", "ABC", "", "drug-gene"), ("Aspirin", "COX", "target:BE1", "drug-target"), ("Aspirin", "CYP", "", "drug-gene"),
        ("Aspirin", "PTGS1", "", "drug-gene"), ("Aspirin", "abc", "transporter:BE4", "drug-transporter"),
        ("Aspirin", "b", "", "drug-drug"), ("Aspirin", "cyp", "enzyme:BE3", "drug-enzyme"),
    ]


def test_source_specs(spark, rows, tmp_path):
    hairpin = "1\tMI1\thsa-MIR-1\tnull\t.\t.\t.\t.\t0\n2\tMI2\thsa-mir-2\told\t.\t.\t.\t.\tx\n"
    assert rows(read_source(spark, catalog.MIRNA_HAIRPIN, write(tmp_path, "h.txt", hairpin))) == [
        ("MI1", "hsa-mir-1", "null", 0), ("MI2", "hsa-mir-2", "old", None),
    ]
    links = "protein1 protein2 combined_score\n9606.A 9606.B 700\n"
    assert rows(read_source(spark, catalog.NETWORK_PROTEIN_LINKS, write(tmp_path, "l.txt", links))) == [("9606.A", "9606.B", 700)]
    target = "miRTarBase ID,miRNA,Species (miRNA),Target Gene,Species (Target Gene)\nMT1,hsa-miR-1,Homo sapiens,G,Homo sapiens\n"
    assert rows(read_source(spark, catalog.MIRNA_TARGET, write(tmp_path, "t.csv", target))) == [
        ("MT1", "hsa-mir-1", "Homo sapiens", "G", "Homo sapiens")
    ]


def test_sinks(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = write_tsv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert rows(read_tsv(spark, path)) == [("1", "a"), ("2", "b")]
    table = write_table(df, str(tmp_path / "t"), range_by=["k"])
    write_table(df, table, mode="append")
    assert spark.read.parquet(table).count() == 4
