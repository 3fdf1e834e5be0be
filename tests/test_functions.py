import random

import pytest
from pyspark.sql import functions as F

from netloom.functions import text as fn
from netloom.functions.ids import entity_id, entity_type, row_id
from netloom.functions.parsing import attribute, fasta_fields, insert_columns, insert_tuples, tuple_values, unescaped


@pytest.fixture
def apply(spark):
    def run(function, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.x for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]

    return run


def test_normalize_term(apply):
    assert apply(fn.normalize_term, "hsa-miR-1", "IL - 2", "a, b+ c", "hsa", "lncRNA", "Plain") == [
        "miR1", "IL2", "ab+c", "hsa", "lncRNA", "Plain",
    ]


def test_empty_key_never_joins(apply):
    assert apply(fn.matching_key, "IL-2", "--", "", None) == ["il2", None, None, None]


def test_clean_reference(apply):
    assert apply(fn.clean_reference, "db:id", "db:HGNC=5", "db:a:b", "none") == ["id", "HGNC:5", "a:b", ""]


def test_accession_list(apply):
    assert apply(fn.accession_list, "DB:a;b [x];", "DisGenNet:123;12345678;", "HGNC:HGNC:7;", "none") == [
        ["DB:a", "DB:b"], ["DisGenNet:C0000123", "DisGenNet:C12345678"], ["HGNC:HGNC:7"], [],
    ]


def test_expand_family(apply):
    assert apply(fn.expand_family, "miR-1/206", "miR-17-5p/20", "let7") == [
        ["miR-1", "miR-206"], ["miR-17-5p", "miR-20"], ["let7"],
    ]


def test_human_mirna_reference(apply):
    assert apply(fn.human_mirna_reference, "miRNA:miR-1", "gene:X", "miRNA") == ["miRNA:hsa-mir-1", "gene:X", "miRNA"]


def test_inverted_names(apply):
    assert apply(fn.inverted_names, "Diabetes, Insipid", "Diabetes, Severe, Type 2", "Hand, Foot", "Asthma") == [
        ["Insipid Diabetes", "Diabetes, Insipid"],
        ["Severe Diabetes Type 2", "Diabetes, Severe, Type 2"],
        ["Hand, Foot"],
        ["Asthma"],
    ]


def test_protein_aliases_are_whole(apply):
    assert apply(fn.protein_aliases, "Enzyme A (EC 1.1) (Enz)", "Plain") == [["Enzyme A", "EC 1.1", "Enz"], ["Plain"]]
    got = apply(fn.protein_aliases, "A (B) chain (EC 2) (C (d) e) [Cleaved into: X (Y)]", "N(1) x")
    assert got == [["A (B) chain", "EC 2", "C (d) e"], ["N(1) x"]]


def test_missing_values(apply):
    assert apply(fn.missing_to_null, "", "null", "x", None) == [None, None, "x", None]


def test_quoted_items(apply):
    assert apply(fn.quoted_items, '"a", "b,c"', "plain") == [["a", "b,c"], ["plain"]]


def test_proteins_of_species(spark):
    lines = ["#1# Homo sapiens P1 UniProt <1,2>", "#2# Homo sapiens P1 UniProt <3>", "#3# Bos taurus Q1 UniProt <4>", "#4,5# Homo sapiens <1>"]
    df = spark.createDataFrame([(lines,)], "v array<string>")
    assert df.select(fn.proteins_of_species(F.col("v"))).first()[0] == ["P1"]


def test_attributes(apply):
    info = 'gene_id "G 1"; gene_alias_1 "A"; gene_alias_2 "B"; transcript_id "T";'
    assert apply(lambda c: attribute(c, "gene_id"), info, "") == ["G 1", None]
    assert apply(lambda c: attribute(c, "gene_alias", numbered=True), info) == ["A;B"]
    assert apply(lambda c: attribute(c, "alias"), info) == [None]


def test_fasta_fields(apply):
    line = ">NM_1.2 Homo sapiens protein (alpha) kinase (PK1), transcript variant 2, mRNA"
    got = {k: apply(lambda c, k=k: fasta_fields(c)[k], line)[0] for k in ("RNA_id", "RNA_name", "gene_name", "variant", "type")}
    assert got == {"RNA_id": "NM_1.2", "RNA_name": "protein (alpha) kinase", "gene_name": "PK1",
                   "variant": "transcript variant 2", "type": "mRNA"}
    assert apply(lambda c: fasta_fields(c)["gene_name"], ">NM_2.1 Homo sapiens no gene here, mRNA") == [None]
    assert apply(lambda c: fasta_fields(c)["gene_name"], ">NM_3.1 Homo sapiens cap (5') end (CAP), mRNA") == ["CAP"]
    assert apply(lambda c: fasta_fields(c)["variant"], ">NM_4.1 Homo sapiens x (Y), mRNA") == [None]


STATEMENTS = [
    ("INSERT INTO `S` VALUES (1,'7','ti',2,'One, two'),(2,'7','ab',1,'Three');", [["1", "7", "ti", "2", "One, two"], ["2", "7", "ab", "1", "Three"]]),
    ("INSERT INTO `S` VALUES (5,'9','ti',1,NULL),(6, null ,'NULL',-1.5e3);", [["5", "9", "ti", "1", None], ["6", None, "NULL", "-1.5e3"]]),
    (r"INSERT INTO `S` VALUES (1,'It''s'),(2,'\'p\''),(3,'a\\'),(4,'\\\'x');", [["1", "It's"], ["2", "'p'"], ["3", "a\\"], ["4", "\\'x"]]),
    ("INSERT INTO `S` VALUES (1,'a'),(2,'b (c''),(d'),(3,'e;');", [["1", "a"], ["2", "b (c'),(d"], ["3", "e;"]]),
    (r"INSERT INTO `S` VALUES (1,'x\ny\tz\0\Z\%\\n',0x1F,_binary 'q');", [["1", "x\ny\tz\0\x1a%\\n", "0x1F", "_binary 'q'"]]),
    ("insert ignore into `S` (`b`, `a`) values ('', POINT(1,2)) , ('''''', 2) ;", [["", "POINT(1,2)"], ["''", "2"]]),
    ("INSERT INTO `S` VALUES ();", []),
]


def test_insert_statements(apply):
    for statement, want in STATEMENTS:
        assert apply(lambda c: F.transform(insert_tuples(c), tuple_values), statement) == [want], statement
    assert apply(insert_columns, "INSERT INTO `S` (`b`, `a`) VALUES (1,2);", STATEMENTS[0][0]) == [["b", "a"], []]


def test_random_values_survive_a_dump(apply):
    """Values written as a database writes them come back, quotes, brackets and long texts included."""
    rng = random.Random(3)
    escape = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\0": "\\0", "\x1a": "\\Z"}

    def written(value):
        if value is None:
            return "NULL"
        quote = rng.choice(["''", "\\'"])
        return "'" + "".join(escape.get(c, quote if c == "'" else c) for c in value) + "'"

    def some():
        return rng.choice([None, "".join(rng.choice("ab'\\(),;`\"\n\r\0\x1a %é") for _ in range(rng.choice([0, 3, 30])))])

    wanted = []
    for _ in range(40):
        rows = [[some() for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 5))]
        rows[0][0] = "'),(\\" * rng.choice([1, 20_000])
        wanted.append(rows)
    statements = ["INSERT INTO `T` VALUES " + ",".join(f"({','.join(map(written, r))})" for r in rows) + ";" for rows in wanted]
    assert apply(lambda c: F.transform(insert_tuples(c), tuple_values), *statements) == wanted
    assert apply(unescaped, r"a\\'") == ["a\\'"]


def test_ids_do_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "n string")
    made = df.select("n", entity_id("GENE", F.col("n")).alias("i"), row_id("DE", "n").alias("r"))
    assert rows(made.repartition(3)) == rows(made.coalesce(1))
    first = made.first()
    assert first.i.startswith("KN_GENE:") and first.r.startswith("DE:")
    assert made.select(entity_type(F.col("i"))).first()[0] == "GENE"
