import random

import pytest

from netloom.queries import files
from netloom.queries.registry import Tables
from netloom.sources.spec import read_xml
from netloom.sources.xml import record_texts
from netloom.sources import catalog


@pytest.fixture
def small_splits(spark):
    """Splits of so many bytes, for a while."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, old)


def put(tmp_path, text, name="a.xml"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def drug(rng, n):
    inner = "".join(
        f"<pathway><name>p{k}</name><drugs>" + "".join(f"<drug><drugbank-id>DB{k}</drugbank-id><name>in {k}</name></drug>" for k in range(rng.randint(0, 4)))
        + "</drugs></pathway>" for k in range(rng.randint(0, 3))
    )
    pathways = f"<pathways>{inner}</pathways>" if rng.random() < 0.7 else ""
    filler = "x" * rng.choice([0, 10, 900])
    parts = [f"<name>n{n} &amp; {filler}</name>", pathways, f"<targets><target><id>BE{n}</id><name>t</name><organism>Humans</organism></target></targets>"]
    rng.shuffle(parts)
    return f'<drug type="a>b" created="2005"><drugbank-id primary="true">DB{n}</drugbank-id>{"".join(parts)}<drug-interactions/></drug>'


@pytest.mark.parametrize("size", [400, 3000, 16384, 1 << 27])
def test_nested_records_equal_the_engines_own_reader(spark, rows, tmp_path, small_splits, size):
    rng = random.Random(size)
    body = "\n".join(drug(rng, n) for n in range(150))
    path = put(tmp_path, f'<?xml version="1.0"?>\n<drugbank xmlns="u" version="5">\n{body}\n</drugbank>\n')
    small_splits(1 << 27)
    want = rows(spark.read.format("xml").option("rowTag", "drug").schema(catalog.DRUG_XML_SCHEMA).load(path))
    small_splits(size)
    if size < 1 << 17:
        assert spark.read.option("lineSep", "</drug>").text(path).rdd.getNumPartitions() > 3
    found = read_xml(spark, path, "drug", catalog.DRUG_XML_SCHEMA)
    assert rows(found) == want and len(want) == 150


def texts(spark, path, name="r"):
    return sorted(r.value for r in record_texts(spark, path, name).collect())


def test_odd_markup(spark, tmp_path, small_splits):
    records = [
        "<r>plain</r>", "<r a='/>'><r/>empty inside</r>", "<r><!-- <r> --><r\n>deep<r>er</r></r></r>", "<r><![CDATA[ <r> ]]></r>",
        "<r ><rr>other name</rr></r>", "<r>deep<r>er</r ></r>",
    ]
    text = "<all><!-- <r> none --><r/>" + "<b/>".join(records) + "<r>no end</all>"
    want = sorted(records)
    for size in (40, 1 << 27):
        small_splits(size)
        assert texts(spark, put(tmp_path, text)) == want


@pytest.mark.parametrize("size", [60, 200, 5000])
def test_random_depths_in_several_files(spark, tmp_path, small_splits, size):
    """Records cut by hand with a counter equal those cut in splits."""
    rng = random.Random(size)
    want, paths = [], []
    for f in range(3):
        body = []
        for _ in range(60):
            depth, record = 0, []
            while True:
                if depth == 0 or rng.random() < 0.4:
                    record.append("<r>" + "y" * rng.choice([0, 5, 150]))
                    depth += 1
                else:
                    record.append("</r>")
                    depth -= 1
                if depth == 0:
                    break
            want.append("".join(record))
            body.append(want[-1] + rng.choice(["", "\n", "<x>z</x>"]))
        paths.append(put(tmp_path, "<all>" + "".join(body) + "</all>", f"f{f}.xml"))
    small_splits(size)
    assert texts(spark, paths) == sorted(want)


def test_one_deep_record_over_many_splits(spark, tmp_path, small_splits):
    record = "<r>" + "<r>abc</r>" * 500 + "</r>"
    small_splits(256)
    assert texts(spark, put(tmp_path, f"<all><r>1</r>{record}<r>2</r></all>")) == sorted(["<r>1</r>", record, "<r>2</r>"])


def test_files_without_records(spark, tmp_path):
    assert texts(spark, put(tmp_path, "<all/>")) == [] and texts(spark, put(tmp_path, "", "b.xml")) == []


def test_a_record_that_does_not_parse_is_an_error(spark, rows, tmp_path):
    path = put(tmp_path, "<all><r><v>1</v></r><r><v>2</w></r></all>")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_xml(spark, path, "r", "v string").collect()
    assert rows(read_xml(spark, path, "r", "v string", mode="PERMISSIVE"))[0] == ("1",)
    assert rows(read_xml(spark, put(tmp_path, "<all><r><v>1</v></r>x<r><v>2</v></r></all>", "c.xml"), "r", "v string", nests=False)) == [("1",), ("2",)]


def test_no_window_holds_a_whole_split_without_order(spark, tmp_path):
    path = put(tmp_path, "<all><r>one</r><r>two <r>in</r></r><r>three</r></all>")
    plan = record_texts(spark, path, "r")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("], [at#" in line or "], [block#" in line for line in windows)
    assert texts(spark, path) == ["<r>one</r>", "<r>three</r>", "<r>two <r>in</r></r>"]


def test_nested_queries_parse_what_they_read_and_once(spark, rows):
    tables = Tables(spark, "/root/testdata/sf0.001")
    wanted = files.drug_records(tables, "drugbank-id", "name")
    assert wanted.columns == ["drugbank-id", "name"]
    assert rows(wanted) == rows(files.drug_records(tables).select("drugbank-id", "name"))
    plan = files.QUERIES["nested_polypeptides"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "xml" not in plan.lower() and "Relation [" in plan
