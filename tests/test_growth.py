"""What a job lists on its way, by the row counts of its joins."""

import pytest

from netloom.operators.annotate import coherence


@pytest.fixture
def join_rows(spark):
    """Rows that each join of a frame gives when it is collected."""
    def walk(node):
        if "Join" in node.nodeName():
            yield node.metrics().apply("numOutputRows").value()
        children = node.children()
        for n in range(children.size()):
            yield from walk(children.apply(n))

    def read(df):
        frame = df.select("*")
        frame.collect()
        return list(walk(frame._jdf.queryExecution().executedPlan()))

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield read
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_coherence_does_not_list_the_neighbours_elsewhere(spark, join_rows, rows):
    matches = spark.createDataFrame([(pmid, wid) for pmid in range(20) for wid in (1, 2, 3)], "pmid bigint, wiki_id bigint")
    related = spark.createDataFrame([(1, 2, 0.5), (3, 1, 0.25)] + [(1, 100 + n, 0.5) for n in range(200)], "wid1 bigint, wid2 bigint, relatedness double")
    found = coherence(matches, related)
    assert max(join_rows(found)) <= 20 * 3
    assert rows(found)[:3] == [(0, 1, 0.375), (0, 2, 0.25), (0, 3, 0.125)]


def test_coherence_is_with_the_other_entities(spark, rows):
    matches = spark.createDataFrame([(1, 1), (1, 2)], "pmid bigint, wiki_id bigint")
    related = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.5)], "wid1 bigint, wid2 bigint, relatedness double")
    assert rows(coherence(matches, related)) == [(1, 1, 0.5), (1, 2, 0.5)]
