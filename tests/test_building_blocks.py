import random

import pytest
from pyspark.sql import Window, functions as F

from netloom.operators import incremental
from netloom.operators.joins import full_join
from netloom.operators.setops import new_rows, swap_ends, symmetrize, union_all, unpivot_references
from netloom.operators.windows import chunked, forward_fill, number_batches, number_rows, scale_by_group_max, top_n
from netloom.session import materialize, shared_folder


def test_sessions_split_hot_keys(spark):
    """Joins are plain; that a hot key is cut on both sides is left to adaptive execution, which must be on."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        assert spark.conf.get(key) == "true"


def test_full_join_coalesces_keys(spark, rows):
    a = spark.createDataFrame([(1, 1, "a")], "x int, y int, a string")
    b = spark.createDataFrame([(1, 1, "b"), (2, 2, "b2")], "x int, y int, b string")
    c = spark.createDataFrame([(2, 2, "c"), (3, 3, "c3")], "x int, y int, c string")
    assert rows(full_join([a, b, c], ["x", "y"])) == [
        (1, 1, "a", "b", None), (2, 2, None, "b2", "c"), (3, 3, None, None, "c3"),
    ]


def test_edges_in_both_directions(spark, rows):
    e = spark.createDataFrame([(1, 2, 0.5)], "a int, b int, s double")
    assert rows(symmetrize(e, "a", "b")) == [(1, 2, 0.5), (2, 1, 0.5)]
    assert rows(swap_ends(e, "a", "b")) == [(2, 1, 0.5)]


def test_union_pads_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2,)], "id int")
    assert rows(union_all([a, b], allow_missing=True)) == [(1, "x"), (2, None)]


@pytest.mark.parametrize("small", [False, True])
def test_new_rows(spark, rows, small):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    old = spark.createDataFrame([(2, "z"), (9, "y")], "k int, v string")
    assert rows(new_rows(new, old, ["k"], small)) == [(1, "a"), (3, "c")]


def test_unpivot_drops_missing_references(spark, rows):
    wide = spark.createDataFrame([("g", 1, None), ("h", None, "y")], "id string, `a b` int, c string")
    assert rows(unpivot_references(wide, "id", ["a b", "c"])) == [("g", "a b", "1"), ("h", "c", "y")]


def test_forward_fill_equals_one_window(spark, rows):
    """A key with most of the rows, filled over many chunks."""
    rng = random.Random(2)
    data = [(0 if i % 3 else i % 5, i, rng.choice([None, None, None, i])) for i in range(300)]
    df = spark.createDataFrame(data, "k int, pos int, v int")
    got = forward_fill(df, ["k"], ["pos"], F.col("v"), "f", F.floor(F.col("pos") / 7))
    want = df.withColumn("f", F.last("v", True).over(Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(got, "k", "pos", "f") == rows(want, "k", "pos", "f")


def test_top_n_and_scaling(spark, rows):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 3, 4.0), ("b", 1, 5.0)], "k string, i int, v double")
    assert rows(top_n(df, ["k"], [F.desc("v"), F.col("i")], 1), "k", "i") == [("a", 2), ("b", 1)]
    assert rows(scale_by_group_max(df, ["k"], "v", "s"), "k", "i", "s") == [
        ("a", 1, 0.5), ("a", 2, 1.0), ("a", 3, 1.0), ("b", 1, 1.0),
    ]


def test_numbers_follow_the_order_over_many_tasks(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7).withColumn("none", F.when(F.col("id") % 5 > 0, F.col("id"))).repartition(9)
    got = [(r.id, r.rank, r.batch) for r in number_batches(df, [F.col("k").desc(), F.col("id")], 10).collect()]
    want = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert sorted(got, key=lambda r: r[1]) == [(i, n + 1, n // 10) for n, i in enumerate(want)]
    by_null = number_rows(df, [F.col("none").asc_nulls_last(), F.col("id")]).orderBy("rank").collect()
    assert [r.id for r in by_null] == sorted(range(1000), key=lambda i: (i % 5 == 0, i))
    assert number_rows(df.limit(0), [F.col("id")]).count() == 0
    same = number_rows(spark.range(300).withColumn("one", F.lit(1)), [F.col("one")]).collect()
    assert sorted(r.rank for r in same) == list(range(1, 301))



def test_a_key_with_very_many_values_has_no_large_cell(spark):
    many = spark.range(200_000).select(F.lit("hot").alias("k"), F.concat(F.lit("r"), "id").alias("v"))
    few = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "z")], "k string, v string")
    found = chunked(many.unionByName(few), ["k"], "v", 1000)
    sizes = {(r.k, r.chunk): r.n for r in found.select("k", "chunk", F.size("v").alias("n")).collect()}
    assert sizes[("a", 0)] == 2 and sizes[(None, 0)] == 1
    assert [sizes[("hot", c)] for c in range(200)] == [1000] * 200 and len(sizes) == 202
    hot = sorted(f"r{i}" for i in range(200_000))
    assert found.where("k = 'hot' and chunk = 7").first().v == hot[7000:8000]


def test_materialized_table_keeps_its_schema(spark, rows):
    df = spark.createDataFrame([(1, ["a"], None)], "id int, names array<string>, x double")
    stored = materialize(df, "t")
    assert stored.schema == df.schema and rows(stored) == rows(df)
    assert stored.inputFiles()[0].find(shared_folder(spark)) >= 0


def test_shared_folder_is_the_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_new_annotations_by_document_and_entity(spark, rows):
    new = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "pmid int, wiki_id int, spot string")
    old = spark.createDataFrame([(1, 1, "z")], "pmid int, wiki_id int, spot string")
    assert rows(incremental.new_annotations(new, old)) == [(1, 2, "b")]
    assert rows(incremental.new_documents(new, old)) == []
    assert rows(incremental.new_surface_forms(new.select("wiki_id", "spot"), old.select("wiki_id", "spot"))) == [(1, "a"), (2, "b")]
