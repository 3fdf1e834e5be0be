import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_on_a_small_table(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before, kept = docs.columns, docs.count(), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{n}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.select("doc_id").distinct().count())
        if n + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns and docs.count() == kept[-1]
    assert before > kept[0] > kept[1] > kept[2] == kept[3] > before / 2


def test_stages_take_rows_of_any_kind(spark, documents, tricky):
    docs = documents(tricky)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert stage(spark, documents([]), "/root/testdata/sf0.001").count() == 0
    assert {r.doc_id for r in docs.collect()} <= {i for i, _ in tricky}
