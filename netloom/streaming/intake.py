"""Files arriving in a folder are appended to the corpus, each document once.

The stream checkpoint records which files were read, and the keys of the documents so far are state in key buckets: a batch looks up the
buckets of its own keys, never the corpus. Every batch writes a folder of its own, and the state as of a batch is kept under the
batch's number, so a batch that runs again after a failure finds the state it found before and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from netloom.operators.incremental import new_documents
from netloom.operators.textjobs import ARTICLE_SCHEMA, articles
from netloom.session import delete_now, materialize_at, new_path
from netloom.sources.buckets import BucketTable
from netloom.sources.xml import from_start_tag

START = "start"


def article_stream(spark: SparkSession, folder: str, row_tag: str = "PubmedArticle", files_per_batch: int = 200) -> DataFrame:
    """(PMID, Title, Abstract) from article XML files as they arrive. An article holds no other one, so a large file is split
    among tasks at the end tags."""
    chunks = spark.readStream.option("lineSep", f"</{row_tag}>").option("maxFilesPerTrigger", files_per_batch).text(folder)
    records = chunks.select(from_start_tag(F.col("value"), row_tag).alias("value")).where("value <> ''")
    whole = F.concat("value", F.lit(f"</{row_tag}>"))
    return articles(records.select(F.from_xml(whole, ARTICLE_SCHEMA, {"rowTag": row_tag, "mode": "FAILFAST"}).alias("_x")).select("_x.*"))


def table_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int = 200) -> DataFrame:
    """Parquet files of a folder, or of the files and folders that a path pattern finds, as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def known_keys(corpus_path: str, schema: StructType, key: str, buckets: int = 256) -> BucketTable:
    """The state that says which documents a corpus has; readers of the corpus pass over its folder."""
    return BucketTable(f"{corpus_path.rstrip('/')}/_state", "known", f"{key} {schema[key].dataType.simpleString()}", key, buckets)


def append_new_documents(corpus_path: str, known: BucketTable):
    """A ``foreachBatch`` function that adds the unseen documents of a batch to a parquet corpus, as folder ``batch=<number>``.

    Within a batch one row per key is kept: the smallest. Rows without a key are no documents.
    """
    key = known.key

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        row = F.struct(*[c for c in columns if c != key])
        unique = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_row")).select(key, "_row.*").select(*columns)
        path = new_path(spark, "intake")
        unique = materialize_at(unique, path)
        before = str(batch_id - 1) if batch_id else START
        touched = known.buckets_of(unique.select(key))
        seen = known.read(spark, before, touched)
        new = new_documents(unique.withColumnRenamed(key, "pmid"), seen.withColumnRenamed(key, "pmid")).withColumnRenamed("pmid", key)
        new.select(*columns).write.mode("overwrite").parquet(f"{corpus_path.rstrip('/')}/batch={batch_id}")
        known.write(seen.unionByName(unique.select(key)).distinct(), str(batch_id), touched, before)
        delete_now(spark, path)

    return run


def start_intake(
    stream: DataFrame, corpus_path: str, checkpoint: str, key: str = "pmid", once: bool = True, known: DataFrame | None = None, buckets: int = 256,
) -> StreamingQuery:
    """Append a document stream to the corpus; ``once`` reads what is there now and stops.

    ``known``: keys of documents to leave out from the start, read once when the corpus is new.
    """
    spark = stream.sparkSession
    state = known_keys(corpus_path, stream.schema, key, buckets)
    if not state.exists(spark, START):
        empty = spark.createDataFrame([], stream.schema)
        state.write(empty.select(key) if known is None else known.select(key).where(F.col(key).isNotNull()).distinct(), START)
        empty.write.mode("overwrite").parquet(f"{corpus_path.rstrip('/')}/batch=-1")
    writer = stream.writeStream.foreachBatch(append_new_documents(corpus_path, state)).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
