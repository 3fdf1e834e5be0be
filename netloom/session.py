"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. Each can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the next operator then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Hash instead of sort a shuffled join whose measured partitions are all below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Compressed files are several times larger in memory; broadcast decisions should know.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.exchange.reuse": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive and skew-join settings for the given session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "netloom", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` uses ``__`` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return apply_settings(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``, or else a folder below its warehouse.

    Both are places that the session's owner has named as shared, so no machine-local folder is ever used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{warehouse.rstrip('/')}/_stages"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/netloom/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())


def delete_at_exit(spark: SparkSession, path: str) -> str:
    """Delete an existing intermediate folder when the application ends."""
    hadoop_path, system = _hadoop(spark, path)
    system.deleteOnExit(hadoop_path)
    return path


def delete_now(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    hadoop_path, system = _hadoop(spark, path)
    system.delete(hadoop_path, True)


# Folders written by ``materialize`` and not deleted yet.
_written: list[str] = []


def releases_stages(job: Callable) -> Callable:
    """A job whose results are stored tables: what it has materialised on the way is deleted when it ends."""
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        mark = len(_written)
        try:
            return job(spark, *args, **kwargs)
        finally:
            for path in _written[mark:]:
                delete_now(spark, path)
            del _written[mark:]

    return run


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and every reader
    of the table prunes columns and pushes filters on its own.
    """
    path = new_path(df.sparkSession, label)
    stored = materialize_at(df, path)
    delete_at_exit(df.sparkSession, path)
    _written.append(path)
    return stored


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a folder that the caller deletes, and read it back."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, system = _hadoop(spark, path)
    return system.exists(hadoop_path)


class Stages:
    """Intermediate tables of one job, deleted one by one as soon as nothing reads them, or all at the end."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self.paths: dict[str, str] = {}

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` under ``name`` and read it back; an older table of that name is deleted afterwards."""
        path = new_path(self.spark, f"{self.label}-{name}")
        df.write.mode("errorifexists").parquet(path)
        delete_at_exit(self.spark, path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str) -> str:
        """A fresh folder for files under ``name``, deleted like a table."""
        path = self.paths[name] = new_path(self.spark, f"{self.label}-{name}")
        return path

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                delete_now(self.spark, self.paths.pop(name))

    def close(self) -> None:
        self.drop(*list(self.paths))
