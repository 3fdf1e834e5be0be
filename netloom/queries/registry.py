"""Registry of the queries on the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from netloom.session import apply_settings

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return self.run(Tables(spark, folder))


class Registry(dict):
    """Name to Query; ``register`` is used as a decorator and takes the function's name."""

    def register(self, sql: str | None = None):
        def add(fn):
            self[fn.__name__] = Query(fn, sql)
            return fn

        return add
