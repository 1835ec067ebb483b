from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with the SQL for comparison."""

    def add(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return f

    return add


class Tables:
    """The test tables and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
