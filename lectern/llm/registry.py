"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import prepare

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (table loader) under a name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
