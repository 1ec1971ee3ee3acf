"""The registered queries: a name, a function of (spark, folder), the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.session import ship, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a table loader."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(tune(spark))
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
