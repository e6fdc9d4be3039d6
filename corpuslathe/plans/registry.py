"""Named queries with, where SQL can express them, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuslathe.runtime import ship

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, in the order of their definition."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            n = name or f.__name__
            if n in self.queries:
                raise ValueError(f"two queries named {n}")
            self.queries[n] = f
            if sql:
                self.sql[n] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
