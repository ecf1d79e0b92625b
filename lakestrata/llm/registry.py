"""Registry of the queries of this package."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class LlmCheck:
    name: str
    run: Query
    sql: str | None


CHECKS: dict[str, LlmCheck] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"two checks are called {name}")
        CHECKS[name] = LlmCheck(name, query, sql)
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")
