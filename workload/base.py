"""Registry of the checked queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakestrata.session import apply_settings

Query = Callable[["Source"], DataFrame]


@dataclass(frozen=True)
class Source:
    """The test tables of one scale factor."""

    spark: SparkSession
    folder: str

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


@dataclass(frozen=True)
class Check:
    name: str
    query: Query
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.query(Source(apply_settings(spark), str(folder).rstrip("/")))


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"two checks are called {name}")
        CHECKS[name] = Check(name, query, sql)
        return query

    return register
