"""Where intermediate tables go: a folder the driver and all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakestrata.sources.folders import delete_folder


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset, the warehouse, unless that is a folder of a cluster's driver."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("executors do not share the driver's folders: set spark.checkpoint.dir")
    return folder.rstrip("/")


_given: list[str] = []  # paths since the last clearing


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; every call gives a new one."""
    path = f"{shared_dir(spark)}/lakestrata/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this process; for the end of a job, when none is read any more."""
    while _given:
        delete_folder(spark, _given.pop())


@contextmanager
def scratch_dropped(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that were made inside, when nothing reads them any more; for one thread."""
    first = len(_given)
    try:
        yield
    finally:
        while len(_given) > first:
            delete_folder(spark, _given.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and go on from the written columns.

    Fixes values that depend on the physical layout and cuts the lineage, so
    later branches neither recompute the input nor disagree with each other.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
