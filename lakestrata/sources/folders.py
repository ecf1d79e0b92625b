"""Folders of whatever store Spark is set up for, through its Hadoop file systems."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import SparkSession

LISTED_AT_ONCE = 16  # a store answers slowly, but many at a time

# Folders below a table that hold no further tables.
INSIDE = re.compile(r"data|history|removed|control|schemas|rejected|\d{4}-\d{2}-\d{2}|[._].*")


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


class Entry(NamedTuple):
    name: str
    folder: bool


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder; nothing where there is none."""
    store, where = _located(spark, path)
    if not store.exists(where):
        return []
    return [Entry(s.getPath().getName(), s.isDirectory()) for s in store.listStatus(where)]


def delete_folder(spark: SparkSession, path: str) -> None:
    store, where = _located(spark, path)
    store.delete(where, True)


def table_folders(spark: SparkSession, root: str, kind: str) -> Iterator[str]:
    """Folders at any depth below `root` that have a folder `kind`, relative to it.

    Lists the folders between the root and its tables, no data files; those of a level at the same time.
    """
    level = [""]
    with ThreadPoolExecutor(LISTED_AT_ONCE, thread_name_prefix="list") as pool:
        while level:
            found = pool.map(lambda name: entries(spark, f"{root}/{name}"), level)
            below = [(name, [e.name for e in held if e.folder]) for name, held in zip(level, found)]
            yield from (name for name, folders in below if name and kind in folders)
            level = [f"{name}/{f}".lstrip("/") for name, folders in below for f in folders if not INSIDE.fullmatch(f)]
