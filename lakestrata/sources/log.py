"""Small tables that grow by a few rows at a time: run logs and histories.

    <path>/part-...parquet      rows as they were appended, a file each
    <path>/g000001/             all rows so far in one file, and what was appended since

A log of many files is written anew as its next generation.  Readers take the newest complete one, so they
see either the many files or the one; the generation before it stays until the next, for readers that are
still at it.  One writer per log at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakestrata.functions.schemas import local_frame
from lakestrata.sources.folders import delete_folder, entries

MOST_FILES = 100
DONE = "_SUCCESS"


def _generations(spark: SparkSession, path: str) -> list[int]:
    """Complete generations, oldest first; 0, the folder itself, is not listed."""
    numbers = [int(e.name[1:]) for e in entries(spark, path) if e.folder and e.name[1:].isdigit() and e.name[0] == "g"]
    return [n for n in sorted(numbers) if any(e.name == DONE for e in entries(spark, _folder(path, n)))]


def _folder(path: str, generation: int) -> str:
    return f"{path}/g{generation:06d}" if generation else path


def log_folder(spark: SparkSession, path: str) -> str:
    """Where the rows of a log are now."""
    return _folder(path, max(_generations(spark, path), default=0))


def read_log(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """The rows of a log, none before the first one."""
    return _rows(spark, log_folder(spark, path), columns)


def _rows(spark: SparkSession, folder: str, columns: StructType) -> DataFrame:
    held = _files(spark, folder)
    return spark.read.schema(columns).parquet(folder) if held else local_frame(spark, columns)


def append_rows(
    spark: SparkSession,
    path: str,
    columns: StructType,
    records: Sequence[Mapping[str, Any]],
    *,
    most_files: int = MOST_FILES,
) -> None:
    """Append rows as one file; a log that then has more than `most_files` becomes a new generation."""
    folder = log_folder(spark, path)
    local_frame(spark, columns, records).coalesce(1).write.mode("append").parquet(folder)
    if len(_files(spark, folder)) > most_files:
        compact_log(spark, path, columns)


def _files(spark: SparkSession, folder: str) -> list[str]:
    return [e.name for e in entries(spark, folder) if not e.folder and e.name.endswith(".parquet")]


def compact_log(spark: SparkSession, path: str, columns: StructType) -> None:
    """Write all rows into one file of the next generation; the generation before the last goes."""
    held = _generations(spark, path)
    last = max(held, default=0)
    target = _folder(path, last + 1)
    # Overwrites what a writer that failed half-way left there.
    _rows(spark, _folder(path, last), columns).coalesce(1).write.mode("overwrite").parquet(target)
    for old in held[:-1]:
        delete_folder(spark, _folder(path, old))
    if last:
        for name in _files(spark, path):
            delete_folder(spark, f"{path}/{name}")
