"""Column-level operators: all lazy, all inside one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*(F.col(f"`{c}`") for c in sorted(df.columns)))


def align_columns(df: DataFrame, target: StructType) -> DataFrame:
    """Add the columns of `target` that `df` lacks, as typed nulls."""
    missing = [f for f in target.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def epoch_to_timestamp(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Turn epoch-second columns into timestamps."""
    return df.withColumns({c: F.timestamp_seconds(F.col(c)) for c in cols})


def fill_label(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Replace nulls by a text label.

    The column becomes text first: under ANSI rules `coalesce(bigint, 'label')`
    would try to read the label as a number and fail.
    """
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c, label in labels.items()}
    )


def incremental_filter(df: DataFrame, column: str, since: Any) -> DataFrame:
    """Rows changed strictly after the high-water mark; all rows if there is none."""
    return df if since is None else df.where(F.col(column) > F.lit(since))
