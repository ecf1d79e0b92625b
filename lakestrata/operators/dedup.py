"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_by(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str] | None,
    ties: Sequence[str],
) -> DataFrame:
    """Keep the newest row of every key: largest `order`, nulls last, then largest `ties`.

    Ties must be named, so that the survivor does not depend on the layout of
    the data.  The rank filter lets Spark drop all but one row per key and task
    before the shuffle, so a hot key costs one row per task.
    """
    if not ties:
        raise ValueError("latest_by needs at least one tie-breaking column")
    ranking = _names(order or []) + list(ties)
    window = Window.partitionBy(*_names(key)).orderBy(
        *(F.col(c).desc_nulls_last() for c in ranking)
    )
    return (
        df.withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def has_duplicates(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and whether some key occurs more than once."""
    per_key = df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("has_duplicates", F.col("n_rows") != F.col("n_keys"))
