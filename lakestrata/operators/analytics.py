"""Shares, top lists and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from lakestrata.functions.expressions import percent
from lakestrata.operators.enrich import lookup
from lakestrata.operators.membership import unfold


def earliest(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Smallest value of each column per key, `{output: column}`, independently of each other."""
    return df.groupBy(*keys).agg(*(F.min(c).alias(out) for out, c in columns.items()))


def share_by(
    df: DataFrame,
    key: str,
    dim: DataFrame | None = None,
    *,
    label: str = "name",
    dim_key: str = "id",
    count: str = "id",
    explode: bool = False,
    unknown: str = "Undefined",
    unknown_only_for_null_key: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Count and percentage of rows (or memberships) per category: `label`, `n`, `percent`.

    With `explode`, `key` is an array and every member counts once; null and
    empty arrays count as one unknown membership.  The percentages are of the
    sum of the counts.  Categories are told apart by key, so two keys with one
    label stay two rows.  `unknown` labels categories without a label, or, with
    `unknown_only_for_null_key`, only the one whose key is null.
    """
    member = unfold(key, df, "keep") if explode else F.col(key)
    counts = (
        df.select(F.col(count).alias("__counted"), member.alias("key"))
        .groupBy("key")
        .agg(F.count("__counted").alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    if dim is None:
        named = counts.withColumn("label", F.col("key").cast("string"))
    else:
        named = lookup(counts, "key", dim, {label: "label"}, dim_key=dim_key, keep_key=True)
    nameless = F.col("key" if unknown_only_for_null_key else "label").isNull()
    if ordered:  # by key last, so that equal labels still spread over the sort
        named = named.orderBy(F.col("n").desc(), "label", "key")
    return (
        named.withColumn("total", total)
        .withColumn("percent", percent("n", "total"))
        .select(F.when(nameless, unknown).otherwise(F.col("label")).alias("label"), "n", "percent")
    )


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The `k` rows with the largest `by` (nulls last), ties in ascending order of `ties`."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of the numeric columns.

    All columns are measured in one aggregation; one output row per column.
    """
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    measured = df.agg(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.mean(c).cast("double").alias("mean"),
                F.stddev(c).cast("double").alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        )
    )
    return measured.select(F.inline(F.array(*measured.columns)))
