"""Exploratory reports over the context layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakestrata.operators.analytics import profile, share_by, top_k

# Labels and list length of the reports.
UNKNOWN_LISTING = "Unknown"
TOP = 10


def games_by(games: DataFrame, array_col: str, dim: DataFrame) -> DataFrame:
    """Share of games per member of an array: genres, modes, perspectives, platforms."""
    return share_by(games, array_col, dim, explode=True)


def platforms_by_category(platforms: DataFrame, categories: DataFrame) -> DataFrame:
    """Share of platforms per category code; only a null code is 'Undefined'."""
    codes = categories.withColumn("value", categories["value"].try_cast("bigint"))
    return share_by(platforms, "category", codes, dim_key="value", unknown_only_for_null_key=True)


def listings_by_category(external: DataFrame, categories: DataFrame) -> DataFrame:
    """Share of external listings per category code; codes without a name are 'Unknown'."""
    codes = categories.withColumn("value", categories["value"].try_cast("bigint"))
    return share_by(external, "category", codes, dim_key="value", unknown=UNKNOWN_LISTING)


def recently_updated(games: DataFrame) -> DataFrame:
    return top_k(games, "updated_at", TOP, ["id"]).select("name", "updated_at")


def best_rated(games: DataFrame) -> DataFrame:
    return top_k(games.select("id", "name", "rating"), "rating", TOP, ["id"])


def numeric_profile(games: DataFrame) -> DataFrame:
    return profile(games)
