"""One row per (fact, member): the shape nine of the twelve marts share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.operators.columns import fill_label
from lakestrata.operators.enrich import lookup


def unfold(array_col: str, df: DataFrame, empty: str = "drop") -> Column:
    """Generator for the members of an array column.

    A null array gives one null member.  An empty array gives none
    (`empty='drop'`) or one null member (`empty='keep'`).
    """
    if empty == "keep":
        return F.explode_outer(array_col)
    if empty != "drop":
        raise ValueError(f"empty must be 'drop' or 'keep', not {empty!r}")
    element = df.schema[array_col].dataType.elementType
    return F.explode(F.coalesce(F.col(array_col), F.array(F.lit(None).cast(element))))


def membership(
    fact: DataFrame,
    keep: Sequence[str | Column],
    array_col: str,
    id_name: str,
    dim: DataFrame,
    take: Mapping[str, str],
    defaults: Mapping[str, str] | None = None,
    *,
    dim_key: str = "id",
    empty: str = "drop",
) -> DataFrame:
    """Explode `array_col` in one pass over the fact and label every member.

    `keep` are the fact columns to carry, `take` maps dimension columns to
    output names, `defaults` gives the label for members that have none.
    """
    rows = fact.select(*keep, unfold(array_col, fact, empty).alias(id_name))
    labelled = lookup(rows, id_name, dim, take, dim_key=dim_key, keep_key=True)
    return fill_label(labelled, defaults or {})
