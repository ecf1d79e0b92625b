"""Left joins that swap a code or an id for its label.

No join here carries a broadcast hint.  Spark broadcasts a dimension itself
when its measured size is under `spark.sql.autoBroadcastJoinThreshold`, and
otherwise shuffles; adaptive execution then splits hot and null keys.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType


NULL_SALTS = 256  # rows of nulls for rows without a match


def lookup(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    take: Mapping[str, str],
    *,
    dim_key: str = "id",
    keep_key: bool = False,
) -> DataFrame:
    """Left-join `dim` on `key` and take over the columns `{dim column: new name}`.

    The key column goes away unless `keep_key`.  A new name may equal the key,
    in which case the label replaces the id.  Rows with a null key match nothing
    and are dealt out by a hash of their columns, so that a shuffle does not
    gather them in one task.
    """
    taken = {f"__take_{i}": (source, name) for i, (source, name) in enumerate(take.items())}
    side = dim.select(
        F.col(dim_key).alias("__dim_key"),
        *(F.col(source).alias(tmp) for tmp, (source, _) in taken.items()),
        # Always 0, but no constant: Spark would take that out of the join's keys.
        F.pmod(F.xxhash64(dim_key), F.lit(1).cast("bigint")).alias("__dim_salt"),
    )
    new_names = {name for _, name in taken.values()}
    kept = [c for c in df.columns if c not in new_names and (keep_key or c != key)]
    salt = F.when(df[key].isNull(), _spread(df)).otherwise(F.lit(0).cast("bigint"))
    meet = (df[key] == side["__dim_key"]) & (salt == side["__dim_salt"])
    return df.join(side, meet, "left").select(
        *(df[c] for c in kept),
        *(side[tmp].alias(name) for tmp, (_, name) in taken.items()),
    )


def _spread(df: DataFrame) -> Column:
    """A hash of a row's columns; maps and variants, which have none, are passed over."""
    plain = [f.name for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    return F.xxhash64(*(df[name] for name in plain))


def fan_out(
    df: DataFrame, key: str, other: DataFrame, take: Mapping[str, str], *, other_key: str
) -> DataFrame:
    """Left join to a table with many rows per key; `{other column: new name}` is added.

    A left join cannot split a hot key on its right side, an inner join can.
    So every row first learns whether it has a match (against the distinct
    keys), and rows without one meet rows of nulls in an inner join: they are
    dealt out over NULL_SALTS of these by a hash of their columns, so that they
    never gather under one key.
    """
    side = other.where(F.col(other_key).isNotNull()).select(
        F.col(other_key).alias("__other_key"),
        *(F.col(source).alias(name) for source, name in take.items()),
        F.lit(0).cast("bigint").alias("__other_salt"),
    )
    nothing = df.sparkSession.range(0, NULL_SALTS, 1, numPartitions=1).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema.fields[:-1]),
        F.col("id").alias("__other_salt"),
    )
    keys = side.select(F.col("__other_key").alias("__match")).distinct()
    known = df.join(keys, df[key] == keys["__match"], "left")
    spread = F.xxhash64(*(F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()))
    salt = F.when(F.col("__match").isNull(), F.pmod(spread, F.lit(NULL_SALTS))).otherwise(F.lit(0))
    salted = known.withColumn("__salt", salt.cast("bigint"))
    meet = F.col("__match").eqNullSafe(F.col("__other_key")) & (F.col("__salt") == F.col("__other_salt"))
    return salted.join(side.unionByName(nothing), meet).drop("__match", "__other_key", "__salt", "__other_salt")


def decode(
    df: DataFrame,
    column: str,
    enum: DataFrame | None,
    *,
    into: str | None = None,
    optional: bool = False,
) -> DataFrame:
    """Swap the code in `column` for its name in the enum table (`name`, `value`).

    Enum values are text and may be zero padded, so against an integer column
    they are compared as numbers; a value that is no number matches nothing.
    With `into`, the name goes to that column and the code stays.  A missing
    enum table is an error, or leaves `df` as it is when `optional`.
    """
    if enum is None:
        if optional:
            return df
        raise ValueError(f"no enum table for column {column!r}")
    value = F.col("value")
    if isinstance(df.schema[column].dataType, IntegralType):
        value = value.try_cast("bigint")
    codes = enum.select(value.alias("value"), "name")
    return lookup(
        df,
        column,
        codes,
        {"name": into or column},
        dim_key="value",
        keep_key=into is not None and into != column,
    )


def with_parent(
    df: DataFrame,
    id_col: str,
    parent_col: str,
    name_col: str,
    *,
    parent_name: str = "parent_name",
) -> DataFrame:
    """Add the parent's name by a self join; a row without a parent is its own."""
    named = lookup(df, parent_col, df, {name_col: parent_name}, dim_key=id_col, keep_key=True)
    return named.withColumns(
        {
            parent_col: F.coalesce(F.col(parent_col), F.col(id_col)),
            parent_name: F.coalesce(F.col(parent_name), F.col(name_col)),
        }
    )
