"""Upsert and change detection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from lakestrata.sources.files import PAGE_OPTIONS
from lakestrata.sources.scratch import materialize

# Up to so many columns a row is no larger than its hashes.
NARROW = 3


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose key does not occur in `other`.

    An anti join cannot split its right side, so copies of a key collapse first.
    """
    return df.join(other.select(key).distinct(), key, "left_anti")


def upsert(
    base: DataFrame | None,
    updates: DataFrame,
    key: str,
    *,
    overwrite_missing: bool = False,
) -> DataFrame:
    """Base rows replaced by the update of the same key, plus the new ones.

    `updates` must hold one row per key (see `latest_by`).  New columns are
    added.  Columns the updates lack keep their stored value, or become null
    with `overwrite_missing`.  A small update set is broadcast by Spark, so the
    base is then scanned but not shuffled.
    """
    if base is None:
        return updates
    untouched = base.join(updates.select(key), key, "left_anti")
    lacking = [c for c in base.columns if c not in updates.columns]
    if lacking and not overwrite_missing:
        # Only the stored values of the rows being replaced travel to the updates.
        stored = base.select(key, *lacking).join(updates.select(key), key, "left_semi")
        updates = updates.join(stored, key, "left")
    columns = base.columns + [c for c in updates.columns if c not in base.columns]
    return untouched.unionByName(updates, allowMissingColumns=True).select(*columns)


def row_hashes(columns: StructType, second: Callable[..., Column] = F.xxhash64) -> list[Column]:
    """Two hashes of a row, `__h1` of 64 bits and `__h2` by `second`, the same for any order of its columns.

    Spark's hash passes nulls over, so which columns are null is hashed as well; nested values are hashed as text.
    """
    values, nulls = [], []
    for name in sorted(columns.names):
        column = F.col(f"`{name}`")
        nested = isinstance(columns[name].dataType, (StructType, ArrayType, MapType, VariantType))
        values.append(F.to_json(F.struct(column), PAGE_OPTIONS) if nested else column)
        nulls.append(column.isNull())
    words = [nulls[i : i + 32] for i in range(0, len(nulls), 32)]
    marks = [reduce(Column.__add__, (n.cast("bigint") * F.lit(1 << i) for i, n in enumerate(word))) for word in words]
    return [f(F.lit(salt), *marks, *values).alias(f"__h{salt}") for salt, f in ((1, F.xxhash64), (2, second))]


@dataclass(frozen=True)
class Digest:
    """Of a multiset of rows: their number and the sums of two hashes, so the order of the rows does not matter."""

    rows: int
    first: int
    second: int

    def __str__(self) -> str:
        return f"{self.rows}:{self.first}:{self.second}"

    @staticmethod
    def columns(columns: StructType) -> list[Column]:
        """Aggregates that make a digest; sums of up to 10^19 rows fit."""
        sums = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)) for h in row_hashes(columns)]
        return [F.count(F.lit(1)).alias("rows"), sums[0].alias("first"), sums[1].alias("second")]

    @classmethod
    def of(cls, found) -> Digest:
        """From a row or dictionary of `columns`."""
        return cls(*(int(found[name]) for name in ("rows", "first", "second")))


def digest(df: DataFrame) -> Digest:
    """One pass over the rows; nothing but a row per task is moved."""
    return Digest.of(df.agg(*Digest.columns(df.schema)).first())


def changed_rows(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Multiset difference: rows of `current` that `previous` does not hold.

    Of each version only the rows' hashes and their numbers are shuffled.  Hashes of which `current` has more
    are written.  Rows with a hash that `previous` lacks differ from all of its rows; where it has the hash, but
    fewer times, the rows are taken from both versions and compared by value.
    """
    previous = previous.select(*current.columns)
    if len(current.columns) <= NARROW:
        return current.exceptAll(previous)
    hashes = row_hashes(current.schema, F.hash)  # 96 bits are enough for 10^12 rows, and what is shuffled
    both = current.select(*hashes, F.lit(1).alias("__n")).unionByName(previous.select(*hashes, F.lit(-1).alias("__n")))
    counted = both.groupBy("__h1", "__h2").agg(F.sum("__n").alias("__n"), (F.min("__n") < 0).alias("__held"))
    more = materialize(counted.where(F.col("__n") > 0).drop("__n"), "changed-hashes")
    partly = materialize(more.where("__held"), "changed-partly")  # its size decides how the rows are found

    def having(df: DataFrame, wanted: DataFrame) -> DataFrame:
        return df.select("*", *hashes).join(wanted, ["__h1", "__h2"], "left_semi").select(*current.columns)

    fresh = having(current, more.where(~F.col("__held")))
    held = materialize(having(current, partly), "changed-held")
    return fresh.unionByName(held.exceptAll(having(previous, partly)))


def new_or_changed(
    current: DataFrame, previous: DataFrame, held: DataFrame, key: str
) -> DataFrame:
    """Rows that are new or differ from the previous version and are not held already."""
    return not_in(changed_rows(current, previous), held, key)


def differing_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows found on one side only, with `side` = 'old' or 'new'.

    One aggregation over both inputs: copies of a row collapse before the
    shuffle, and null equals null.
    """
    columns = sorted(old.columns)

    def tagged(df: DataFrame, in_old: bool) -> DataFrame:
        return df.select(
            *columns, F.lit(in_old).alias("__in_old"), F.lit(not in_old).alias("__in_new")
        )

    found = (
        tagged(old, True)
        .unionByName(tagged(new, False))
        .groupBy(*columns)
        .agg(F.max("__in_old").alias("__in_old"), F.max("__in_new").alias("__in_new"))
    )
    return found.where(F.col("__in_old") != F.col("__in_new")).select(
        *columns, F.when(F.col("__in_old"), "old").otherwise("new").alias("side")
    )


def has_changed(old: DataFrame, new: DataFrame, *, symmetric: bool = True) -> bool:
    """Whether a full load differs from the one before, in structure or content.

    With `symmetric=False` rows that were only added do not count.
    """
    if not schema_diff(old.schema, new.schema).same:
        return True
    rows = differing_rows(old, new)
    return not (rows if symmetric else rows.where("side = 'old'")).isEmpty()


@dataclass(frozen=True)
class SchemaDiff:
    only_left: tuple[str, ...]
    only_right: tuple[str, ...]
    retyped: tuple[str, ...]

    @property
    def same(self) -> bool:
        return not (self.only_left or self.only_right or self.retyped)


def schema_diff(left: StructType, right: StructType) -> SchemaDiff:
    """Columns on one side only and columns whose type differs; order does not matter."""
    a = {f.name: f.dataType.simpleString() for f in left.fields}
    b = {f.name: f.dataType.simpleString() for f in right.fields}
    return SchemaDiff(
        tuple(sorted(a.keys() - b.keys())),
        tuple(sorted(b.keys() - a.keys())),
        tuple(sorted(c for c in a.keys() & b.keys() if a[c] != b[c])),
    )
