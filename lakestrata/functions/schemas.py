"""Schemas from keyword arguments, and small frames made on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegralType,
    LongType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

TEXT, COUNT, REAL, FLAG = StringType(), LongType(), DoubleType(), BooleanType()


def schema(*, nullable: bool = True, **columns: DataType) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind in columns.items()])


def local_frame(
    spark: SparkSession, columns: StructType, records: Sequence[Mapping[str, Any]] = ()
) -> DataFrame:
    """A frame of a few driver-side records, such as log rows.

    Arrow data becomes a local relation: no Python worker, one task, and a
    size the planner knows.  Only nullable columns may be missing from a record.
    """
    rows = [
        {f.name: record.get(f.name) if f.nullable else record[f.name] for f in columns.fields}
        for record in records
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(columns)), columns)


VARIANT = VariantType()


def merged_type(a: DataType, b: DataType, clash: DataType = TEXT) -> DataType:
    """Type that holds both: numbers widen, nested types merge, anything else becomes `clash`: text, or a variant.

    What is a variant already stays one.
    """
    if a == b:
        return a
    if VARIANT in (a, b):
        return VARIANT
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return COUNT
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return REAL
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merged_type(a.elementType, b.elementType, clash))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema([a, b], clash)
    return clash


def merged_schema(schemas: Sequence[StructType], clash: DataType = TEXT, plain: Sequence[str] = ()) -> StructType:
    """All columns in order of appearance, with types that hold what every schema says.

    Columns of `plain`, such as keys, become text where their types clash, whatever `clash` is.
    """
    types: dict[str, DataType] = {}
    for one in schemas:
        for f in one.fields:
            other = TEXT if f.name in plain else clash
            types[f.name] = merged_type(types[f.name], f.dataType, other) if f.name in types else f.dataType
    return StructType([StructField(name, kind) for name, kind in types.items()])


def holds_variant(kind: DataType) -> bool:
    """Whether a value of the type can be, or contain, a variant."""
    return "variant" in kind.simpleString()


def converted(column: Column, old: DataType, new: DataType) -> Column:
    """A column of the type `old` as `new`, one that `merged_type` made of it and others."""
    nested = isinstance(old, (StructType, ArrayType, MapType))
    if old == new:
        return column
    if new == VARIANT:
        return F.to_variant_object(column) if nested else column.cast(new)
    if nested and new == TEXT:
        return F.to_json(column)
    if nested and holds_variant(new):
        return F.from_json(F.to_json(column), new)
    return column.cast(new)
