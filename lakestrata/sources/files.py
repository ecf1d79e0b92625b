"""Landing files: JSON pages and delimited enum lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakestrata.functions.schemas import local_frame

# Fixed value: <prefix>_enum_<entity>_<column>.csv; greedy, so the last word is the column.
# The list may be one file or a folder of parts.
ENUM_FILE_PATTERN = r"/[a-z]+_enum_(\w+)_(\w+)\.csv(/.+)?$"


PAGE_OPTIONS = {
    "ignoreNullFields": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_json_batch(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """All files of a batch in one scan; columns missing from a file are null.

    Files may hold JSON lines or one array of records per line.  Give the
    schema where it is known: inferring it reads the batch a first time.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(paths)


def write_json_pages(df: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Write JSON files of at most `records_per_file` records each.

    Nulls are written, so that a column is there whatever it holds, and
    timestamps keep their microseconds.
    """
    df.write.options(**PAGE_OPTIONS, maxRecordsPerFile=records_per_file).json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON text, column `value`."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def read_enum_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """One enum list; header line, all columns text."""
    return spark.read.csv(path, header=True, sep=sep)


def read_enum_dir(
    spark: SparkSession, root: str, pattern: str = ENUM_FILE_PATTERN, sep: str = ";"
) -> DataFrame:
    """All enum lists of a folder in one scan: entity, enum, name, value, modified.

    Paths that do not fit the pattern are left out, a list with another header
    is an error.  `modified` is the file's modification time in epoch seconds.
    """
    path = F.col("_metadata.file_path")
    listed = spark.read.schema("name string, value string").csv(
        root, header=True, sep=sep, enforceSchema=False, recursiveFileLookup=True
    )
    return listed.where(path.rlike(pattern)).select(
        F.regexp_extract(path, pattern, 1).alias("entity"),
        F.regexp_extract(path, pattern, 2).alias("enum"),
        "name",
        "value",
        F.unix_timestamp(F.col("_metadata.file_modification_time")).alias("modified"),
    )


def read_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A parquet table, or None if nothing is there."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table, or an empty one of the given schema."""
    found = read_or_none(spark, path, schema)
    return local_frame(spark, schema) if found is None else found
