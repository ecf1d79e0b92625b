"""Register the tables of a lake in Spark's catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

from lakestrata.functions.schemas import TEXT, local_frame, schema
from lakestrata.sources.folders import table_folders
from lakestrata.sources.log import log_folder
from lakestrata.sources.snapshot import PART, current_location

FOUND = schema(name=TEXT, path=TEXT)
RESULT = schema(database=TEXT, table=TEXT, action=TEXT, error=TEXT, columns=TEXT)

PARTS_AT_ONCE = 500  # added by one statement
SYNCED_AT_ONCE = 8  # tables

# Type names of the SQL catalogue where they differ from Spark's.
SQL_TYPE_NAMES = {"string": "varchar", "int": "integer"}


def ddl_type(data_type: DataType) -> str:
    """SQL name of a column type: varchar, integer, bigint, array(bigint), ..."""
    if data_type.typeName() == "array":
        return f"array({ddl_type(data_type.elementType)})"
    name = data_type.simpleString()
    return SQL_TYPE_NAMES.get(name, name)


def typed(columns: StructType) -> str:
    """`name type, ...` in SQL type names."""
    return ", ".join(f"{f.name} {ddl_type(f.dataType)}" for f in columns.fields)


def discover_tables(spark: SparkSession, root: str, layer: str, kind: str) -> DataFrame:
    """Tables of a layer: name, path.  `kind` is 'history' (data) or 'control'.

    A table is a folder `<root>/<layer>/<parts...>`, at any depth, with a folder
    `<kind>`; its name joins the layer and the parts by `_`, with `-` as `_`.
    """
    found = [
        {"name": f"{layer}/{parts}".translate(str.maketrans("/-", "__")), "path": f"{root}/{layer}/{parts}"}
        for parts in sorted(table_folders(spark, f"{root}/{layer}", kind))
    ]
    return local_frame(spark, FOUND, found)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    columns: StructType,
    parts: Mapping[int, str] | None = None,
) -> None:
    """External parquet table at a location; the location is kept as its comment.

    A table in parts has a further column, by which Spark finds the folder of each part.
    """
    if parts is not None:
        named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        name, root = f"`{database}`.`{table}`", location.rsplit("/", 1)[0]
        spark.sql(
            f"CREATE TABLE {name} ({named}, `{PART}` BIGINT) USING parquet PARTITIONED BY (`{PART}`) "
            f"LOCATION {_quoted(root)} COMMENT {_quoted(location)}"
        )
        listed = [f"PARTITION (`{PART}` = {part}) LOCATION {_quoted(folder)}" for part, folder in parts.items()]
        for i in range(0, len(listed), PARTS_AT_ONCE):
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(listed[i : i + PARTS_AT_ONCE]))
        return
    spark.catalog.createTable(
        f"{database}.{table}",
        path=location,
        source="parquet",
        schema=columns,
        description=location,
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _own(columns: StructType) -> StructType:
    """Without the number of the part."""
    return StructType([f for f in columns.fields if f.name != PART])


def sync_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    columns: StructType,
    parts: Mapping[int, str] | None = None,
) -> str:
    """Register a table, or again if its columns or location moved on.

    Returns 'created', 'recreated' or 'unchanged'.  Dropping an external table
    leaves its files alone.
    """
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        register_table(spark, database, table, location, columns, parts)
        return "created"
    same_columns = typed(_own(spark.table(name).schema)) == typed(_own(columns))
    if same_columns and spark.catalog.getTable(name).description == location:
        return "unchanged"
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    register_table(spark, database, table, location, columns, parts)
    return "recreated"


def sync_catalog(
    spark: SparkSession,
    root: str,
    data_layers: Sequence[str] = ("raw", "context", "trust"),
    control_layers: Sequence[str] = ("landing-zone", "raw", "context", "trust"),
    control_database: str = "control",
) -> DataFrame:
    """Bring the catalogue in line with the lake: one result row per table.

    Data tables go to a database per layer and point at the current version;
    run logs go to the control database as `ctrl_<name>`.  A table that fails
    is reported and does not stop the others; `columns` has names and SQL types.
    """
    jobs = []
    for layer in data_layers:
        ensure_database(spark, layer.replace("-", "_"))
        jobs.append((layer.replace("-", "_"), layer, "history"))
    ensure_database(spark, control_database)
    jobs += [(control_database, layer, "control") for layer in control_layers]

    found = [
        (database, kind, name, path)
        for database, layer, kind in jobs
        for name, path in discover_tables(spark, root, layer, kind).orderBy("name").collect()
    ]

    def sync(database: str, kind: str, name: str, path: str) -> dict[str, str | None]:
        named = name if kind == "history" else f"ctrl_{name}"
        action, error, told = "failed", None, None
        try:
            if kind == "history":
                location, columns, parts = current_location(spark, path)
            else:
                location, parts = log_folder(spark, f"{path}/control"), None
                columns = spark.read.parquet(location).schema
            action, told = sync_table(spark, database, named, location, columns, parts), typed(_own(columns))
        except Exception as failure:  # noqa: BLE001 - reported, the others go on
            error = str(failure)
        return {"database": database, "table": named, "action": action, "error": error, "columns": told}

    with ThreadPoolExecutor(SYNCED_AT_ONCE, thread_name_prefix="catalog") as pool:
        results = list(pool.map(inheritable_thread_target(spark)(sync), *zip(*found))) if found else []
    return local_frame(spark, RESULT, results)
