"""Landing and raw layer: dated JSON batches become one upserted table.

    landing-zone/<api>/<entity>/<yyyy-MM-dd>/<run>/   JSON pages of one run
    landing-zone/<api>/<entity>/control/              run log
    landing-zone/<api>/<entity>/schemas/              columns and types of each run's pages
    raw/<api>/<entity>/rejected/                      records that could not be read, or have no key
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from lakestrata.functions.schemas import TEXT, VARIANT, converted, holds_variant, merged_schema, schema as columns_of
from lakestrata.operators.changes import Digest, digest, has_changed, schema_diff, upsert
from lakestrata.operators.columns import incremental_filter
from lakestrata.operators.dedup import latest_by
from lakestrata.plans.control import (
    LANDING_RUN,
    RAW_RUN,
    TABLE_RUN,
    Run,
    append_run,
    append_runs,
    control_or_empty,
    last_run_time,
    plan_load,
    unread_dates,
)
from lakestrata.plans.lake import CATALOGUE_ENUMS, LANDING, RAW, Lake, TableId
from lakestrata.sources.files import read_enum_dir, read_json_batch, read_or_empty, write_json_pages
from lakestrata.sources.log import read_log
from lakestrata.sources.scratch import materialize
from lakestrata.sources.snapshot import Layout, snapshot_layout, touched_rows, upsert_snapshot, write_snapshot

# Records per landed file.
RECORDS_PER_FILE = 10_000

# `digest` is that of a full load; pages of other loads have none.
PAGES = columns_of(date=TEXT, folder=TEXT, schema=TEXT, digest=TEXT)

_DATE, _BROKEN = "__landed", "__broken"


def batch_path(lake: Lake, source: TableId, date: str) -> str:
    return f"{lake.path(source)}/{date}"


def land(
    lake: Lake,
    source: TableId,
    df: DataFrame,
    load_type: str,
    run: Run,
    *,
    records_per_file: int = RECORDS_PER_FILE,
    log: StructType = LANDING_RUN,
    with_digest: bool = False,
    **metrics: Any,
) -> int:
    """Write one run's pages, what they hold, and its log row; returns the number of files."""
    counted = Observation()
    folder = f"{batch_path(lake, source, run.date)}/{run.folder}"
    measures = Digest.columns(df.schema) if with_digest else [F.count(F.lit(1)).alias("rows")]
    write_json_pages(df.observe(counted, *measures), folder, records_per_file)
    files = _count_files(lake, folder) if counted.get["rows"] else 0
    if files:
        told = str(Digest.of(counted.get)) if with_digest else None
        pages = {"date": run.date, "folder": run.folder, "schema": df.schema.json(), "digest": told}
        append_run(lake.spark, _schemas_path(lake, source), PAGES, pages)
    record = run.record(Load_type=load_type, Loaded_files=files, **metrics)
    append_run(lake.spark, lake.control_path(source), log, record)
    return files


def _count_files(lake: Lake, folder: str) -> int:
    files = lake.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    return files.select("path").count()


def land_incremental(
    lake: Lake,
    source: TableId,
    df: DataFrame,
    updated_at: str,
    *,
    records_per_file: int = RECORDS_PER_FILE,
) -> int:
    """Land what changed since the last run (`updated_at` in epoch seconds), or all at first."""
    run = Run()
    load_type, since = plan_load(control_or_empty(lake.spark, lake.control_path(source), LANDING_RUN))
    changed = incremental_filter(df, updated_at, since)
    return land(lake, source, changed, load_type, run, records_per_file=records_per_file)


def _schemas_path(lake: Lake, source: TableId) -> str:
    return f"{lake.path(source)}/schemas"


def _landed_pages(lake: Lake, source: TableId) -> DataFrame:
    """One row per run that landed files: date, folder, schema."""
    return read_log(lake.spark, _schemas_path(lake, source), PAGES)


def _full_load_changed(lake: Lake, source: TableId, df: DataFrame, symmetric: bool) -> bool:
    """Whether `df` differs from the newest run that landed files.

    Structure and digest are compared with those stored at that run; its pages are read only to confirm by rows
    a digest that differs, as it does already where a row was doubled.
    """
    last = _landed_pages(lake, source).orderBy(F.desc("folder")).first()
    if last is None:
        return True
    held = StructType.fromJson(json.loads(last["schema"]))
    if not schema_diff(held, df.schema).same:
        return True
    if last["digest"] is not None and last["digest"] == str(digest(df)):
        return False
    pages = read_json_batch(lake.spark, f"{batch_path(lake, source, last['date'])}/{last['folder']}", held)
    return has_changed(pages, df, symmetric=symmetric)


def land_full(
    lake: Lake,
    source: TableId,
    df: DataFrame,
    *,
    symmetric: bool = True,
    records_per_file: int = RECORDS_PER_FILE,
) -> int:
    """Land a whole table if it differs from what was landed last; the run is logged either way.

    A column that came, went or changed its type is a difference.  Where nothing differs, what was landed
    is not read: a digest of its rows is kept with it.
    """
    run = Run()
    if not _full_load_changed(lake, source, df, symmetric):
        df = df.limit(0)
    return land(lake, source, df, "Full", run, records_per_file=records_per_file, with_digest=True)


@dataclass(frozen=True)
class Pending:
    """What the unread dates hold: types over all dates, and the columns of each date."""

    types: StructType
    columns: dict[str, frozenset[str]]
    retyped: dict[str, str]  # column -> 'old type -> new type'


def _date_glob(lake: Lake, source: TableId, dates: Sequence[str]) -> str:
    return f"{lake.path(source)}/{{{','.join(dates)}}}/*"


def _landed_date() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+/[^/]+$", 1)


def _plan_read(
    lake: Lake,
    source: TableId,
    dates: Sequence[str],
    given: StructType | None,
    base: DataFrame | None,
    clash: DataType,
    plain: Sequence[str],
) -> Pending | None:
    """Types and columns of the dates: as given, as their runs say, or else looked up in the pages.

    The number of jobs does not depend on the number of dates.
    """
    held = [] if base is None else [base.schema]
    if given is not None:
        told = [(d, given) for d in dates]
    else:
        rows = _landed_pages(lake, source).where(F.col("date").isin(list(dates))).orderBy("folder").collect()
        told = [(r["date"], StructType.fromJson(json.loads(r["schema"]))) for r in rows]
    columns: dict[str, frozenset[str]] = {}
    for date, one in told:
        columns[date] = columns.get(date, frozenset()) | set(one.names)
    unknown = [d for d in dates if d not in columns]
    schemas = [one for _, one in told]
    if unknown:
        found, types = _look_up(lake, source, unknown)
        names = sorted(set().union(*found.values())) if found else []
        columns |= found
        schemas.append(types)
        # A column of nothing but nulls takes the type it has in the table.
        known = set().union(*(one.names for one in (*held, *schemas)))
        schemas.append(StructType([StructField(n, TEXT) for n in names if n not in known]))
    if not any(columns.values()):
        return None
    merged = merged_schema([*held, *schemas], clash, plain)
    used = set().union(*columns.values())
    types = StructType([f for f in merged.fields if f.name in used])
    retyped: dict[str, str] = {}
    for one in [*held, *schemas]:
        for f in one.fields:
            if f.name in used and f.dataType != merged[f.name].dataType and f.name not in retyped:
                now = merged[f.name].dataType.simpleString()
                retyped[f.name] = f"{f.dataType.simpleString()} -> {now}"
    return Pending(types, columns, retyped)


def _look_up(
    lake: Lake, source: TableId, dates: Sequence[str]
) -> tuple[dict[str, frozenset[str]], StructType]:
    """Columns per date, and types, of pages that no run described."""
    glob = _date_glob(lake, source, dates)
    try:
        types = lake.spark.read.json(glob, dropFieldIfAllNull=True).schema
        lines = lake.spark.read.text(glob).select("value", _landed_date().alias("date"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}, StructType([])
        raise
    several = F.from_json("value", ArrayType(StringType()))
    records = F.when(F.trim("value").startswith("["), several).otherwise(F.array("value"))
    keys = (
        lines.select("date", F.explode(records).alias("record"))
        .select("date", F.explode(F.json_object_keys("record")).alias("key"))
        .groupBy("date")
        .agg(F.collect_set("key").alias("keys"))
    )
    found = {r["date"]: frozenset(r["keys"]) - {"_corrupt_record"} for r in keys.collect()}
    return found, StructType([f for f in types.fields if f.name != "_corrupt_record"])


def _read_dates(lake: Lake, source: TableId, pending: Pending) -> DataFrame | None:
    """All records of the dates in one scan, parsed once; lines that fail are in a column of their own."""
    reader = lake.spark.read.schema(StructType([*pending.types.fields, StructField(_BROKEN, TEXT)]))
    try:
        pages = reader.json(_date_glob(lake, source, list(pending.columns)), columnNameOfCorruptRecord=_BROKEN)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # A null in the pages is a null of the column, not a variant that holds one.
    variants = [f.name for f in pending.types.fields if f.dataType == VARIANT]
    nulls = {c: F.when(~F.is_variant_null(c), F.col(c)) for c in variants}
    return materialize(pages.withColumns({**nulls, _DATE: _landed_date()}), "pages")


def _newest(
    good: DataFrame, pending: Pending, key: str, order: str | None, ties: Sequence[str], overwrite: bool
) -> tuple[DataFrame, list[str]]:
    """One record per key, and the columns that some date lacks.

    The latest date wins, and within it the latest record.  A column that a date
    lacks comes from the latest date that has it; a flag `<column>__set` says if one has.
    """
    ranked = [order] if order else []
    comparable = [c for c in pending.types.names if not holds_variant(pending.types[c].dataType)]
    rest = list(ties) or [c for c in comparable if c not in (key, *ranked)] or [key]
    partial = [c for c in pending.types.names if any(c not in held for held in pending.columns.values())]
    if overwrite or not partial:
        return latest_by(good, key, [_DATE, *ranked], rest).drop(_DATE), []
    per_date = latest_by(good, [key, _DATE], ranked, rest)
    values = []
    for c in pending.types.names:
        if c == key:
            continue
        having = [d for d, held in pending.columns.items() if c in held]
        dated = F.when(F.col(_DATE).isin(having), F.col(_DATE)) if c in partial else F.col(_DATE)
        values.append(F.max_by(F.when(dated.isNotNull(), F.struct(c)), dated).alias(c))
    found = per_date.groupBy(key).agg(*values)
    flags = [F.col(c).isNotNull().alias(f"{c}__set") for c in partial]
    return found.select(key, *(F.col(v)[v].alias(v) for v in pending.types.names if v != key), *flags), partial


def _with_stored(newest: DataFrame, base: DataFrame | None, partial: Sequence[str], key: str) -> DataFrame:
    """Values that no date gave come from the stored row."""
    stored = [c for c in partial if base is not None and c in base.columns]
    if stored:
        old = base.select(key, *(F.col(c).alias(f"{c}__old") for c in stored))
        newest = newest.join(old.join(newest.select(key), key, "left_semi"), key, "left")
        newest = newest.withColumns(
            {c: F.when(F.col(f"{c}__set"), F.col(c)).otherwise(F.col(f"{c}__old")) for c in stored}
        )
    return newest.drop(*(f"{c}__set" for c in partial), *(f"{c}__old" for c in stored))


def _retype(base: DataFrame, pending: Pending) -> DataFrame:
    """The stored table with the types it will have."""
    now = {f.name: f.dataType for f in pending.types.fields}
    return base.select(
        *(converted(F.col(f.name), f.dataType, now.get(f.name, f.dataType)).alias(f.name) for f in base.schema.fields)
    )


def apply_batches(
    lake: Lake,
    api: str,
    entity: str,
    *,
    key: str = "id",
    order: str | None = "updated_at",
    ties: Sequence[str] = (),
    schema: StructType | None = None,
    overwrite_missing: bool = False,
    same_day: bool = False,
    layout: Layout | None = None,
    variants: bool = False,
) -> int | None:
    """Upsert every unread landing date into the raw table; returns its rows, None if idle.

    The outcome is that of applying the dates one after the other, but the pages
    are read in one scan and the table is rewritten once: per key the latest
    date wins, and within it the latest record.  The log gets one row per date.

    With a `layout`, or one that the table has already, only the parts of the table
    that the dates have keys of are read and written, unless a type changed.

    `order` must be a column of every date; None leaves the choice to `ties`, which
    default to all other columns.  Lines that are no JSON or do not fit the types,
    and records without key, go to the table's `rejected` folder and are counted
    in the log.  A type that changed widens: numbers to larger numbers, anything
    else to text; the log says so.  With `variants` anything else becomes a variant,
    which keeps numbers, texts, lists and objects as they are (see `variant_field`);
    key, order and ties still become text.
    """
    spark, run = lake.spark, Run()
    source, target = TableId(LANDING, entity, api), TableId(RAW, entity, api)
    base = lake.read(target, required=False)
    log = control_or_empty(spark, lake.control_path(target), RAW_RUN)
    landed = control_or_empty(spark, lake.control_path(source), LANDING_RUN)
    pending_dates = unread_dates(landed, None if base is None else log, same_day=same_day)
    dates = [row["exec_date"] for row in pending_dates.collect()]  # one short text per calendar day
    clash, plain = VARIANT if variants else TEXT, [key, *([order] if order else []), *ties]
    pending = _plan_read(lake, source, dates, schema, base, clash, plain) if dates else None
    if pending is None:
        return None
    for column in (key, *([order] if order else [])):
        without = sorted(d for d, held in pending.columns.items() if held and column not in held)
        if without:
            raise ValueError(f"column {column!r} is missing from {source.folder} on {', '.join(without)}")

    parsed = _read_dates(lake, source, pending)
    if parsed is None:
        return None
    bad = F.col(_BROKEN).isNotNull() | F.col(key).isNull()
    keys = F.when(~bad, F.col(key))
    counts = {
        row[_DATE]: row
        for row in parsed.groupBy(_DATE)
        .agg(F.count_distinct(keys).alias("n"), F.count(F.when(bad, 1)).alias("bad"))
        .collect()
    }
    if any(row["bad"] for row in counts.values()):
        whole = F.to_json(F.struct(*pending.types.names), {"ignoreNullFields": "false"})
        rejected = parsed.where(bad).select(
            F.col(_DATE).alias("Loaded_date"),
            F.lit(int(run.started)).cast("bigint").alias("Exec_time"),
            F.coalesce(F.col(_BROKEN), whole).alias("record"),
        )
        rejected.write.mode("append").parquet(f"{lake.path(target)}/rejected")
    if not counts:
        return None

    good = parsed.where(~bad).drop(_BROKEN)
    newest, partial = _newest(good, pending, key, order, ties, overwrite_missing)
    newest = materialize(newest, f"batch-{entity}")  # the upsert reads it more than once
    path = lake.path(target)
    if base is not None and pending.retyped:
        base, layout = _retype(base, pending), layout or snapshot_layout(spark, path)
        updates = _with_stored(newest, base, partial, key)
        whole = upsert(base, updates, key, overwrite_missing=overwrite_missing)
        written = write_snapshot(whole, path, layout=layout)
    else:
        updates = _with_stored(newest, touched_rows(newest, path), partial, key)
        written = upsert_snapshot(updates, path, key, overwrite_missing=overwrite_missing, layout=layout)
    retyped = "; ".join(f"{c}: {change}" for c, change in sorted(pending.retyped.items()))
    append_runs(
        spark,
        lake.control_path(target),
        RAW_RUN,
        [
            run.record(
                Loaded_date=d,
                Read_Rows=counts[d]["n"],
                Table_Rows=written.rows,
                Bad_Rows=counts[d]["bad"],
                Retyped=retyped or None,
            )
            for d in dates
            if d in counts
        ],
    )
    return written.rows


def read_rejected(lake: Lake, api: str, entity: str) -> DataFrame:
    """Records kept apart by `apply_batches`: Loaded_date, Exec_time, record."""
    columns = columns_of(Loaded_date=TEXT, Exec_time=RAW_RUN["Exec_time"].dataType, record=TEXT)
    return read_or_empty(lake.spark, f"{lake.path(TableId(RAW, entity, api))}/rejected", columns)


def import_enums(lake: Lake, folder: str, api: str = CATALOGUE_ENUMS) -> list[str]:
    """Import the enum lists of which some part changed since they were last read; returns their names.

    All files are read in one scan, which begins after the run's clock: a part
    that changes meanwhile is read again next time.  The loop runs over enum
    lists, which are a fixed handful; the rows of each stay in Spark.
    """
    run = Run()
    listed = read_enum_dir(lake.spark, folder).persist()
    imported = []
    files = (
        listed.groupBy("entity", "enum")
        .agg(F.max("modified").alias("modified"))
        .orderBy("entity", "enum")
        .collect()
    )
    for file in files:
        table = TableId(RAW, f"{file['entity']}/{file['enum']}", api)
        last = last_run_time(control_or_empty(lake.spark, lake.control_path(table), TABLE_RUN))
        if last is not None and file["modified"] < last:
            continue
        rows = listed.where((F.col("entity") == file["entity"]) & (F.col("enum") == file["enum"]))
        written = write_snapshot(rows.select("name", "value"), lake.path(table), evolve=False)
        append_run(lake.spark, lake.control_path(table), TABLE_RUN, run.record(Table_Rows=written.rows))
        imported.append(f"{file['entity']}/{file['enum']}")
    listed.unpersist()
    return imported
