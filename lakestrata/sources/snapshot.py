"""Versioned tables as plain parquet directories.

    <path>/data/<run>/            the files of one version, written once
    <path>/data/<run>/__part=7/   of a table in parts: those parts that this version wrote
    <path>/data/<run>/__pack=3/   where these are many: several of them, each row with its `__part`
    <path>/history/               one row per version: number, time, rows, schema, run, parts
    <path>/removed/               one row per version that was removed

A version becomes visible when its history row is written, after its data, so
a write that fails half-way leaves nothing a reader would pick up.  A table in
parts is updated by writing the parts that have changes; its other parts are
those of earlier versions.  A part of a pack that a later version wrote again
stays in its file, and readers pass it over.  One writer per table at a time, as the scheduled
jobs guarantee.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from lakestrata.functions.schemas import COUNT, TEXT, local_frame, schema
from lakestrata.operators.changes import schema_diff, upsert
from lakestrata.sources.folders import delete_folder, entries
from lakestrata.sources.log import DONE, append_rows, read_log
from lakestrata.sources.scratch import materialize, scratch_path

PART, PACK, RUN, WHOLE = "__part", "__pack", "__run", "whole"
MOST_FOLDERS = 256  # parts that a version writes to a folder each; of more, several share one
PACK_ROWS = 1_000_000  # above, a folder takes no further part
HISTORY = schema(
    version=COUNT,
    timestamp=COUNT,
    rows=COUNT,
    schema=TEXT,
    run=TEXT,
    layout=TEXT,
    parts=ArrayType(schema(part=COUNT, run=TEXT, rows=COUNT, pack=COUNT, packed=COUNT)),
)
REMOVED = schema(version=COUNT, timestamp=COUNT)


@dataclass(frozen=True)
class Snapshot:
    version: int
    rows: int
    parts_written: int | None = None


@dataclass(frozen=True)
class Layout:
    """Which part of a table a row belongs to, by its key.

    `range`: `size` consecutive whole numbers a part, so that rows added together lie together, all other keys
    in one; `hash`: one of `size` parts, for keys of any type.
    """

    key: str
    kind: str
    size: int

    def __post_init__(self) -> None:
        if self.kind not in ("range", "hash") or self.size < 1:
            raise ValueError(f"no such layout: {self}")

    def part(self) -> Column:
        if self.kind == "hash":
            return F.pmod(F.xxhash64(self.key), F.lit(self.size)).cast("bigint")
        return F.coalesce(F.expr(f"try_cast(`{self.key}` AS bigint) div {self.size}L"), F.lit(0).cast("bigint"))


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """The versions of a table that were not removed, newest first."""
    history = read_log(spark, f"{path}/history", HISTORY)
    removed = read_log(spark, f"{path}/removed", REMOVED).select("version")
    return history.join(removed, "version", "left_anti").select(*HISTORY.names).orderBy(F.desc("version"))


def _find(spark: SparkSession, path: str, version: int | None) -> Row | None:
    history = snapshot_history(spark, path)
    found = (history if version is None else history.where(F.col("version") == version)).first()
    if found is None and version is not None:
        gone = read_log(spark, f"{path}/removed", REMOVED).where(F.col("version") == version).first()
        if gone is not None:
            when = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(gone["timestamp"]))
            raise FileNotFoundError(f"version {version} of {path} was removed on {when} UTC")
    return found


def _folder(path: str, part: Row) -> str:
    """Where a part is, alone or with others."""
    name = f"{PART}={part['part']}" if part["pack"] is None else f"{PACK}={part['pack']}"
    return f"{path}/data/{part['run']}/{name}"


def _folders(path: str, entry: Row) -> list[str]:
    """Folders of a version's files."""
    if entry["parts"] is None:
        return [f"{path}/data/{entry['run']}"]
    return list(dict.fromkeys(_folder(path, p) for p in entry["parts"]))


def _schema(entry: Row) -> StructType:
    return StructType.fromJson(json.loads(entry["schema"]))


def snapshot_layout(spark: SparkSession, path: str) -> Layout | None:
    """How the latest version is in parts, if it is."""
    return _layout(_find(spark, path, None))


def _layout(entry: Row | None) -> Layout | None:
    return None if entry is None or entry["layout"] is None else Layout(**json.loads(entry["layout"]))


def _read(spark: SparkSession, path: str, entry: Row, parts: Iterable[int] | None = None) -> DataFrame:
    columns = _schema(entry)
    if entry["parts"] is None:
        return spark.read.schema(columns).parquet(*_folders(path, entry))
    wanted = None if parts is None else set(parts)
    held: dict[str, list[Row]] = defaultdict(list)
    for p in entry["parts"]:
        if wanted is None or p["part"] in wanted:
            held[_folder(path, p)].append(p)
    if not held:
        return local_frame(spark, columns)
    whole = {folder for folder, some in held.items() if some[0]["pack"] is None or len(some) == some[0]["packed"]}
    frames = [spark.read.schema(columns).parquet(*(f for f in held if f in whole))] if whole else []
    if len(whole) < len(held):
        cut = [f for f in held if f not in whole]
        key = schema(**{RUN: TEXT, PART: COUNT})
        found = local_frame(spark, key, [{RUN: p["run"], PART: p["part"]} for f in cut for p in held[f]])
        run = F.element_at(F.split("_metadata.file_path", "/"), -3)
        stored = spark.read.schema(_with_part(columns)).parquet(*cut).withColumn(RUN, run)
        frames.append(stored.join(found, key.names, "left_semi").select(*_quoted(columns.names)))
    return reduce(DataFrame.unionByName, frames)


def _with_part(columns: StructType) -> StructType:
    """The columns of a file of several parts."""
    return StructType([*columns.fields, *schema(**{PART: COUNT}).fields])


def current_location(spark: SparkSession, path: str) -> tuple[str, StructType, dict[int, str] | None]:
    """Folder and schema of the latest version, and of a table in parts the folder of each.

    Others cannot tell which rows of a pack count, so a table with packs is written whole for them, once a version,
    with the part of each row as its last column.
    """
    entry = _find(spark, path, None)
    if entry is None:
        raise FileNotFoundError(f"no version of {path}")
    folder, columns = f"{path}/data/{entry['run']}", _schema(entry)
    if entry["parts"] is None:
        return folder, columns, None
    if all(p["pack"] is None for p in entry["parts"]):
        return folder, columns, {p["part"]: _folder(path, p) for p in entry["parts"]}
    if not any(e.name == DONE for e in entries(spark, f"{folder}/{WHOLE}")):
        numbered = _read(spark, path, entry).withColumn(PART, _layout(entry).part())
        numbered.write.mode("overwrite").parquet(f"{folder}/{WHOLE}")
    return f"{folder}/{WHOLE}", _with_part(columns), None


def read_snapshot(
    spark: SparkSession, path: str, version: int | None = None, *, required: bool = True
) -> DataFrame | None:
    """The latest version or the one asked for; None if absent and not `required`."""
    entry = _find(spark, path, version)
    if entry is None:
        if required:
            raise FileNotFoundError(f"no version {'' if version is None else version} of {path}")
        return None
    return _read(spark, path, entry)


def read_enum(spark: SparkSession, root: str, entity: str, column: str) -> DataFrame | None:
    """Enum list of a column, or None if it was never imported."""
    return read_snapshot(spark, f"{root}/{entity}/{column}", required=False)


def write_snapshot(
    df: DataFrame,
    path: str,
    *,
    evolve: bool = True,
    sort_by: Sequence[str] = (),
    layout: Layout | None = None,
) -> Snapshot:
    """Write the next version whole; earlier versions are never touched.

    Without `evolve` a schema other than the stored one is refused.  `sort_by`
    range-partitions and sorts the files; the sort samples its input, so that is
    written to the shared folder first, and the sources are read once.  With a
    `layout` the table is in parts from then on, a task writing whole parts.
    Rows are counted during the write.
    """
    spark = df.sparkSession
    if sort_by and layout is not None:
        raise ValueError("a table is sorted or in parts")
    last = _find(spark, path, None)
    if last is not None and not evolve:
        diff = schema_diff(_schema(last), df.schema)
        if not diff.same:
            raise ValueError(f"schema of {path} would change: {diff}")
    if layout is not None:
        return _write_parts(df, path, last, layout, [])
    version, run = _next(last)
    counted = Observation(run)
    ordered = materialize(df, "unsorted").orderBy(*sort_by) if sort_by else df
    (
        ordered.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("errorifexists")
        .parquet(f"{path}/data/{run}")
    )
    rows = counted.get["rows"]
    _add_version(spark, path, version=version, rows=rows, schema=df.schema.json(), run=run)
    return Snapshot(version, rows)


def _next(last: Row | None) -> tuple[int, str]:
    version = 0 if last is None else last["version"] + 1
    return version, f"{version:06d}-{uuid.uuid4().hex}"


def _add_version(spark: SparkSession, path: str, **entry) -> None:
    append_rows(spark, f"{path}/history", HISTORY, [{"timestamp": int(time.time()), **entry}])


def _write_parts(df: DataFrame, path: str, last: Row | None, layout: Layout, kept: list[Row]) -> Snapshot:
    """A version of the parts that `df` has rows of, written now, and the `kept` ones of earlier versions."""
    spark = df.sparkSession
    version, run = _next(last)
    unsorted = scratch_path(spark, "unpacked")  # how many parts there are decides where they go
    df.withColumn(PART, layout.part()).write.parquet(unsorted)
    numbered = spark.read.schema(_with_part(df.schema)).parquet(unsorted)
    counts = numbered.groupBy(PART).agg(F.count(F.lit(1)).alias("rows")).collect()
    written = _packed([{"part": c[PART], "run": run, "rows": c["rows"]} for c in counts])
    folder = PART
    if len(written) > MOST_FOLDERS:
        places = local_frame(spark, schema(**{PART: COUNT, PACK: COUNT}), [{PART: p["part"], PACK: p["pack"]} for p in written])
        numbered, folder = numbered.join(places, PART).select(*_quoted(numbered.columns), PACK), PACK
    (
        numbered.repartition(folder)
        .sortWithinPartitions(folder, PART)  # of a pack, what is read for an update lies together
        .write.mode("errorifexists")
        .partitionBy(folder)
        .parquet(f"{path}/data/{run}")
    )
    delete_folder(spark, unsorted)
    parts = [p.asDict() for p in kept] + written
    rows = sum(p["rows"] for p in parts)
    _add_version(
        spark, path, version=version, rows=rows, schema=df.schema.json(), run=run,
        layout=json.dumps(asdict(layout)), parts=parts,
    )
    return Snapshot(version, rows, len(written))


def _quoted(names: Iterable[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def _packed(parts: list[dict]) -> list[dict]:
    """The parts of one version, with the pack each goes to where they are too many for a folder each.

    Neighbouring parts share a pack, as they are likely to change together.
    """
    if len(parts) <= MOST_FOLDERS:
        return parts
    most = -(-len(parts) // MOST_FOLDERS)
    packs: list[list[dict]] = []
    rows = 0
    for p in sorted(parts, key=lambda p: p["part"]):
        if not packs or len(packs[-1]) == most or rows + p["rows"] > PACK_ROWS:
            packs.append([])
            rows = 0
        packs[-1].append(p)
        rows += p["rows"]
    return [{**p, "pack": n, "packed": len(held)} for n, held in enumerate(packs) for p in held]


def touched_rows(updates: DataFrame, path: str) -> DataFrame | None:
    """Rows of the latest version in the parts that `updates` has keys of; all rows of a table not in parts."""
    entry = _find(updates.sparkSession, path, None)
    if entry is None:
        return None
    layout = _layout(entry)
    return _read(updates.sparkSession, path, entry, None if layout is None else _parts_of(updates, layout))


def _parts_of(updates: DataFrame, layout: Layout) -> list[int]:
    """Numbers of the parts with updates: no more than the table has or gets."""
    return [r[PART] for r in updates.select(layout.part().alias(PART)).distinct().collect()]


def upsert_snapshot(
    updates: DataFrame,
    path: str,
    key: str,
    *,
    overwrite_missing: bool = False,
    layout: Layout | None = None,
) -> Snapshot:
    """The next version: `updates`, one row per key, over the latest one (see `upsert`).

    Of a table in parts only those with updates are read and written.  `layout` is for the first version, or
    puts a table that was not in parts into parts.  A column whose type changed, or a layout other than the
    stored one, rewrites the table; types that do not fit each other are the caller's to convert first.
    `updates` are read several times.
    """
    spark = updates.sparkSession
    last = _find(spark, path, None)
    stored = _layout(last)
    layout = layout or stored
    if layout is not None and layout.key != key:
        raise ValueError(f"{path} is in parts by {layout.key!r}, not by {key!r}")
    if last is None:
        return write_snapshot(updates, path, layout=layout)
    if stored is None or stored != layout or schema_diff(_schema(last), updates.schema).retyped:
        base = _read(spark, path, last)  # lists all folders
        return write_snapshot(upsert(base, updates, key, overwrite_missing=overwrite_missing), path, layout=layout)
    touched = set(_parts_of(updates, layout))
    changed = upsert(_read(spark, path, last, touched), updates, key, overwrite_missing=overwrite_missing)
    return _write_parts(changed, path, last, layout, [p for p in last["parts"] if p["part"] not in touched])


def expire_versions(
    spark: SparkSession,
    path: str,
    *,
    older_than: int,
    read_at: Sequence[int | None] = (),
    keep: int = 1,
) -> list[int]:
    """Remove versions that were replaced before `older_than` (epoch seconds); returns their numbers.

    `read_at` holds the time of the last run of each reader: what was current then, and everything since, stays;
    a reader that never ran (None) needs nothing.  The newest `keep` versions always stay.  The versions are
    marked as removed first, so a removal that fails half-way leaves no version that cannot be read, and the next
    one deletes what is left.  Files that a version shares with one that stays are kept.
    """
    if keep < 1:
        raise ValueError("the newest version cannot be removed")
    limit = min([older_than, *(t for t in read_at if t is not None)])
    every = read_log(spark, f"{path}/history", HISTORY).orderBy("version").collect()  # one row a version
    gone = {r["version"] for r in read_log(spark, f"{path}/removed", REMOVED).collect()}
    held = [e for e in every if e["version"] not in gone]
    replaced = [e for e, after in zip(held, held[1:]) if after["timestamp"] <= limit]
    removed = replaced[: max(0, len(held) - keep)]
    if removed:
        now = int(time.time())
        append_rows(spark, f"{path}/removed", REMOVED, [{"version": e["version"], "timestamp": now} for e in removed])
    gone |= {e["version"] for e in removed}
    needed: dict[str, set[str]] = defaultdict(set)
    for e in every:
        if e["version"] not in gone:
            for folder in _folders(path, e):
                needed[folder.removeprefix(f"{path}/data/").split("/")[0]].add(folder)
    for e in every:
        if e["version"] in gone:
            delete_folder(spark, f"{path}/data/{e['run']}" + (f"/{WHOLE}" if e["run"] in needed else ""))
            for folder in _folders(path, e) if e["parts"] is not None else ():
                run = folder.removeprefix(f"{path}/data/").split("/")[0]
                if run in needed and folder not in needed[run]:
                    delete_folder(spark, folder)
    return [e["version"] for e in removed]
