"""Command line for the scheduled jobs.

    spark-submit lakestrata/jobs.py land    --root s3a://lake --api igdb --table games --records s3a://in/games --updated-at updated_at
    spark-submit lakestrata/jobs.py land    --root s3a://lake --api igdb --table genres --records s3a://in/genres --full
    spark-submit lakestrata/jobs.py match   --root s3a://lake --candidates s3a://in/times
    spark-submit lakestrata/jobs.py enums   --root s3a://lake --folder s3a://lake/enums
    spark-submit lakestrata/jobs.py raw     --root s3a://lake --api igdb --tables games genres
    spark-submit lakestrata/jobs.py context --root s3a://lake [--tables games ...]
    spark-submit lakestrata/jobs.py trust   --root s3a://lake [--tables games_by_genre ...]
    spark-submit lakestrata/jobs.py catalog --root s3a://lake
    spark-submit lakestrata/jobs.py expire  --root s3a://lake --layer raw --older-than 30 [--keep 2]

Records and candidates are parquet, or with `--format json` JSON lines.  Tables of a job are
built side by side; one that fails is logged and fails the job at its end, and only those that
read it are left out.  Intermediate tables are removed when a job ends.  Storage access comes from the Spark configuration
of the cluster.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from lakestrata.plans.context import CONTEXT_TABLES
from lakestrata.plans.ingest import apply_batches, import_enums, land_full, land_incremental
from lakestrata.plans.lake import CATALOGUE, CATALOGUE_ENUMS, LANDING, RAW, TIMES, Lake, TableId
from lakestrata.plans.marts import MARTS
from lakestrata.plans.matching import land_matches
from lakestrata.plans.retention import expire_layer
from lakestrata.plans.runner import PARALLEL, BuildResult, TableSpec, build_all, failures, run_tables
from lakestrata.session import build_session
from lakestrata.sources.catalog import sync_catalog
from lakestrata.sources.scratch import clear_scratch
from lakestrata.sources.snapshot import Layout


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakestrata")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--root", required=True)
        return sub

    land = job("land")
    land.add_argument("--api", default=CATALOGUE)
    land.add_argument("--table", required=True)
    land.add_argument("--records", required=True)
    how = land.add_mutually_exclusive_group(required=True)
    how.add_argument("--updated-at", help="column of epoch seconds: land what changed since the last run")
    how.add_argument("--full", action="store_true", help="land the whole table if it changed")
    match = job("match")
    match.add_argument("--candidates", required=True)
    for sub in (land, match):
        sub.add_argument("--format", choices=("parquet", "json"), default="parquet")
    enums = job("enums")
    enums.add_argument("--folder", required=True)
    enums.add_argument("--api", default=CATALOGUE_ENUMS)
    raw = job("raw")
    raw.add_argument("--api", default=CATALOGUE)
    raw.add_argument("--tables", nargs="+", required=True)
    raw.add_argument("--key", default="id")
    raw.add_argument("--order", default="updated_at")
    raw.add_argument("--no-order", action="store_const", const=None, dest="order")
    raw.add_argument("--ties", nargs="+", default=())
    raw.add_argument("--schema", help="types of the records, as DDL; else as they were landed")
    raw.add_argument("--overwrite-missing", action="store_true")
    raw.add_argument("--variants", action="store_true", help="columns of changing types become variants, not text")
    parts = raw.add_mutually_exclusive_group()
    parts.add_argument("--part-keys", type=int, help="put a table into parts of so many consecutive keys")
    parts.add_argument("--parts", type=int, help="put a table into so many parts by the hash of the key")
    raw.add_argument("--first-landing-only", action="store_true", help="do not read a second landing on one day")
    expire = job("expire")
    expire.add_argument("--layer", required=True)
    expire.add_argument("--older-than", type=int, required=True, help="days since a version was replaced")
    expire.add_argument("--keep", type=int, default=1, help="newest versions that always stay")
    context = job("context")
    context.add_argument("--api", choices=(CATALOGUE, TIMES))
    context.add_argument("--tables", nargs="*")
    trust = job("trust")
    trust.add_argument("--tables", nargs="*")
    for sub in (raw, context, trust):
        sub.add_argument("--parallel", type=int, default=PARALLEL, help="tables that are built at the same time")
    job("catalog")
    return top


def _chosen(specs: dict[str, TableSpec], names: Sequence[str] | None) -> list[TableSpec]:
    """The named tables in build order, or all of them."""
    known = {spec.target.name for spec in specs.values()}
    unknown = set(names or ()) - known
    if unknown:
        raise SystemExit(f"unknown tables: {sorted(unknown)}")
    return [s for s in specs.values() if not names or s.target.name in names]


def _done(results: list[BuildResult]) -> list[BuildResult]:
    if failed := failures(results):  # the others are done
        raise SystemExit("\n".join(failed))
    return results


def _rows(results: list[BuildResult]) -> list[int | None]:
    return [r.rows for r in _done(results)]


def _apply_all(args: argparse.Namespace, lake: Lake) -> list[BuildResult]:
    """Unread batches of every named table; the tables do not read each other."""
    layout = None
    if args.part_keys or args.parts:
        layout = Layout(args.key, "range" if args.part_keys else "hash", args.part_keys or args.parts)

    def apply(table: TableId) -> BuildResult:
        rows = apply_batches(
            lake,
            args.api,
            table.name,
            key=args.key,
            order=args.order,
            ties=args.ties,
            schema=StructType.fromDDL(args.schema) if args.schema else None,
            overwrite_missing=args.overwrite_missing,
            same_day=not args.first_landing_only,
            layout=layout,
            variants=args.variants,
        )
        return BuildResult(table.folder, rows is not None, rows=rows)

    return run_tables(lake, [TableId(RAW, t, args.api) for t in args.tables], {}, apply, parallel=args.parallel)


def run(args: argparse.Namespace, lake: Lake) -> list:
    if args.job == "land":
        source = TableId(LANDING, args.table, args.api)
        records = lake.spark.read.format(args.format).load(args.records)
        if args.full:
            return [land_full(lake, source, records)]
        return [land_incremental(lake, source, records, args.updated_at)]
    if args.job == "match":
        return [land_matches(lake, lake.spark.read.format(args.format).load(args.candidates))]
    if args.job == "enums":
        return import_enums(lake, args.folder, args.api)
    if args.job == "raw":
        return _rows(_apply_all(args, lake))
    if args.job == "catalog":
        rows = sync_catalog(lake.spark, lake.root).collect()
        failed = [f"{r['database']}.{r['table']}: {r['error']}" for r in rows if r["action"] == "failed"]
        if failed:  # the others are done
            raise SystemExit("\n".join(failed))
        return rows
    if args.job == "expire":
        return expire_layer(lake, args.layer, older_than=int(time.time()) - 86400 * args.older_than, keep=args.keep)
    tables = MARTS
    if args.job == "context":
        tables = {k: s for k, s in CONTEXT_TABLES.items() if args.api in (None, s.target.api)}
    return _done(build_all(lake, _chosen(tables, args.tables), parallel=args.parallel))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> list:
    args = parser().parse_args(argv)
    lake = Lake(spark or build_session(f"lakestrata-{args.job}"), args.root)
    try:
        return run(args, lake)
    finally:
        clear_scratch(lake.spark)


if __name__ == "__main__":
    for result in main():
        print(result)
