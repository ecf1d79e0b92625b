"""Build tables side by side, each after the tables it reads and only when one of them is newer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lakestrata.plans.control import (
    LANDING_RUN,
    RAW_RUN,
    TABLE_RUN,
    Run,
    append_failure,
    append_run,
    control_or_empty,
    is_stale,
)
from lakestrata.plans.lake import LANDING, RAW, Lake, TableId
from lakestrata.sources.snapshot import write_snapshot

# Fixed value: tables that are built at the same time.
PARALLEL = 8


@dataclass(frozen=True)
class TableSpec:
    """A derived table: what it is built from and how."""

    target: TableId
    sources: tuple[TableId, ...]
    transform: Callable[[Lake], DataFrame]
    sort_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class BuildResult:
    """What became of a table: `state` is built, fresh (no source is newer), failed, or waiting.

    A waiting table reads, directly or not, one that failed in the same run.
    """

    table: str
    built: bool
    version: int | None = None
    rows: int | None = None
    error: str | None = None
    waits_for: str | None = None

    @property
    def state(self) -> str:
        if self.error is not None:
            return "failed"
        if self.waits_for is not None:
            return "waiting"
        return "built" if self.built else "fresh"


def run_schema(table: TableId) -> StructType:
    """Run-log schema of a table, by its layer."""
    return {LANDING: LANDING_RUN, RAW: RAW_RUN}.get(table.layer, TABLE_RUN)


def build_table(lake: Lake, spec: TableSpec) -> BuildResult:
    """Gate, transform, one write, one log row.

    The row count comes from the write itself; nothing is computed twice.
    """
    spark = lake.spark
    run = Run()
    log_path = lake.control_path(spec.target)
    target_log = control_or_empty(spark, log_path, TABLE_RUN)
    source_logs = [control_or_empty(spark, lake.control_path(s), run_schema(s)) for s in spec.sources]
    if not is_stale(target_log, source_logs):
        return BuildResult(spec.target.folder, built=False)
    written = write_snapshot(spec.transform(lake), lake.path(spec.target), sort_by=spec.sort_by)
    append_run(spark, log_path, TABLE_RUN, run.record(Table_Rows=written.rows))
    return BuildResult(spec.target.folder, True, written.version, written.rows)


def run_tables(
    lake: Lake,
    tables: Sequence[TableId],
    sources: Mapping[TableId, Sequence[TableId]],
    work: Callable[[TableId], BuildResult],
    *,
    parallel: int = PARALLEL,
) -> list[BuildResult]:
    """`work` on every table, several at a time, each after those of its sources that are among the tables.

    Every table runs in a thread, job group and scheduler pool of its own, so that Spark shares the
    executors between them.  An error goes to the table's run log and result; tables that read it are left
    out, the others go on.  Results come in the order of `tables`; sources in a circle are an error.
    """
    if len(set(tables)) < len(tables):
        raise ValueError("a table is listed twice")
    order = TopologicalSorter({t: [s for s in sources.get(t, ()) if s in tables] for t in tables})
    order.prepare()
    context = lake.spark.sparkContext

    def one(table: TableId) -> BuildResult:
        run = Run()
        context.setJobGroup(table.folder, f"build {table.folder}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", table.folder)
        try:
            return work(table)
        except Exception as error:  # noqa: BLE001 - kept with the table, the others go on
            reason = append_failure(lake.spark, lake.control_path(table), run_schema(table), run, error)
            return BuildResult(table.folder, built=False, error=reason)

    results: dict[TableId, BuildResult] = {}
    running: dict[Future[BuildResult], TableId] = {}
    with ThreadPoolExecutor(parallel, thread_name_prefix="build") as pool:
        while order.is_active():
            for table in order.get_ready():
                broken = next((s for s in sources.get(table, ()) if s in results and results[s].state in ("failed", "waiting")), None)
                if broken is None:
                    running[pool.submit(inheritable_thread_target(lake.spark)(one), table)] = table
                else:
                    results[table] = BuildResult(table.folder, built=False, waits_for=results[broken].waits_for or broken.folder)
                    order.done(table)
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    table = running.pop(future)
                    results[table] = future.result()
                    order.done(table)
    return [results[t] for t in tables]


def build_all(lake: Lake, specs: Sequence[TableSpec], *, parallel: int = PARALLEL) -> list[BuildResult]:
    """Build what is due, side by side, in the order that the sources ask for (see `run_tables`)."""
    by_target = {spec.target: spec for spec in specs}
    return run_tables(
        lake,
        [spec.target for spec in specs],
        {target: spec.sources for target, spec in by_target.items()},
        lambda target: build_table(lake, by_target[target]),
        parallel=parallel,
    )


def failures(results: Sequence[BuildResult]) -> list[str]:
    """A line per table that failed or was left out."""
    return [
        f"{r.table}: {r.error if r.error is not None else f'waits for {r.waits_for}'}"
        for r in results
        if r.state in ("failed", "waiting")
    ]
