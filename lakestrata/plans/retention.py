"""Which old versions of a layer may go: those no reader has still to see."""

from __future__ import annotations

from collections.abc import Iterable

from lakestrata.plans.context import CONTEXT_TABLES
from lakestrata.plans import matching
from lakestrata.plans.control import LANDING_RUN, TABLE_RUN, control_or_empty, last_run_time
from lakestrata.plans.lake import Lake
from lakestrata.plans.marts import MARTS
from lakestrata.plans.runner import TableSpec
from lakestrata.sources.catalog import discover_tables
from lakestrata.sources.snapshot import expire_versions


def expire_layer(
    lake: Lake,
    layer: str,
    *,
    older_than: int,
    keep: int = 1,
    readers: Iterable[TableSpec] = (*CONTEXT_TABLES.values(), *MARTS.values()),
) -> list[tuple[str, int]]:
    """Remove the versions of all tables of a layer that were replaced before `older_than` and are read no more.

    What a reader's last run saw, and everything since, stays; the work-list of the matching compares with the
    version of its last run, so it is a reader too.  Returns table and version of each one removed.
    """
    readers = list(readers)
    runs = {r.target: last_run_time(control_or_empty(lake.spark, lake.control_path(r.target), TABLE_RUN)) for r in readers}
    removed = []
    for table in discover_tables(lake.spark, lake.root, layer, "history").orderBy("path").collect():
        read_at = [runs[r.target] for r in readers if any(lake.path(s) == table["path"] for s in r.sources)]
        if table["path"] == lake.path(matching.GAMES):
            read_at.append(last_run_time(control_or_empty(lake.spark, lake.control_path(matching.LANDED), LANDING_RUN)))
        for version in expire_versions(lake.spark, table["path"], older_than=older_than, read_at=read_at, keep=keep):
            removed.append((table["path"].removeprefix(f"{lake.root}/"), version))
    return removed
