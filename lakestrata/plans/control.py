"""Run logs: when a table was built, from what, and whether it is due again."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from lakestrata.functions.expressions import local_date
from lakestrata.functions.schemas import COUNT, TEXT, schema
from lakestrata.sources.log import append_rows, log_folder, read_log

# Column names of the run logs, per layer.
LANDING_RUN = schema(
    nullable=False,
    Exec_date=TEXT,
    Exec_time=COUNT,
    Load_type=TEXT,
    Loaded_files=COUNT,
    Total_duration=TEXT,
)
MATCHED_LANDING_RUN = StructType(
    [*LANDING_RUN.fields, StructField("IGDB_Game_Version", COUNT, nullable=False)]
)
_CLOCK = schema(nullable=False, Exec_date=TEXT, Exec_time=COUNT, Total_duration=TEXT).fields
# The last ones are additions: records kept apart, columns whose type had to change, and why
# a run failed.  A failed run has no counts and is no run to the gates.
RAW_RUN = StructType(
    [
        *_CLOCK,
        *schema(
            Loaded_date=TEXT, Read_Rows=COUNT, Table_Rows=COUNT, Bad_Rows=COUNT, Retyped=TEXT, Error=TEXT
        ).fields,
    ]
)
TABLE_RUN = StructType([*_CLOCK, *schema(Table_Rows=COUNT, Error=TEXT).fields])

# Fixed value: dates are those of GMT-3.
OFFSET_HOURS = -3

ERROR_CHARS = 2000  # of a reason that is logged


@dataclass
class Run:
    """Clock of one job run; `record` gives its row for the log."""

    offset_hours: int = OFFSET_HOURS
    started: float = field(default_factory=time.time)

    @property
    def date(self) -> str:
        return self._local().strftime("%Y-%m-%d")

    @property
    def folder(self) -> str:
        """Name no other run of the table has; begins with the run's `Exec_time`."""
        return str(int(self.started * 1000))

    def _local(self) -> datetime:
        return datetime.fromtimestamp(self.started, timezone(timedelta(hours=self.offset_hours)))

    def record(self, **metrics: Any) -> dict[str, Any]:
        minutes, seconds = divmod(int(time.time() - self.started), 60)
        hours, minutes = divmod(minutes, 60)
        return {
            "Exec_date": self._local().strftime("%Y-%m-%d %H:%M:%S"),
            "Exec_time": int(self.started),
            "Total_duration": f"{hours:02d}:{minutes:02d}:{seconds:02d}",
            **metrics,
        }


def append_runs(
    spark: SparkSession, path: str, columns: StructType, records: Sequence[Mapping[str, Any]]
) -> None:
    """Append rows to the run log at `path`."""
    append_rows(spark, path, columns, records)


def append_run(
    spark: SparkSession, path: str, columns: StructType, record: Mapping[str, Any]
) -> None:
    append_runs(spark, path, columns, [record])


def append_failure(spark: SparkSession, path: str, columns: StructType, run: Run, error: Exception) -> str:
    """Log a run that failed, with its reason; returns the reason."""
    reason = f"{type(error).__name__}: {error}"[:ERROR_CHARS]
    append_run(spark, path, columns, run.record(Error=reason))
    return reason


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """A run log that must exist."""
    return spark.read.parquet(log_folder(spark, path))


def control_or_empty(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """A run log, empty before the first run."""
    return read_log(spark, path, columns)


def succeeded(control: DataFrame) -> DataFrame:
    """The runs of a log that did not fail."""
    return control.where(F.col("Error").isNull()) if "Error" in control.columns else control


def last_run(control: DataFrame) -> DataFrame:
    """One row `last_run`: time of the newest run, null if there was none; failed runs do not count."""
    return succeeded(control).agg(F.max("Exec_time").alias("last_run"))


def last_run_time(control: DataFrame) -> int | None:
    return last_run(control).first()["last_run"]


def plan_load(control: DataFrame) -> tuple[str, int | None]:
    """('Initial', None) before the first run, else ('Incremental', time of the last one)."""
    last = last_run_time(control)
    return ("Initial", None) if last is None else ("Incremental", last)


def staleness(target: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """One row: last target run, last source run, and whether the target is due.

    Due means never built, or some source ran strictly later.  A source without
    runs does not count.
    """
    newest = reduce(DataFrame.unionByName, [last_run(s) for s in sources])
    return (
        last_run(target)
        .withColumnRenamed("last_run", "target_run")
        .withColumn("source_run", newest.select(F.max("last_run")).scalar())
        .withColumn(
            "is_stale",
            F.col("target_run").isNull()
            | F.coalesce(F.col("source_run") > F.col("target_run"), F.lit(False)),
        )
    )


def is_stale(target: DataFrame, sources: Sequence[DataFrame]) -> bool:
    return staleness(target, sources).first()["is_stale"]


def unread_dates(
    source_control: DataFrame,
    target_control: DataFrame | None,
    *,
    offset_hours: int = OFFSET_HOURS,
    same_day: bool = False,
) -> DataFrame:
    """Landing dates still to read, ascending: `exec_date`.

    Dates of runs that loaded files, strictly after the last date read; all of
    them when nothing was read.  With `same_day` a date counts again if a run
    came after the last read, so a second landing on one day is not lost.
    """
    landed = source_control.where(F.col("Loaded_files") > 0).select(
        local_date(F.col("Exec_time"), offset_hours).alias("exec_date"), "Exec_time"
    )
    if target_control is not None:
        read = succeeded(target_control).agg(
            F.max("Loaded_date").alias("last_date"), F.max("Exec_time").alias("last_time")
        )
        later = F.col("exec_date") > F.coalesce(read.select("last_date").scalar(), F.lit(""))
        if same_day:
            later = later | (
                F.col("Exec_time") > F.coalesce(read.select("last_time").scalar(), F.lit(0))
            )
        landed = landed.where(later)
    return landed.select("exec_date").distinct().orderBy("exec_date")
