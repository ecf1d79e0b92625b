"""Global row numbers and fixed-size chunks without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.schemas import COUNT, local_frame, schema
from lakestrata.sources.scratch import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row position below


def assign_chunks(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Add `row_num` (1..n in `order`) and `chunk_num` = (row_num - 1) div size.

    A range sort spreads the rows; every task numbers its own range.  Only the
    row count per range comes to the driver, one number per task.  `order`
    should be unique, which also lets the sort split a hot value.
    """
    numbered = materialize(
        df.orderBy(*order).withColumn("__pos", F.monotonically_increasing_id()), "chunks"
    )
    located = numbered.withColumns(
        {
            "__range": F.shiftright("__pos", _LOCAL_BITS),
            "__local": F.col("__pos").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    )
    counts = sorted(
        located.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    starts = accumulate((r["n"] for r in counts), initial=0)
    offsets = local_frame(
        df.sparkSession,
        schema(__range=COUNT, __start=COUNT),
        [{"__range": r["__range"], "__start": start} for r, start in zip(counts, starts)],
    )
    # One row per sort task, so the broadcast is bounded by the partition count.
    return (
        located.join(F.broadcast(offsets), "__range")
        .withColumn("row_num", F.col("__start") + F.col("__local") + 1)
        .withColumn("chunk_num", F.expr(f"(row_num - 1) div {int(size)}"))
        .select(*df.columns, "row_num", "chunk_num")
    )


def chunk(df: DataFrame, k: int) -> DataFrame:
    """The rows of one chunk, without the numbering columns."""
    return df.where(F.col("chunk_num") == k).drop("row_num", "chunk_num")
