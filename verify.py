"""Compare every checked query with its SQL in DuckDB, row for row.

    python verify.py [sf folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload import CHECKS


# Spark type -> type the SQL side should report.
SAME_TYPE = {
    "bigint": "bigint",
    "int": "integer",
    "double": "double",
    "string": "varchar",
    "boolean": "boolean",
    "timestamp_ntz": "timestamp",
}


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if hasattr(value, "as_integer_ratio") and not isinstance(value, bool):
        return float(f"{float(value):.10g}")
    return str(value) if value is not None and not isinstance(value, bool) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def compare(spark, db, check, folder: str) -> str | None:
    """None if Spark and SQL agree, else what differs."""
    return difference(db, check, check.run(spark, folder))


def difference(db, check, ours) -> str | None:
    got = rows_of(ours.columns, ours.collect())
    if check.sql is None:
        return None
    theirs = db.execute(check.sql)
    columns = [d[0] for d in theirs.description]
    kinds = {d[0]: str(d[1]).lower() for d in theirs.description}
    if sorted(columns) != sorted(ours.columns):
        return f"columns {sorted(ours.columns)} != {sorted(columns)}"
    odd = {
        f.name: (f.dataType.simpleString(), kinds[f.name])
        for f in ours.schema.fields
        if SAME_TYPE.get(f.dataType.simpleString()) not in (None, kinds[f.name])
    }
    if odd:
        return f"types {odd}"
    want = rows_of(columns, theirs.fetchall())
    if got != want:
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
        )
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CHECKS)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, db, CHECKS[name], folder)
        except Exception as error:  # noqa: BLE001 - reported below
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
