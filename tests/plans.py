"""Reading physical plans."""

from __future__ import annotations

import re

PYTHON_AND_CROSS = (
    "PythonUDF",
    "BatchEvalPython",
    "ArrowEvalPython",
    "CartesianProduct",
    "NestedLoopJoin",
)


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def forbidden_nodes(df) -> list[str]:
    """Python workers, cross joins, and windows that put all rows in one task."""
    text = plan(df)
    found = [node for node in PYTHON_AND_CROSS if node in text]
    windows = re.findall(r"\+- Window \[.*", text)
    return found + [w for w in windows if w.rstrip().endswith("[]")]
