"""Every registered query: its plan, and its rows against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from plans import forbidden_nodes
from verify import connect, difference
from workload import CHECKS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_agrees_with_sql(spark, db, name):
    ours = CHECKS[name].run(spark, FOLDER)
    assert forbidden_nodes(ours) == []
    assert difference(db, CHECKS[name], ours) is None


def test_driver_contract(spark):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert entry.entry(spark).columns == ["label", "n", "percent"]
