"""Membership arrays and shares.

Arrays are made from each row's own columns: null, empty, one or two members,
some of which no dimension row matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators.analytics import share_by
from lakestrata.operators.membership import membership
from workload.base import Source, check


def line_parts(t: Source) -> DataFrame:
    """Line items with the parts they offer."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), F.lit(None))
        .when(F.col("l_quantity") > 45, F.array().cast("array<bigint>"))
        .otherwise(F.array("l_partkey", F.col("l_partkey") + 1))
        .alias("members"),
    )


LINE_PARTS_SQL = """
    SELECT l_orderkey, l_linenumber, l_shipdate,
           CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL
                WHEN l_quantity > 45 THEN []::BIGINT[]
                ELSE [l_partkey, l_partkey + 1] END AS members
    FROM lineitem"""


def order_customers(t: Source) -> DataFrame:
    """Orders with the customers that may take them."""
    return t.orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderkey") % 7 == 1, F.array().cast("array<bigint>"))
        .otherwise(F.array("o_custkey", F.col("o_custkey") * 2))
        .alias("members"),
    )


ORDER_CUSTOMERS_SQL = """
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN o_orderkey % 7 = 1 THEN []::BIGINT[]
                ELSE [o_custkey, o_custkey * 2] END AS members
    FROM orders"""


@check(
    "membership_parts",
    f"""
    WITH fact AS ({LINE_PARTS_SQL}),
    unfolded AS (
        SELECT l_orderkey, l_linenumber, unnest(members) AS part_id FROM fact
        UNION ALL
        SELECT l_orderkey, l_linenumber, NULL FROM fact WHERE members IS NULL)
    SELECT l_orderkey, l_linenumber, part_id,
           coalesce(p_name, '(none)') AS part_name, p_brand AS part_brand
    FROM unfolded LEFT JOIN part ON part_id = p_partkey""",
)
def membership_parts(t: Source) -> DataFrame:
    return membership(
        line_parts(t),
        ["l_orderkey", "l_linenumber"],
        "members",
        "part_id",
        t.part,
        {"p_name": "part_name", "p_brand": "part_brand"},
        {"part_name": "(none)"},
        dim_key="p_partkey",
    )


def _customers(t: Source, empty: str) -> DataFrame:
    return membership(
        order_customers(t),
        ["o_orderkey"],
        "members",
        "customer_id",
        t.customer,
        {"c_mktsegment": "segment"},
        {"segment": "(none)"},
        dim_key="c_custkey",
        empty=empty,
    )


def _customers_sql(without_members: str) -> str:
    return f"""
    WITH fact AS ({ORDER_CUSTOMERS_SQL}),
    unfolded AS (
        SELECT o_orderkey, unnest(members) AS customer_id FROM fact
        UNION ALL
        SELECT o_orderkey, NULL FROM fact WHERE {without_members})
    SELECT o_orderkey, customer_id, coalesce(c_mktsegment, '(none)') AS segment
    FROM unfolded LEFT JOIN customer ON customer_id = c_custkey"""


@check("membership_empty_drop", _customers_sql("members IS NULL"))
def membership_empty_drop(t: Source) -> DataFrame:
    return _customers(t, "drop")


@check("membership_empty_keep", _customers_sql("members IS NULL OR len(members) = 0"))
def membership_empty_keep(t: Source) -> DataFrame:
    return _customers(t, "keep")


# Half-up rounding in whole numbers, as the library does it.
PERCENT_SQL = "CAST((n * 20000 + total) // (total * 2) AS DOUBLE) / 100"


@check(
    "share_parts",
    f"""
    WITH fact AS ({LINE_PARTS_SQL}),
    unfolded AS (
        SELECT unnest(members) AS part_id FROM fact
        UNION ALL
        SELECT NULL FROM fact WHERE members IS NULL OR len(members) = 0),
    counts AS (SELECT part_id, count(*) AS n FROM unfolded GROUP BY part_id),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT coalesce(p_name, 'Undefined') AS label, n, {PERCENT_SQL} AS percent
    FROM counts CROSS JOIN totals LEFT JOIN part ON part_id = p_partkey""",
)
def share_parts(t: Source) -> DataFrame:
    return share_by(
        line_parts(t),
        "members",
        t.part,
        label="p_name",
        dim_key="p_partkey",
        count="l_orderkey",
        explode=True,
    )


@check(
    "share_plain",
    f"""
    WITH counts AS (SELECT c_mktsegment AS label, count(*) AS n FROM customer GROUP BY 1),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT label, n, {PERCENT_SQL} AS percent FROM counts CROSS JOIN totals""",
)
def share_plain(t: Source) -> DataFrame:
    return share_by(t.customer, "c_mktsegment", count="c_custkey")


@check(
    "share_unknown",
    f"""
    WITH counts AS (SELECT c_nationkey AS code, count(*) AS n FROM customer GROUP BY 1),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT coalesce(n_name, 'Unknown') AS label, n, {PERCENT_SQL} AS percent
    FROM counts CROSS JOIN totals
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON code = n_nationkey""",
)
def share_unknown(t: Source) -> DataFrame:
    return share_by(
        t.customer,
        "c_nationkey",
        t.nation.where("n_regionkey <> 0"),
        label="n_name",
        dim_key="n_nationkey",
        count="c_custkey",
        unknown="Unknown",
    )


@check(
    "share_null_key",
    f"""
    WITH counts AS (SELECT nullif(s_nationkey, 3) AS code, count(*) AS n FROM supplier GROUP BY 1),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT CASE WHEN code IS NULL THEN 'Undefined' ELSE n_name END AS label, n,
           {PERCENT_SQL} AS percent
    FROM counts CROSS JOIN totals
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON code = n_nationkey""",
)
def share_null_key(t: Source) -> DataFrame:
    return share_by(
        t.supplier.withColumn("code", F.expr("nullif(s_nationkey, 3)")),
        "code",
        t.nation.where("n_regionkey <> 0"),
        label="n_name",
        dim_key="n_nationkey",
        count="s_suppkey",
        unknown_only_for_null_key=True,
    )
