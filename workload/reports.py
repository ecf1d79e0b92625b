"""Top lists, profiles and the exploratory reports on reshaped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators.analytics import profile, top_k
from lakestrata.plans.analyses import (
    best_rated,
    games_by,
    listings_by_category,
    platforms_by_category,
    recently_updated,
)
from workload.base import Source, check
from workload.joins import country_codes
from workload.members import LINE_PARTS_SQL, ORDER_CUSTOMERS_SQL, PERCENT_SQL, line_parts, order_customers


@check(
    "top_recent",
    "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id LIMIT 10",
)
def top_recent(t: Source) -> DataFrame:
    return top_k(t.events.select("event_id", "ts", "user_id"), "ts", 10, ["event_id"])


@check(
    "top_rated",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_rated(t: Source) -> DataFrame:
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@check(
    "profile_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
                   round(stddev({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
                   CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _PROFILED
    ),
)
def profile_numeric(t: Source) -> DataFrame:
    return profile(t.lineitem, _PROFILED).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    )


@check(
    "report_members",
    f"""
    WITH fact AS ({ORDER_CUSTOMERS_SQL}),
    unfolded AS (
        SELECT unnest(members) AS id FROM fact
        UNION ALL
        SELECT NULL FROM fact WHERE members IS NULL OR len(members) = 0),
    counts AS (SELECT id AS code, count(*) AS n FROM unfolded GROUP BY 1),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT coalesce(c_name, 'Undefined') AS label, n, {PERCENT_SQL} AS percent
    FROM counts CROSS JOIN totals LEFT JOIN customer ON code = c_custkey""",
)
def report_members(t: Source) -> DataFrame:
    games = order_customers(t).withColumnRenamed("o_orderkey", "id")
    dim = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return games_by(games, "members", dim)


_BY_CODE_SQL = f"""
    WITH counts AS (
        SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS code, count(*) AS n
        FROM customer GROUP BY 1),
    totals AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
    SELECT %s AS label, n, {PERCENT_SQL} AS percent
    FROM counts CROSS JOIN totals
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON code = n_nationkey"""


def _coded_customers(t: Source) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("category"),
    )


def _some_codes(t: Source) -> DataFrame:
    kept = t.nation.where("n_regionkey <> 2").select(F.col("n_name").alias("name"))
    return country_codes(t).join(kept, "name", "left_semi")


@check(
    "report_category",
    _BY_CODE_SQL % "CASE WHEN code IS NULL THEN 'Undefined' ELSE n_name END",
)
def report_category(t: Source) -> DataFrame:
    return platforms_by_category(_coded_customers(t), _some_codes(t))


@check("report_listing", _BY_CODE_SQL % "coalesce(n_name, 'Unknown')")
def report_listing(t: Source) -> DataFrame:
    return listings_by_category(_coded_customers(t), _some_codes(t))


@check(
    "report_recent",
    "SELECT event_type AS name, ts AS updated_at FROM events ORDER BY ts DESC, event_id LIMIT 10",
)
def report_recent(t: Source) -> DataFrame:
    return recently_updated(
        t.events.select(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("name"),
            F.col("ts").alias("updated_at"),
        )
    )


@check(
    "report_rated",
    """SELECT l_orderkey * 100 + l_linenumber AS id, l_shipdate::VARCHAR AS name, l_extendedprice AS rating
       FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey * 100 + l_linenumber LIMIT 10""",
)
def report_rated(t: Source) -> DataFrame:
    return best_rated(
        t.lineitem.select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("name"),
            F.col("l_extendedprice").alias("rating"),
        )
    )


@check(
    "report_years",
    f"""
    WITH fact AS ({LINE_PARTS_SQL}),
    unfolded AS (
        SELECT l_shipdate, unnest(members) AS part_id FROM fact
        UNION ALL
        SELECT l_shipdate, NULL FROM fact WHERE members IS NULL OR len(members) = 0)
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, count(part_id) AS members
    FROM unfolded GROUP BY 1""",
)
def report_years(t: Source) -> DataFrame:
    unfolded = line_parts(t).select("l_shipdate", F.explode_outer("members").alias("part_id"))
    return unfolded.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("part_id").alias("members")
    )
