"""Decodes, lookups, parents and the column operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from lakestrata.functions.expressions import (
    mean_of_present,
    mean_with_total,
    platform_family,
    similarity,
)
from lakestrata.functions.schemas import COUNT
from lakestrata.operators.analytics import earliest
from lakestrata.operators.columns import (
    align_columns,
    drop_columns,
    epoch_to_timestamp,
    fill_label,
    incremental_filter,
    rename,
    sort_columns,
)
from lakestrata.operators.enrich import decode, fan_out, lookup, with_parent
from lakestrata.operators.match import best_match, pick_best, similar_names
from workload.base import Source, check


def country_codes(t: Source) -> DataFrame:
    """Nations as an enum list: text codes, zero padded."""
    return t.nation.select(
        F.col("n_name").alias("name"),
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("value"),
    )


@check(
    "decode_country",
    """SELECT c_custkey, n_name AS c_nationkey
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_country(t: Source) -> DataFrame:
    return decode(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", country_codes(t))


@check(
    "decode_into",
    """SELECT s_suppkey, s_nationkey, n_name AS country
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def decode_into(t: Source) -> DataFrame:
    return decode(
        t.supplier.select("s_suppkey", "s_nationkey"),
        "s_nationkey",
        country_codes(t),
        into="country",
    )


@check(
    "decode_optional",
    """SELECT c_custkey, n_name AS c_nationkey, c_mktsegment
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_optional(t: Source) -> DataFrame:
    """One column has an enum list, the other one has none and stays."""
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return decode(decode(customers, "c_mktsegment", None, optional=True), "c_nationkey", country_codes(t))


@check(
    "decode_unmatched",
    """SELECT c_custkey, n_name AS c_nationkey
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0)
       ON c_nationkey = n_nationkey""",
)
def decode_unmatched(t: Source) -> DataFrame:
    codes = t.nation.select(
        F.col("n_name").alias("name"),
        F.when(F.col("n_regionkey") == 0, "zz")
        .otherwise(F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
        .alias("value"),
    )
    return decode(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", codes)


@check(
    "lookup_replace",
    """SELECT s_suppkey, s_name, n_name AS nation
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def lookup_replace(t: Source) -> DataFrame:
    suppliers = t.supplier.select("s_suppkey", "s_name", F.col("s_nationkey").alias("nation"))
    return lookup(suppliers, "nation", t.nation, {"n_name": "nation"}, dim_key="n_nationkey")


@check(
    "lookup_keep_id",
    """SELECT o_orderkey, c_custkey AS customer_id, c_name AS customer_name
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY')
       ON o_custkey = c_custkey""",
)
def lookup_keep_id(t: Source) -> DataFrame:
    return lookup(
        t.orders.select("o_orderkey", "o_custkey"),
        "o_custkey",
        t.customer.where("c_mktsegment <> 'MACHINERY'"),
        {"c_custkey": "customer_id", "c_name": "customer_name"},
        dim_key="c_custkey",
    )


@check(
    "two_key_first_date",
    """WITH firsts AS (
           SELECT l_orderkey, l_partkey, min(l_shipdate) AS first_date,
                  min(year(l_shipdate)) AS first_year
           FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2)
       SELECT l.l_orderkey, l.l_partkey, l_linenumber, first_date,
              CAST(first_year AS INTEGER) AS first_year
       FROM lineitem l LEFT JOIN firsts f
         ON l.l_orderkey = f.l_orderkey AND l.l_partkey = f.l_partkey""",
)
def two_key_first_date(t: Source) -> DataFrame:
    keys = ["l_orderkey", "l_partkey"]
    dates = t.lineitem.where("l_returnflag <> 'R'").withColumn("y", F.year("l_shipdate"))
    firsts = earliest(dates, keys, {"first_date": "l_shipdate", "first_year": "y"})
    return t.lineitem.select(*keys, "l_linenumber").join(firsts, keys, "left")


@check(
    "parent_self",
    """WITH parts AS (
           SELECT p_partkey, p_name, nullif(p_partkey // 10, 0) AS parent FROM part)
       SELECT c.p_partkey, c.p_name, coalesce(c.parent, c.p_partkey) AS parent,
              coalesce(p.p_name, c.p_name) AS parent_name
       FROM parts c LEFT JOIN parts p ON c.parent = p.p_partkey""",
)
def parent_self(t: Source) -> DataFrame:
    parts = t.part.select(
        "p_partkey", "p_name", F.expr("nullif(p_partkey div 10, 0)").alias("parent")
    )
    return with_parent(parts, "p_partkey", "parent", "p_name")


@check(
    "fanout_chain",
    """SELECT o_orderkey, o_orderdate, l_linenumber, l_suppkey, s_name, n_name AS nation
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def fanout_chain(t: Source) -> DataFrame:
    lines = fan_out(
        t.orders.select("o_orderkey", "o_orderdate"),
        "o_orderkey",
        t.lineitem,
        {"l_linenumber": "l_linenumber", "l_suppkey": "l_suppkey"},
        other_key="l_orderkey",
    )
    supplied = lookup(
        lines,
        "l_suppkey",
        t.supplier,
        {"s_name": "s_name", "s_nationkey": "nation"},
        dim_key="s_suppkey",
        keep_key=True,
    )
    return lookup(supplied, "nation", t.nation, {"n_name": "nation"}, dim_key="n_nationkey")


@check(
    "blend_ratings",
    """WITH scored AS (
           SELECT d.doc_id, CASE WHEN lang = 'en' THEN n_chars / 100.0::DOUBLE END AS a,
                  CAST(quality AS DOUBLE) AS b
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       SELECT doc_id, (coalesce(a, b) + coalesce(b, a)) / 2 AS users,
              (a + coalesce(b, a)) / 2 AS total
       FROM scored""",
)
def blend_ratings(t: Source) -> DataFrame:
    documents = t.documents.select(
        "doc_id", F.when(F.col("lang") == "en", F.col("n_chars") / F.lit(100.0)).alias("a")
    )
    scored = lookup(
        documents, "doc_id", t.labels, {"quality": "b"}, dim_key="doc_id", keep_key=True
    ).withColumn("b", F.col("b").cast("double"))
    a, b = F.col("a"), F.col("b")
    return scored.select(
        "doc_id", mean_of_present(a, b).alias("users"), mean_with_total(a, b).alias("total")
    )


_CATEGORY_SQL = """CASE p_type WHEN 'ECONOMY' THEN 'arcade' WHEN 'SMALL' THEN 'console'
    WHEN 'STANDARD' THEN 'operating_system' WHEN 'PROMO' THEN 'computer'
    WHEN 'MEDIUM' THEN 'portable_console' END"""


@check(
    "family_rule",
    f"""WITH named AS (
            SELECT p_partkey, {_CATEGORY_SQL} AS category,
                   CASE WHEN p_size > 40 THEN p_brand END AS family,
                   CASE WHEN p_size < 10 THEN 'Android' ELSE p_name END AS name
            FROM part)
        SELECT p_partkey, coalesce(
            CASE WHEN family IS NOT NULL THEN family
                 WHEN category = 'operating_system' AND name IN ('iOS', 'Android', 'BlackBerry OS',
                      'Windows Mobile', 'Palm OS', 'Windows Phone') THEN 'Mobile'
                 WHEN category IN ('operating_system', 'computer') THEN 'Computer'
                 WHEN category = 'arcade' THEN 'Arcade'
                 WHEN category = 'console' THEN 'Other Consoles'
                 WHEN category = 'portable_console' THEN 'Portable Console'
                 WHEN category = 'platform' THEN 'Cloud Gaming' END, '(none)') AS family
        FROM named""",
)
def family_rule(t: Source) -> DataFrame:
    family = platform_family(
        F.when(F.col("p_size") > 40, F.col("p_brand")),
        F.expr(_CATEGORY_SQL),
        F.when(F.col("p_size") < 10, "Android").otherwise(F.col("p_name")),
    )
    return fill_label(t.part.select("p_partkey", family.alias("family")), {"family": "(none)"})


@check(
    "epoch_columns",
    """SELECT event_id, date_trunc('second', ts) AS at, CAST(year(ts) AS INTEGER) AS year FROM events""",
)
def epoch_columns(t: Source) -> DataFrame:
    stamped = t.events.select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at")
    )
    return epoch_to_timestamp(stamped, ["at"]).select(
        "event_id", F.col("at").cast("timestamp_ntz").alias("at"), F.year("at").alias("year")
    )


@check(
    "columns_ops",
    """SELECT p_brand, p_partkey, p_name AS part_name, p_retailprice, CAST(NULL AS BIGINT) AS stock
       FROM part""",
)
def columns_ops(t: Source) -> DataFrame:
    parts = drop_columns(t.part, ["p_size", "p_type", "not_there"])
    parts = rename(parts, {"p_name": "part_name"})
    wanted = StructType([*parts.schema.fields, StructField("stock", COUNT)])
    return sort_columns(align_columns(parts, wanted))


@check(
    "regex_url",
    "SELECT page_id, regexp_replace(url, 'example', 'mirror', 'g') AS url FROM pages",
)
def regex_url(t: Source) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("url", "example", "mirror").alias("url"))


@check(
    "incremental_filter",
    """SELECT event_id, ts, value FROM events
       WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')""",
)
def incremental(t: Source) -> DataFrame:
    earlier = t.events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    mark = earlier.agg(F.max("ts").alias("ts")).first()["ts"]
    since = F.lit(mark).cast("timestamp_ntz")
    return incremental_filter(t.events, "ts", since).select("event_id", "ts", "value")


def _named_parts(t: Source) -> tuple[DataFrame, DataFrame]:
    """Parts, and the same parts under names that carry their brand number."""
    left = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("year")
    )
    right = t.part.select(
        F.col("p_partkey").alias("cand_id"),
        F.concat("p_name", F.substring("p_brand", 7, 9)).alias("name"),
        F.col("p_size").alias("year"),
    )
    return left, right


# All pairs of distinct names, scored; the winner per part by the tie rule.
BEST_MATCH_SQL = """
    WITH a AS (SELECT DISTINCT p_name AS lname FROM part),
    b AS (SELECT p_name || substr(p_brand, 7) AS rname, p_size AS y, count(*) AS n,
                 min(p_partkey) AS first FROM part GROUP BY 1, 2),
    names AS (SELECT DISTINCT rname FROM b),
    scored AS (
        SELECT lname, rname,
               1 - levenshtein(lname, rname)::DOUBLE / greatest(length(lname), length(rname)) AS sim
        FROM a, names),
    top AS (SELECT lname, rname, sim FROM (
                SELECT *, max(sim) OVER (PARTITION BY lname) AS best FROM scored WHERE sim > 0.8)
            WHERE sim = best),
    ties AS (SELECT lname, y, sum(n) AS n, min(first) AS first, max(sim) AS sim
             FROM top JOIN b USING (rname) GROUP BY 1, 2),
    sole AS (SELECT lname, sum(n) AS n, min(first) AS first, max(sim) AS sim FROM ties GROUP BY 1)
    SELECT p_partkey AS id, CASE WHEN sole.n = 1 THEN sole.first ELSE ties.first END AS cand_id,
           round(sole.sim, 9) AS similarity
    FROM part JOIN sole ON p_name = sole.lname
    LEFT JOIN ties ON p_name = ties.lname AND p_size = ties.y
    WHERE CASE WHEN sole.n = 1 THEN sole.first ELSE ties.first END IS NOT NULL"""


@check("best_match", BEST_MATCH_SQL)
def best_match_parts(t: Source) -> DataFrame:
    left, right = _named_parts(t)
    return best_match(left, right).withColumn("similarity", F.round("similarity", 9))


@check(
    "best_match_customers",
    """WITH scored AS (
           SELECT a.c_custkey AS id, b.c_custkey AS cand_id,
                  1 - levenshtein(a.c_name, b.c_name || 'x')::DOUBLE
                      / greatest(length(a.c_name), length(b.c_name) + 1) AS sim
           FROM customer a, customer b),
       top AS (SELECT *, max(sim) OVER (PARTITION BY id) AS best FROM scored WHERE sim > 0.8)
       SELECT id, min(cand_id) AS cand_id, round(max(sim), 9) AS similarity FROM top
       WHERE sim = best GROUP BY id HAVING count(*) = 1""",
)
def best_match_customers(t: Source) -> DataFrame:
    """Names that differ in a few digits, against the same names with one letter more."""
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("int").alias("year"))
    right = t.customer.select(F.col("c_custkey").alias("cand_id"), F.concat("c_name", F.lit("x")).alias("name"), F.lit(1).alias("year"))
    return best_match(left, right).withColumn("similarity", F.round("similarity", 9))


@check(
    "similar_names_low",
    """WITH a AS (SELECT DISTINCT 'Cust#' || substr(c_name, 13) || n_name AS l FROM customer JOIN nation ON c_nationkey = n_nationkey),
       b AS (SELECT DISTINCT c_name || n_name AS r FROM customer JOIN nation ON c_nationkey = n_nationkey)
       SELECT l AS lname, r AS rname, round(1 - levenshtein(l, r)::DOUBLE / greatest(length(l), length(r)), 9) AS similarity
       FROM a, b WHERE round(1 - levenshtein(l, r)::DOUBLE / greatest(length(l), length(r)), 12) > 0.6""",
)
def similar_names_low(t: Source) -> DataFrame:
    """Shortened customer names with their nation against whole ones, at a threshold of 0.6."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    short = F.concat(F.lit("Cust#"), F.substring("c_name", 13, 99), "n_name")
    return similar_names(named.select(short.alias("name")), named.select(F.concat("c_name", "n_name").alias("name")), 0.6).withColumn("similarity", F.round("similarity", 9))


@check(
    "best_match_low",
    """WITH b AS (SELECT c_custkey AS cand_id, c_name || c_mktsegment AS r FROM customer),
       scored AS (SELECT a.c_custkey AS id, cand_id,
                         1 - levenshtein(upper(a.c_mktsegment) || substr(a.c_name, 13), r)::DOUBLE
                             / greatest(length(a.c_mktsegment) + length(a.c_name) - 12, length(r)) AS sim FROM customer a, b),
       top AS (SELECT *, max(sim) OVER (PARTITION BY id) AS best FROM scored WHERE round(sim, 12) > 0.35)
       SELECT id, min(cand_id) AS cand_id, round(max(sim), 9) AS similarity FROM top
       WHERE sim = best GROUP BY id HAVING count(*) = 1""",
)
def best_match_low(t: Source) -> DataFrame:
    """Segment and number against name and segment, which leaves a little more than a third alike."""
    none, one = F.lit(None).cast("int").alias("year"), F.lit(1).alias("year")
    short = F.concat(F.upper("c_mktsegment"), F.substring("c_name", 13, 99)).alias("name")
    left = t.customer.select(F.col("c_custkey").alias("id"), short, none)
    right = t.customer.select(F.col("c_custkey").alias("cand_id"), F.concat("c_name", "c_mktsegment").alias("name"), one)
    return best_match(left, right, 0.35).withColumn("similarity", F.round("similarity", 9))


@check(
    "pick_best",
    """WITH hits AS (
           SELECT o_orderkey AS id, year(o_orderdate) AS y, l_partkey AS cand_id,
                  year(l_shipdate) AS cy, 1 - l_discount AS sim
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
       ranked AS (SELECT *, max(sim) OVER (PARTITION BY id) AS best FROM hits WHERE sim > 0.8),
       top AS (SELECT id, count(*) AS n, min(cand_id) AS first, max(sim) AS sim,
                      min(CASE WHEN y = cy THEN cand_id END) AS dated
               FROM ranked WHERE sim = best GROUP BY id)
       SELECT id, CASE WHEN n = 1 THEN first ELSE dated END AS cand_id,
              round(sim, 9) AS similarity
       FROM top WHERE CASE WHEN n = 1 THEN first ELSE dated END IS NOT NULL""",
)
def pick_best_lines(t: Source) -> DataFrame:
    hits = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.col("l_partkey").alias("cand_id"),
        F.year("l_shipdate").alias("cand_year"),
        (1 - F.col("l_discount")).alias("similarity"),
    )
    return pick_best(hits).withColumn("similarity", F.round("similarity", 9))


@check(
    "name_similarity",
    """SELECT p_partkey, round(1 - levenshtein(p_name, p_type)::DOUBLE
              / greatest(length(p_name), length(p_type)), 9) AS similarity FROM part""",
)
def name_similarity(t: Source) -> DataFrame:
    return t.part.select(
        "p_partkey", F.round(similarity(F.col("p_name"), F.col("p_type")), 9).alias("similarity")
    )
