"""Latest record, upsert, change detection, work-lists and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.expressions import hms, local_date
from lakestrata.operators.changes import (
    changed_rows,
    differing_rows,
    new_or_changed,
    not_in,
    schema_diff,
    upsert,
)
from lakestrata.operators.chunks import assign_chunks, chunk
from lakestrata.operators.dedup import has_duplicates, latest_by
from lakestrata.operators.match import refresh_worklist
from lakestrata.plans.control import last_run, staleness, unread_dates
from workload.base import Source, check


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


@check(
    "latest_per_key",
    """SELECT event_id, ts, user_id, event_type FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
           FROM events) WHERE r = 1""",
)
def latest_per_key(t: Source) -> DataFrame:
    events = t.events.select("event_id", "ts", "user_id", "event_type")
    return latest_by(events, "user_id", "ts", ["event_id"])


@check(
    "latest_with_ties",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
           SELECT *, row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r
           FROM lineitem) WHERE r = 1""",
)
def latest_with_ties(t: Source) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    ties = ["l_partkey", "l_suppkey", "l_extendedprice"]
    return latest_by(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


@check(
    "duplicate_keys",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
              count(*) <> count(DISTINCT (l_orderkey, l_linenumber)) AS has_duplicates
       FROM lineitem""",
)
def duplicate_keys(t: Source) -> DataFrame:
    return has_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


def _base(t: Source) -> DataFrame:
    return t.events.where(F.col("ts") < at("2024-01-21")).select(
        "event_id", "user_id", "event_type", "value", "props"
    )


def _late(t: Source) -> DataFrame:
    return t.events.where(F.col("ts") >= at("2024-01-11")).select(
        "event_id", "user_id", "event_type", (F.col("value") + 1).alias("value"), "props"
    )


@check(
    "upsert_events",
    """SELECT event_id, user_id, event_type,
              CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN value + 1 ELSE value END AS value, props
       FROM events""",
)
def upsert_events(t: Source) -> DataFrame:
    return upsert(_base(t), _late(t), "event_id")


def _late_partial(t: Source) -> DataFrame:
    """Updates that lack `props` and bring a new column."""
    return _late(t).drop("props").withColumn("note", F.upper("event_type"))


@check(
    "upsert_partial",
    """SELECT event_id, user_id, event_type,
              CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN value + 1 ELSE value END AS value,
              CASE WHEN ts < TIMESTAMP '2024-01-21' THEN props END AS props,
              CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN upper(event_type) END AS note
       FROM events""",
)
def upsert_partial(t: Source) -> DataFrame:
    return upsert(_base(t), _late_partial(t), "event_id")


@check(
    "upsert_overwrite",
    """SELECT event_id, user_id, event_type,
              CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN value + 1 ELSE value END AS value,
              CASE WHEN ts < TIMESTAMP '2024-01-11' THEN props END AS props,
              CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN upper(event_type) END AS note
       FROM events""",
)
def upsert_overwrite(t: Source) -> DataFrame:
    return upsert(_base(t), _late_partial(t), "event_id", overwrite_missing=True)


@check(
    "changed_rows",
    """SELECT l_orderkey, l_returnflag FROM lineitem
       EXCEPT ALL
       SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O'""",
)
def changed(t: Source) -> DataFrame:
    current = t.lineitem.select("l_orderkey", "l_returnflag")
    previous = t.lineitem.where("l_linestatus = 'O'").select("l_returnflag", "l_orderkey")
    return changed_rows(current, previous)


_LINES = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@check(
    "changed_lines",
    f"""WITH now AS (
           SELECT {_LINES.replace("l_tax", "CASE WHEN l_orderkey % 50 = 0 THEN l_tax + 1 ELSE l_tax END AS l_tax")
                        .replace("l_returnflag", "CASE WHEN l_orderkey % 77 <> 0 THEN l_returnflag END AS l_returnflag")}
           FROM lineitem
           UNION ALL SELECT {_LINES} FROM lineitem WHERE l_orderkey % 90 = 1)
       SELECT * FROM now EXCEPT ALL SELECT {_LINES} FROM lineitem""",
)
def changed_lines(t: Source) -> DataFrame:
    """Some lines taxed anew, some with a null, some doubled, out of all columns of all lines."""
    lines = t.lineitem
    now = lines.withColumns(
        {
            "l_tax": F.when(F.col("l_orderkey") % 50 == 0, F.col("l_tax") + 1).otherwise(F.col("l_tax")),
            "l_returnflag": F.when(F.col("l_orderkey") % 77 != 0, F.col("l_returnflag")),
        }
    )
    return changed_rows(now.unionByName(lines.where(F.col("l_orderkey") % 90 == 1)), lines)


def _versions(t: Source) -> tuple[DataFrame, DataFrame]:
    """Orders now, and as they were before the finished ones got dearer and the last year came."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    before = t.orders.where(F.col("o_orderdate") < at("2001-01-01")).withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") - 1).otherwise(
            F.col("o_totalprice")
        ),
    )
    return t.orders.select(*columns), before.select(*columns)


_CHANGED_ORDERS = "(o_orderstatus = 'F' OR o_orderdate >= TIMESTAMP '2001-01-01')"


@check(
    "new_not_held",
    f"""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        WHERE {_CHANGED_ORDERS} AND o_orderpriority <> '1-URGENT'""",
)
def new_not_held(t: Source) -> DataFrame:
    current, previous = _versions(t)
    held = t.orders.where("o_orderpriority = '1-URGENT'")
    return new_or_changed(current, previous, held, "o_orderkey")


@check(
    "worklist",
    f"""SELECT o_orderkey, 'id' AS search, NULL::VARCHAR AS o_orderstatus,
               NULL::DOUBLE AS o_totalprice
        FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT o_orderkey, 'name', o_orderstatus, o_totalprice FROM orders
        WHERE {_CHANGED_ORDERS} AND o_orderpriority <> '1-URGENT'""",
)
def worklist(t: Source) -> DataFrame:
    current, previous = _versions(t)
    held = t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return refresh_worklist(current, previous, held, "o_orderkey")


@check(
    "has_changed",
    """WITH old AS (
           SELECT o_orderkey, o_orderstatus,
                  CASE WHEN o_orderstatus = 'F' THEN o_totalprice - 1 ELSE o_totalprice END AS price
           FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
       new AS (SELECT o_orderkey, o_orderstatus, o_totalprice AS price FROM orders)
       SELECT 'old' AS side, count(*) AS n FROM (SELECT * FROM old EXCEPT SELECT * FROM new)
       UNION ALL
       SELECT 'new', count(*) FROM (SELECT * FROM new EXCEPT SELECT * FROM old)""",
)
def has_changed_sides(t: Source) -> DataFrame:
    current, previous = _versions(t)
    return differing_rows(previous, current).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@check(
    "anti_unlabelled",
    """SELECT doc_id, lang, source FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def anti_unlabelled(t: Source) -> DataFrame:
    return not_in(t.documents.select("doc_id", "lang", "source"), t.labels, "doc_id")


_CHUNKS_SQL = """
    SELECT o_orderkey, o_orderdate, row_num, (row_num - 1) // 150 AS chunk_num FROM (
        SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders)"""


@check("chunks", _CHUNKS_SQL)
def chunks(t: Source) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return assign_chunks(orders, ["o_orderdate", "o_orderkey"], 150)


@check("chunk_rows", f"SELECT o_orderkey, o_orderdate FROM ({_CHUNKS_SQL}) WHERE chunk_num = 3")
def chunk_rows(t: Source) -> DataFrame:
    return chunk(chunks(t), 3)


@check(
    "schema_columns",
    """SELECT p_partkey, d.kind, CASE d.kind WHEN 'only_left' THEN p_size::VARCHAR
              WHEN 'only_right' THEN p_brand ELSE (p_size * 2)::VARCHAR END AS value
       FROM part, (VALUES ('only_left'), ('only_right'), ('retyped')) AS d(kind)""",
)
def schema_columns(t: Source) -> DataFrame:
    """Per part the values of the columns that two versions of the table do not share."""
    old = t.part.select("p_partkey", "p_name", "p_size", (F.col("p_size") * 2).alias("stock"))
    new = t.part.select("p_partkey", "p_name", F.col("p_brand").alias("brand"), (F.col("p_size") * 2).cast("string").alias("stock"))
    diff = schema_diff(old.schema, new.schema)
    sides = {"only_left": old, "only_right": new, "retyped": new}
    parts = [
        sides[kind].select("p_partkey", F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"))
        for kind, names in vars(diff).items()
        for c in names
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _runs(events: DataFrame) -> DataFrame:
    """A landing run log: every event is a run that loaded `value` files."""
    return events.select(
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("Exec_time"),
        F.floor("value").alias("Loaded_files"),
    )


@check(
    "exec_dates",
    """SELECT DISTINCT strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS exec_date FROM events
       WHERE floor(value) > 0
         AND strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') > (
             SELECT max(strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d')) FROM events
             WHERE ts < TIMESTAMP '2024-01-10')""",
)
def exec_dates(t: Source) -> DataFrame:
    read = _runs(t.events.where(F.col("ts") < at("2024-01-10"))).withColumn(
        "Loaded_date", local_date(F.col("Exec_time"))
    )
    return unread_dates(_runs(t.events), read)


@check(
    "exec_dates_first",
    """SELECT DISTINCT strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS exec_date FROM events
       WHERE floor(value) > 0""",
)
def exec_dates_first(t: Source) -> DataFrame:
    return unread_dates(_runs(t.events), None)


@check(
    "stale_gate",
    """WITH runs AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events),
       gate AS (SELECT (SELECT max(e) FROM runs WHERE event_type = 'purchase') AS target_run,
                       (SELECT max(e) FROM runs WHERE event_type IN ('view', 'click')) AS source_run)
       SELECT target_run, source_run, source_run > target_run AS is_stale FROM gate""",
)
def stale_gate(t: Source) -> DataFrame:
    def log(kind: str) -> DataFrame:
        return _runs(t.events.where(F.col("event_type") == kind))

    return staleness(log("purchase"), [log("view"), log("click")])


@check(
    "run_log",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS table_rows,
              CAST(floor(epoch(max(ts))) AS BIGINT) AS exec_time,
              strftime(TIMESTAMP '2024-01-01'
                       + to_seconds(CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT)),
                       '%H:%M:%S') AS total_duration
       FROM events GROUP BY 1""",
)
def run_log(t: Source) -> DataFrame:
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return (
        t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("table_rows"),
            F.max(epoch).alias("exec_time"),
            hms(F.max(epoch) - F.min(epoch)).alias("total_duration"),
        )
    )


@check("last_run", "SELECT CAST(floor(epoch(max(ts))) AS BIGINT) AS last_run FROM events")
def last_run_of_events(t: Source) -> DataFrame:
    return last_run(_runs(t.events))
