"""Landing files, snapshots, the raw layer, building and cataloguing, through real files.

Everything is written under the shared folder of the session and read back.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from lakestrata.functions.expressions import variant_field, variant_kind
from lakestrata.functions.schemas import COUNT, REAL, TEXT, schema
from lakestrata.operators.match import parse_records
from lakestrata.plans import matching
from lakestrata.plans.context import CONTEXT_TABLES
from lakestrata.plans.control import LANDING_RUN, RAW_RUN, TABLE_RUN, Run, append_runs, last_run_time, read_control
from lakestrata.plans.ingest import (
    apply_batches,
    batch_path,
    import_enums,
    land,
    land_full,
    land_incremental,
    read_rejected,
)
from lakestrata.plans.lake import CATALOGUE, CONTEXT, LANDING, RAW, TRUST, Lake, TableId
from lakestrata.plans.runner import TableSpec, build_all
from lakestrata.sources.catalog import sync_catalog
from lakestrata.sources.files import (
    read_enum_csv,
    read_enum_dir,
    read_json_batch,
    read_or_empty,
    to_json_rows,
    write_json_pages,
)
from lakestrata.sources.log import append_rows, read_log
from lakestrata.sources.scratch import scratch_path
from lakestrata.sources.snapshot import (
    Layout,
    expire_versions,
    read_snapshot,
    snapshot_history,
    upsert_snapshot,
    write_snapshot,
)
from workload.base import Source, check
from workload.changes import at
from workload.joins import BEST_MATCH_SQL, country_codes

EVENT = schema(
    event_id=COUNT, user_id=COUNT, event_type=TEXT, value=REAL, props=TEXT, at=COUNT
)


def _records(t: Source) -> DataFrame:
    return t.events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
    )


@check(
    "json_batch",
    """SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS at FROM events""",
)
def json_batch(t: Source) -> DataFrame:
    path = scratch_path(t.spark, "pages")
    write_json_pages(_records(t), path, 5_000)
    return read_json_batch(t.spark, path, EVENT)


@check(
    "json_batch_inferred",
    """SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END AS value,
              CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props
       FROM events""",
)
def json_batch_inferred(t: Source) -> DataFrame:
    early, late = scratch_path(t.spark, "early"), scratch_path(t.spark, "late")
    middle = at("2024-01-16")
    write_json_pages(
        t.events.where(F.col("ts") < middle).select("event_id", "event_type", "value"), early
    )
    write_json_pages(
        t.events.where(F.col("ts") >= middle).select("event_id", "event_type", "props"), late
    )
    return read_json_batch(t.spark, [early, late])


@check(
    "union_by_name",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS value,
              CASE WHEN event_type <> 'click' THEN props END AS props
       FROM events""",
)
def union_by_name(t: Source) -> DataFrame:
    clicks = t.events.where("event_type = 'click'").select("event_id", "value")
    others = t.events.where("event_type <> 'click'").select("event_id", "props")
    return clicks.unionByName(others, allowMissingColumns=True)


@check(
    "json_records",
    """SELECT event_id, event_type <> 'error' AS parsed,
              CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
       FROM events""",
)
def json_records(t: Source) -> DataFrame:
    texts = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("<"), "props"))
        .otherwise(F.col("props"))
        .alias("props"),
    )
    good, bad = parse_records(texts, "props", schema(k=COUNT))
    return good.select("event_id", F.lit(True).alias("parsed"), "k").unionByName(
        bad.select("event_id", F.lit(False).alias("parsed")), allowMissingColumns=True
    )


@check(
    "json_rows",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value
       FROM customer""",
)
def json_rows(t: Source) -> DataFrame:
    return to_json_rows(t.customer.select("c_custkey", "c_mktsegment"))


def _write_enums(t: Source) -> str:
    """Nations and customers as delimited lists, one folder per list."""
    root = scratch_path(t.spark, "enums")
    lists = {
        "shop_enum_customer_nation.csv": country_codes(t),
        "shop_enum_customer_account_holder.csv": t.customer.select(
            F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("value")
        ),
        "notes.csv": t.region.select(F.col("r_name").alias("name"), F.lit("1").alias("value")),
    }
    for name, df in lists.items():
        df.write.csv(f"{root}/{name}", header=True, sep=";")
    return root


@check(
    "enum_csv",
    "SELECT n_name AS name, lpad(n_nationkey::VARCHAR, 3, '0') AS value FROM nation",
)
def enum_csv(t: Source) -> DataFrame:
    return read_enum_csv(t.spark, f"{_write_enums(t)}/shop_enum_customer_nation.csv")


_ENUMS_SQL = """
    SELECT 'customer' AS entity, 'nation' AS enum, n_name AS name,
           lpad(n_nationkey::VARCHAR, 3, '0') AS value
    FROM nation
    UNION ALL
    SELECT 'customer_account', 'holder', c_name, c_custkey::VARCHAR FROM customer"""


@check("enum_dir", _ENUMS_SQL)
def enum_dir(t: Source) -> DataFrame:
    return read_enum_dir(t.spark, _write_enums(t)).drop("modified")


@check("enum_import", _ENUMS_SQL)
def enum_import(t: Source) -> DataFrame:
    lake = Lake(t.spark, scratch_path(t.spark, "lake"))
    root = _write_enums(t)
    import_enums(lake, root, "shop_enums")
    tables = [("customer", "nation"), ("customer_account", "holder")]
    first, second = (
        lake.enum("shop_enums", entity, enum).select(
            F.lit(entity).alias("entity"), F.lit(enum).alias("enum"), "name", "value"
        )
        for entity, enum in tables
    )
    return first.unionByName(second)


@check(
    "enum_reimport",
    """SELECT c_name || CASE WHEN c_custkey % 2 = 0 THEN '!' ELSE '' END AS name, c_custkey::VARCHAR AS value
       FROM customer""",
)
def enum_reimport(t: Source) -> DataFrame:
    """A list of two parts, one of which changed after the import: the other one's rows stay."""
    lake, root = Lake(t.spark, scratch_path(t.spark, "lake")), scratch_path(t.spark, "enums")
    folder = f"{root}/shop_enum_customer_account.csv"
    rows = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("value"), "c_custkey")
    even, odd = (rows.where(F.col("c_custkey") % 2 == k).drop("c_custkey") for k in (0, 1))
    odd.coalesce(1).write.csv(f"{folder}/odd", header=True, sep=";")
    even.coalesce(1).write.csv(f"{folder}/even", header=True, sep=";")
    import_enums(lake, root, "shop_enums")
    time.sleep(1.1)  # files and run logs count seconds
    louder = even.withColumn("name", F.concat("name", F.lit("!")))
    louder.coalesce(1).write.mode("overwrite").csv(f"{folder}/even", header=True, sep=";")
    import_enums(lake, root, "shop_enums")
    return lake.enum("shop_enums", "customer", "account")


def _two_versions(t: Source) -> str:
    path = scratch_path(t.spark, "orders")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_snapshot(orders.where("o_orderstatus = 'O'"), path)
    write_snapshot(orders.withColumn("seen", F.lit(True)), path, sort_by=["o_orderkey"])
    return path


@check(
    "snapshot_roundtrip",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, true AS seen FROM orders",
)
def snapshot_roundtrip(t: Source) -> DataFrame:
    return read_snapshot(t.spark, _two_versions(t))


@check(
    "snapshot_version",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
)
def snapshot_version(t: Source) -> DataFrame:
    return read_snapshot(t.spark, _two_versions(t), version=0)


@check(
    "snapshot_versions",
    """SELECT 0::BIGINT AS version, count(*) AS rows FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT 1, count(*) FROM orders""",
)
def snapshot_versions(t: Source) -> DataFrame:
    return snapshot_history(t.spark, _two_versions(t)).select("version", "rows")


def _in_parts(t: Source) -> str:
    """Orders in parts of 100 keys: all, then the finished ones of the first keys dearer, then some new ones."""
    path = scratch_path(t.spark, "parts")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    upsert_snapshot(orders, path, "o_orderkey", layout=Layout("o_orderkey", "range", 100))
    dearer = orders.where("o_orderkey < 250 AND o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert_snapshot(dearer, path, "o_orderkey")
    new = orders.where("o_orderkey % 100 = 7 AND o_orderkey < 1000").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("new").alias("note"))
    upsert_snapshot(new, path, "o_orderkey")
    return path


@check(
    "upsert_parts",
    """SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderkey < 250 AND o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice,
              NULL::VARCHAR AS note FROM orders
       UNION ALL
       SELECT -o_orderkey, NULL, NULL, 'new' FROM orders WHERE o_orderkey % 100 = 7 AND o_orderkey < 1000""",
)
def upsert_parts(t: Source) -> DataFrame:
    return read_snapshot(t.spark, _in_parts(t))


@check(
    "upsert_parts_written",
    """WITH news AS (SELECT -o_orderkey AS k FROM orders WHERE o_orderkey % 100 = 7 AND o_orderkey < 1000)
       SELECT 0::BIGINT AS version, count(DISTINCT o_orderkey // 100) AS written, 0::BIGINT AS kept, count(*) AS rows FROM orders
       UNION ALL
       SELECT 1, count(DISTINCT o_orderkey // 100) FILTER (o_orderkey < 250 AND o_orderstatus = 'F'),
              count(DISTINCT o_orderkey // 100) - count(DISTINCT o_orderkey // 100) FILTER (o_orderkey < 250 AND o_orderstatus = 'F'), count(*)
       FROM orders
       UNION ALL
       SELECT 2, (SELECT count(DISTINCT -(-k // 100)) FROM news),
              (SELECT count(*) FROM (SELECT DISTINCT o_orderkey // 100 FROM orders EXCEPT SELECT -(-k // 100) FROM news)),
              (SELECT count(*) FROM orders) + (SELECT count(*) FROM news)""",
)
def upsert_parts_written(t: Source) -> DataFrame:
    """How many parts each version wrote, and how many it took over."""
    own = F.size(F.filter("parts", lambda p: p["run"] == F.col("run"))).cast("bigint")
    return snapshot_history(t.spark, _in_parts(t)).select(
        "version", own.alias("written"), (F.size("parts") - own).cast("bigint").alias("kept"), "rows"
    )


@check(
    "expired_versions",
    """SELECT 1::BIGINT AS version, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0
       UNION ALL SELECT 2, o_orderkey, o_orderstatus || '!' FROM orders""",
)
def expired_versions(t: Source) -> DataFrame:
    """Three versions, of which the first one went; the second one was read by somebody's last run."""
    path = scratch_path(t.spark, "orders")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    write_snapshot(orders, path)
    time.sleep(1.1)  # histories count seconds
    write_snapshot(orders.where("o_orderkey % 2 = 0"), path)
    read = int(time.time())
    time.sleep(1.1)
    write_snapshot(orders.withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("!"))), path)
    expire_versions(t.spark, path, older_than=int(time.time()) + 100, read_at=[read, None])
    left = [r["version"] for r in snapshot_history(t.spark, path).collect()]
    versions = [read_snapshot(t.spark, path, v).select(F.lit(v).cast("bigint").alias("version"), "*") for v in left]
    return reduce(DataFrame.unionByName, versions)


@check(
    "compacted_log",
    """SELECT CAST(floor(epoch(date_trunc('day', ts))) AS BIGINT) AS exec_time, count(*) AS table_rows, true AS few_files
       FROM events GROUP BY 1""",
)
def compacted_log(t: Source) -> DataFrame:
    """A run for every day of events, appended one by one to a log that is written anew after each eight files."""
    path = scratch_path(t.spark, "control")
    day = F.unix_timestamp(F.date_trunc("day", F.col("ts").cast("timestamp")))
    for r in t.events.groupBy(day.alias("day")).count().orderBy("day").collect():  # one row a calendar day
        run = {"Exec_date": "-", "Exec_time": r["day"], "Total_duration": "00:00:00", "Table_Rows": r["count"]}
        append_rows(t.spark, path, TABLE_RUN, [run], most_files=8)
    log = read_log(t.spark, path, TABLE_RUN)
    files = log.select("_metadata.file_path").distinct().count()
    return log.select(F.col("Exec_time").alias("exec_time"), F.col("Table_Rows").alias("table_rows"), F.lit(files <= 8).alias("few_files"))


@check("read_absent", "SELECT o_orderkey, o_orderstatus FROM orders")
def read_absent(t: Source) -> DataFrame:
    """A table that is not there yet adds no rows to one that is."""
    held = t.orders.select("o_orderkey", "o_orderstatus")
    return held.unionByName(read_or_empty(t.spark, scratch_path(t.spark, "nothing"), held.schema))


@check(
    "land_incremental",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS updated_at FROM events""",
)
def land_events(t: Source) -> DataFrame:
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "events", "shop")
    events = t.events.select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("updated_at")
    )
    land_incremental(lake, source, events, "updated_at")
    land_incremental(lake, source, events, "updated_at")  # nothing is newer: lands no file
    columns = schema(event_id=COUNT, updated_at=COUNT)
    return read_json_batch(t.spark, f"{lake.path(source)}/2*/*", columns)


@check(
    "land_full",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
       UNION ALL
       SELECT c_custkey, c_name, upper(c_mktsegment) || '!' FROM customer""",
)
def land_customers(t: Source) -> DataFrame:
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "customers", "shop")
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    land_full(lake, source, customers)
    land_full(lake, source, customers)  # unchanged: lands no file
    louder = F.concat(F.upper("c_mktsegment"), F.lit("!"))
    land_full(lake, source, customers.withColumn("c_mktsegment", louder))
    return read_json_batch(t.spark, f"{lake.path(source)}/2*/*", customers.schema)


@check(
    "land_full_digest",
    """SELECT v.round, v.what, v.landed, (SELECT count(*) FROM customer) AS rows
       FROM (VALUES (1, 'first', true), (2, 'same', false), (3, 'permuted', false), (4, 'doubled', false),
                    (5, 'changed', true), (6, 'changed again', false)) AS v(round, what, landed)""",
)
def land_full_digest(t: Source) -> DataFrame:
    """Six full loads: only another row is a difference, not another order of rows or columns, nor a doubled row."""
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "customers", "shop")
    customers = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    smallest = customers.agg(F.min("c_custkey")).scalar()
    one = customers.where(F.col("c_custkey") == smallest)
    louder = F.when(F.col("c_custkey") == smallest, F.upper("c_name")).otherwise(F.col("c_name"))
    changed = customers.withColumn("c_name", louder)
    loads = {
        "first": customers,
        "same": customers,
        "permuted": customers.select(*reversed(customers.columns)).repartition(5, "c_name"),
        "doubled": customers.unionByName(one),
        "changed": changed,
        "changed again": changed.orderBy("c_name"),
    }
    landed = [(i, what, land_full(lake, source, df) > 0) for i, (what, df) in enumerate(loads.items(), 1)]
    held = read_json_batch(t.spark, f"{lake.path(source)}/2*/*", customers.schema).select("c_custkey").distinct()
    rounds = t.spark.createDataFrame(landed, "round int, what string, landed boolean")
    return rounds.withColumn("rows", held.agg(F.count(F.lit(1)).alias("rows")).scalar())


@check("land_full_micros", "SELECT event_id, user_id, ts FROM events")
def land_full_micros(t: Source) -> DataFrame:
    """Landed twice: the second time nothing differs, to the microsecond, and nothing is landed."""
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "events", "shop")
    events = t.events.select("event_id", "user_id", "ts")
    land_full(lake, source, events)
    land_full(lake, source, events)
    return read_json_batch(t.spark, f"{lake.path(source)}/2*/*", events.schema)


def _two_dates(t: Source, first: DataFrame, second: DataFrame, **options) -> Lake:
    """A lake in which both batches were landed and applied, on two days."""
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "orders", "shop")
    for day, batch in ((10, first), (11, second)):
        noon = datetime(2024, 1, day, 15, tzinfo=timezone.utc).timestamp()
        land(lake, source, batch, "Incremental", Run(started=noon), records_per_file=5_000)
        apply_batches(lake, "shop", "orders", key="o_orderkey", order=None, **options)
    return lake


_ORDERS = TableId(RAW, "orders", "shop")


@check(
    "apply_null_update",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS note,
              CASE WHEN o_orderstatus <> 'F' OR o_totalprice >= 100000 THEN o_totalprice END AS price
       FROM orders""",
)
def apply_null_update(t: Source) -> DataFrame:
    """Updates to null: `note` is null in the whole batch, `price` in a part of its records."""
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("note"), F.col("o_totalprice").alias("price"))
    closed = orders.where("o_orderstatus = 'F'").withColumns(
        {"note": F.lit(None).cast("string"), "price": F.when(F.col("price") >= 100000, F.col("price"))}
    )
    lake = _two_dates(t, orders.drop("o_orderstatus"), closed.drop("o_orderstatus"))
    return lake.read(_ORDERS)


@check(
    "apply_bad_records",
    """SELECT o_orderkey, 'held' AS state, o_totalprice AS price, NULL::VARCHAR AS record FROM orders
       WHERE o_orderstatus <> 'F'
       UNION ALL
       SELECT NULL, 'rejected', NULL, '{"o_orderkey": ' || o_orderkey FROM orders WHERE o_orderstatus = 'F'
       UNION ALL
       SELECT n, 'log', NULL, NULL FROM (SELECT count(*) FILTER (o_orderstatus <> 'F') AS n FROM orders
                                         UNION ALL SELECT count(*) FILTER (o_orderstatus = 'F') FROM orders)""",
)
def apply_bad_records(t: Source) -> DataFrame:
    """Lines of closed orders are cut off: they are kept apart and counted, the others are held."""
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "orders", "shop")
    whole = F.to_json(F.struct("o_orderkey", F.col("o_totalprice").alias("price")))
    cut = F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey").cast("string"))
    lines = t.orders.select(F.when(F.col("o_orderstatus") == "F", cut).otherwise(whole).alias("value"))
    lines.write.text(f"{batch_path(lake, source, '2024-01-10')}/1")
    noon = int(datetime(2024, 1, 10, 15, tzinfo=timezone.utc).timestamp())
    append_runs(t.spark, lake.control_path(source), LANDING_RUN, [Run(started=noon).record(Load_type="Full", Loaded_files=1)])
    columns = schema(o_orderkey=COUNT, price=REAL)
    apply_batches(lake, "shop", "orders", key="o_orderkey", order=None, schema=columns)
    none = F.lit(None)
    held = lake.read(_ORDERS).select("o_orderkey", F.lit("held").alias("state"), "price", none.cast("string").alias("record"))
    bad = read_rejected(lake, "shop", "orders").select(
        none.cast("bigint").alias("o_orderkey"), F.lit("rejected").alias("state"), none.cast("double").alias("price"), "record"
    )
    log = read_control(t.spark, lake.control_path(_ORDERS))
    counts = log.select(F.explode(F.array("Read_Rows", "Bad_Rows")).alias("o_orderkey"), F.lit("log").alias("state"))
    return held.unionByName(bad).unionByName(counts, allowMissingColumns=True)


@check(
    "apply_type_drift",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_custkey END::DOUBLE AS amount,
              CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_custkey::VARCHAR END AS code,
              'amount: bigint -> double; code: bigint -> string' AS retyped
       FROM orders""",
)
def apply_type_drift(t: Source) -> DataFrame:
    """Whole numbers at first; later one column has fractions and the other one texts."""
    orders = t.orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("amount"), F.col("o_custkey").alias("code")
    )
    closed = t.orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("code")
    )
    lake = _two_dates(t, orders.drop("o_orderstatus"), closed)
    log = read_control(t.spark, lake.control_path(_ORDERS)).where("Retyped is not null")
    return lake.read(_ORDERS).withColumn("retyped", log.select("Retyped").scalar())


@check(
    "apply_variants",
    """WITH kinds AS (SELECT *, o_orderkey % 4 AS k FROM orders)
       SELECT o_orderkey, CASE k WHEN 1 THEN 'text' WHEN 2 THEN 'object' WHEN 3 THEN 'array' ELSE 'number' END AS kind,
              CASE k WHEN 0 THEN o_custkey END AS number, CASE k WHEN 1 THEN o_orderpriority END AS text,
              CASE k WHEN 2 THEN o_custkey END AS object_key, CASE k WHEN 2 THEN o_orderstatus END AS object_status,
              CASE k WHEN 3 THEN o_orderpriority END AS second, 'extra: bigint -> variant' AS retyped
       FROM kinds""",
)
def apply_variants(t: Source) -> DataFrame:
    """One field that is a number at first, then a text, an object and a list, on four dates."""
    orders = t.orders
    kinds = [
        F.col("o_custkey"),
        F.col("o_orderpriority"),
        F.struct(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status")),
        F.array("o_orderstatus", "o_orderpriority"),
    ]
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "orders", "shop")
    for k, kind in enumerate(kinds):
        noon = datetime(2024, 1, 10 + k, 15, tzinfo=timezone.utc).timestamp()
        batch = orders.where(F.col("o_orderkey") % 4 >= k).select("o_orderkey", kind.alias("extra"))
        land(lake, source, batch, "Incremental", Run(started=noon))
        if k != 2:  # the object and the list are read together
            apply_batches(lake, "shop", "orders", key="o_orderkey", order=None, variants=True)
    log = read_control(t.spark, lake.control_path(_ORDERS)).where("Loaded_date = '2024-01-11'")
    return lake.read(_ORDERS).select(
        "o_orderkey",
        variant_kind("extra").alias("kind"),
        F.when(variant_kind("extra") == "number", variant_field("extra", "bigint")).alias("number"),
        F.when(variant_kind("extra") == "text", variant_field("extra", "string")).alias("text"),
        variant_field("extra", "bigint", "$.key").alias("object_key"),
        variant_field("extra", "string", "$.status").alias("object_status"),
        variant_field("extra", "string", "$[1]").alias("second"),
        log.select("Retyped").scalar().alias("retyped"),
    )


@check(
    "match_landing",
    f"SELECT id, cand_id AS game_id, 1970 + p_size AS release_world FROM ({BEST_MATCH_SQL}) "
    "JOIN part ON cand_id = p_partkey",
)
def match_landing(t: Source) -> DataFrame:
    lake = Lake(t.spark, scratch_path(t.spark, "lake"))
    released = F.unix_timestamp(
        F.make_date(F.col("p_size") + 1970, F.lit(6), F.lit(1)).cast("timestamp")
    )
    catalogue = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        released.alias("first_release_date"),
    )
    candidates = t.part.select(
        F.col("p_partkey").alias("game_id"),
        F.concat("p_name", F.substring("p_brand", 7, 9)).alias("game_name"),
        (F.col("p_size") + 1970).alias("release_world"),
    )
    write_snapshot(catalogue, lake.path(matching.GAMES))
    matching.land_matches(lake, candidates)
    columns = schema(id=COUNT, game_id=COUNT, release_world=IntegerType())
    return read_json_batch(t.spark, f"{lake.path(matching.LANDED)}/2*/*", columns)


def _landed(t: Source) -> Lake:
    """Three landing dates: first load, a batch without `props`, one with stale copies."""
    lake, source = Lake(t.spark, scratch_path(t.spark, "lake")), TableId(LANDING, "events", "shop")
    ts = F.col("ts")
    events = t.events.withColumn("updated_at", F.unix_timestamp(ts.cast("timestamp")))
    columns = ["event_id", "user_id", "event_type", "value", "props", "updated_at"]
    second = events.where((ts >= at("2024-01-06")) & (ts < at("2024-01-21"))).withColumn(
        "value", F.col("value") + 1
    )
    third = events.where(ts >= at("2024-01-16")).withColumn("value", F.col("value") + 2)
    stale = third.withColumns({"value": F.lit(-1.0), "updated_at": F.col("updated_at") - 1})
    batches = {
        "2024-01-10": events.where(ts < at("2024-01-11")).select(*columns),
        "2024-01-20": second.select(*columns).drop("props"),
        "2024-01-30": third.unionByName(stale).select(*columns),
    }
    for date, batch in batches.items():
        noon = datetime.fromisoformat(f"{date}T15:00:00").replace(tzinfo=timezone.utc)
        land(lake, source, batch, "Incremental", Run(started=noon.timestamp()), records_per_file=5_000)
    return lake


@check(
    "apply_batches",
    """SELECT event_id, user_id, event_type,
              CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value + 2
                   WHEN ts >= TIMESTAMP '2024-01-06' THEN value + 1 ELSE value END AS value,
              CASE WHEN ts < TIMESTAMP '2024-01-11' OR ts >= TIMESTAMP '2024-01-16' THEN props END
                  AS props,
              CAST(floor(epoch(ts)) AS BIGINT) AS updated_at
       FROM events""",
)
def apply_events(t: Source) -> DataFrame:
    lake = _landed(t)
    apply_batches(lake, "shop", "events", key="event_id")
    return lake.read(TableId(RAW, "events", "shop"))


@check(
    "apply_batches_log",
    """SELECT '2024-01-10' AS loaded_date, count(*) AS read_rows,
              (SELECT count(*) FROM events) AS table_rows
       FROM events WHERE ts < TIMESTAMP '2024-01-11'
       UNION ALL
       SELECT '2024-01-20', count(*), (SELECT count(*) FROM events) FROM events
       WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-21'
       UNION ALL
       SELECT '2024-01-30', count(*), (SELECT count(*) FROM events) FROM events
       WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def apply_events_log(t: Source) -> DataFrame:
    lake = _landed(t)
    apply_batches(lake, "shop", "events", key="event_id")
    log = read_control(t.spark, lake.control_path(TableId(RAW, "events", "shop")))
    return log.select(
        F.col("Loaded_date").alias("loaded_date"),
        F.col("Read_Rows").alias("read_rows"),
        F.col("Table_Rows").alias("table_rows"),
    )


def _small_lake(t: Source) -> tuple[Lake, list[TableSpec]]:
    """Raw orders with a run log, a context table over them and a mart over that."""
    lake = Lake(t.spark, scratch_path(t.spark, "lake"))
    raw = TableId(RAW, "orders", "shop")
    clean, mart = TableId(CONTEXT, "orders", "shop"), TableId(TRUST, "orders_by_status")
    written = write_snapshot(t.orders.select("o_orderkey", "o_orderstatus"), lake.path(raw))
    append_runs(
        t.spark,
        lake.control_path(raw),
        RAW_RUN,
        [
            {
                "Exec_date": "2024-01-30 12:00:00",
                "Exec_time": 1706626800,
                "Loaded_date": "2024-01-30",
                "Read_Rows": written.rows,
                "Table_Rows": written.rows,
                "Total_duration": "00:00:00",
            }
        ],
    )
    specs = [
        TableSpec(
            clean, (raw,), lambda l: l.read(raw).withColumn("open", F.col("o_orderstatus") == "O")
        ),
        TableSpec(
            mart,
            (clean,),
            lambda l: l.read(clean).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")),
            sort_by=("o_orderstatus",),
        ),
    ]
    return lake, specs


@check(
    "plan_and_build",
    """SELECT 1 AS round, 'context/shop/orders' AS "table", true AS built, count(*) AS rows FROM orders
       UNION ALL
       SELECT 1, 'trust/orders_by_status', true, count(DISTINCT o_orderstatus) FROM orders
       UNION ALL SELECT 2, 'context/shop/orders', false, NULL
       UNION ALL SELECT 2, 'trust/orders_by_status', false, NULL""",
)
def plan_and_build(t: Source) -> DataFrame:
    lake, specs = _small_lake(t)
    rows = [
        (turn, r.table, r.built, r.rows) for turn in (1, 2) for r in build_all(lake, specs)
    ]
    return t.spark.createDataFrame(rows, "round int, table string, built boolean, rows bigint")


def _lake_with_a_broken_mart(t: Source) -> tuple[Lake, list[TableSpec]]:
    """Four marts over orders: one reads a table that was never built, one reads that mart and a good one."""
    lake, specs = _small_lake(t)
    clean = specs[0].target
    broken, both = TableId(TRUST, "orders_by_rating"), TableId(TRUST, "orders_summary")
    share = TableId(TRUST, "open_share")
    specs += [
        TableSpec(broken, (clean,), lambda l: l.read(TableId(CONTEXT, "ratings", "shop"))),
        TableSpec(both, (broken, share), lambda l: l.read(broken).crossJoin(l.read(share))),
        TableSpec(share, (clean,), lambda l: l.read(clean).agg(F.avg(F.col("open").cast("int")).alias("share"))),
    ]
    return lake, specs


@check(
    "build_failures",
    """WITH orders_n AS (SELECT count(*) AS n, count(DISTINCT o_orderstatus) AS s FROM orders)
       SELECT 1 AS round, 'context/shop/orders' AS "table", 'built' AS state, n AS rows, NULL AS waits_for FROM orders_n
       UNION ALL SELECT 1, 'trust/orders_by_status', 'built', s, NULL FROM orders_n
       UNION ALL SELECT 1, 'trust/open_share', 'built', 1, NULL
       UNION ALL SELECT 2, v.t, 'fresh', NULL, NULL
                 FROM (VALUES ('context/shop/orders'), ('trust/orders_by_status'), ('trust/open_share')) AS v(t)
       UNION ALL SELECT r, 'trust/orders_by_rating', 'failed', NULL, NULL FROM (VALUES (1), (2)) AS v(r)
       UNION ALL SELECT r, 'trust/orders_summary', 'waiting', NULL, 'trust/orders_by_rating' FROM (VALUES (1), (2)) AS v(r)""",
)
def build_failures(t: Source) -> DataFrame:
    """A mart that fails stops only what reads it, in the first run and in the second."""
    lake, specs = _lake_with_a_broken_mart(t)
    rows = [(turn, r.table, r.state, r.rows, r.waits_for) for turn in (1, 2) for r in build_all(lake, specs)]
    return t.spark.createDataFrame(rows, "round int, table string, state string, rows bigint, waits_for string")


@check(
    "failure_log",
    """SELECT 'orders_by_status' AS name, count(DISTINCT o_orderstatus) AS table_rows, false AS failed, true AS has_run FROM orders
       UNION ALL SELECT 'orders_by_rating', NULL, true, false
       UNION ALL SELECT 'orders_by_rating', NULL, true, false""",
)
def failure_log(t: Source) -> DataFrame:
    """Run logs after two builds: failures are rows with a reason, and no runs to the gate."""
    lake, specs = _lake_with_a_broken_mart(t)
    build_all(lake, specs)
    build_all(lake, specs)
    logs = []
    for spec in (specs[1], specs[2]):
        log = read_control(t.spark, lake.control_path(spec.target))
        logs.append(
            log.select(
                F.lit(spec.target.name).alias("name"),
                F.col("Table_Rows").alias("table_rows"),
                F.coalesce(F.col("Error").contains("rating"), F.lit(False)).alias("failed"),
                F.lit(last_run_time(log) is not None).alias("has_run"),
            )
        )
    return logs[0].unionByName(logs[1])


@check(
    "built_mart",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
)
def built_mart(t: Source) -> DataFrame:
    lake, specs = _small_lake(t)
    build_all(lake, specs)
    return lake.read(specs[-1].target)


@check(
    "built_log",
    "SELECT count(*) AS table_rows FROM orders",
)
def built_log(t: Source) -> DataFrame:
    lake, specs = _small_lake(t)
    build_all(lake, specs)
    log = read_control(t.spark, lake.control_path(specs[0].target))
    return log.select(F.col("Table_Rows").alias("table_rows"))


@check(
    "catalog_sync",
    """SELECT n AS name, (SELECT count(*) FROM orders) AS rows
       FROM (VALUES ('context_shop_orders'), ('raw_shop_orders')) AS v(n)
       UNION ALL
       SELECT 'trust_orders_by_status', count(DISTINCT o_orderstatus) FROM orders
       UNION ALL
       SELECT n, 1 FROM (VALUES ('ctrl_context_shop_orders'), ('ctrl_raw_shop_orders'),
                                ('ctrl_trust_orders_by_status')) AS v(n)""",
)
def catalog_sync(t: Source) -> DataFrame:
    lake, specs = _small_lake(t)
    build_all(lake, specs)
    synced = sync_catalog(t.spark, lake.root)
    # One query per registered table: their number, not their size, is on the driver.
    counts = [
        t.spark.table(f"{r['database']}.{r['table']}").agg(
            F.lit(r["table"]).alias("name"), F.count(F.lit(1)).alias("rows")
        )
        for r in synced.collect()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@check(
    "catalog_failures",
    """SELECT t AS "table", a AS action, a = 'failed' AS has_error, (SELECT count(*) FROM orders) AS held
       FROM (VALUES ('raw_shop_orders', 'created'), ('raw_shop_torn', 'failed'), ('ctrl_raw_shop_orders', 'created')) AS v(t, a)""",
)
def catalog_failures(t: Source) -> DataFrame:
    """A lake with a table whose history cannot be read: it is reported, and the others are registered."""
    lake, _ = _small_lake(t)
    for database in ("raw", "control"):
        t.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    t.spark.range(3).write.parquet(f"{lake.path(TableId(RAW, 'torn', 'shop'))}/history")
    synced = sync_catalog(t.spark, lake.root, (RAW,), (RAW,))
    held = t.spark.table("raw.raw_shop_orders").agg(F.count(F.lit(1)).alias("held")).scalar()
    return synced.select("table", "action", F.col("error").isNotNull().alias("has_error"), held.alias("held"))


@check(
    "catalog_types",
    """SELECT o_orderstatus, count(*) AS n, 'o_orderstatus varchar, n bigint' AS columns FROM orders GROUP BY 1""",
)
def catalog_types(t: Source) -> DataFrame:
    """The registered mart, with the SQL types the catalogue shows for it."""
    lake, specs = _small_lake(t)
    build_all(lake, specs)
    synced = sync_catalog(t.spark, lake.root)
    told = synced.where("table = 'trust_orders_by_status'")
    return t.spark.table("trust.trust_orders_by_status").withColumn("columns", told.select("columns").scalar())


@check(
    "catalog_drift",
    """SELECT o_orderkey, o_orderstatus, o_orderstatus = 'O' AS open, o_orderkey % 7 AS extra,
              'recreated' AS action FROM orders""",
)
def catalog_drift(t: Source) -> DataFrame:
    """A second build with another column: the registered table follows."""
    lake, specs = _small_lake(t)
    build_all(lake, specs)
    sync_catalog(t.spark, lake.root)
    current = lake.read(specs[0].target).withColumn("extra", F.col("o_orderkey") % 7)
    write_snapshot(current, lake.path(specs[0].target))
    action = sync_catalog(t.spark, lake.root).where("table = 'context_shop_orders'").select("action").scalar()
    return t.spark.table("context.context_shop_orders").withColumn("action", action)


@check(
    "enum_makes_due",
    """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'first' END AS category, 1 AS round FROM orders
       UNION ALL
       SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'second' END, 2 FROM orders""",
)
def enum_makes_due(t: Source) -> DataFrame:
    """A context table is built again when an enum list it decodes with was imported anew."""
    lake = Lake(t.spark, scratch_path(t.spark, "lake"))
    raw, rounds = TableId(RAW, "websites", CATALOGUE), []
    orders = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(2).cast("bigint").alias("category"),
        F.lit("c").alias("checksum"),
    )
    written = write_snapshot(orders, lake.path(raw))
    long_ago = Run(started=time.time() - 3600)
    record = long_ago.record(Loaded_date="2024-01-01", Read_Rows=written.rows, Table_Rows=written.rows)
    append_runs(t.spark, lake.control_path(raw), RAW_RUN, [record])
    for number, label in enumerate(("first", "second"), 1):
        folder = scratch_path(t.spark, "enums")
        names = t.orders.where("o_orderstatus = 'O'").select(F.lit(label).alias("name"), F.lit("1").alias("value"))
        names.distinct().coalesce(1).write.csv(f"{folder}/igdb_enum_websites_category.csv", header=True, sep=";")
        import_enums(lake, folder)
        time.sleep(1.1)  # run logs count seconds
        build_all(lake, [CONTEXT_TABLES["context/igdb/websites"]])
        time.sleep(1.1)
        rounds.append(lake.read(TableId(CONTEXT, "websites", CATALOGUE)).withColumn("round", F.lit(number)))
    return rounds[0].unionByName(rounds[1])
