"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from lakestrata.operators.changes import changed_rows, not_in, upsert
from lakestrata.operators.dedup import latest_by
from lakestrata.operators.enrich import decode, fan_out, lookup
from plans import plan
from workload import CHECKS
from workload.base import Source

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    events = Source(spark, FOLDER).events
    text = plan(latest_by(events, "user_id", "ts", ["event_id"]))
    assert re.search(r"WindowGroupLimit .* Partial", text)


def test_small_dimension_is_broadcast_by_size(spark):
    t = Source(spark, FOLDER)
    enum = t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("value"))
    df = decode(t.customer, "c_nationkey", enum)
    assert "BroadcastHashJoin" in plan(df)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1"):
        assert "BroadcastHashJoin" not in plan(decode(t.customer, "c_nationkey", enum))


def test_only_needed_columns_are_read(spark):
    text = plan(CHECKS["membership_parts"].query(Source(spark, FOLDER)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert any("p_name" in s and "p_type" not in s for s in schemas)
    assert not any("l_extendedprice" in s for s in schemas)


def test_copies_of_a_key_collapse_before_an_anti_join(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        t = Source(spark, FOLDER)
        orders = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
        text = plan(not_in(orders, t.lineitem, "l_orderkey"))
    # One shuffle per side: the distinct keys already lie where the join needs them.
    assert text.count("Exchange hashpartitioning") == 2
    assert "HashAggregate(keys=[l_orderkey" in text


def test_a_version_difference_shuffles_hashes_and_the_rows_that_differ(spark):
    lines = Source(spark, FOLDER).lineitem
    now = lines.withColumn("l_tax", F.when(F.col("l_orderkey") == 7, F.lit(0.5)).otherwise(F.col("l_tax")))
    text = plan(changed_rows(now, lines))
    # Rows meet the written hashes by broadcast; what is shuffled comes after that.
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_upsert_does_not_shuffle_the_base_for_a_small_batch(spark):
    t = Source(spark, FOLDER)
    updates = t.orders.where("o_orderkey = 5").withColumn("o_totalprice", F.lit(0.0))
    assert "Exchange hashpartitioning" not in plan(upsert(t.orders, updates, "o_orderkey"))
    partial = updates.drop("o_orderstatus")
    assert "Exchange hashpartitioning" not in plan(upsert(t.orders, partial, "o_orderkey"))


def skewed(spark):
    """A third of the rows under one key, a third under null."""
    return spark.range(60_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 1000).cast("long").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    "spark__sql__shuffle__partitions": "16",
}


def test_hot_and_null_keys_of_a_lookup_are_split(spark):
    with settings(spark, **SKEW):
        dim = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
        df = lookup(skewed(spark), "k", dim, {"name": "name"}, keep_key=True)
        assert df.agg(F.count("id"), F.count("name")).first() == (60_000, 40_000)
        df.collect()
        assert "skew=true" in plan(df)


def test_hot_keys_of_a_fan_out_are_split(spark):
    with settings(spark, **SKEW):
        left = spark.range(1000).withColumnRenamed("id", "k")
        df = fan_out(left, "k", skewed(spark), {"id": "id", "pad": "pad"}, other_key="k")
        matched = skewed(spark).where("k is not null")
        expected = matched.count() + 1000 - matched.select("k").distinct().count()
        assert len(df.collect()) == expected
        assert "skew=true" in plan(df)
