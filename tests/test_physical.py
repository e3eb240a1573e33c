"""What the physical plans look like: pushdown, shuffles, broadcasts, no Python in batch plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyworks.operators import panes, rows

FOLDER = "/root/testdata/sf0.01"
MAIN = [name for name in entry.queries() if name not in entry.TEXT_QUERIES]
# Aggregates of one's own are written in Python.
BATCH = [name for name in MAIN if not name.startswith(("stream_", "own_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"\bExchange (?:hash|single|range|round)", text, re.IGNORECASE))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for node in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize(
    "name, count",
    {
        "attendance_count": 1,
        "sum_per_key": 1,
        "distinct_pairs": 1,
        "mean_per_key": 1,
        "cogroup_full_outer": 1,
        "cogroup_named": 1,
        "tag_routing": 1,
        "word_count": 1,
        "card_points": 1,
        "missed_periods": 1,
        "tumbling_sum": 1,
        "session_mean": 1,
        "weapon_sessions": 1,
        "pane_discarding": 1,
        "pane_accumulating": 1,
        "top_defaulters": 1,
        "union_all": 0,
        "length_prefix_filter": 0,
    }.items(),
)
def test_shuffles(spark, name, count):
    assert shuffles(plan(entry.queries()[name](spark, FOLDER))) == count


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["attendance_count"](spark, FOLDER))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text
    text = plan(entry.queries()["missed_periods"](spark, FOLDER))
    assert "EqualTo(event_type,purchase)" in text
    assert "props" not in text
    text = plan(entry.queries()["membership_profit"](spark, FOLDER))
    assert "In(l_returnflag, [A,R])" in text


def test_partial_aggregation(spark):
    for name in ("sum_per_key", "word_count", "tumbling_sum", "global_mean", "missed_periods"):
        assert "partial_" in plan(entry.queries()[name](spark, FOLDER))


def test_top_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_defaulters"](spark, FOLDER))


def test_exclusion_broadcasts_only_a_list_of_few_bytes(spark):
    df, ids = spark.range(1000).withColumnRenamed("id", "key"), spark.range(0, 500).withColumnRenamed("id", "key")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, sent in (("4001", True), ("3999", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert ("BroadcastHashJoin" in plan(rows.exclude(df, ids, "key"))) == sent
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_hot_keys_are_marked_by_broadcast_and_sorted_by_slot(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("key"), F.lit(1).alias("v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(panes.accumulating_panes(df, ["key"], "seq", F.col("v"), 5, slot_rows=100))
        assert "BroadcastHashJoin" in text
        assert re.search(r"Exchange hashpartitioning\(pane_key#\d+, slot#\d+L", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_skewed_join_partition_is_split(spark, tmp_path):
    """A third of the lines belong to one order: the join of the query splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("l_orderkey"),
            F.timestamp_seconds(F.abs(F.xxhash64("id")) % 1_000_000 + 1_000_000).alias("l_shipdate"),
        )
        orders = spark.range(5000).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 10).alias("o_custkey"), F.timestamp_seconds(F.lit(0)).alias("o_orderdate")
        )
        lines.write.parquet(str(tmp_path / "lineitem.parquet"))
        orders.write.parquet(str(tmp_path / "orders.parquet"))
        late = entry.queries()["late_defaulters"](spark, str(tmp_path))
        assert sum(row["late_payments"] for row in late.collect()) == 300_000
        assert "skew=true" in plan(late)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
