"""One key holds 40 % of the rows: joins must split it, aggregates must shrink it first."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import history, joins
from ledgerloom.operators.rollup import roll_up
from ledgerloom.plans import orders
from tests.util import executed_plan, rows

ROWS = 200_000


@pytest.fixture
def small_splits(settings):
    """No broadcast, and partitions so small that the hot one counts as skewed."""
    with settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        # The default, so that splitting does not hang on the session builder.
        spark__sql__adaptive__forceOptimizeSkewedJoin="false",
    ):
        yield


def facts(spark):
    hot = F.when(F.col("id") % 10 < 4, 7).otherwise(F.col("id") % 1000)
    return spark.range(0, ROWS, 1, 16).select(F.col("id").alias("fact_id"), hot.alias("key"))


def keys(spark):
    return spark.range(0, 1000, 1, 4).select(F.col("id").alias("key_id"), (F.col("id") % 9).alias("g"))


def test_totals_meet_hot_rows(spark, small_splits):
    totals = keys(spark).groupBy(F.col("key_id").alias("key")).agg(F.sum("g").alias("n"))
    carried = roll_up(totals, facts(spark).withColumn("g", F.col("fact_id") % 5), "key", "g", ["n"])
    assert "skew=true" in executed_plan(carried)
    direct = (
        facts(spark).join(keys(spark).withColumnRenamed("g", "n"), F.col("key") == F.col("key_id"))
        .groupBy((F.col("fact_id") % 5).alias("g")).agg(F.sum("n").alias("n"))
    )
    assert sorted(rows(carried)) == sorted(rows(direct))


def test_left_join_splits_hot_key(spark, small_splits):
    joined = joins.left_join(
        facts(spark), keys(spark).filter("key_id <> 3"), "key", "key_id"
    )
    assert "skew=true" in executed_plan(joined)
    assert joined.count() == ROWS
    missed = joined.filter("key_id IS NULL")
    assert missed.count() == facts(spark).filter("key = 3").count()
    assert missed.filter("key <> 3").count() == 0


def test_left_join_scatters_null_keys(spark, settings):
    half_null = facts(spark).withColumn("key", F.expr("if(key = 7, NULL, key)"))
    with settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    ):
        joined = joins.left_join(half_null, keys(spark), "key", "key_id")
        sizes = [
            n for _, n in rows(joined.groupBy(F.spark_partition_id()).count())
        ]
        plain = half_null.join(keys(spark), F.col("key") == F.col("key_id"), "left")
        worst = max(n for _, n in rows(plain.groupBy(F.spark_partition_id()).count()))
    assert sum(sizes) == ROWS
    assert max(sizes) < ROWS / 4 < worst


def test_anti_join_splits_hot_key_and_has_no_duplicates(spark, small_splits):
    stocked = facts(spark).select(F.col("key").alias("stocked")).filter("stocked <> 7")
    left = joins.without_match(facts(spark), stocked, "key", "stocked")
    assert "skew=true" in executed_plan(left)
    assert left.count() == facts(spark).filter("key = 7").count()


def test_member_with_a_third_of_all_orders(spark, small_splits):
    placed = facts(spark).select(
        F.col("key").alias("member"), (F.col("fact_id") % 50).alias("place"), F.lit(1).alias("v")
    )
    members = spark.range(1000).select(F.col("id").alias("member"), F.lit("x").alias("name"))
    metrics = orders.member_metrics(members, placed, "member", "v", "place")
    hot = rows(metrics.filter("member = 7").select("total", "visited"))
    expected = facts(spark).filter("key = 7")
    places = sorted(n for (n,) in rows(expected.select(F.col("fact_id") % 50).distinct()))
    assert hot == [(expected.count(), places)]


def test_key_with_a_third_of_all_versions(spark):
    log = facts(spark).select(
        "key",
        F.col("fact_id").alias("value"),
        F.timestamp_seconds(F.col("fact_id")).alias("commit_ts"),
        F.col("fact_id").alias("commit_id"),
        F.lit("U").alias("op"),
    )
    newest = history.latest(log, ["key"])
    direct = facts(spark).groupBy("key").agg(F.max("fact_id"))
    assert sorted(rows(newest)) == sorted(rows(direct))
    # The local step has already reduced what the shuffle carries.
    plan = executed_plan(newest)
    assert "partial_max_by" in plan and "Window" not in plan
