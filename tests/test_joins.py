"""Joins on keys that are NULL, and on tables that share a layout."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.sources import tables
from tests.util import executed_plan, rows


@pytest.mark.parametrize("title", ["CAST(NULL AS STRING)", "'same'"])
def test_null_keys_are_spread_whatever_a_column_holds(spark, settings, title):
    left = spark.range(8000).selectExpr("CAST(NULL AS BIGINT) AS k", f"{title} AS title", "id AS n", "map('a', 1) AS m")
    right = spark.range(10).withColumnRenamed("id", "r")
    with settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        joined = joins.left_join(left, right, "k", "r")
        sizes = [n for _, n in rows(joined.groupBy(F.spark_partition_id()).count())]
        assert sum(sizes) == 8000 and max(sizes) < 8000 / 4
        missing = joins.without_match(left, right, "k", "r")
        assert missing.columns == left.columns and missing.count() == 8000


def test_missing_rows_keep_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (None, None)], "k BIGINT, t STRING")
    right = spark.createDataFrame([(1,), (1,), (None,)], "r BIGINT")
    got = sorted(rows(joins.without_match(left, right, "k", "r")), key=str)
    assert got == sorted([(2, "b"), (2, "b"), (None, "c"), (None, None)], key=str)


def test_same_layout_needs_no_shuffle(spark, settings):
    left, right = (
        tables.write_bucketed(spark.range(n).withColumnRenamed("id", key), f"layout_{key}", key, 4)
        for n, key in ((1000, "a"), (600, "b"))
    )
    with settings(spark__sql__autoBroadcastJoinThreshold="-1"):
        for joined, count in (
            (joins.left_join(left, right, "a", "b", same_layout=True), 1000),
            (joins.without_match(left, right, "a", "b", same_layout=True), 400),
        ):
            assert "Exchange" not in executed_plan(joined)
            assert joined.count() == count
