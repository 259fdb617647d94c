"""Exact money sums in two whole numbers."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.aggregates import money_names, money_parts, money_total


def total(frame):
    parts = frame.select("g", *money_parts(F.col("amount"), "paid"))
    sums = parts.groupBy("g").agg(*[F.sum(name).alias(name) for name in money_names("paid")])
    return {row.g: row.paid for row in sums.select("g", money_total("paid")).collect()}


def test_decimal_sums_are_exact(spark):
    rng = random.Random(4)
    rows = [(at % 3, Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-4)) for at in range(500)]
    rows += [(3, None), (4, None), (4, Decimal("-0.0001")), (5, Decimal("-3.2500")), (5, Decimal("3.2500"))]
    frame = spark.createDataFrame(rows, "g INT, amount DECIMAL(38,4)")
    plain = {g: sum(a for h, a in rows if h == g and a is not None) for g in range(6)}
    assert total(frame) == {**plain, 3: None, 4: Decimal("-0.0001")}


def test_sums_beyond_64_bits_of_cents(spark):
    one = Decimal("40000000000000000.9999")
    frame = spark.createDataFrame([(sign, one * sign) for sign in (1, -1) for _ in range(30)], "g INT, amount DECIMAL(38,4)")
    assert total(frame) == {1: one * 30, -1: one * -30}
    assert one * 30 * 100 > 2**63


def test_floating_point_amounts_round_to_four_decimals(spark):
    amounts = [0.1, 0.2, -0.1, 1e9 + 0.07, -123456.7, 0.00005, 99999.99994, 99999.99996]
    frame = spark.createDataFrame([(at, a) for at, a in enumerate(amounts)], "g INT, amount DOUBLE")
    plain = {row.g: row.d for row in frame.select("g", F.col("amount").cast("decimal(38,4)").alias("d")).collect()}
    assert total(frame) == plain


def test_groups_are_hashed(spark):
    parts = spark.range(9).select((F.col("id") % 2).alias("g"), *money_parts(F.col("id") * 1.5, "paid"))
    sums = parts.groupBy("g").agg(*[F.sum(name).alias(name) for name in money_names("paid")])
    assert "HashAggregate" in sums._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in sums._jdf.queryExecution().executedPlan().toString()
