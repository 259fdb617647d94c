from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars, variants
from ledgerloom.functions.aggregates import count_where, distinct_values
from ledgerloom.functions.ordering import ascending, descending
from tests.util import physical_plan, rows


@pytest.mark.parametrize(
    "value, upper, lower, expected",
    [
        (12.0, 11.0, 4.0, 11.0),
        (3.0, 11.0, 4.0, 4.0),
        (7.0, 11.0, 4.0, 7.0),
        (11.0, 11.0, 4.0, 11.0),
        (4.0, 11.0, 4.0, 4.0),
        (None, 11.0, 4.0, None),
        (12.0, None, 4.0, 12.0),
        (3.0, 11.0, None, 3.0),
        (5.0, 4.0, 6.0, 4.0),  # crossed bounds: the upper one is tested first
    ],
)
def test_clamp(spark, value, upper, lower, expected):
    row = spark.createDataFrame([(value, upper, lower)], "v double, u double, l double")
    got = row.select(scalars.clamp(F.col("v"), F.col("u"), F.col("l")))
    assert rows(got) == [(expected,)]


def test_clamp_agrees_with_a_python_function(spark):
    def by_hand(value, upper, lower):
        return upper if value > upper else lower if value < lower else value

    slow = F.udf(by_hand, "bigint")
    numbers = spark.range(-50, 50).select("id")
    native = scalars.clamp(F.col("id"), F.lit(20), F.lit(-10))
    compared = numbers.select(native.alias("a"), slow("id", F.lit(20), F.lit(-10)).alias("b"))
    assert compared.filter("a <> b").count() == 0
    assert "Python" not in physical_plan(numbers.select(native))


def test_concat_treats_null_as_empty(spark):
    names = spark.createDataFrame([("Ann", None), (None, "Lee"), ("Jo", "Ray")], "f string, l string")
    joined = scalars.concat_blank([F.col("f"), F.lit(" "), F.col("l")])
    assert rows(names.select(joined)) == [("Ann ",), (" Lee",), ("Jo Ray",)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
        ("2024-01-01 00:00:01.1", "2024-01-01 00:00:00.9", -1),
        ("2024-01-01 00:00:00.1", "2024-01-01 00:00:00.9", 0),
        ("2024-03-10 00:00:00", "2024-03-11 00:00:00", 86400),  # clocks change that day
        ("1969-12-31 23:59:59.9", "1970-01-01 00:00:00.1", 1),
        ("2024-01-01 00:00:00", None, None),
    ],
)
def test_seconds_crossed(spark, settings, zone, start, end, expected):
    with settings(spark__sql__session__timeZone=zone):
        row = spark.createDataFrame([(start, end)], "a string, b string").select(
            F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
        )
        assert rows(row.select(scalars.seconds_crossed(F.col("a"), F.col("b")))) == [(expected,)]


def test_sum_hours_skips_open_pairs_and_keeps_fractions(spark):
    pairs = spark.createDataFrame(
        [
            ("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)),
            ("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500_000)),
            ("a", datetime(2024, 1, 1), None),
            ("b", datetime(2024, 1, 1), None),
            ("c", datetime(2024, 1, 2), datetime(2024, 1, 1)),
        ],
        "k string, s timestamp_ntz, e timestamp_ntz",
    )
    totals = pairs.groupBy("k").agg(scalars.sum_hours(F.col("s"), F.col("e")).alias("h"))
    assert dict(rows(totals)) == {"a": (5400 + 0.5) / 3600, "b": None, "c": -24.0}


def test_sum_hours_outlasts_a_sum_of_microseconds(spark):
    start, end = (F.lit(text).cast("timestamp_ntz") for text in ("0001-01-01", "9999-12-31"))
    total = spark.range(1000).agg(scalars.sum_hours(start, end).alias("h"))
    assert rows(total) == [((datetime(9999, 12, 31) - datetime(1, 1, 1)).days * 24 * 1000.0,)]


def test_year_columns(spark):
    row = spark.range(1).select(
        scalars.year_gap(2026, F.lit(2010)).alias("gap"),
        scalars.year_ratio(2026, F.lit(2010)).alias("ratio"),
    )
    assert rows(row) == [(16, Decimal("1.007960"))]


def test_zoned_text_and_utc_clock(spark, settings):
    for zone in ("UTC", "Asia/Tokyo"):
        with settings(spark__sql__session__timeZone=zone):
            moment = scalars.utc_clock(scalars.zoned("2024-04-04 21:34:31.833 -0700"))
            shown = spark.range(1).select(moment.cast("string"))
            assert rows(shown) == [("2024-04-05 04:34:31.833",)]


def test_null_order(spark):
    numbers = spark.createDataFrame([(1,), (None,), (2,)], "n int")
    assert rows(numbers.orderBy(descending("n"))) == [(None,), (2,), (1,)]
    assert rows(numbers.orderBy(ascending("n"))) == [(1,), (2,), (None,)]


def test_aggregates(spark):
    table = spark.createDataFrame([(1, "b"), (2, "a"), (None, "b"), (1, None)], "n int, t string")
    got = table.agg(count_where(F.col("n") == 1), distinct_values(F.col("t")))
    assert rows(got) == [(2, ["a", "b"])]


@pytest.mark.parametrize(
    "text, kind",
    [
        ('{"k": 69}', "INTEGER"),
        ('{"k": 6.5}', "DECIMAL"),
        ('{"k": 1e300}', "DOUBLE"),
        ('{"k": "x"}', "VARCHAR"),
        ('{"k": true}', "BOOLEAN"),
        ('{"k": null}', "NULL_VALUE"),
        ('{"k": [1]}', "ARRAY"),
        ('{"k": {"a": 1}}', "OBJECT"),
        ('{"K": 1}', None),  # keys are case-sensitive
        ("{}", None),
        ("not json", None),
        (None, None),
    ],
)
def test_variant_type(spark, text, kind):
    held = spark.createDataFrame([(text,)], "t string").select(variants.parse(F.col("t")).alias("v"))
    assert rows(held.select(variants.type_name(variants.field(F.col("v"), "k")))) == [(kind,)]


def test_variant_fields_and_arithmetic(spark):
    texts = ['{"k": 12.5, "a b": 1}', '{"k": "x"}', "{}", "broken", None]
    held = spark.createDataFrame([(t,) for t in texts], "t string").select(
        variants.parse(F.col("t")).alias("v")
    )
    numbers = held.select(
        variants.field_as(F.col("v"), "k", "double"), variants.field_as(F.col("v"), "a b", "int")
    )
    assert rows(numbers) == [(12.5, 1), (None, None), (None, None), (None, None), (None, None)]
    number = spark.range(1).select(variants.parse(F.lit('{"k": 12.5}')).alias("v"))
    doubled = number.select(variants.as_number(variants.field(F.col("v"), "k")) * 2)
    assert rows(doubled) == [(Decimal("25.0000"),)]
    with pytest.raises(Exception, match="VARIANT"):
        held.select(variants.as_number(variants.field(F.col("v"), "k"))).collect()
    with pytest.raises(ValueError):
        variants.field(F.col("v"), "it's")
