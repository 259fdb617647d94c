"""Price bounds are exact and reach the reader; the SQL functions are ordered."""

from decimal import Decimal

from ledgerloom.plans import menu, sql_api
from ledgerloom.sources import tables
from tests.util import physical_plan, rows


def stored(spark, path):
    prices = spark.sql(
        "SELECT * FROM VALUES ('a', 12345678901234567.0001BD), ('b', 9.5BD), ('c', 9.5001BD), ('d', NULL) AS t(item, price)"
    ).selectExpr("item", "CAST(price AS DECIMAL(38,4)) AS price")
    return tables.write_new(prices, path)


def test_bounds_are_exact_and_pushed(spark, new_path):
    prices = stored(spark, new_path("prices"))
    names = lambda df: [r.item for r in df.collect()]
    assert names(menu.prices_above(prices, "12345678901234567.0")) == ["a"]
    assert names(menu.prices_above(prices, Decimal("9.50009"))) == ["a", "c"]
    assert names(menu.prices_above(prices, 9.5)) == ["a", "c"]
    assert names(menu.prices_below(prices, "9.50011")) == ["c", "b"]
    assert names(menu.prices_below(prices, 9.5001)) == ["b"]
    for df in (menu.prices_above(prices, "9.50009"), menu.prices_below(prices, 10)):
        plan = physical_plan(df)
        assert "GreaterThan(price" in plan or "LessThan(price" in plan


def test_bounds_on_doubles(spark):
    prices = spark.sql("SELECT * FROM VALUES ('a', 1.5D), ('b', 2.5D) AS t(item, price)")
    assert rows(menu.prices_above(prices, "1.75")) == [("b", 2.5)]


def test_sql_functions_are_ordered(spark):
    spark.sql(
        "SELECT * FROM VALUES ('x', 16), ('y', 18), ('z', 17), ('w', 18) AS t(item, price)"
    ).selectExpr("item", "CAST(price AS DECIMAL(38,4)) AS price").createOrReplaceTempView("price_list")
    for statement in sql_api.FUNCTIONS:
        spark.sql(statement)
    assert [r.item for r in spark.sql("SELECT * FROM menu_prices_above(15)").collect()] == ["w", "y", "z", "x"]
    assert [r.item for r in spark.sql("SELECT * FROM menu_prices_below(18)").collect()] == ["z", "x"]
