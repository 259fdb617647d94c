"""The tables, views and functions under their SQL names, for use from ``spark.sql``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import menu, orders

# Scalar and table functions over the view `price_list` (item, price). The rate stays outside the
# subquery, because Spark rejects an argument that is used inside it.
FUNCTIONS = [
    """
    CREATE OR REPLACE TEMPORARY FUNCTION max_menu_price() RETURNS DECIMAL(5,2)
    RETURN (SELECT max(price) FROM price_list)
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION min_menu_price() RETURNS DECIMAL(5,2)
    RETURN (SELECT min(price) FROM price_list)
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION max_menu_price_converted(usd_to_new DECIMAL(10,4))
    RETURNS DECIMAL(38,2)
    RETURN usd_to_new * (SELECT CAST(max(price) AS DECIMAL(28,4)) FROM price_list)
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION winsorize(
        val DECIMAL(38,4), up_bound DECIMAL(38,4), low_bound DECIMAL(38,4))
    RETURNS DECIMAL(38,4)
    RETURN CASE WHEN val > up_bound THEN up_bound
                WHEN val < low_bound THEN low_bound
                ELSE val END
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION menu_prices_above(price_floor DECIMAL(38,4))
    RETURNS TABLE (item STRING, price DECIMAL(38,4))
    RETURN SELECT item, price FROM price_list WHERE price > price_floor
        ORDER BY price DESC NULLS FIRST, item NULLS LAST
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION menu_prices_below(price_ceiling DECIMAL(38,4))
    RETURNS TABLE (item STRING, price DECIMAL(38,4))
    RETURN SELECT item, price FROM price_list WHERE price < price_ceiling
        ORDER BY price DESC NULLS FIRST, item NULLS LAST
    """,
]


def register_orders(spark: SparkSession, raw: Mapping[str, DataFrame]) -> None:
    """Temporary views for the raw tables and the analytics views, and the price functions."""
    for name, rows in raw.items():
        rows.createOrReplaceTempView(name)
    menu.price_list(raw["menu"]).createOrReplaceTempView("price_list")
    orders.order_lines(raw).createOrReplaceTempView("harmonized_orders_v")
    orders.order_lines_dated(raw).createOrReplaceTempView("orders_v")
    orders.loyalty_metrics(raw).createOrReplaceTempView("customer_loyalty_metrics_v")
    for statement in FUNCTIONS:
        spark.sql(statement)


def register_rental(tables: Mapping[str, DataFrame]) -> None:
    """Temporary views for the rental store's tables."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
