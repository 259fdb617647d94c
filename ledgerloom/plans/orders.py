"""Views of the order system: raw tables, harmonized views, analytics views.

``raw`` maps the table names of ``sources.schemas`` to DataFrames. Views are lazy and stack on
each other; a query that uses a few columns of a view reads only those.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.aggregates import distinct_values
from ledgerloom.operators.joins import join_totals, left_join

# The columns of the order line view, in order.
ORDER_LINE_COLUMNS = """
    order_id truck_id order_ts order_detail_id line_number truck_brand_name menu_type
    primary_city region country franchise_flag franchise_id franchisee_first_name
    franchisee_last_name location_id customer_id first_name last_name e_mail phone_number
    children_count gender marital_status menu_item_id menu_item_name quantity unit_price price
    order_amount order_tax_amount order_discount_amount order_total
""".split()

# What the loyalty metrics view shows of a member.
MEMBER_COLUMNS = "customer_id city country first_name last_name phone_number e_mail".split()


def order_lines(raw: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order line with its order, truck, franchisee, menu item, place and member.

    Everything that hangs on the order is joined to the order first. The order lines, the
    largest table, then move once for the order and once for the menu, not once per table. Each
    table joins as a plain scan, whose size Spark knows, and not as the result of another join,
    whose size it would overrate.
    """
    franchisees = raw["franchise"].select(
        F.col("franchise_id").alias("owner_id"),
        F.col("first_name").alias("franchisee_first_name"),
        F.col("last_name").alias("franchisee_last_name"),
    )
    trucks = raw["truck"].select(
        "truck_id", "primary_city", "region", "country", "franchise_flag", "franchise_id"
    )
    places = raw["location"].select("location_id")
    members = raw["customer_loyalty"].select(
        "customer_id", "first_name", "last_name", "e_mail", "phone_number",
        "children_count", "gender", "marital_status",
    )
    headers = raw["order_header"].select(
        "order_id", "truck_id", "order_ts",
        F.col("location_id").alias("header_location_id"),
        F.col("customer_id").alias("header_customer_id"),
        "order_amount", "order_tax_amount", "order_discount_amount", "order_total",
    )
    orders = left_join(
        headers.join(trucks, "truck_id")
        .join(franchisees, F.col("franchise_id") == F.col("owner_id"))
        .join(places, F.col("header_location_id") == F.col("location_id").cast("double")),
        members,
        "header_customer_id",
        "customer_id",
    )
    items = raw["menu"].select("menu_item_id", "menu_item_name", "menu_type", "truck_brand_name")
    lines = (
        raw["order_detail"]
        .select(
            "order_detail_id", "order_id", "menu_item_id", "line_number",
            "quantity", "unit_price", "price",
        )
        .join(items, "menu_item_id")
    )
    return lines.join(orders, "order_id").select(*ORDER_LINE_COLUMNS)


def loyalty_metrics(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per loyalty member with orders: total sales and the array of distinct places visited."""
    return member_metrics(
        raw["customer_loyalty"].select(*MEMBER_COLUMNS),
        raw["order_header"].select("customer_id", "location_id", "order_total"),
        key="customer_id",
        value="order_total",
        visited="location_id",
    ).select(
        *MEMBER_COLUMNS,
        F.col("total").alias("total_sales"),
        F.col("visited").alias("visited_location_ids_array"),
    )


def member_metrics(
    members: DataFrame, orders: DataFrame, key: str, value: str, visited: str
) -> DataFrame:
    """Per group of equal member rows: ``total`` of the value and distinct ``visited`` values.

    Orders are reduced to one row per member and place, then to one per member, before they meet
    the members. A member with a third of all orders is thus spread over its places, and only
    distinct places reach its array. Members with several equal rows count their orders as often.
    """
    per_place = orders.groupBy(key, visited).agg(F.sum(value).alias("_part"))
    per_member = per_place.groupBy(key).agg(
        F.sum("_part").alias("total"), distinct_values(F.col(visited)).alias("visited")
    )
    copies = members.groupBy(*members.columns).agg(F.count("*").alias("_copies"))
    return join_totals(per_member, copies, key).select(
        *members.columns, (F.col("total") * F.col("_copies")).alias("total"), "visited"
    )


def with_date(rows: DataFrame, moment: str) -> DataFrame:
    """The view with the calendar date of ``moment`` in front."""
    return rows.select(day(F.col(moment)).alias("date"), "*")


def day(moment: Column) -> Column:
    return F.to_date(moment)


def order_lines_dated(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Analytics view: ``order_lines`` with the date of the order in front."""
    return with_date(order_lines(raw), "order_ts")
