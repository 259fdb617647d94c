"""The order system as catalog tables and views that outlive the session, each view with its comment.

A catalog view is kept as SQL text, so the views stand here as SQL; they give the rows of the
DataFrame views in ``plans.orders``. Raw tables are external: the catalog only knows where they lie.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.orders import MEMBER_COLUMNS, ORDER_LINE_COLUMNS

# The sources of those columns of an order line that more than one joined table has.
_SOURCES = {"order_id": "d.order_id", "menu_item_id": "d.menu_item_id"}

ORDER_LINES = f"""
    SELECT {", ".join(_SOURCES.get(name, name) for name in ORDER_LINE_COLUMNS)}
    FROM {{raw}}.order_detail d
    JOIN (SELECT menu_item_id AS sold_item_id, menu_item_name, menu_type, truck_brand_name
          FROM {{raw}}.menu) ON d.menu_item_id = sold_item_id
    JOIN (SELECT h.order_id AS placed_order_id, h.truck_id, h.order_ts, t.primary_city, t.region,
                 t.country, t.franchise_flag, t.franchise_id,
                 f.first_name AS franchisee_first_name, f.last_name AS franchisee_last_name,
                 l.location_id, c.customer_id, c.first_name, c.last_name, c.e_mail, c.phone_number,
                 c.children_count, c.gender, c.marital_status, h.order_amount, h.order_tax_amount,
                 h.order_discount_amount, h.order_total
          FROM {{raw}}.order_header h
          JOIN {{raw}}.truck t ON h.truck_id = t.truck_id
          JOIN {{raw}}.franchise f ON t.franchise_id = f.franchise_id
          JOIN {{raw}}.location l ON h.location_id = CAST(l.location_id AS DOUBLE)
          LEFT JOIN {{raw}}.customer_loyalty c ON h.customer_id = c.customer_id)
      ON d.order_id = placed_order_id
"""

# Orders are reduced to one row per member and place, then per member, before they meet the members.
MEMBER_METRICS = f"""
    SELECT {", ".join(f"m.{name}" for name in MEMBER_COLUMNS)},
           total * copies AS total_sales, visited AS visited_location_ids_array
    FROM (SELECT {", ".join(MEMBER_COLUMNS)}, count(*) AS copies
          FROM {{raw}}.customer_loyalty GROUP BY ALL) m
    JOIN (SELECT customer_id, sum(part) AS total, collect_set(location_id) AS visited
          FROM (SELECT customer_id, location_id, sum(order_total) AS part
                FROM {{raw}}.order_header GROUP BY customer_id, location_id)
          GROUP BY customer_id) o ON m.customer_id = o.customer_id
"""


@dataclass(frozen=True)
class Zones:
    """The catalog schemas of the raw tables, the harmonized views and the analytics views."""

    raw: str = "raw"
    harmonized: str = "harmonized"
    analytics: str = "analytics"


COMMENTS = {
    "orders_v": "Order Detail View",
    "customer_loyalty_metrics_v": "Customer Loyalty Member Metrics View",
}


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_view(spark: SparkSession, name: str, sql: str, comment: str | None = None) -> DataFrame:
    """A catalog view over stored tables, new or in the place of the one of that name."""
    said = f"COMMENT {_text(comment)}" if comment is not None else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} {said} AS {sql}")
    return spark.table(name)


def view_comment(spark: SparkSession, name: str) -> str | None:
    """The comment that the catalog keeps on a table or view."""
    return spark.catalog.getTable(name).description


def create_order_views(
    spark: SparkSession,
    stored: Mapping[str, str],
    zones: Zones = Zones(),
    comments: Mapping[str, str] | None = None,
) -> None:
    """Raw tables at the ``stored`` paths, the harmonized views, and the analytics views with comments.

    The columns of a raw table are those of its files; batches in folders below it are read too.
    """
    for schema in (zones.raw, zones.harmonized, zones.analytics):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table, path in stored.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {zones.raw}.{table} USING parquet "
            f"OPTIONS (recursiveFileLookup 'true') LOCATION {_text(path)}"
        )
    said = {**COMMENTS, **(comments or {})}
    create_view(spark, f"{zones.harmonized}.orders_v", ORDER_LINES.format(raw=zones.raw))
    create_view(
        spark, f"{zones.harmonized}.customer_loyalty_metrics_v", MEMBER_METRICS.format(raw=zones.raw)
    )
    create_view(
        spark,
        f"{zones.analytics}.orders_v",
        f"SELECT to_date(o.order_ts) AS date, o.* FROM {zones.harmonized}.orders_v o",
        said["orders_v"],
    )
    create_view(
        spark,
        f"{zones.analytics}.customer_loyalty_metrics_v",
        f"SELECT * FROM {zones.harmonized}.customer_loyalty_metrics_v",
        said["customer_loyalty_metrics_v"],
    )
