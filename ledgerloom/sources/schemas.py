"""Declared schemas of the order system's raw tables.

Ids are BIGINT, money is DECIMAL(38,4), times of day stay text. Numbers that the source
declares as text stay text. ``JSON_COLUMNS`` are read as text and parsed to VARIANT on load.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names, in file order, with the Spark type of each column.
RAW_TABLES = {
    "country": """
        country_id BIGINT, country STRING, iso_currency STRING, iso_country STRING,
        city_id BIGINT, city STRING, city_population STRING
    """,
    "franchise": """
        franchise_id BIGINT, first_name STRING, last_name STRING, city STRING,
        country STRING, e_mail STRING, phone_number STRING
    """,
    "location": """
        location_id BIGINT, placekey STRING, location STRING, city STRING,
        region STRING, iso_country_code STRING, country STRING
    """,
    "menu": """
        menu_id BIGINT, menu_type_id BIGINT, menu_type STRING, truck_brand_name STRING,
        menu_item_id BIGINT, menu_item_name STRING, item_category STRING,
        item_subcategory STRING, cost_of_goods_usd DECIMAL(38,4),
        sale_price_usd DECIMAL(38,4), menu_item_health_metrics_obj STRING
    """,
    "truck": """
        truck_id BIGINT, menu_type_id BIGINT, primary_city STRING, region STRING,
        iso_region STRING, country STRING, iso_country_code STRING, franchise_flag BIGINT,
        year BIGINT, make STRING, model STRING, ev_flag BIGINT, franchise_id BIGINT,
        truck_opening_date DATE
    """,
    "order_header": """
        order_id BIGINT, truck_id BIGINT, location_id DOUBLE, customer_id BIGINT,
        discount_id STRING, shift_id BIGINT, shift_start_time STRING, shift_end_time STRING,
        order_channel STRING, order_ts TIMESTAMP_NTZ, served_ts STRING,
        order_currency STRING, order_amount DECIMAL(38,4), order_tax_amount STRING,
        order_discount_amount STRING, order_total DECIMAL(38,4)
    """,
    "order_detail": """
        order_detail_id BIGINT, order_id BIGINT, menu_item_id BIGINT, discount_id STRING,
        line_number BIGINT, quantity INT, unit_price DECIMAL(38,4), price DECIMAL(38,4),
        order_item_discount_amount STRING
    """,
    "customer_loyalty": """
        customer_id BIGINT, first_name STRING, last_name STRING, city STRING,
        country STRING, postal_code STRING, preferred_language STRING, gender STRING,
        favourite_brand STRING, marital_status STRING, children_count STRING,
        sign_up_date DATE, birthday_date DATE, e_mail STRING, phone_number STRING
    """,
    "test_table": """
        test_number DECIMAL(38,0), test_varchar STRING, test_boolean BOOLEAN,
        test_date DATE, test_variant VARIANT
    """,
}

# Text columns with a declared maximum length.
MAX_LENGTHS = {
    "country": {"iso_currency": 3, "iso_country": 2},
    "order_header": {"order_currency": 3},
}

# JSON text columns that become VARIANT on load.
JSON_COLUMNS = {"menu": ("menu_item_health_metrics_obj",)}


def file_schema(table: str) -> T.StructType:
    """The schema of the table's files, by column position."""
    return T.StructType.fromDDL(RAW_TABLES[table])
