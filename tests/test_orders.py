"""The order system: views on a small set of raw tables, reports, and the SQL names."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import variants
from ledgerloom.plans import menu, orders, sql_api, trucks
from ledgerloom.sources import schemas
from tests.util import physical_plan, rows

# Column values per table; columns left out are NULL.
RAW = {
    "country": [],
    "franchise": [
        dict(franchise_id=1, first_name="Fay", last_name="Ott"),
        dict(franchise_id=2, first_name="Gil", last_name=None),
    ],
    "location": [dict(location_id=10), dict(location_id=11)],
    "menu": [
        dict(menu_item_id=100, menu_item_name="Chicken Bun", menu_type="Grill",
             truck_brand_name="B", item_category="Snack", item_subcategory="Warm Option",
             cost_of_goods_usd=12.5, sale_price_usd=16,
             menu_item_health_metrics_obj='{"menu_item_health_metrics": [{"a": "x"}], "menu_item_id": 100}'),
        dict(menu_item_id=101, menu_item_name="Tea", item_category="Beverage",
             item_subcategory="Hot Option", cost_of_goods_usd=1, sale_price_usd=2.5,
             menu_item_health_metrics_obj="{broken"),
        dict(menu_item_id=102, menu_item_name="Soup of the day", item_category="Snack",
             item_subcategory="Warm Option", cost_of_goods_usd=3, sale_price_usd=15),
        dict(menu_item_id=103, menu_item_name="Gift", item_category="Snack",
             item_subcategory=None, menu_item_health_metrics_obj="{}"),
    ],
    "truck": [
        dict(truck_id=1, franchise_id=1, year=2010, make="M", model="T", primary_city="Aix",
             region="R", country="C", franchise_flag=1),
        dict(truck_id=2, franchise_id=None, year=2012),
        dict(truck_id=3, franchise_id=2, year=2020),
    ],
    "order_header": [
        dict(order_id=1, truck_id=1, location_id=10.0, customer_id=5,
             order_ts=datetime(2024, 1, 2, 23, 59, 59), order_total=30),
        dict(order_id=2, truck_id=1, location_id=10.0, customer_id=6, order_total=7),
        dict(order_id=3, truck_id=2, location_id=10.0, customer_id=5, order_total=1),
        dict(order_id=4, truck_id=3, location_id=None, customer_id=5, order_total=2),
        dict(order_id=5, truck_id=3, location_id=11.0, customer_id=None, order_total=4),
        dict(order_id=6, truck_id=3, location_id=11.5, customer_id=5, order_total=None),
        dict(order_id=7, truck_id=3, location_id=10.0, customer_id=5, order_total=8),
    ],
    "order_detail": [
        dict(order_detail_id=n, order_id=order, menu_item_id=item, line_number=0, quantity=1,
             unit_price=1, price=1)
        for n, (order, item) in enumerate(
            [(1, 100), (1, 101), (2, 100), (3, 100), (4, 100), (5, 101), (6, 100), (7, 999),
             (None, 100)])
    ],
    "customer_loyalty": [
        dict(customer_id=5, first_name="Ann", last_name="Lee", city="Aix", e_mail="a@x"),
        dict(customer_id=8, first_name="No", last_name="Orders"),
    ],
}


def build(spark):
    built = {}
    for name, table in RAW.items():
        schema = schemas.file_schema(name)
        texts = [[None if row.get(c) is None else str(row[c]) for c in schema.names] for row in table]
        frame = spark.createDataFrame(texts, ", ".join(f"{c} string" for c in schema.names))
        frame = frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        for column in schemas.JSON_COLUMNS.get(name, ()):
            frame = frame.withColumn(column, variants.parse(F.col(column)))
        built[name] = frame
    return built


@pytest.fixture(scope="module")
def raw(spark):
    return build(spark)


def test_order_lines_keep_and_drop_the_right_rows(raw):
    lines = orders.order_lines(raw)
    assert lines.columns == orders.ORDER_LINE_COLUMNS and len(lines.columns) == 32
    got = lines.select(
        "order_id", "order_detail_id", "location_id", "customer_id", "first_name",
        "franchisee_first_name", "franchisee_last_name", "menu_item_name")
    # Dropped: a truck without franchise (3), a place that is NULL (4) or unknown (6), an unknown
    # item (7). Kept without a member: an unknown customer (2) and none at all (5).
    assert sorted(rows(got)) == [
        (1, 0, 10, 5, "Ann", "Fay", "Ott", "Chicken Bun"),
        (1, 1, 10, 5, "Ann", "Fay", "Ott", "Tea"),
        (2, 2, 10, None, None, "Fay", "Ott", "Chicken Bun"),
        (5, 5, 11, None, None, "Gil", None, "Tea"),
    ]
    assert dict(lines.dtypes)["order_total"] == "decimal(38,4)"


def test_dated_view(raw):
    dated = orders.order_lines_dated(raw)
    assert dated.columns == ["date", *orders.ORDER_LINE_COLUMNS]
    days = {row.order_id: row.date for row in dated.collect()}
    assert days == {1: date(2024, 1, 2), 2: None, 5: None}


def test_loyalty_metrics(raw):
    got = orders.loyalty_metrics(raw)
    assert got.columns == [*orders.MEMBER_COLUMNS, "total_sales", "visited_location_ids_array"]
    assert rows(got.select("customer_id", "total_sales", "visited_location_ids_array")) == [
        (5, Decimal("41.0000"), [10.0, 11.5])
    ]


def test_loyalty_metrics_count_repeated_members(raw):
    twice = {**raw, "customer_loyalty": raw["customer_loyalty"].unionAll(raw["customer_loyalty"])}
    assert rows(orders.loyalty_metrics(twice).select("total_sales")) == [(Decimal("82.0000"),)]


def test_view_reads_only_the_columns_in_use(spark, raw, new_path):
    stored = {}
    for name, frame in raw.items():
        frame.write.parquet(new_path(name))
        stored[name] = spark.read.parquet(new_path(name))
    plan = physical_plan(orders.order_lines(stored).select("order_id", "price"))
    assert "e_mail" not in plan and "menu_item_name" not in plan


def test_menu_reports(raw):
    table = raw["menu"]
    counted = menu.count_matching(table, item_category="Snack", item_subcategory="Warm Option")
    assert rows(counted) == [(2,)]
    maxima = rows(menu.group_maxima(table, "item_subcategory", "sale_price_usd"))
    assert [price for (price,) in maxima] == [None, Decimal("16.0000"), Decimal("2.5000")]
    assert rows(menu.max_price(table)) == [(Decimal("16.00"),)]
    assert rows(menu.min_price(table)) == [(Decimal("2.50"),)]


def test_price_functions(spark, raw):
    prices = menu.price_list(raw["menu"])
    above = menu.prices_above(prices, 2)
    assert [item for item, _ in rows(above)] == ["Chicken Bun", "Soup of the day", "Tea"]
    assert rows(above.filter(F.col("item").ilike("%CHICKEN%")).select("item")) == [("Chicken Bun",)]
    assert rows(menu.prices_above(prices, 16)) == []  # the floor itself is not above
    assert [item for item, _ in rows(menu.prices_below(prices, 15))] == ["Tea"]
    rates = spark.createDataFrame([("1.35",), ("2",)], "rate string")
    converted = menu.max_price_converted(raw["menu"], F.col("rate"))
    assert rows(rates.select(converted)) == [(Decimal("21.60"),), (Decimal("32.00"),)]


def test_health_metrics(raw):
    got = menu.health_metrics(raw["menu"]).select(
        "menu_item_name",
        F.to_json("menu_item_health_metrics"),
        F.col("menu_item_id").try_cast("int"),
        "obj_type",
    )
    assert rows(got) == [
        ("Chicken Bun", '[{"a":"x"}]', 100, "OBJECT"),
        ("Tea", None, None, None),
        ("Soup of the day", None, None, None),
        ("Gift", None, None, "OBJECT"),
    ]


def test_doubled_cost(raw):
    costs = raw["menu"].select(F.col("cost_of_goods_usd").cast("variant").alias("cost_of_goods_variant"))
    doubled = menu.doubled_cost(costs).select("doubled")
    assert [n for (n,) in rows(doubled)] == [25, 2, 6, None]
    kinds = costs.select(variants.type_name(F.col("cost_of_goods_variant")))
    assert rows(kinds)[:3] == [("DECIMAL",), ("INTEGER",), ("INTEGER",)]


def test_trucks(raw):
    named = trucks.trucks_with_franchisee(raw["truck"], raw["franchise"])
    assert named.columns == [
        *raw["truck"].columns, "franchisee_first_name", "franchisee_last_name"]
    assert sorted(row.truck_id for row in named.collect()) == [1, 3]
    ages = trucks.truck_ages(raw["truck"], 2026).select("truck_id", "truck_age", "truck_age_ratio")
    assert rows(ages)[0] == (1, 16, Decimal("1.007960"))
    assert rows(trucks.truck_ages(raw["truck"]).select("truck_age"))[0][0] >= 16


def test_sql_names(spark, raw):
    sql_api.register_orders(spark, raw)
    assert rows(spark.sql("SELECT max_menu_price(), min_menu_price()")) == [
        (Decimal("16.00"), Decimal("2.50"))]
    assert rows(spark.sql("SELECT max_menu_price_converted(1.35)")) == [(Decimal("21.60"),)]
    clamped = spark.sql("SELECT winsorize(12.0, 11.0, 4.0), winsorize(NULL, 11.0, 4.0)")
    assert rows(clamped) == [(Decimal("11.0000"), None)]
    chicken = spark.sql("SELECT item FROM menu_prices_above(15) WHERE item ILIKE '%CHICKEN%'")
    assert rows(chicken) == [("Chicken Bun",)]
    assert rows(spark.sql("SELECT item FROM menu_prices_below(3)")) == [("Tea",)]
    assert spark.sql("SELECT * FROM orders_v").columns[0] == "date"
    assert spark.sql("SELECT count(*) FROM customer_loyalty_metrics_v").head()[0] == 1
    held = spark.sql("""
        SELECT menu_item_health_metrics_obj:menu_item_id::int FROM menu
        WHERE menu_item_id = 100""")
    assert rows(held) == [(100,)]


def test_sql_variable_holds_a_scalar(spark, raw):
    raw["order_header"].createOrReplaceTempView("order_header")
    spark.sql("DECLARE OR REPLACE VARIABLE max_ts TIMESTAMP_NTZ")
    spark.sql("SET VAR max_ts = (SELECT max(order_ts) FROM order_header)")
    earlier = spark.sql("SELECT dateadd(DAY, -180, max_ts)")
    assert rows(earlier) == [(datetime(2023, 7, 6, 23, 59, 59),)]
