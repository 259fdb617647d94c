"""Reports, price functions and semi-structured access on the menu table."""

from __future__ import annotations

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, localcontext

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions import variants
from ledgerloom.functions.ordering import ascending, descending
from ledgerloom.operators.ranking import sort_down

PRICE = "sale_price_usd"


def count_matching(rows: DataFrame, **equal: object) -> DataFrame:
    """How many rows have all the given column values."""
    for name, value in equal.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows.agg(F.count("*").alias("row_count"))


def group_maxima(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The largest value of each group in descending order; the group itself is not shown."""
    return sort_down(rows.groupBy(group).agg(F.max(value).alias("max")).select("max"), "max")


def max_price(menu: DataFrame, price: str = PRICE, returns: str = "decimal(5,2)") -> DataFrame:
    """One row: the highest price."""
    return menu.agg(F.max(price).cast(returns).alias("max_price"))


def min_price(menu: DataFrame, price: str = PRICE, returns: str = "decimal(5,2)") -> DataFrame:
    """One row: the lowest price."""
    return menu.agg(F.min(price).cast(returns).alias("min_price"))


def max_price_converted(
    menu: DataFrame, rate: Column, price: str = PRICE, returns: str = "decimal(38,2)"
) -> Column:
    """The highest price times a rate, callable on every row of another table.

    The rate stays outside the scalar subquery, so it may be a column of that table; the maximum
    is still computed once.
    """
    highest = menu.agg(F.max(price).cast("decimal(28,4)")).scalar()
    return (rate.cast("decimal(10,4)") * highest).cast(returns)


def price_list(
    menu: DataFrame, item: str = "menu_item_name", price: str = PRICE
) -> DataFrame:
    """What each item costs."""
    return menu.select(F.col(item).alias("item"), F.col(price).alias("price"))


def prices_above(prices: DataFrame, floor: Decimal | int | float | str) -> DataFrame:
    """Entries of a price list dearer than the floor, dearest first."""
    return _dearest_first(prices.filter(F.col("price") > _bound(prices, floor, ROUND_FLOOR)))


def prices_below(prices: DataFrame, ceiling: Decimal | int | float | str) -> DataFrame:
    """Entries of a price list cheaper than the ceiling, dearest first."""
    return _dearest_first(prices.filter(F.col("price") < _bound(prices, ceiling, ROUND_CEILING)))


def _bound(prices: DataFrame, bound: Decimal | int | float | str, rounding: str) -> Column:
    """The bound in the type of the price, so that the reader can use it.

    Decimals that a price cannot have are cut toward the side where no price lies between.
    """
    kind, exact = prices.schema["price"].dataType, Decimal(str(bound))
    if isinstance(kind, T.DecimalType):
        step = Decimal(1).scaleb(-kind.scale)
        with localcontext(prec=100):
            return F.lit(str(exact.quantize(step, rounding))).cast(kind)
    if isinstance(kind, T.IntegralType):
        return F.lit(int(exact.to_integral_value(rounding)))
    return F.lit(float(exact))


def _dearest_first(prices: DataFrame) -> DataFrame:
    return prices.orderBy(descending("price"), ascending("item"))


def health_metrics(menu: DataFrame) -> DataFrame:
    """The health metrics object of each item, and the item id stored inside it."""
    held = F.col("menu_item_health_metrics_obj")
    return menu.select(
        "menu_item_name",
        variants.field(held, "menu_item_health_metrics").alias("menu_item_health_metrics"),
        variants.field(held, "menu_item_id").alias("menu_item_id"),
        variants.type_name(held).alias("obj_type"),
    )


def doubled_cost(test_menu: DataFrame) -> DataFrame:
    """A VARIANT cost next to twice that cost, computed as a number."""
    cost = F.col("cost_of_goods_variant")
    return test_menu.select(
        cost, (variants.as_number(cost) * F.lit(2.0).cast("decimal(2,1)")).alias("doubled")
    )
