"""The six reports of the rental store.

Column names are those of the store's tables; which tables a report needs is its signature. No
key is assumed to be unique, so a repeated row on either side counts as often as it would in a
plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.aggregates import count_where, money_names, money_parts, money_total
from ledgerloom.functions.ordering import ascending
from ledgerloom.functions.scalars import ilike, concat_blank, sum_hours
from ledgerloom.operators.joins import without_match
from ledgerloom.operators.ranking import leaders, sort_down, top_k
from ledgerloom.operators.rollup import label, roll_up


def most_rented_actors(
    actor: DataFrame, film_actor: DataFrame, inventory: DataFrame, rental: DataFrame, k: int = 10
) -> DataFrame:
    """The ``k`` actors whose films were rented most; a rental counts for every actor of a film."""
    per_copy = rental.groupBy("inventory_id").agg(F.count("rental_id").alias("total_rentals"))
    per_film = roll_up(per_copy, inventory, "inventory_id", "film_id", ["total_rentals"])
    per_actor = roll_up(per_film, film_actor, "film_id", "actor_id", ["total_rentals"])
    name = concat_blank([F.col("first_name"), F.lit(" "), F.col("last_name")])
    named = actor.select("actor_id", name.alias("actor_name"))
    report = label(per_actor, named, "actor_id", ["actor_name"], ["total_rentals"])
    return top_k(report, "total_rentals", k, ["actor_id", "actor_name"])


def top_spend_category(
    payment: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    k: int = 1,
) -> DataFrame:
    """The category that earned most. Categories are told apart by id, and shown by name."""
    # A rental has about one payment, so payments meet the rentals as they are and shrink after.
    measures = money_names("total_amount")
    amounts = payment.select("rental_id", *money_parts(F.col("amount"), "total_amount"))
    paid = amounts.join(rental.select("rental_id", "inventory_id"), "rental_id")
    per_copy = paid.groupBy("inventory_id").agg(*[F.sum(measure).alias(measure) for measure in measures])
    per_film = roll_up(per_copy, inventory, "inventory_id", "film_id", measures)
    per_category = roll_up(per_film, film_category, "film_id", "category_id", measures)
    report = label(per_category, category, "category_id", ["name"], measures)
    report = report.select("category_id", "name", money_total("total_amount"))
    return top_k(report, "total_amount", k, ["category_id"]).select(
        F.col("name").alias("category"), "total_amount"
    )


def city_is_listed(city: Column) -> Column:
    """Cities that start with an A in either case, or whose name has a hyphen."""
    return ilike(city, "a%") | city.like("%-%")


def top_hours_categories(
    rental: DataFrame,
    inventory: DataFrame,
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    city: DataFrame,
) -> DataFrame:
    """Per listed city, the category rented for the most hours in total; ties all stay.

    The city filter is met first, in the small customer tables, and thins the rentals before
    they are joined to the film tables.
    """
    residents = (
        city.filter(city_is_listed(F.col("city"))).select("city_id", "city")
        .join(address.select("address_id", "city_id"), "city_id")
        .join(customer.select("customer_id", "address_id"), "address_id")
        .select("customer_id", "city")
    )
    copies = (
        film_category.select("film_id", "category_id")
        .join(category.select("category_id", F.col("name").alias("category")), "category_id")
        .join(film.select("film_id"), "film_id")
        .join(inventory.select("inventory_id", "film_id"), "film_id")
        .select("inventory_id", "category")
    )
    facts = (
        rental.select("customer_id", "inventory_id", "rental_date", "return_date")
        .join(residents, "customer_id")
        .join(copies, "inventory_id")
    )
    return hours_leaders(facts, "city", "category", "rental_date", "return_date")


def hours_leaders(
    facts: DataFrame, place: str, category: str, start: str, end: str
) -> DataFrame:
    """Total hours per place and category, reduced to the leading categories of each place."""
    totals = facts.groupBy(place, category).agg(
        sum_hours(F.col(start), F.col(end)).alias("total_hours")
    )
    best = leaders(totals, [place], "total_hours")
    return best.orderBy(ascending(place), ascending(category))


def customers_by_city(city: DataFrame, address: DataFrame, customer: DataFrame) -> DataFrame:
    """Active and inactive customers per city id, most inactive first; other states count for none."""
    counters = ["active_customers", "inactive_customers"]
    # An address has about one customer, so customers meet their addresses as they are.
    placed = customer.select("address_id", "active").join(
        address.select("address_id", "city_id"), "address_id"
    )
    per_city = placed.groupBy("city_id").agg(
        count_where(F.col("active") == 1).alias("active_customers"),
        count_where(F.col("active") == 0).alias("inactive_customers"),
    )
    report = label(per_city, city, "city_id", ["city"], counters)
    return sort_down(report, "inactive_customers", ["city", "city_id"]).select("city", *counters)


def films_not_stocked(film: DataFrame, inventory: DataFrame) -> DataFrame:
    """Films that no copy in the inventory refers to."""
    return without_match(
        film.select("film_id", "title"),
        inventory.select(F.col("film_id").alias("stocked_film_id")),
        "film_id",
        "stocked_film_id",
    )


def films_per_category(
    category: DataFrame, film_category: DataFrame, film: DataFrame
) -> DataFrame:
    """Films per category id, most first."""
    listed = film.select("film_id").join(film_category.select("film_id", "category_id"), "film_id")
    per_category = listed.groupBy("category_id").agg(F.count("film_id").alias("film_count"))
    report = label(per_category, category, "category_id", ["name"], ["film_count"])
    return sort_down(report, "film_count", ["name", "category_id"]).select(
        F.col("name").alias("category"), "film_count"
    )
