"""The rental reports: hand-made edge cases, and random stores against plain SQL."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from ledgerloom.plans import rental
from tests.util import Frames, physical_plan, rows, same_rows

DAY = datetime(2024, 1, 1)


@pytest.fixture(params=[1, 2, 3])
def store(spark, request):
    """A small store with repeated keys, NULL keys, orphans and one hot film."""
    f = Frames(spark, request.param)

    def money():
        return None if f.random.random() < 0.1 else Decimal(f.random.randint(1, 99_999)) / 100

    def lent():
        out = DAY + timedelta(seconds=f.random.randint(0, 10**6))
        back = out + timedelta(microseconds=f.random.randint(0, 10**12))
        return out, None if f.random.random() < 0.2 else back

    f.add("actor", "actor_id INT, first_name STRING, last_name STRING",
          f.draw(20, f.whole(0, 15), f.pick("Ann", "Bo", None), f.pick("Lee", "Ray", None)))
    f.add("film_actor", "actor_id INT, film_id INT",
          f.draw(120, f.whole(0, 15, 0.05), f.hot(0, 40, 7)))
    f.add("inventory", "inventory_id INT, film_id INT",
          f.draw(80, f.whole(0, 60), f.hot(0, 35, 7, 0.3)))
    f.add("rental", "rental_id INT, inventory_id INT, customer_id INT,"
          " rental_date TIMESTAMP, return_date TIMESTAMP",
          [(*ids, *lent()) for ids in
           f.draw(400, f.whole(0, 300, 0.05), f.hot(0, 65, 3, 0.3), f.whole(0, 45, 0.1))])
    f.frames["rental"] = f.frames["rental"].selectExpr(
        "rental_id", "inventory_id", "customer_id", "rental_date::timestamp_ntz rental_date",
        "return_date::timestamp_ntz return_date")
    f.add("payment", "rental_id INT, amount DECIMAL(5,2)",
          f.draw(400, f.hot(0, 300, 11, 0.3), money))
    f.add("film", "film_id INT, title STRING",
          f.draw(45, f.whole(0, 40, 0.1), f.pick("a", "b", "c")))
    f.add("film_category", "film_id INT, category_id INT",
          f.draw(60, f.whole(0, 40), f.whole(0, 6, 0.1)))
    f.add("category", "category_id INT, name STRING",
          [*enumerate(["Action", "Drama", "Drama", "Music", None]), (1, "Drama")])
    f.add("customer", "customer_id INT, address_id INT, active INT",
          f.draw(60, f.whole(0, 40), f.hot(0, 20, 5, 0.3), f.whole(0, 2, 0.2)))
    f.add("address", "address_id INT, city_id INT", f.draw(25, f.whole(0, 18), f.whole(0, 8)))
    f.add("city", "city_id INT, city STRING",
          [*enumerate(["Aurora", "aachen", "Baden-Baden", "Aix-les-Bains", "Bonn", "Aurora"]),
           (3, "Aix-les-Bains"), (6, None)])
    return f


def given(store, *names):
    return {name: store.frames[name] for name in names}


def test_most_rented_actors(store):
    ours = rental.most_rented_actors(
        **given(store, "actor", "film_actor", "inventory", "rental"), k=10)
    same_rows(ours, store.sql("""
        SELECT actor_id, coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS shown,
               count(rental_id) AS n
        FROM rental JOIN inventory USING (inventory_id) JOIN film_actor USING (film_id)
        JOIN actor USING (actor_id)
        GROUP BY 1, 2 ORDER BY 3 DESC NULLS FIRST, 1, 2 LIMIT 10"""))


def test_top_spend_category(store):
    ours = rental.top_spend_category(
        **given(store, "payment", "rental", "inventory", "film_category", "category"), k=3)
    same_rows(ours, store.sql("""
        SELECT name, sum(amount)
        FROM category JOIN film_category USING (category_id) JOIN inventory USING (film_id)
        JOIN rental USING (inventory_id) JOIN payment USING (rental_id)
        GROUP BY category_id, name ORDER BY 2 DESC NULLS FIRST, category_id LIMIT 3"""))


def test_top_hours_categories(store):
    ours = rental.top_hours_categories(**given(
        store, "rental", "inventory", "film", "film_category", "category", "customer",
        "address", "city"))
    same_rows(ours, store.sql("""
        WITH hours AS (
            SELECT city, name, sum(epoch_us(return_date) - epoch_us(rental_date)) / 3.6e9 AS h
            FROM city JOIN address USING (city_id) JOIN customer USING (address_id)
            JOIN rental USING (customer_id) JOIN inventory USING (inventory_id)
            JOIN film USING (film_id) JOIN film_category USING (film_id)
            JOIN category USING (category_id)
            WHERE city ILIKE 'a%' OR city LIKE '%-%'
            GROUP BY city, name)
        SELECT * FROM hours
        QUALIFY rank() OVER (PARTITION BY city ORDER BY h DESC NULLS FIRST) = 1"""))


def test_customers_by_city(store):
    ours = rental.customers_by_city(**given(store, "city", "address", "customer"))
    same_rows(ours, store.sql("""
        SELECT city, count(*) FILTER (active = 1), count(*) FILTER (active = 0)
        FROM customer JOIN address USING (address_id) JOIN city USING (city_id)
        GROUP BY city_id, city"""))


def test_films_not_stocked(store):
    ours = rental.films_not_stocked(**given(store, "film", "inventory"))
    same_rows(ours, store.sql("""
        SELECT film_id, title FROM film
        WHERE NOT EXISTS (SELECT 1 FROM inventory WHERE inventory.film_id = film.film_id)"""))


def test_films_per_category(store):
    ours = rental.films_per_category(**given(store, "category", "film_category", "film"))
    same_rows(ours, store.sql("""
        SELECT name, count(film_id)
        FROM film JOIN film_category USING (film_id) JOIN category USING (category_id)
        GROUP BY category_id, name"""))


def hours_store(spark, lent):
    """Rentals given as (category, city, hours or None), one copy per category."""
    categories = sorted({category for category, _, _ in lent})
    cities = sorted({city for _, city, _ in lent})
    one_per_category = [(i,) for i, _ in enumerate(categories)]
    frames = {
        "rental": spark.createDataFrame(
            [(i, categories.index(g), cities.index(c), DAY,
              None if h is None else DAY + timedelta(hours=h)) for i, (g, c, h) in enumerate(lent)],
            "rental_id int, inventory_id int, customer_id int,"
            " rental_date timestamp_ntz, return_date timestamp_ntz"),
        "inventory": spark.createDataFrame(
            [(i, i) for (i,) in one_per_category], "inventory_id int, film_id int"),
        "film": spark.createDataFrame(one_per_category, "film_id int"),
        "film_category": spark.createDataFrame(
            [(i, i) for (i,) in one_per_category], "film_id int, category_id int"),
        "category": spark.createDataFrame(
            list(enumerate(categories)), "category_id int, name string"),
        "customer": spark.createDataFrame(
            [(i, i) for i, _ in enumerate(cities)], "customer_id int, address_id int"),
        "address": spark.createDataFrame(
            [(i, i) for i, _ in enumerate(cities)], "address_id int, city_id int"),
        "city": spark.createDataFrame(list(enumerate(cities)), "city_id int, city string"),
    }
    return frames


def test_rank_keeps_ties_and_puts_unreturned_first(spark):
    lent = [
        ("Action", "Aurora", 5), ("Drama", "Aurora", 5), ("Music", "Aurora", 4),
        ("Action", "aachen", 9), ("Drama", "aachen", None),
        ("Action", "Aix-les-Bains", 1),
        ("Action", "Bonn", 100),
    ]
    got = rental.top_hours_categories(**hours_store(spark, lent))
    assert rows(got) == [
        ("Aix-les-Bains", "Action", 1.0),
        ("Aurora", "Action", 5.0),
        ("Aurora", "Drama", 5.0),
        ("aachen", "Drama", None),
    ]
    plan = physical_plan(got)
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_cities_with_one_name_stay_apart_in_counts(spark):
    got = rental.customers_by_city(
        spark.createDataFrame([(1, "Aurora"), (2, "Aurora")], "city_id int, city string"),
        spark.createDataFrame([(1, 1), (2, 2)], "address_id int, city_id int"),
        spark.createDataFrame(
            [(1, 1, 1), (2, 1, 0), (3, 2, 2), (4, 2, None)],
            "customer_id int, address_id int, active int"),
    )
    assert rows(got) == [("Aurora", 1, 1), ("Aurora", 0, 0)]


def test_top_k_and_anti_join_plans(spark, store):
    top = rental.most_rented_actors(
        **given(store, "actor", "film_actor", "inventory", "rental"))
    assert "TakeOrderedAndProject" in physical_plan(top)
    anti = physical_plan(rental.films_not_stocked(**given(store, "film", "inventory")))
    assert "LeftAnti" in anti and "LeftOuter" not in anti
