"""One query per operator, on the generated tables.

Each function takes the session and a table folder and returns a DataFrame. Where the tables can
take the part of the order system's or the rental store's tables, the library's own report runs
on them; otherwise the query puts the same operators together.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions import aggregates, scalars, variants
from ledgerloom.functions.ordering import ascending
from ledgerloom.operators import changes, history, joins, ranking, retention
from ledgerloom.operators.rollup import roll_up
from ledgerloom.operators.stored_log import StoredLog
from ledgerloom.plans import catalog_views, menu, orders, rental, sql_api, trucks
from ledgerloom.session import scratch_path
from ledgerloom.sources import csv_files, tables
from ledgerloom.streaming.csv_arrivals import load_arrivals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def money(name: str) -> Column:
    """Money given as floating-point, in the declared type, so that sums are exact in any order."""
    return F.col(name).cast("decimal(38,4)")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- the rental store's reports -----------------------------------------------------------------


@query
def top_k_bridge(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read(spark, folder, "lineitem")
    nation = read(spark, folder, "nation")
    actor = (
        read(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("actor_id"),
            F.col("s_name").alias("first_name"),
            F.col("n_name").alias("last_name"),
        )
    )
    film_actor = lineitem.select(
        F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")
    ).distinct()
    inventory = read(spark, folder, "part").select(
        F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id")
    )
    rentals = lineitem.select(
        F.col("l_orderkey").alias("rental_id"), F.col("l_partkey").alias("inventory_id")
    )
    return rental.most_rented_actors(actor, film_actor, inventory, rentals, k=10)


@query
def top1_category_spend(spark: SparkSession, folder: str) -> DataFrame:
    measures = aggregates.money_names("total_amount")
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", *aggregates.money_parts(F.col("l_extendedprice"), "total_amount")
    )
    orders_ = read(spark, folder, "orders").select("o_orderkey")
    per_part = (
        lines.join(orders_, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(*[F.sum(measure).alias(measure) for measure in measures])
    )
    parts = read(spark, folder, "part").select("p_partkey", "p_type")
    per_type = roll_up(per_part, parts, "p_partkey", "p_type", measures)
    per_type = per_type.select("p_type", aggregates.money_total("total_amount"))
    return ranking.top_k(per_type, "total_amount", 1, ["p_type"]).select(
        F.col("p_type").alias("category"), F.col("total_amount").cast("double").alias("total_amount")
    )


@query
def rank_category_hours(spark: SparkSession, folder: str) -> DataFrame:
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, folder, "nation")
    regions = read(spark, folder, "region")
    # The orders are located and thinned out before the order lines, the largest table, move.
    placed = (
        read(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(scalars.ilike(F.col("r_name"), "a%") | F.col("o_orderpriority").like("%-H%"))
        .select("o_orderkey", "o_orderdate", F.col("n_name").alias("city"))
    )
    parts = read(spark, folder, "part").select("p_partkey", F.col("p_type").alias("category"))
    facts = (
        read(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_shipdate")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    best = rental.hours_leaders(facts, "city", "category", "o_orderdate", "l_shipdate")
    return best.select("city", "category", F.round("total_hours", 2).alias("total_hours"))


@query
def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region").select("r_regionkey")
    city = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city")
    )
    address = nation.select(
        F.col("n_nationkey").alias("address_id"), F.col("n_nationkey").alias("city_id")
    )
    balance = F.col("c_acctbal")
    customer = read(spark, folder, "customer").select(
        F.col("c_nationkey").alias("address_id"),
        F.when(balance >= 0, 1).when(balance < 0, 0).alias("active"),
    )
    return rental.customers_by_city(city, address, customer)


@query
def count_per_category(spark: SparkSession, folder: str) -> DataFrame:
    category = read(spark, folder, "region").select(
        F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name")
    )
    film_category = read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("film_id"), F.col("n_regionkey").alias("category_id")
    )
    film = read(spark, folder, "supplier").select(F.col("s_nationkey").alias("film_id"))
    return rental.films_per_category(category, film_category, film)


@query
def anti_join(spark: SparkSession, folder: str) -> DataFrame:
    urgent = (
        read(spark, folder, "orders")
        .filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
        .select("o_custkey")
    )
    customers = read(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.without_match(customers, urgent, "c_custkey", "o_custkey")


@query
def films_not_stocked(spark: SparkSession, folder: str) -> DataFrame:
    film = read(spark, folder, "part").select(
        F.when(F.col("p_size") % 7 > 0, F.col("p_partkey")).alias("film_id"), F.col("p_name").alias("title")
    )
    stocked = read(spark, folder, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("film_id"))
    return rental.films_not_stocked(film, stocked)


@query
def top_spend_category(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    payment = lines.select(
        F.col("l_orderkey").alias("rental_id"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("amount"),
    )
    rentals = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("inventory_id")
    )
    inventory = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("inventory_id"), F.col("c_nationkey").alias("film_id")
    )
    nation = read(spark, folder, "nation")
    film_category = nation.select(
        F.col("n_nationkey").alias("film_id"), F.col("n_regionkey").alias("category_id")
    )
    category = read(spark, folder, "region").select(
        F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name")
    )
    best = rental.top_spend_category(payment, rentals, inventory, film_category, category, k=3)
    return best.select("category", F.col("total_amount").cast("string").alias("total_amount"))


# --- the order system's views -------------------------------------------------------------------


@query
def orders_wide_view(spark: SparkSession, folder: str) -> DataFrame:
    nations = read(spark, folder, "nation").select(
        "n_nationkey", F.col("n_name").alias("supplier_nation")
    )
    suppliers = read(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    members = (
        read(spark, folder, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    )
    headers = joins.left_join(
        read(spark, folder, "orders"), members, "o_custkey", "c_custkey"
    )
    parts = read(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return (
        read(spark, folder, "lineitem")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority",
            "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate",
            "s_suppkey", "s_name", "supplier_nation", "p_partkey", "p_name", "p_brand", "p_type",
            "c_custkey", "c_name", "c_mktsegment", "c_acctbal",
        )
    )


@query
def loyalty_metrics(spark: SparkSession, folder: str) -> DataFrame:
    members = read(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    placed = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        money("o_totalprice").alias("order_total"),
        "o_orderpriority",
    )
    metrics = orders.member_metrics(
        members, placed, "c_custkey", "order_total", "o_orderpriority"
    )
    return metrics.select(
        *members.columns,
        F.col("total").cast("double").alias("total_sales"),
        F.array_join("visited", "|").alias("order_priorities"),
    )


@query
def orders_date_view(spark: SparkSession, folder: str) -> DataFrame:
    return orders.with_date(read(spark, folder, "orders"), "o_orderdate")


@query
def star_join_rename(spark: SparkSession, folder: str) -> DataFrame:
    s = read(spark, folder, "supplier").alias("s")
    n = read(spark, folder, "nation").alias("n")
    return s.join(n, F.col("s.s_nationkey") == F.col("n.n_nationkey")).select(
        "s.*", F.col("n.n_name").alias("supplier_nation")
    )


@query
def join_mixed_types(spark: SparkSession, folder: str) -> DataFrame:
    placed = read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice"
    )
    customers = read(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.join_as_double(placed, customers, "o_custkey", "c_custkey")


# --- scans, filters, plain aggregates -----------------------------------------------------------


@query
def full_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part")


@query
def filtered_count(spark: SparkSession, folder: str) -> DataFrame:
    return menu.count_matching(read(spark, folder, "part"), p_type="ECONOMY", p_size=11)


@query
def group_max_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return menu.group_maxima(read(spark, folder, "part"), "p_brand", "p_retailprice")


@query
def global_minmax_ts(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").agg(
        F.max("ts").alias("max_ts"), F.min("ts").alias("min_ts")
    )


@query
def cutoff_max(spark: SparkSession, folder: str) -> DataFrame:
    return retention.newest_expired(read(spark, folder, "events"), "ts", 10)


@query
def limit_sample(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    return events.orderBy(ascending("ts"), ascending("event_id")).limit(100)


@query
def age_columns(spark: SparkSession, folder: str) -> DataFrame:
    since = F.year("o_orderdate")
    return read(spark, folder, "orders").select(
        "o_orderkey",
        scalars.year_gap(2026, since).alias("age"),
        scalars.year_ratio(2026, since).cast("double").alias("age_ratio"),
    )


@query
def ts_diff_seconds(spark: SparkSession, folder: str) -> DataFrame:
    noon = instant("2024-01-15 12:00:00.5")
    return read(spark, folder, "events").select(
        "event_id", scalars.seconds_crossed(noon, F.col("ts")).alias("seconds")
    )


@query
def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        "c_custkey",
        F.abs("c_acctbal").alias("abs_balance"),
        F.upper("c_name").alias("upper_name"),
        scalars.concat_blank([F.col("c_name"), F.lit(" "), F.col("c_mktsegment")]).alias("label"),
    )


# --- scalar and table functions -----------------------------------------------------------------


@query
def scalar_fn_minmax(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part")
    highest = menu.max_price(part, "p_retailprice")
    lowest = menu.min_price(part, "p_retailprice")
    return highest.select(
        F.col("max_price").cast("double"), lowest.scalar().cast("double").alias("min_price")
    )


@query
def scalar_fn_converted(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part")
    converted = menu.max_price_converted(part, F.lit(1.35), "p_retailprice")
    return spark.range(1).select(converted.cast("double").alias("converted"))


@query
def winsorize(spark: SparkSession, folder: str) -> DataFrame:
    clamped = scalars.clamp(F.col("l_quantity"), F.lit(40.0), F.lit(5.0))
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", clamped.alias("clamped")
    )


def part_prices(spark: SparkSession, folder: str) -> DataFrame:
    return menu.price_list(read(spark, folder, "part"), "p_name", "p_retailprice")


@query
def table_fn_above(spark: SparkSession, folder: str) -> DataFrame:
    return menu.prices_above(part_prices(spark, folder), 995.0)


@query
def table_fn_below(spark: SparkSession, folder: str) -> DataFrame:
    return menu.prices_below(part_prices(spark, folder), 905.0)


def stored_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The prices as stored fixed-point numbers."""
    priced = part_prices(spark, folder).select("item", F.col("price").cast("decimal(38,4)").alias("price"))
    return tables.write_new(priced, scratch_path(spark, "prices"))


@query
def table_fn_above_exact(spark: SparkSession, folder: str) -> DataFrame:
    above = menu.prices_above(stored_prices(spark, folder), "994.99995")
    return above.select("item", F.col("price").cast("string").alias("price"))


@query
def table_fn_below_exact(spark: SparkSession, folder: str) -> DataFrame:
    below = menu.prices_below(stored_prices(spark, folder), "905.00005")
    return below.select("item", F.col("price").cast("string").alias("price"))


@query
def table_fn_ilike(spark: SparkSession, folder: str) -> DataFrame:
    return menu.prices_above(part_prices(spark, folder), 950.0).filter(
        scalars.ilike(F.col("item"), "%RING%")
    )


@query
def ilike_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").filter(scalars.ilike(F.col("c_mktsegment"), "bUi%")).select("c_custkey")


# --- semi-structured columns --------------------------------------------------------------------


def event_objects(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select(
        "event_id", variants.parse(F.col("props")).alias("props")
    )


@query
def variant_extract(spark: SparkSession, folder: str) -> DataFrame:
    return event_objects(spark, folder).select(
        "event_id",
        variants.field_as(F.col("props"), "k", "bigint").alias("k"),
        variants.field_as(F.col("props"), "missing", "bigint").alias("missing"),
    )


@query
def variant_stored_field(spark: SparkSession, folder: str) -> DataFrame:
    """One member of a stored VARIANT; the scan reads that member alone."""
    stored = tables.write_new(event_objects(spark, folder), scratch_path(spark, "variants"))
    return stored.select("event_id", variants.field_as(F.col("props"), "k", "bigint").alias("k"))


@query
def variant_type(spark: SparkSession, folder: str) -> DataFrame:
    held = F.col("props")
    return event_objects(spark, folder).select(
        "event_id",
        variants.type_name(held).alias("object_type"),
        variants.type_name(variants.field(held, "k")).alias("member_type"),
    )


@query
def variant_arith(spark: SparkSession, folder: str) -> DataFrame:
    number = variants.as_number(variants.field(F.col("props"), "k"))
    return event_objects(spark, folder).select(
        "event_id", (number * F.lit(2.0).cast("decimal(2,1)")).cast("double").alias("doubled")
    )


@query
def ctas_variant(spark: SparkSession, folder: str) -> DataFrame:
    stored = tables.create_as(
        read(spark, folder, "customer"),
        scratch_path(spark, "ctas"),
        {
            "custkey": "c_custkey",
            "balance_variant": "CAST(CAST(c_acctbal AS DECIMAL(38,4)) AS VARIANT)",
        },
    )
    balance = F.col("balance_variant")
    return stored.select(
        "custkey",
        variants.as_number(balance).cast("double").alias("balance"),
        variants.type_name(balance).alias("balance_type"),
    )


# --- loads and inserts --------------------------------------------------------------------------


def write_csv(rows: DataFrame, directory: str) -> None:
    options = {k: v for k, v in csv_files.CSV_FORMAT.items() if k not in ("mode", "enforceSchema")}
    rows.write.options(**options).csv(directory)


@query
def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    source = read(spark, folder, "orders")
    directory = scratch_path(spark, "csv")
    write_csv(source, directory)
    return csv_files.load_csv(spark, directory, source.schema, scratch_path(spark, "loaded"))


@query
def csv_load_refused(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as CSV lines, some of them spoiled: the loaded ones, and the refused ones by reason."""
    key = F.col("o_orderkey")
    held = F.when(key % 7 == 0, "{broken").otherwise(F.concat(F.lit('{""k"": '), key.cast("string"), F.lit("}")))
    line = F.concat(
        F.when(key % 5 == 0, "x").otherwise(""), key.cast("string"), F.lit(","), "o_orderpriority",
        F.lit(',"'), held, F.lit('"'), F.when(key % 11 == 0, ",more").otherwise(""),
    )
    directory = scratch_path(spark, "csv")
    read(spark, folder, "orders").select(line.alias("line")).write.text(directory)
    schema = T.StructType().add("id", T.LongType()).add("priority", T.StringType()).add("held", T.StringType())
    loaded, refused = csv_files.load_csv_or_refuse(
        spark, directory, schema, scratch_path(spark, "judged"), None, ["held"], {"priority": 10}
    )
    good = loaded.select(F.lit("loaded").alias("verdict"), variants.field_as(F.col("held"), "k", "bigint").alias("k"))
    bad = refused.select(F.col("reason").alias("verdict"), F.lit(None).cast("bigint").alias("k"))
    return good.unionByName(bad).groupBy("verdict").agg(
        F.count("*").alias("lines"), F.sum("k").alias("sum_k")
    )


@query
def csv_load_incremental(spark: SparkSession, folder: str) -> DataFrame:
    source = read(spark, folder, "customer")
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    directory = scratch_path(spark, "arrivals")
    target, history_ = scratch_path(spark, "loaded"), scratch_path(spark, "history")
    write_csv(source.filter(in_debt), f"{directory}/first")
    load_arrivals(spark, directory, source.schema, target, history_)
    load_arrivals(spark, directory, source.schema, target, history_)  # nothing new
    write_csv(source.filter(~in_debt), f"{directory}/second")
    return load_arrivals(spark, directory, source.schema, target, history_)


@query
def load_then_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops loaded once, a rerun, rows appended beside them, and a third drop."""
    source = read(spark, folder, "customer")
    part = F.pmod(F.col("c_custkey"), F.lit(4))
    directory = scratch_path(spark, "arrivals")
    target, history_ = scratch_path(spark, "loaded"), scratch_path(spark, "history")
    for drop in (0, 1):
        write_csv(source.filter(part == drop), f"{directory}/{drop}")
        load_arrivals(spark, directory, source.schema, target, history_)
    load_arrivals(spark, directory, source.schema, target, history_)  # nothing new
    tables.append(source.filter(part == 2), target)
    write_csv(source.filter(part == 3), f"{directory}/3")
    return load_arrivals(spark, directory, source.schema, target, history_)


@query
def insert_values(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "insert")
    stored = tables.write_new(
        read(spark, folder, "orders").select(
            F.col("o_orderkey").cast("decimal(38,0)").alias("test_number"),
            F.col("o_orderpriority").alias("test_varchar"),
            (F.col("o_orderstatus") == "F").alias("test_boolean"),
            F.to_date("o_orderdate").alias("test_date"),
            F.lit(None).cast("variant").alias("test_variant"),
        ),
        path,
    )
    row = (28, "ha!", True, "2024-01-01", None)
    return tables.append(tables.value_rows(spark, stored, [row]), path).select(
        F.col("test_number").cast("bigint").alias("test_number"),
        "test_varchar",
        "test_boolean",
        "test_date",
        F.col("test_variant").isNull().alias("variant_is_null"),
    )


# --- row changes and history --------------------------------------------------------------------


@query
def update_rows(spark: SparkSession, folder: str) -> DataFrame:
    half = F.col("o_totalprice") / 2
    return changes.update_rows(
        read(spark, folder, "orders"), {"o_totalprice": half}, F.col("o_orderstatus") == "P"
    )


@query
def retention_delete(spark: SparkSession, folder: str) -> DataFrame:
    return retention.keep_recent(read(spark, folder, "events"), "ts", 10)


@query
def retention_job(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    return retention.expire(events, "ts", 10, scratch_path(spark, "retention"))


@query
def clone_append_counts(spark: SparkSession, folder: str) -> DataFrame:
    source = read(spark, folder, "orders")
    path = scratch_path(spark, "clone")
    tables.copy_table(source, path)
    clone = tables.append(source, path)
    return tables.row_counts({"orders_clone": clone, "orders": source})


@query
def footer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "events")
    return tables.stored_row_counts(spark, {name: f"{folder}/{name}.parquet" for name in names})


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the history of a table with one row per user; an error removes the user."""
    return read(spark, folder, "events").select(
        "user_id",
        "event_type",
        "value",
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("commit_id"),
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"),
    )


def last_commit_ts(log: DataFrame) -> Column:
    return log.agg(F.max("commit_ts")).scalar()


@query
def asof_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    moment = scalars.utc_clock(scalars.zoned("2024-01-15 05:00:00.000 -0700"))
    return history.as_of(event_log(spark, folder), ["user_id"], moment, with_commit=True)


@query
def asof_offset(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder)
    return history.as_of_offset(log, ["user_id"], -600, last_commit_ts(log), with_commit=True)


@query
def asof_before(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder)
    last_purchase = log.filter(F.col("event_type") == "purchase").agg(F.max("commit_id")).scalar()
    return history.before_commit(log, ["user_id"], last_purchase, with_commit=True)


@query
def clone_asof(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder)
    past = history.as_of_offset(log, ["user_id"], -600, last_commit_ts(log), with_commit=True)
    return tables.copy_table(past, scratch_path(spark, "clone"))


@query
def history_prune(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder)
    return history.prune(log, ["user_id"], scalars.add_days(last_commit_ts(log), -10))


@query
def update_log(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "log")
    log = changes.write_log(event_log(spark, folder), path)
    newest = log.agg(F.max("commit_ts").alias("ts"), F.max("commit_id").alias("id"))
    commit = changes.update_commit(
        log,
        ["user_id"],
        {"value": F.col("value") / 2},
        scalars.add_days(newest.select("ts").scalar(), 1),
        newest.select("id").scalar() + 1,
        F.col("value") > 10,
    )
    return history.latest(changes.append_log(commit, path), ["user_id"])


@query
def delete_log(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "log")
    log = changes.write_log(event_log(spark, folder), path)
    newest = log.agg(F.max("commit_ts").alias("ts"), F.max("commit_id").alias("id"))
    commit = changes.delete_commit(
        log,
        ["user_id"],
        F.col("value") > 10,
        scalars.add_days(newest.select("ts").scalar(), 1),
        newest.select("id").scalar() + 1,
    )
    return history.latest(changes.append_log(commit, path), ["user_id"])


@query
def update_key_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every second user moves to the next key; nobody is left at the old one."""
    path = scratch_path(spark, "log")
    doubled = event_log(spark, folder).withColumn("user_id", F.col("user_id") * 2)
    log = changes.write_log(doubled, path)
    newest = log.agg(F.max("commit_ts").alias("ts"), F.max("commit_id").alias("id"))
    commit = changes.update_commit(
        log,
        ["user_id"],
        {"user_id": F.col("user_id") + 1},
        scalars.add_days(newest.select("ts").scalar(), 1),
        newest.select("id").scalar() + 1,
        F.col("value") > 10,
    )
    return history.latest(changes.append_log(commit, path), ["user_id"])


@query
def update_rounded(spark: SparkSession, folder: str) -> DataFrame:
    """A quotient that goes into a whole-number column."""
    path = scratch_path(spark, "log")
    whole = event_log(spark, folder).withColumn("value", F.round("value").cast("bigint"))
    log = changes.write_log(whole, path)
    newest = log.agg(F.max("commit_ts").alias("ts"), F.max("commit_id").alias("id"))
    commit = changes.update_commit(
        log,
        ["user_id"],
        {"value": F.col("value") / 2},
        scalars.add_days(newest.select("ts").scalar(), 1),
        newest.select("id").scalar() + 1,
    )
    return history.latest(changes.append_log(commit, path), ["user_id"])


@query
def asof_stored_log(spark: SparkSession, folder: str) -> DataFrame:
    log = changes.write_log(event_log(spark, folder), scratch_path(spark, "log"))
    return history.as_of(log, ["user_id"], instant("2024-01-15 12:00:00"), with_commit=True)


@query
def prune_stored_log(spark: SparkSession, folder: str) -> DataFrame:
    """The state before the last commits, read from a log that was pruned and stored."""
    log = changes.write_log(event_log(spark, folder), scratch_path(spark, "log"))
    cutoff = instant("2024-01-15 12:00:00")
    pruned = changes.write_pruned(log, ["user_id"], cutoff, scratch_path(spark, "pruned"))
    return history.as_of(pruned, ["user_id"], cutoff, with_commit=True)


def store_log(spark: SparkSession, folder: str) -> StoredLog:
    return StoredLog.create(event_log(spark, folder), scratch_path(spark, "stored-log"), ["user_id"])


@query
def before_stored_log(spark: SparkSession, folder: str) -> DataFrame:
    """Just before a commit; the index of commits tells which days to open."""
    log = store_log(spark, folder)
    purchases = log.rows().filter(F.col("event_type") == "purchase")
    return log.before(purchases.agg(F.max("commit_id")).first()[0], with_commit=True)


@query
def asof_snapshot_log(spark: SparkSession, folder: str) -> DataFrame:
    """A past state from a stored state and the days after it."""
    log = store_log(spark, folder)
    for day in (datetime.date(2024, 1, 5), datetime.date(2024, 1, 10)):
        log.build_state(day)
    return log.as_of(datetime.datetime(2024, 1, 15, 12), with_commit=True)


@query
def update_snapshot_log(spark: SparkSession, folder: str) -> DataFrame:
    """An update that reads the newest stored state and the days after it."""
    log = store_log(spark, folder)
    newest = log.rows().agg(F.max("commit_ts").alias("ts"), F.max("commit_id").alias("id")).first()
    log.build_state(newest.ts.date() - datetime.timedelta(days=1))
    moment = F.lit(newest.ts + datetime.timedelta(days=1)).cast(log.rows().schema["commit_ts"].dataType)
    log.update({"value": F.col("value") / 2}, moment, F.lit(newest.id + 1), F.col("value") > 10)
    return log.latest()


@query
def prune_twice_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log pruned in two steps; the second rewrites only the days between the cutoffs."""
    log = store_log(spark, folder)
    newest = log.rows().agg(F.max("commit_ts")).first()[0]
    for days in (20, 10):
        log.prune(newest - datetime.timedelta(days=days))
    return log.pruned().drop("commit_date")


# --- the shipped reports by their SQL names, on tables mapped to the order system's ---------------


def order_system(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The generated tables with the order system's names and columns."""
    money = "CAST({} AS DECIMAL(38,4)) AS {}".format
    customer, nation = read(spark, folder, "customer"), read(spark, folder, "nation")
    return {
        "order_detail": read(spark, folder, "lineitem").selectExpr(
            "CAST(l_linenumber AS BIGINT) AS order_detail_id", "l_orderkey AS order_id",
            "l_partkey AS menu_item_id", "CAST(l_linenumber AS BIGINT) AS line_number",
            "CAST(l_quantity AS INT) AS quantity", money("l_tax", "unit_price"),
            money("l_extendedprice", "price"),
        ),
        "order_header": read(spark, folder, "orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey % 100 + 1 AS truck_id", "o_orderdate AS order_ts",
            "CAST(o_orderkey % 30 AS DOUBLE) AS location_id", "o_custkey AS customer_id",
            money("o_totalprice", "order_amount"), "'0' AS order_tax_amount",
            "'0' AS order_discount_amount", money("o_totalprice", "order_total"),
        ),
        "truck": read(spark, folder, "supplier").selectExpr(
            "s_suppkey AS truck_id", "s_name AS primary_city", "'r' AS region", "'c' AS country",
            "1L AS franchise_flag", "CAST(s_nationkey AS BIGINT) AS franchise_id",
        ),
        "franchise": nation.selectExpr(
            "CAST(n_nationkey AS BIGINT) AS franchise_id", "n_name AS first_name", "'x' AS last_name"
        ),
        "location": nation.selectExpr("CAST(n_nationkey AS BIGINT) AS location_id"),
        "customer_loyalty": customer.filter("c_acctbal > 0").selectExpr(
            "c_custkey AS customer_id", "c_name AS first_name", "c_mktsegment AS last_name",
            "'e' AS e_mail", "'p' AS phone_number", "'0' AS children_count", "'g' AS gender",
            "'m' AS marital_status", "'t' AS city", "'c' AS country",
        ),
        "menu": read(spark, folder, "part").selectExpr(
            "p_partkey AS menu_item_id", "p_name AS menu_item_name", "p_type AS menu_type",
            "p_brand AS truck_brand_name", money("p_retailprice", "sale_price_usd"),
        ),
    }


@query
def sql_orders_view(spark: SparkSession, folder: str) -> DataFrame:
    sql_api.register_orders(spark, order_system(spark, folder))
    return spark.sql(
        """SELECT date, order_id, line_number, primary_city, franchisee_first_name, location_id,
                  customer_id, first_name, menu_item_name, quantity, CAST(price AS STRING) AS price
           FROM orders_v"""
    )


@query
def catalog_orders_view(spark: SparkSession, folder: str) -> DataFrame:
    """The views as the catalog keeps them, over stored raw tables, with what it says of them."""
    label = f"run_{uuid4().hex}"
    zones = catalog_views.Zones(*(f"{label}_{zone}" for zone in ("raw", "harmonized", "analytics")))
    stored = {name: scratch_path(spark, name) for name in order_system(spark, folder)}
    for name, rows in order_system(spark, folder).items():
        tables.write_new(rows, stored[name])
    catalog_views.create_order_views(spark, stored, zones)
    lines = spark.table(f"{zones.analytics}.orders_v").select(
        F.lit("orders_v").alias("view"), "date", F.col("customer_id").alias("member"), "price"
    )
    members = spark.table(f"{zones.analytics}.customer_loyalty_metrics_v").select(
        F.lit("customer_loyalty_metrics_v").alias("view"), F.lit(None).cast("date").alias("date"),
        F.col("customer_id").alias("member"), F.col("total_sales").alias("price"),
    )
    said = F.create_map(*(
        F.lit(text)
        for name in ("orders_v", "customer_loyalty_metrics_v")
        for text in (name, catalog_views.view_comment(spark, f"{zones.analytics}.{name}"))
    ))
    return lines.unionByName(members).groupBy("view", "date").agg(
        F.count("*").alias("rows"), F.count("member").alias("of_members"),
        F.sum("price").cast("string").alias("price"),
    ).withColumn("comment", said[F.col("view")])


@query
def sql_prices_above(spark: SparkSession, folder: str) -> DataFrame:
    sql_api.register_orders(spark, order_system(spark, folder))
    return spark.sql("SELECT item, CAST(price AS STRING) AS price FROM menu_prices_above(995)")


@query
def sql_loyalty_view(spark: SparkSession, folder: str) -> DataFrame:
    sql_api.register_orders(spark, order_system(spark, folder))
    return spark.sql(
        """SELECT customer_id, first_name, CAST(total_sales AS STRING) AS total_sales,
                  CAST(size(visited_location_ids_array) AS BIGINT) AS places
           FROM customer_loyalty_metrics_v"""
    )


@query
def trucks_report(spark: SparkSession, folder: str) -> DataFrame:
    tables_ = order_system(spark, folder)
    return trucks.trucks_with_franchisee(tables_["truck"], tables_["franchise"]).select(
        "truck_id", "primary_city", "franchise_id", "franchisee_first_name", "franchisee_last_name"
    )
