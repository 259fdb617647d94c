"""Loads, inserts, copies: typed rows, loud failures, nothing loaded twice."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from ledgerloom.functions import variants
from ledgerloom.session import scratch_path, shuffle_partitions
from ledgerloom.sources import csv_files, schemas, tables
from ledgerloom.streaming.csv_arrivals import load_arrivals
from tests.util import physical_plan, rows

TWO = T.StructType().add("n", T.IntegerType()).add("t", T.StringType())


def write(directory, name, text):
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, name), "w") as file:
        file.write(text)


def test_load_by_position_with_nulls(spark, new_path):
    write(new_path("in"), "a.csv", '1,x\n2,\n3,\\N\n,"a,b"\n5,""\n')
    write(new_path("in/deeper"), "b.csv", '6,"say ""hi"""\n')
    loaded = csv_files.load_csv(spark, new_path("in"), TWO, new_path("out"))
    assert sorted(rows(loaded), key=str) == sorted(
        [(1, "x"), (2, None), (3, None), (None, "a,b"), (5, ""), (6, 'say "hi"')], key=str)


@pytest.mark.parametrize("bad", ["x,y\n", "1\n", "1,a,b\n"])
def test_malformed_row_stops_the_load(spark, new_path, bad):
    write(new_path("in"), "a.csv", "1,a\n" + bad)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|malformed"):
        csv_files.load_csv(spark, new_path("in"), TWO, new_path("out"))


def test_quote_is_a_parameter(spark, new_path):
    write(new_path("in"), "a.csv", "1|'a|b'\n")
    options = {"sep": "|", "quote": "'"}
    loaded = csv_files.load_csv(spark, new_path("in"), TWO, new_path("out"), options)
    assert rows(loaded) == [(1, "a|b")]


def test_raw_tables_load_typed(spark, new_path):
    write(new_path("truck"), "t.csv",
          "1,2,Aix,R,IR,C,CC,1,2010,M,T,0,\\N,2020-05-01\n")
    truck = csv_files.load_raw_table(spark, "truck", new_path("truck"), new_path("t"))
    assert rows(truck.select("year", "franchise_id", "truck_opening_date")) == [
        (2010, None, date(2020, 5, 1))]
    write(new_path("oh"), "o.csv",
          "1,2,10.0,,,3,08:00:00,15:00:00,,2022-01-01 08:30:15.123,,USD,12.5,,,12.5\n")
    order = csv_files.load_raw_table(spark, "order_header", new_path("oh"), new_path("o"))
    assert rows(order.select("location_id", "shift_start_time", "order_ts", "order_total")) == [
        (10.0, "08:00:00", datetime(2022, 1, 1, 8, 30, 15, 123000), Decimal("12.5000"))]


def test_json_becomes_variant_and_bad_json_null(spark, new_path):
    line = "1,2,T,B,{},Item,C,S,1.5,2.5,{}\n"
    objects = ['"{""menu_item_id"": 7, ""x"": [1, 2]}"', "broken", "", "{}"]
    write(new_path("menu"), "m.csv",
          "".join(line.format(n, text) for n, text in enumerate(objects)))
    loaded = csv_files.load_raw_table(spark, "menu", new_path("menu"), new_path("out"))
    held = F.col("menu_item_health_metrics_obj")
    got = loaded.select("menu_item_id", variants.field_as(held, "menu_item_id", "int"), held.isNull())
    assert sorted(rows(got)) == [(0, 7, False), (1, None, True), (2, None, True), (3, None, False)]


def test_too_long_text_stops_the_load(spark, new_path):
    write(new_path("ok"), "c.csv", "1,France,EUR,FR,1,Paris,1000\n")
    loaded = csv_files.load_raw_table(spark, "country", new_path("ok"), new_path("a"))
    assert rows(loaded.select("iso_currency")) == [("EUR",)]
    write(new_path("bad"), "c.csv", "1,France,EURO,FR,1,Paris,1000\n")
    with pytest.raises(Exception, match="exceeds 3 characters"):
        csv_files.load_raw_table(spark, "country", new_path("bad"), new_path("b"))


def test_every_declared_schema_parses():
    assert {name: len(schemas.file_schema(name)) for name in schemas.RAW_TABLES} == {
        "country": 7, "franchise": 7, "location": 7, "menu": 11, "truck": 14,
        "order_header": 16, "order_detail": 9, "customer_loyalty": 15, "test_table": 5}


def test_arrivals_load_once(spark, new_path):
    def load(options=None):
        return load_arrivals(
            spark, new_path("in"), TWO, new_path("out"), new_path("history"), options,
            files_per_batch=1)

    write(new_path("in"), "a.csv", "1,a\n")
    write(new_path("in"), "b.csv", "2,b\n")
    assert sorted(rows(load())) == [(1, "a"), (2, "b")]
    assert load().count() == 2
    write(new_path("in"), "c.csv", "3,c\n")
    long_ago = datetime(2001, 1, 1).timestamp()
    os.utime(os.path.join(new_path("in"), "c.csv"), (long_ago, long_ago))
    assert sorted(rows(load())) == [(1, "a"), (2, "b"), (3, "c")]
    write(new_path("in"), "d.csv", "oops\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|malformed"):
        load()
    assert tables.read_table(spark, new_path("out")).count() == 3
    write(new_path("in"), "d.csv", "4,d\n")  # repaired: the failed batch runs again
    assert load().count() == 4


def test_arrivals_keep_one_history_per_target(spark, new_path):
    write(new_path("in"), "a.csv", "1,a\n")
    for n in "12":
        loaded = load_arrivals(
            spark, new_path("in"), TWO, new_path("out" + n), new_path("history" + n))
        assert loaded.count() == 1


def test_copy_is_independent(spark, new_path):
    source = tables.write_new(spark.range(10).withColumn("t", F.lit("x")), new_path("source"))
    tables.copy_table(source, new_path("clone"))
    clone = tables.append(source, new_path("clone"))
    counts = tables.row_counts({"clone": clone, "source": source})
    assert sorted(rows(counts)) == [("clone", 20), ("source", 10)]
    with pytest.raises(Exception, match="EXISTS"):
        tables.copy_table(source, new_path("clone"))


def test_append_goes_by_name_and_type(spark, new_path):
    tables.write_new(spark.sql("SELECT 1 AS n, 'a' AS t"), new_path("t"))
    both = tables.append(spark.sql("SELECT 'b' AS t, 2L AS n"), new_path("t"))
    assert sorted(rows(both)) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.append(spark.sql("SELECT 'b' AS t, 'x' AS n"), new_path("t")).count()


def test_insert_literal_row(spark):
    like = spark.createDataFrame([], schemas.file_schema("test_table"))
    row = tables.value_rows(spark, like, [(28, "ha!", True, "2024-01-01", None)])
    assert row.schema == like.schema
    assert rows(row) == [(Decimal(28), "ha!", True, date(2024, 1, 1), None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.value_rows(spark, like, [(28, "ha!", True, "no date", None)]).collect()
    with pytest.raises(ValueError):
        tables.value_rows(spark, like, [(28, "too short")])


def test_create_as_names_and_casts(spark, new_path):
    made = tables.create_as(
        spark.sql("SELECT CAST(12.5 AS DECIMAL(38,4)) AS cost"),
        new_path("t"), {"cost_variant": "CAST(cost AS VARIANT)"})
    assert made.dtypes == [("cost_variant", "variant")]
    assert rows(made.select(variants.as_number(F.col("cost_variant")))) == [(Decimal("12.5000"),)]


def test_bucketed_tables_join_without_shuffle(spark, settings):
    left, right = (
        tables.write_bucketed(spark.range(1000).withColumn(side, F.col("id")), f"b_{side}", "id", 4)
        for side in ("l", "r"))
    with settings(spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = left.join(right, "id")
        assert joined.count() == 1000
        assert "Exchange" not in physical_plan(joined)


def test_scratch_paths_are_shared_and_new(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root)


def test_shuffle_partitions():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 1024**4, 4000) == 409_600


def test_arrivals_into_nothing_and_into_a_table(spark, new_path):
    os.makedirs(new_path("in"))
    empty = load_arrivals(spark, new_path("in"), TWO, new_path("out"), new_path("history"))
    assert empty.count() == 0 and empty.columns == TWO.names
    wide = spark.sql("SELECT 7L AS n, 'x' AS t").select(*[F.col(c).alias(f) for c, f in zip("nt", TWO.names)])
    tables.write_new(wide, new_path("old"))
    write(new_path("in"), "a.csv", "1,a\n")
    for name in ("other", "history2"):
        loaded = load_arrivals(spark, new_path("in"), TWO, new_path("old"), new_path(name))
    assert sorted(rows(loaded)) == [(1, "a"), (1, "a"), (7, "x")]
    assert loaded.dtypes[0][1] == "bigint"
    assert tables.append(wide, new_path("old")).count() == 4
    assert load_arrivals(spark, new_path("in"), TWO, new_path("old"), new_path("other")).count() == 4


def test_literals_keep_their_type(spark):
    like = spark.createDataFrame([], "b BINARY, n BIGINT, d DECIMAL(10,2), v VARIANT")
    got = tables.value_rows(spark, like, [(b"ab", 12.5, Decimal("1.005"), {"k": [1]}), (None, -12.5, 3, None)])
    assert got.schema == like.schema
    assert rows(got.select("b", "n", "d", F.to_json("v"))) == [
        (b"ab", 13, Decimal("1.01"), '{"k":[1]}'), (None, -13, Decimal("3.00"), None)]
    with pytest.raises(TypeError):
        tables.value_rows(spark, like, [(object(), 1, 1, None)])


def test_append_rounds_fractions(spark, new_path):
    tables.write_new(spark.sql("SELECT 1L AS n"), new_path("t"))
    got = tables.append(spark.sql("SELECT explode(array(2.5D, -2.5D, 2.4D)) AS n"), new_path("t"))
    assert sorted(rows(got)) == [(-3,), (1,), (2,), (3,)]
