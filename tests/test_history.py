"""Past states, row changes and cleanup, on a small log and on random ones."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes, history, retention
from ledgerloom.sources import tables
from tests.util import Frames, physical_plan, rows

T0 = datetime(2024, 4, 4, 12)
LOG = "id INT, year INT, make STRING, commit_ts TIMESTAMP_NTZ, commit_id BIGINT, op STRING"


def at(seconds):
    return F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def log(spark):
    def row(id_, year, seconds, commit, op="U"):
        return id_, year, "M", T0 + timedelta(seconds=seconds), commit, op

    return spark.createDataFrame(
        [
            row(1, 2010, 0, 1), row(2, 2012, 0, 1), row(3, None, 0, 1),
            row(1, 1, 10, 2), row(2, 1, 10, 2),  # the year is overwritten
            row(2, 1, 20, 3, "D"),
            row(1, 5, 30, 4), row(1, 6, 30, 5),  # two versions at one time stamp
            row(2, 2022, 40, 6),  # back again
        ],
        LOG,
    )


def years(state):
    return {row.id: row.year for row in state.collect()}


def test_as_of_includes_its_moment(log):
    assert years(history.as_of(log, ["id"], at(-1))) == {}
    assert years(history.as_of(log, ["id"], at(9))) == {1: 2010, 2: 2012, 3: None}
    assert years(history.as_of(log, ["id"], at(10))) == {1: 1, 2: 1, 3: None}
    assert years(history.as_of(log, ["id"], at(20))) == {1: 1, 3: None}
    assert years(history.as_of(log, ["id"], at(30))) == {1: 6, 3: None}
    assert years(history.latest(log, ["id"])) == {1: 6, 2: 2022, 3: None}
    assert history.latest(log, ["id"]).columns == ["id", "year", "make"]


def test_before_commit_excludes_it(log):
    assert years(history.before_commit(log, ["id"], F.lit(2))) == {1: 2010, 2: 2012, 3: None}
    assert years(history.before_commit(log, ["id"], F.lit(5))) == {1: 5, 3: None}
    assert years(history.before_commit(log, ["id"], F.lit(1))) == {}


def test_as_of_offset(log):
    assert years(history.as_of_offset(log, ["id"], -31, at(40))) == {1: 2010, 2: 2012, 3: None}
    assert years(history.as_of_offset(log, ["id"], -30, at(40))) == {1: 1, 2: 1, 3: None}


def test_second_mistake_can_be_undone(spark, log, new_path):
    """Overwrite the year in every row, then read the table as it was before."""
    path = new_path("log")
    stored = changes.write_log(log.filter("commit_id = 1"), path)
    wrong = changes.update_commit(
        stored, ["id"], {"year": F.lit(2026) / F.col("year")}, at(100), F.lit(2).cast("bigint"))
    both = changes.append_log(wrong, path)
    assert years(history.latest(both, ["id"])) == {1: 1, 2: 1, 3: None}
    assert years(history.as_of(both, ["id"], at(99))) == {1: 2010, 2: 2012, 3: None}
    assert years(history.before_commit(both, ["id"], F.lit(2))) == {1: 2010, 2: 2012, 3: None}
    removed = changes.delete_commit(
        both, ["id"], F.col("year") == 1, at(200), F.lit(3).cast("bigint"))
    assert years(history.latest(changes.append_log(removed, path), ["id"])) == {3: None}


def test_update_commit_writes_only_selected_rows(log):
    commit = changes.update_commit(
        log, ["id"], {"year": F.col("year") - 1000, "make": F.concat("make", "year")},
        at(50), F.lit(9), F.col("year") > 100)
    assert rows(commit.select("id", "year", "make", "op")) == [(2, 1022, "M2022", "U")]


def test_insert_commit_starts_a_log(spark):
    table = spark.createDataFrame([(1, 2010)], "id int, year int")
    log = changes.insert_commit(table, at(0), F.lit(1))
    assert rows(history.latest(log, ["id"])) == [(1, 2010)]


def test_stored_log_opens_only_needed_days(spark, log, new_path):
    days = log.withColumn("commit_ts", F.expr("commit_ts + make_dt_interval(commit_id::int * 5)"))
    stored = changes.write_log(days, new_path("log"))
    past = history.as_of(stored, ["id"], at(86400 * 6))
    assert years(past) == {1: 2010, 2: 2012, 3: None}
    assert "PartitionFilters: [isnotnull(commit_date" in physical_plan(past)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("days", [0, 1, 90])
def test_prune_keeps_every_visible_state(spark, seed, days):
    f = Frames(spark, seed)
    table = []
    for n in range(300):
        key, op = f.hot(0, 12, 3)(), f.pick("U", "U", "U", "D")()
        moment = T0 + timedelta(hours=f.random.randint(0, 24 * 10))
        table.append((key, n, "M", moment, n, op))
    log = spark.createDataFrame(table, LOG)
    newest = max(row[3] for row in table)
    cutoff = newest - timedelta(days=days)
    pruned = history.prune(log, ["id"], F.lit(cutoff).cast("timestamp_ntz"))
    kept = pruned.count()
    assert kept <= len(table) and (days == 90) == (kept == len(table))
    for hours in (0, 5, 24 * days):
        moment = F.lit(cutoff + timedelta(hours=hours)).cast("timestamp_ntz")
        assert years(history.as_of(pruned, ["id"], moment)) == years(
            history.as_of(log, ["id"], moment))
    per_key = {}
    for key, _, _, moment, _, _ in rows(pruned):
        if moment <= cutoff:
            per_key[key] = per_key.get(key, 0) + 1
    assert all(count == 1 for count in per_key.values())


def test_update_rows_sees_old_values_and_keeps_types(spark):
    table = spark.createDataFrame([(1, 2), (3, None)], "a int, b int")
    swapped = changes.update_rows(table, {"a": F.col("b"), "b": F.col("a") * 10})
    assert rows(swapped) == [(2, 10), (None, 30)] and swapped.dtypes == table.dtypes
    some = changes.update_rows(table, {"a": F.lit(0)}, F.col("b") > 1)
    assert rows(some) == [(0, 2), (3, None)]  # an unknown predicate changes nothing


def test_delete_keeps_rows_with_unknown_predicate(spark):
    table = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    assert rows(changes.delete_rows(table, F.col("a") < 3)) == [(5,), (None,)]


def retained(spark, table):
    return spark.createDataFrame(table, "id int, ts timestamp_ntz")


def test_retention(spark, new_path):
    day = timedelta(days=1)
    table = retained(spark, [(1, T0), (2, T0 - 180 * day), (3, T0 - 181 * day), (4, None)])
    kept = retention.keep_recent(table, "ts", 180)
    assert sorted(row.id for row in kept.collect()) == [1, 2, 4]
    assert rows(retention.newest_expired(table, "ts", 180)) == [(T0 - 181 * day,)]
    report = retention.expire(table, "ts", 180, new_path("kept"))
    assert rows(report) == [(3, 1)]
    left = spark.read.parquet(new_path("kept")).agg(F.min("ts")).head()[0]
    assert left >= T0 - 180 * day


def test_retention_of_empty_and_undated_tables(spark):
    assert rows(retention.keep_recent(retained(spark, []), "ts", 1)) == []
    assert rows(retention.keep_recent(retained(spark, [(1, None)]), "ts", 1)) == [(1, None)]
    assert rows(retention.newest_expired(retained(spark, []), "ts", 1)) == [(None,)]


def test_retention_reaches_the_scan(spark, new_path):
    stored = tables.write_new(retained(spark, [(1, T0)]), new_path("t"))
    plan = physical_plan(retention.keep_recent(stored, "ts", 1))
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts,ScalarSubquery" in plan
    assert "Join" not in plan


def test_updates_that_move_keys(spark):
    log = spark.sql(
        "SELECT id AS k, id * 10 AS v, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS commit_ts, id AS commit_id, 'U' AS op "
        "FROM range(5)"
    )
    when, number = F.lit("2024-01-02").cast("timestamp_ntz"), F.lit(100)

    def after(assignments, where=None):
        commit = changes.update_commit(log, ["k"], assignments, when, number, where)
        return sorted(rows(history.latest(log.unionByName(commit), ["k"])), key=str)

    assert after({"k": F.col("k") + 1}) == [(k + 1, k * 10) for k in range(5)]
    assert after({"k": 1 - F.col("k")}, F.col("k") < 2) == [(0, 10), (1, 0), (2, 20), (3, 30), (4, 40)]
    assert after({"k": F.lit(None)}, F.col("k") == 2) == [(0, 0), (1, 10), (3, 30), (4, 40), (None, 20)]
    for collision in ({"k": F.lit(9)}, {"k": F.col("k") % 2}):
        with pytest.raises(Exception, match="two rows one key"):
            after(collision)
    with pytest.raises(Exception, match="two rows one key"):
        after({"k": F.lit(3)}, F.col("k") == 1)
    assert after({"v": F.col("v") / 4})[1:3] == [(1, 3), (2, 5)]
