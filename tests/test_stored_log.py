"""Stored logs: reads open the state and the days they need, and equal a read of the whole log."""

import datetime
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import history
from ledgerloom.operators.stored_log import StoredLog

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1, 9)
DDL = "k INT, value INT, commit_ts TIMESTAMP_NTZ, commit_id BIGINT, op STRING"


def log_rows(spark, days=20, seed=1):
    rng = random.Random(seed)
    rows = []
    for at in range(days * 15):
        moment = START + DAY * (at // 15) + datetime.timedelta(minutes=rng.randrange(800))
        rows.append((rng.randrange(25), rng.randrange(100), moment, at, rng.choice("UUUD")))
    return spark.createDataFrame(rows, DDL)


def same(one, other):
    assert sorted(map(repr, one.select(*sorted(one.columns)).collect())) == sorted(
        map(repr, other.select(*sorted(other.columns)).collect())
    )


def days_read(frame):
    """The commit days of the files that a plan would open."""
    return sorted({match[1] for f in frame.inputFiles() if (match := re.search(r"log/commit_date=([\d-]+)", f))})


@pytest.fixture
def log(spark, new_path):
    return StoredLog.create(log_rows(spark), new_path("log"), ["k"])


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_before_a_commit_opens_only_earlier_days(log):
    whole = log.rows()
    for commit in (0, 1, 40, 157, 299, 1000):
        same(log.before(commit, True), history.before_commit(whole, ["k"], F.lit(commit), True))
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(log.before(40)))
    assert any("commit_date" in f and "<= 2024-01-03" in f for f in filters)


def test_states_replace_the_days_before_them(log):
    whole = log.rows()
    for day in (4, 9, 15):
        log.build_state((START + DAY * day).date())
    log.build_state((START + DAY * 9).date())
    for days in (-1, 0.3, 4.2, 5.9, 8, 12.5, 17, 40):
        moment = START + DAY * days
        instant = F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
        same(log.as_of(moment, True), history.as_of(whole, ["k"], instant, True))
    for commit in (3, 100, 160, 299):
        same(log.before(commit, True), history.before_commit(whole, ["k"], F.lit(commit), True))
    same(log.latest(True), history.latest(whole, ["k"], True))
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(log.as_of(START + DAY * 12.5)))
    assert any("> 2024-01-10" in f and "<= 2024-01-15" in f for f in filters)
    assert any("until" in f and "2024-01-10" in f for f in filters)


def test_commits_start_from_the_newest_state(log):
    before = {row.k: row.value for row in log.latest().collect()}
    log.build_state((START + DAY * 18).date())
    assert "> 2024-01-19" in plan(log.latest())
    moment = F.lit((START + DAY * 25).isoformat(sep=" ")).cast("timestamp_ntz")
    log.update({"value": F.col("value") * 2}, moment, F.lit(1000), F.col("value") > 50)
    log.delete(F.col("value") < 10, moment, F.lit(1001))
    after = {row.k: row.value for row in log.latest().collect()}
    assert after == {k: v * 2 if v > 50 else v for k, v in before.items() if v >= 10}
    same(log.latest(True), history.latest(log.rows(), ["k"], True))
    assert {row.k: row.value for row in log.before(1000).collect()} == before


def test_a_closed_day_takes_no_commit(log):
    log.build_state((START + DAY * 10).date())
    moment = F.lit((START + DAY * 3).isoformat(sep=" ")).cast("timestamp_ntz")
    with pytest.raises(Exception, match="closed by a state"):
        log.delete(F.lit(True), moment, F.lit(1000))
    assert log.rows().count() == 300 and log.commits().filter("commit_id = 1000").count() == 0


def files_of(folder):
    return {
        os.path.join(root, name): os.stat(os.path.join(root, name)).st_mtime_ns
        for root, _, names in os.walk(folder) for name in names
    }


def test_pruning_in_steps_equals_pruning_at_once(log):
    whole = log.rows()
    untouched = files_of(log.path)
    for days in (5.1, 11.7, 11.8, 16):
        log.prune(START + DAY * days)
        cutoff = F.lit((START + DAY * (11.7 if days == 11.8 else days)).isoformat(sep=" ")).cast("timestamp_ntz")
        same(log.pruned(), history.prune(whole, ["k"], cutoff))
    now = files_of(log.path)
    assert {path: now[path] for path in untouched} == untouched
    with pytest.raises(ValueError):
        log.prune(START + DAY * 2)
    # The last prune read the rows kept before and the days since, no earlier day of the log.
    again = StoredLog(log.spark, log.path, ["k"])._unpruned((START + DAY * 11).date())
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(again))
    assert any("commit_date" in f and "> 2024-01-12" in f for f in filters)
