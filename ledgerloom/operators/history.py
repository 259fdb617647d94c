"""Past states of a table, read from its append-only change log (see ``changes``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LOG_COLUMNS = ("commit_ts", "commit_id", "op", "commit_date")


def as_of(
    log: DataFrame, keys: Sequence[str], moment: Column, with_commit: bool = False
) -> DataFrame:
    """The table as it was at ``moment``, commits of that very moment included."""
    return latest(_until(log, moment), keys, with_commit)


def as_of_offset(
    log: DataFrame, keys: Sequence[str], seconds: int, now: Column, with_commit: bool = False
) -> DataFrame:
    """The table ``seconds`` after ``now``; the offset is negative for the past."""
    moment = now + F.make_dt_interval(secs=F.lit(seconds))
    return as_of(log, keys, moment, with_commit)


def before_commit(
    log: DataFrame, keys: Sequence[str], commit_id: Column, with_commit: bool = False
) -> DataFrame:
    """The table just before a commit, without that commit."""
    return latest(log.filter(F.col("commit_id") < commit_id), keys, with_commit)


def latest(log: DataFrame, keys: Sequence[str], with_commit: bool = False) -> DataFrame:
    """The last version of every key, removed keys left out."""
    last = last_versions(log, keys).filter("op <> 'D'")
    return last.drop("op", "commit_date") if with_commit else last.drop(*LOG_COLUMNS)


def last_versions(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest log row of every key; one time stamp shared by two goes to the higher commit id.

    An aggregate and not a window: each task passes on one row per key, however many versions a
    key has.
    """
    newest = F.max_by(F.struct(*log.columns), F.struct("commit_ts", "commit_id"))
    return log.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def prune(log: DataFrame, keys: Sequence[str], cutoff: Column) -> DataFrame:
    """The log without versions that no read at or after ``cutoff`` can see.

    Every version newer than the cutoff stays, and per key the last one at or before it.
    """
    newer = log.filter(F.col("commit_ts") > cutoff)
    if "commit_date" in log.columns:
        newer = newer.filter(F.col("commit_date") >= F.date_add(F.to_date(cutoff), -2))
    return newer.unionByName(last_versions(_until(log, cutoff), keys))


def _until(log: DataFrame, moment: Column) -> DataFrame:
    seen = log.filter(F.col("commit_ts") <= moment)
    if "commit_date" in log.columns:
        # Skips whole folders. Two days of slack, as writer and reader may differ in time zone.
        seen = seen.filter(F.col("commit_date") <= F.date_add(F.to_date(moment), 2))
    return seen
