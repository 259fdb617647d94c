"""Row changes as rewrites: of a plain table, or as commits appended to a change log.

The log has the table's columns plus ``commit_ts``, ``commit_id`` and ``op`` ('U' for a row
written, 'D' for a row removed). It is stored by ``commit_date``, so reads of a past state open
only the folders up to that day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators import history
from ledgerloom.sources import tables


def update_rows(
    rows: DataFrame, assignments: Mapping[str, Column], where: Column | None = None
) -> DataFrame:
    """``rows`` with the assigned columns replaced where the predicate is true.

    Every expression sees the old row, and each result takes the type of its column; a fraction
    that goes into a whole-number column is rounded.
    """
    types = {field.name: field.dataType for field in rows.schema.fields}
    given = rows.select(*[value.alias(name) for name, value in assignments.items()]).schema
    changed = {}
    for name, value in assignments.items():
        new = tables.fitted(value, given[name].dataType, types[name])
        changed[name] = new if where is None else F.when(where, new).otherwise(F.col(name))
    return rows.withColumns(changed)


def delete_rows(rows: DataFrame, where: Column) -> DataFrame:
    """``rows`` without those where the predicate is true; an unknown predicate keeps the row."""
    return rows.filter(~F.coalesce(where, F.lit(False)))


def insert_commit(rows: DataFrame, commit_ts: Column, commit_id: Column) -> DataFrame:
    """Log rows that write ``rows`` in one commit."""
    return _commit(rows, "U", commit_ts, commit_id)


def update_commit(
    log: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    commit_ts: Column,
    commit_id: Column,
    where: Column | None = None,
) -> DataFrame:
    """Log rows of an update: one per current row that the predicate selects.

    Where the update moves rows to other keys, the keys they leave get tombstones, unless the same
    commit writes them again. A key that would have two rows then fails the commit.
    """
    return update_of(history.latest(log, keys), keys, assignments, commit_ts, commit_id, where)


def update_of(
    current: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    commit_ts: Column,
    commit_id: Column,
    where: Column | None = None,
) -> DataFrame:
    """The log rows of ``update_commit`` where the current rows are known."""
    chosen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    selected = current.filter(chosen)
    written = update_rows(selected, assignments)
    if not set(keys) & set(assignments):
        return _commit(written, "U", commit_ts, commit_id)
    after = written.select(*keys).unionByName(current.filter(~chosen).select(*keys))
    rows_of = after.groupBy(*keys).agg(F.count("*").alias("_rows"))
    taken = rows_of.select(*[F.col(k).alias(f"_{k}") for k in keys], "_rows")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    twice = F.when(F.col("_rows") > 1, F.raise_error(F.lit("the update gives two rows one key")))
    unique = (
        written.join(taken, same)
        .withColumn("_rows", F.coalesce(twice.cast("bigint"), F.col("_rows")))
        .filter("_rows = 1")
        .select(*written.columns)
    )
    left = selected.join(taken, same, "left_anti")
    return _commit(unique, "U", commit_ts, commit_id).unionByName(
        _commit(left, "D", commit_ts, commit_id)
    )


def delete_commit(
    log: DataFrame, keys: Sequence[str], where: Column, commit_ts: Column, commit_id: Column
) -> DataFrame:
    """Log rows of a delete: one tombstone per current row that the predicate selects."""
    return delete_of(history.latest(log, keys), where, commit_ts, commit_id)


def delete_of(current: DataFrame, where: Column, commit_ts: Column, commit_id: Column) -> DataFrame:
    """The log rows of ``delete_commit`` where the current rows are known."""
    return _commit(current.filter(where), "D", commit_ts, commit_id)


def write_log(log: DataFrame, path: str) -> DataFrame:
    """Store a log at a new path, one folder per commit day."""
    return tables.write_new(_by_day(log), path, ["commit_date"])


def write_pruned(log: DataFrame, keys: Sequence[str], cutoff: Column, path: str) -> DataFrame:
    """Store at a new path what ``history.prune`` keeps of a log; commits then read only that."""
    return write_log(history.prune(log, keys, cutoff).drop("commit_date"), path)


def append_log(commit: DataFrame, path: str) -> DataFrame:
    """Add the rows of a commit to a stored log and return the log."""
    stored = commit.sparkSession.read.parquet(path)
    _by_day(commit).select(stored.columns).write.mode("append").partitionBy("commit_date").parquet(path)
    return commit.sparkSession.read.schema(stored.schema).parquet(path)


def _by_day(log: DataFrame) -> DataFrame:
    """Rows gathered by day, so that a folder gets few files; the rows of a busy day are split."""
    return log.withColumn("commit_date", F.to_date("commit_ts")).hint("rebalance", "commit_date")


def _commit(rows: DataFrame, op: str, commit_ts: Column, commit_id: Column) -> DataFrame:
    return rows.select(
        "*",
        commit_ts.alias("commit_ts"),
        commit_id.alias("commit_id"),
        F.lit(op).alias("op"),
    )
