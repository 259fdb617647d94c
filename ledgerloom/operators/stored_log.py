"""A stored change log that past states, commits and prunes read only in part.

Below one path lie

- ``log``: the rows by commit day, append-only (see ``changes``);
- ``commits``: one small row per commit and day with its id, so that a read before a commit knows its days;
- ``states``: the table at the end of some days, each built from the state before and the days between;
- ``kept``: what a prune keeps of the days up to its boundary; later days stay where they are.

A read takes the newest state that lies wholly before it and the days after that. Nothing is overwritten:
states and pruned parts are new folders, chosen by their names' days. Days are those of the session's
time zone; a state or a prune is used from the second day after it on where a reader's zone may differ.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators import changes, history
from ledgerloom.sources import tables

# Readers and writers in different zones disagree on the day of a commit by at most one day each.
SLACK_DAYS = 2


class StoredLog:
    """The log at ``path`` of a table with these keys."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    @classmethod
    def create(cls, log: DataFrame, path: str, keys: Sequence[str]) -> StoredLog:
        """Store log rows at a new path."""
        out = cls(log.sparkSession, path, keys)
        written = changes.write_log(log, f"{out.path}/log")
        _commits(written).write.partitionBy("commit_date").parquet(f"{out.path}/commits")
        return out

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/log")

    def commits(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/commits")

    def append(self, commit: DataFrame) -> None:
        """Add the rows of one commit; a day that a state or a prune has closed takes no more rows.

        The rows are stored first and the index from the stored rows: an index without its rows
        would hide nothing, rows without their index are never lost, only read by a full scan.
        """
        closed = max([*self._days("states"), *self._days("kept"), datetime.date.min])
        late = F.to_date("commit_ts") <= F.lit(closed)
        stop = F.raise_error(F.lit(f"commits up to {closed} are closed by a state or a prune"))
        open_ = commit.withColumn("op", F.when(late, stop.cast("string")).otherwise(F.col("op")))
        fixed = tables.write_new(open_.select(*commit.columns), f"{self.path}/arrivals/{_unused()}")
        changes.append_log(fixed, f"{self.path}/log")
        dated = fixed.withColumn("commit_date", F.to_date("commit_ts"))
        _commits(dated).write.mode("append").partitionBy("commit_date").parquet(f"{self.path}/commits")

    def _days(self, part: str) -> list[datetime.date]:
        """The days that a part of the store has been built for; folder names only."""
        try:
            found = self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []
        return sorted(row[0] for row in found.select("until").distinct().collect())

    def _built(self, part: str, day: datetime.date) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{part}").filter(F.col("until") == F.lit(day))
        return rows.drop("until").withColumn("commit_date", F.to_date("commit_ts"))

    def _merged(self, until: datetime.date | None, low: datetime.date | None) -> DataFrame:
        """Enough of the log for any read that sees all days up to ``low`` and none after ``until``."""
        days = [day for day in self._days("states") if low is not None and day <= low]
        tail = self.rows()
        if until is not None:
            tail = tail.filter(F.col("commit_date") <= F.lit(until))
        if not days:
            return tail
        tail = tail.filter(F.col("commit_date") > F.lit(days[-1]))
        return tail.unionByName(self._built("states", days[-1]).select(*tail.columns))

    def build_state(self, day: datetime.date) -> None:
        """Store the table at the end of ``day``, from the last state before it and the days between."""
        if day in self._days("states"):
            return
        last = history.last_versions(self._merged(day, day), self.keys).filter("op <> 'D'")
        last.drop("commit_date").write.parquet(f"{self.path}/states/until={day}")

    def as_of(self, moment: datetime.datetime, with_commit: bool = False) -> DataFrame:
        """The table at a moment of the session's zone, commits of that very moment included."""
        slack = datetime.timedelta(days=SLACK_DAYS)
        some = self._merged(moment.date() + slack, moment.date() - slack)
        seen = some.filter(F.col("commit_ts") <= _instant(moment, some.schema["commit_ts"].dataType))
        return history.latest(seen, self.keys, with_commit)

    def as_of_offset(self, seconds: int, now: datetime.datetime, with_commit: bool = False) -> DataFrame:
        """The table ``seconds`` after ``now``; the offset is negative for the past."""
        return self.as_of(now + datetime.timedelta(seconds=seconds), with_commit)

    def before(self, commit_id: int, with_commit: bool = False) -> DataFrame:
        """The table just before a commit: the index tells which days hold earlier commits."""
        earlier = F.col("commit_id") < commit_id
        until, first = self.commits().agg(
            F.max(F.when(earlier, F.col("commit_date"))), F.min(F.when(~earlier, F.col("commit_date")))
        ).first()
        if until is None:
            return history.latest(self.rows().limit(0), self.keys, with_commit)
        low = until if first is None else first - datetime.timedelta(days=1)
        return history.latest(self._merged(until, low).filter(earlier), self.keys, with_commit)

    def latest(self, with_commit: bool = False) -> DataFrame:
        """The table now: the newest state and the days after it."""
        return history.latest(self._merged(None, datetime.date.max), self.keys, with_commit)

    def update(self, assignments, commit_ts: Column, commit_id: Column, where: Column | None = None) -> None:
        """Commit an update of the rows that the predicate selects (see ``changes.update_commit``)."""
        current = self.latest()
        self.append(changes.update_of(current, self.keys, assignments, commit_ts, commit_id, where))

    def delete(self, where: Column, commit_ts: Column, commit_id: Column) -> None:
        """Commit a delete of the rows that the predicate selects."""
        self.append(changes.delete_of(self.latest(), where, commit_ts, commit_id))

    def prune(self, cutoff: datetime.datetime) -> None:
        """Keep only the versions that reads at or after ``cutoff`` can see.

        Only the days that the cutoff has passed since the last prune are read and written anew; later
        days are kept where they are.
        """
        boundary, done = cutoff.date(), self._days("kept")
        if boundary in done:
            return
        if done and boundary < done[-1]:
            raise ValueError(f"the log is pruned up to {done[-1]} already")
        passed = self._unpruned(done[-1] if done else None).filter(F.col("commit_date") <= F.lit(boundary))
        kept = history.prune(passed, self.keys, _instant(cutoff, passed.schema["commit_ts"].dataType))
        kept.drop("commit_date").write.parquet(f"{self.path}/kept/until={boundary}")

    def _unpruned(self, boundary: datetime.date | None) -> DataFrame:
        rows = self.rows()
        if boundary is None:
            return rows
        tail = rows.filter(F.col("commit_date") > F.lit(boundary))
        return tail.unionByName(self._built("kept", boundary).select(*rows.columns))

    def pruned(self) -> DataFrame:
        """The log as the last prune left it, and all days after that."""
        done = self._days("kept")
        return self._unpruned(done[-1] if done else None)


def _commits(log: DataFrame) -> DataFrame:
    return log.select("commit_id", "commit_date").distinct()


def _instant(moment: datetime.datetime, kind: T.DataType) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast(kind)


def _unused() -> str:
    from uuid import uuid4

    return uuid4().hex
