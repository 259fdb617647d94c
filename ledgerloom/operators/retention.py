"""Cleanup of rows that are too old, measured from the newest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerloom.functions.scalars import add_days
from ledgerloom.sources import tables


def cutoff(rows: DataFrame, moment: str, days: int) -> Column:
    """``days`` before the newest ``moment``, as a scalar inside the plan; NULL for no rows.

    The engine computes it once, before the scan, and pushes the value into the reader.
    """
    return rows.agg(add_days(F.max(moment), -days)).scalar()


def newest_expired(rows: DataFrame, moment: str, days: int) -> DataFrame:
    """The newest of the rows that a cleanup would remove."""
    expired = rows.filter(F.col(moment) < cutoff(rows, moment, days))
    return expired.agg(F.max(moment).alias("newest_expired"))


def keep_recent(rows: DataFrame, moment: str, days: int) -> DataFrame:
    """``rows`` without those before the cutoff; rows with no time stamp stay."""
    return rows.filter((F.col(moment) >= cutoff(rows, moment, days)) | F.col(moment).isNull())


def expire(rows: DataFrame, moment: str, days: int, target: str) -> DataFrame:
    """Write the cleaned table to ``target`` and report rows kept and removed.

    Both numbers are observed by the write itself: together they are the rows that it read.
    """
    recent = (F.col(moment) >= cutoff(rows, moment, days)) | F.col(moment).isNull()
    counted = Observation()
    marked = rows.withColumn("_recent", F.coalesce(recent, F.lit(False))).observe(
        counted,
        F.count_if("_recent").alias("kept"),
        F.count_if(~F.col("_recent")).alias("removed"),
    )
    tables.write_new(marked.filter("_recent").drop("_recent"), target)
    # No partition of an empty table reaches the write, and nothing is then observed.
    numbers = [counted.get.get(name, 0) for name in ("kept", "removed")]
    return rows.sparkSession.createDataFrame([tuple(numbers)], "kept bigint, removed bigint")
