"""Top-k reports and per-group leaders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.ordering import ascending, descending


def top_k(rows: DataFrame, measure: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest measure, NULL first; each task keeps only its own ``k``."""
    return rows.orderBy(descending(measure), *map(ascending, tie_break)).limit(k)


def leaders(rows: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """Every row that shares the first rank of its group, NULL ranking first; ties all stay.

    The rank filter is applied inside each task before the shuffle, and only then per group.
    """
    ranked = Window.partitionBy(*group).orderBy(descending(measure))
    return rows.withColumn("_rank", F.rank().over(ranked)).filter("_rank = 1").drop("_rank")


def sort_down(rows: DataFrame, measure: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """All rows by descending measure, NULL first."""
    keys: list[Column] = [descending(measure), *map(ascending, tie_break)]
    return rows.orderBy(*keys)
