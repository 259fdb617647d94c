"""Totals carried up a chain of tables, one aggregated step at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import join_totals


def roll_up(
    totals: DataFrame, parents: DataFrame, on: str, by: str, measures: Sequence[str]
) -> DataFrame:
    """Join the totals per ``on`` to ``parents`` and sum the measures per ``by``.

    Summing before each further join leaves one row per key on the large side, so a key that
    holds a third of the facts crosses the network as one row per task. Repeated parents count as
    often as in a plain join, because sums of sums are the same sum.
    """
    return (
        join_totals(totals, parents.select(on, by), on)
        .groupBy(by)
        .agg(*[F.sum(measure).alias(measure) for measure in measures])
    )


def label(
    totals: DataFrame, named: DataFrame, on: str, names: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """The totals per ``on`` with the ``names`` of each key, as a group by key and names gives.

    A key with several names gets a row for each. A key and names that occur in several rows
    count as often, so equal rows are counted beforehand and the join needs no grouping after it.
    """
    copies = named.groupBy(on, *names).agg(F.count("*").alias("_copies"))
    return join_totals(totals, copies, on).select(
        on, *names, *[(F.col(measure) * F.col("_copies")).alias(measure) for measure in measures]
    )
