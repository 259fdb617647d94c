"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_where(condition: Column) -> Column:
    """Rows that meet the condition; NULL conditions do not count, and no row gives 0."""
    return F.sum(F.when(condition, 1).otherwise(0))


def distinct_values(value: Column) -> Column:
    """The distinct non-NULL values of a group as a sorted array."""
    return F.sort_array(F.collect_set(value))


def money_parts(amount: Column, name: str) -> list[Column]:
    """An amount with four decimals as two whole numbers, ``<name>_units`` and ``<name>_rest``.

    Units are rounded down and the rest, in ten-thousandths, is never negative. Both add up in 64 bits,
    so grouping hashes them and needs no wide decimals: units hold sums up to 9.2e18, the rest some
    9e14 rows; a sum beyond that fails. A floating-point amount is rounded to four decimals; halfway
    between two, the binary value decides.
    """
    below = F.floor(amount)
    # Not ``round``, which goes through a big decimal for every row.
    rest = F.floor((amount - below) * 10_000 + F.lit(0.5))
    return [below.cast("bigint").alias(f"{name}_units"), rest.cast("bigint").alias(f"{name}_rest")]


def money_names(name: str) -> list[str]:
    return [f"{name}_units", f"{name}_rest"]


def money_total(name: str) -> Column:
    """The sum of money whose parts have been added up, with four decimals."""
    rest = F.col(f"{name}_rest").cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(4,4)")
    return (F.col(f"{name}_units").cast("decimal(38,4)") + rest).cast("decimal(38,4)").alias(name)
