"""A 128-bit name of a row, for joins that must not take one row for another."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _half(seed: int, columns: tuple[Column, ...]) -> Column:
    # The seed comes first, so that the halves are hashes of their own; a null is told from a blank.
    parts = [part for column in columns for part in (column.isNull(), column.cast("string"))]
    return F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0")


def wide_key(*columns: Column) -> Column:
    """16 bytes; two different rows among 10^14 share them with a probability below 10^-10."""
    return F.unhex(F.concat(_half(1, columns), _half(2, columns)))
