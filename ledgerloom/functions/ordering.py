"""Sort keys with NULL as the largest value, whatever the direction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def descending(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()
