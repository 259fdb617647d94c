"""Reports on trucks and their franchisees."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.scalars import year_gap, year_ratio


def trucks_with_franchisee(truck: DataFrame, franchise: DataFrame) -> DataFrame:
    """All truck columns plus the franchisee's names; a truck without franchise is left out."""
    t, f = truck.alias("t"), franchise.alias("f")
    return t.join(f, F.col("t.franchise_id") == F.col("f.franchise_id")).select(
        "t.*",
        F.col("f.first_name").alias("franchisee_first_name"),
        F.col("f.last_name").alias("franchisee_last_name"),
    )


def truck_ages(truck: DataFrame, current_year: int | None = None) -> DataFrame:
    """Age in years, next to the quotient that is easily mistaken for it."""
    year = F.year(F.current_date()) if current_year is None else F.lit(current_year)
    return truck.select(
        "truck_id", "year", "make", "model",
        year_gap(year, F.col("year")).alias("truck_age"),
        year_ratio(year, F.col("year")).alias("truck_age_ratio"),
    )
