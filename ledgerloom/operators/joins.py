"""Equi-joins.

No join here carries a broadcast hint. Spark broadcasts a side only when its measured size is
under ``autoBroadcastJoinThreshold``, and otherwise shuffles both sides; adaptive execution then
splits the partitions of a hot key over many tasks. It can do so only between two plain shuffles,
and only rows whose key is not NULL are worth a shuffle; the helpers see to both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, same_layout: bool = False
) -> DataFrame:
    """``left`` with the matching rows of ``right``; rows without a match keep NULLs.

    Rows with a NULL key match nothing, so a hash of all their values scatters them. With
    ``same_layout`` both sides are tables bucketed alike on the key and join where they are; such a
    join cannot split a hot key.
    """
    if same_layout:
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    values = [f"`{f.name}`" for f in left.schema if _hashable(f.dataType)]
    slot = F.when(F.col(left_key).isNull(), F.xxhash64(*values)).otherwise(F.lit(0).cast("bigint"))
    joined = left.withColumn("_slot", slot).join(
        right.withColumn("_only_slot", _zero(right_key)),
        (F.col(left_key) == F.col(right_key)) & (F.col("_slot") == F.col("_only_slot")),
        "left",
    )
    return joined.drop("_slot", "_only_slot")


def without_match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, same_layout: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; a NULL key never occurs.

    Rows with a NULL key go past the join and are not shuffled. ``same_layout`` as in
    ``left_join``.
    """
    match = F.col(left_key) == F.col(right_key)
    if same_layout:
        return left.join(right.select(right_key), match, "left_anti")
    keyed = left.filter(F.col(left_key).isNotNull()).withColumn("_slot", _zero(left_key))
    keys = right.select(right_key).distinct().withColumn("_only_slot", _zero(right_key))
    missing = keyed.join(keys, match & (F.col("_slot") == F.col("_only_slot")), "left_anti")
    return missing.drop("_slot").unionByName(left.filter(F.col(left_key).isNull()))


def join_totals(totals: DataFrame, rows: DataFrame, on: str) -> DataFrame:
    """Inner join of per-key totals with rows in which a key may be hot.

    Totals are already partitioned by the key, and Spark would join them where they are. A
    second join key, always 0, makes it shuffle the few totals once more. Only then can adaptive
    execution split the other side.
    """
    left, right = (side.withColumn("_slot", _zero(on)) for side in (totals, rows))
    return left.join(right, [on, "_slot"]).drop("_slot")


def join_as_double(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> DataFrame:
    """Inner join of a floating-point key with a whole-number key, compared as doubles."""
    return left.join(
        right, F.col(left_key).cast("double") == F.col(right_key).cast("double"), "inner"
    )


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _zero(key: str) -> Column:
    """Always 0, but derived from the key: a constant would be folded out of the join keys."""
    return F.pmod(F.xxhash64(key), F.lit(1))
