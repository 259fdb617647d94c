"""Sharding by jump consistent hashing: a stable key alone says in which shard a row is.

The jumps of a key are a fixed rising sequence; with n shards the key is in the last jump below n.
Appending a shard therefore moves a row only into the new shard, and only 1/(n + 1) of the rows.

Defined results: a row without an id takes the checksum of its text for a key; repeated rows share
a shard and get slots of their own; a null text counts as empty; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_SLICE = 50_000
_LOW, _TOP = (1 << 22) - 1, (1 << 20) - 1
# Fixed values of the published algorithm: the multiplier and the scale of a jump.
MULTIPLIER = 2862933555777941757
SCALE = float(1 << 31)


def _next_state(state: Column) -> Column:
    """``state * MULTIPLIER + 1`` modulo 2^64, in three parts that cannot overflow a long."""
    a, b, c = state.bitwiseAND(F.lit(_LOW)), F.shiftright(state, 22).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(state, 44)
    x, y, z = MULTIPLIER & _LOW, MULTIPLIER >> 22 & _LOW, MULTIPLIER >> 44
    first = a * F.lit(x) + F.lit(1)
    second = a * F.lit(y) + b * F.lit(x) + F.shiftright(first, 22)
    third = a * F.lit(z) + b * F.lit(y) + c * F.lit(x) + F.shiftright(second, 22)
    return (
        first.bitwiseAND(F.lit(_LOW))
        .bitwiseOR(F.shiftleft(second.bitwiseAND(F.lit(_LOW)), 22))
        .bitwiseOR(F.shiftleft(third.bitwiseAND(F.lit(_TOP)), 44))
    )


def jumps(key: Column, shards: int) -> Column:
    """The rising jumps of a 64-bit key below ``shards``; the last is the key's shard."""

    def merge(state, _):
        following = _next_state(state["key"])
        drawn = (F.shiftrightunsigned(following, 33) + 1).cast("double")
        target = F.floor((state["next"] + 1).cast("double") * (F.lit(SCALE) / drawn)).cast("long")
        inside = state["next"] < shards
        return F.struct(
            F.when(inside, target).otherwise(state["next"]).alias("next"),
            F.when(inside, following).otherwise(state["key"]).alias("key"),
            F.when(inside, F.concat(state["seen"], F.array(state["next"]))).otherwise(state["seen"]).alias("seen"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("next"),
        key.cast("long").alias("key"),
        F.array().cast("array<bigint>").alias("seen"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, merge, lambda state: state["seen"])


def shard_of(key: Column, shards: int) -> Column:
    return F.element_at(jumps(key, shards), -1).cast("int")


def row_key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), text_checksum(text_col))


def text_checksum(text_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def sharded(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its id, size, checksum, shard, place in the shard, and shard if one is appended.

    Places are numbered within slices of a shard, which are as many as the rows need, and each
    slice begins where those before it end: no task sees more than a slice.
    """
    slices = -(-docs.count() // (ROWS_PER_SLICE * shards)) or 1
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("long").alias("size"),
        text_checksum(text_col).alias("text_crc32"),
        jumps(row_key(id_col, text_col), shards + 1).alias("jumps"),
        F.pmod(
            F.conv(F.substring(F.md5(row_key(id_col, text_col).cast("string")), 1, 8), 16, 10).cast("long"),
            F.lit(slices),
        ).alias("slice"),
    ).select(
        id_col,
        "size",
        "text_crc32",
        F.array_max(F.filter("jumps", lambda at: at < shards)).cast("int").alias("shard"),
        F.element_at("jumps", -1).cast("int").alias("grown_shard"),
        "slice",
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "slice")
        .agg(F.count("*").alias("rows"))
        .select(
            "shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
        )
    )
    within = Window.partitionBy("shard", "slice").orderBy(id_col, "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "slice"])
        .select(
            id_col,
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("place")).alias("slot"),
            "grown_shard",
        )
    )
