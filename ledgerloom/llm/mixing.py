"""Mixing sources to target weights by hash thresholds.

Each row has a fixed hash. A source is taken whole as often as its target holds its size, and the
rest of the target is met by the rows below a threshold of the hash. The threshold is found from
sums by source and hash bucket, refined inside the one bucket where it falls; no row is sorted.

Defined results: a null or blank text has size 0 and takes nothing; a null source is a source of
its own, the last; repeated rows share a hash, and so many of them are taken as come nearest the
target; other columns stay as they are whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.rowkeys import wide_key
from ledgerloom.llm.stored import stored

WORD = r"[^\x20\x09-\x0D]+"
BITS = 12
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(*columns: Column) -> Column:
    """48 bits of a row, the same on every run and in every engine that has MD5."""
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 12), 16, 10).cast("long")


def targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """``source, source_size`` with each source's ``target``; one row per source.

    The budget is ``share`` of all sizes, dealt by weight; a source stops at ``most`` times its
    size and what it leaves goes to the others by weight. With the sources in order of
    ``limit / weight``, the full ones come first, so that one running sum finds them all.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    weighed = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("level", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
    )
    left = weighed.withColumn(
        "rate",
        (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    # The first source that its share does not fill sets the rate of all after it.
    open_rate = F.min(F.when(F.col("level") > F.col("rate"), F.struct("level", "source", "rate"))).over(whole)["rate"]
    return left.withColumn("open_rate", open_rate).select(
        "source",
        "source_size",
        F.least("limit", F.coalesce(F.col("open_rate") * F.col("weight"), F.col("limit"))).alias("target"),
    )


def _bucket(level: int) -> Column:
    return F.shiftright("hash", 48 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def _boundary(rows: DataFrame, budgets: DataFrame, bucket: Column) -> DataFrame:
    """Per source the bucket in which its budget ends, and what the budget leaves for it."""
    before = (
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = (
        rows.groupBy("source", bucket.alias("bucket"))
        .agg(F.sum("size").alias("words"))
        .withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
    )
    return (
        sums.join(budgets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .filter((F.col("below") < F.col("rest")) & (F.col("rest") <= F.col("below") + F.col("words")))
        .select("source", "bucket", (F.col("rest") - F.col("below")).alias("rest"))
    )


def _same(source: str) -> Column:
    return F.col("source").eqNullSafe(F.col(source))


def chosen(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """``source, hash, size`` and other columns, with ``source_size``, ``target`` and ``times``.

    ``rows`` is read several times, so it should be a stored table. A row is taken ``times`` times.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sizes, weights, share, most), "mix-targets")
    rounds = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    budgets = goals.withColumn("rounds", rounds.cast("int")).withColumn(
        "rest", F.col("target") - F.col("rounds") * F.col("source_size")
    )
    # Level by level, the bucket of each source in which its threshold lies.
    prefix, edge = rows, budgets.select("source", "rest")
    levels = []
    for level in range(2):
        found = stored(_boundary(prefix, edge, _bucket(level)), f"mix-level-{level}")
        levels.append(found)
        edge = found.select("source", "rest")
        inside = found.select(F.col("source").alias("of"), F.col("bucket").alias("at"))
        prefix = (
            prefix.join(inside, _same("of") & (_bucket(level) == F.col("at"))).drop("of", "at")
        )
    # What is left of each source is a sliver of its hashes: the threshold is one of them.
    before = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        prefix.filter("size > 0")
        .groupBy("source", "hash")
        .agg(F.sum("size").alias("words"), F.max("size").alias("each"))
        .withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(edge.withColumnRenamed("source", "of"), _same("of"))
        .filter((F.col("below") < F.col("rest")) & (F.col("rest") <= F.col("below") + F.col("words")))
        .select(
            "source",
            F.col("hash").alias("threshold"),
            F.floor((F.col("rest") - F.col("below")) / F.col("each") + 0.5).alias("at_threshold"),
        )
    )
    plan = stored(
        budgets.join(last.withColumnRenamed("source", "of"), _same("of"), "left").select(
            F.col("source").alias("of"), "source_size", "target", "rounds", "threshold", "at_threshold"
        ),
        "mix-plan",
    )
    planned = rows.join(plan, _same("of")).drop("of")
    off = planned.filter((F.col("hash") != F.col("threshold")) | F.col("threshold").isNull())
    on = planned.filter(F.col("hash") == F.col("threshold"))
    # Of rows with one hash, the longest first and else by their keys, so that reruns agree.
    ties = [F.col("key")] if "key" in rows.columns else []
    equal = Window.partitionBy("source", "hash").orderBy(F.col("size").desc(), *ties)
    extra = F.coalesce((F.col("hash") < F.col("threshold")).cast("int"), F.lit(0))
    # A rest of nothing has no threshold, and neither has a source without words.
    done = off.withColumn("times", F.col("rounds") + extra).unionByName(
        on.withColumn(
            "times",
            F.col("rounds") + (F.row_number().over(equal) <= F.col("at_threshold")).cast("int"),
        )
    )
    return done.drop("rounds", "threshold", "at_threshold")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row its id, ``size``, ``source_size``, ``target`` and ``times``."""
    planned = _planned(docs, weights, share, most, id_col, text_col, source_col)
    return planned.withColumnRenamed("id", id_col).drop("key")


def _planned(
    docs: DataFrame,
    weights: Sequence[int],
    share: float,
    most: float,
    id_col: str,
    text_col: str,
    source_col: str,
) -> DataFrame:
    """The rows of ``mixed_documents`` with ``id`` and the ``key`` that names them."""
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            size_in_words(F.col(text_col)).alias("size"),
            row_hash(F.col(id_col), F.col(text_col)).alias("hash"),
            wide_key(F.col(source_col), F.col(id_col), F.col(text_col)).alias("key"),
        ),
        "mix-rows",
    )
    return chosen(rows, weights, share, most).select(
        "id", "size", "source_size", "target", "times", "source", "hash", "key"
    )


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of the mix with the columns they came with, each as often as it is taken.

    Rows without words are kept once: they cost nothing. Rows are known by source, id and text; of
    equal ones, some may be taken once more than the others, in the order of their other columns.
    """
    picks = (
        _planned(docs, weights, share, most, id_col, text_col, source_col)
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("size") == 0, 1).otherwise(F.col("times"))).alias("taken"),
            F.count("*").alias("rows"),
        )
    )
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        wide_key(F.col(source_col), F.col(id_col), F.col(text_col)).alias("key"),
    )
    planned = keyed.join(picks, "key").withColumn("times", F.floor(F.col("taken") / F.col("rows")).cast("int"))
    # Only rows that are not taken equally often have to be told apart.
    even = F.col("taken") % F.col("rows") == 0
    order = Window.partitionBy("key").orderBy(F.to_json("row"))
    more = planned.filter(~even).withColumn("nth", F.row_number().over(order) - 1)
    more = more.withColumn("times", F.col("times") + (F.col("nth") < F.col("taken") % F.col("rows")).cast("int"))
    return (
        planned.filter(even)
        .select("row", "times")
        .unionByName(more.select("row", "times"))
        .filter("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("row.*")
    )
