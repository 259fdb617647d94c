"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.stored import stored


def _hung(pairs: DataFrame) -> DataFrame:
    """Each ``(u, v)`` hung below the least node that ``u`` is joined to, itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hung(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _hung(down)
    own = hung.select("u", F.col("m").alias("v"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node on an edge ``u, v``; the root is the component's least node.

    Every step moves each edge at most once by key and shrinks paths by half; hot nodes are reduced
    before they move. The steps end when the edges no longer change.
    """

    def state(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    def clean(df):
        return df.filter("u <> v").distinct()

    now = stored(clean(edges.select("u", "v")), "star-start")
    seen = state(now)
    while True:
        now = stored(clean(_small(clean(_large(now)))), "star-step")
        new = state(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
