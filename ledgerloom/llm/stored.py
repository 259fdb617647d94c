"""Intermediate tables that cut lineage: written once to the cluster's shared folder and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.session import scratch_path


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows of ``df``, computed once and kept as Parquet below ``spark.checkpoint.dir``.

    A lost executor costs the reread of a file, never a recomputation of what led to it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
