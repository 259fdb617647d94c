"""Load-once ingest: each file of a directory reaches the table exactly once.

A batch is a folder of plain Parquet below the table, named after its load history and number. A
batch that is run again replaces its own folder, so nothing is lost or doubled, and rows may be
appended to the table beside it. Read such a table with ``tables.read_table``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerloom.sources import schemas, tables
from ledgerloom.sources.csv_files import CSV_FORMAT, conform


def load_arrivals(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    target: str,
    history: str,
    options: Mapping[str, str] | None = None,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
    files_per_batch: int = 10_000,
    max_file_age: str = "36500d",
    archive: str | None = None,
) -> DataFrame:
    """Load the files that arrived since the last call into ``target``; return that table.

    ``history`` is the checkpoint folder of this target. It is the load history: a rerun skips
    files already loaded, and a run that died half-way resumes without a gap or a double. Large
    backlogs are taken ``files_per_batch`` at a time. ``target`` may be a table that exists; the
    rows then take its column types. Without any file the result is that table, or an empty one.

    A file counts as new however old it is, for which the driver keeps the names of all loaded
    files. With an ``archive``, a folder outside ``directory``, the next batch or call moves files
    there that are loaded; ``max_file_age`` then bounds that list. A moved file that comes back is
    not loaded again: it is in the list, or too old for it.
    """
    cleaned = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    rows = (
        spark.readStream.options(**{**CSV_FORMAT, **(options or {})})
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .options(**cleaned)
        .schema(schema)
        .csv(directory)
    )
    typed = conform(rows, json_columns, max_lengths)
    # An empty table first: it fixes the schema, also if no file ever arrives.
    spark.createDataFrame([], typed.schema).write.mode("ignore").parquet(target)
    stored = tables.read_table(spark, target).schema
    load = hashlib.sha256(history.encode()).hexdigest()[:12]

    def store(batch: DataFrame, number: int) -> None:
        folder = f"{target}/load-{load}-{number:010d}"
        tables.as_stored(batch, stored).write.mode("overwrite").parquet(folder)

    run = (
        typed.writeStream.foreachBatch(store)
        .option("checkpointLocation", history)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return tables.read_table(spark, target, stored)


def load_raw_arrivals(
    spark: SparkSession,
    table: str,
    directory: str,
    target: str,
    history: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``load_arrivals`` for one of the declared raw tables."""
    return load_arrivals(
        spark,
        directory,
        schemas.file_schema(table),
        target,
        history,
        options,
        schemas.JSON_COLUMNS.get(table, ()),
        schemas.MAX_LENGTHS.get(table),
    )
