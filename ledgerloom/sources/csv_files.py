"""Bulk load of headerless CSV directories into typed parquet tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions import variants
from ledgerloom.sources import schemas, tables

# The one CSV format, shared by the batch and the incremental load. Columns go by position, an
# empty field and \N are NULL, and a malformed row fails the load instead of losing data.
CSV_FORMAT = {
    "sep": ",",
    "header": "false",
    "mode": "FAILFAST",
    "nullValue": r"\N",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "enforceSchema": "true",
}


def read_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The typed rows of every file below ``directory``. ``options`` override the format."""
    return (
        spark.read.options(**{**CSV_FORMAT, **(options or {})})
        .option("recursiveFileLookup", "true")
        .schema(schema)
        .csv(directory)
    )


def conform(
    rows: DataFrame,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Typed rows as they are stored: JSON text becomes VARIANT, too long text fails."""
    columns = {name: variants.parse(F.col(name)) for name in json_columns}
    for name, length in (max_lengths or {}).items():
        message = F.concat(F.lit(f"{name} exceeds {length} characters: "), F.col(name))
        columns[name] = F.when(
            F.char_length(name) > length, F.raise_error(message).cast("string")
        ).otherwise(F.col(name))
    return rows.withColumns(columns) if columns else rows


def judged_lines(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Every line below ``directory`` as a row of ``schema``, JSON as VARIANT, with what speaks against it.

    ``refusal`` holds file, line and reason of a line that is malformed, holds text that is not JSON
    in a JSON column, or too long a text, and is NULL for a good line. ``refused`` says which it is.
    The columns of a refused line are NULL. Blank lines are none, as for the reader.
    """
    clash = {"refused", "refusal"} & {name.lower() for name in schema.fieldNames()}
    if clash:
        raise ValueError(f"columns named like the verdict on a line: {sorted(clash)}")
    form = {**CSV_FORMAT, **(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "refusal"}
    if form["multiLine"] != "false" or form["header"] != "false":
        raise ValueError("lines can be told apart only where each is one row, without a header")
    split = {name: form[name] for name in ("lineSep",) if name in form}
    lines = (
        spark.read.options(recursiveFileLookup="true", **split)
        .text(directory)
        .filter(F.trim("value") != "")
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    fields = T.StructType([*schema.fields, T.StructField("refusal", T.StringType())])
    row = F.from_csv("value", fields.toDDL(), form)
    reasons = [(F.col("row.refusal").isNotNull(), "malformed")]
    columns = {name: F.col("row")[name] for name in schema.fieldNames()}
    for name, length in (max_lengths or {}).items():
        reasons.append((F.char_length(columns[name]) > length, f"{name} exceeds {length} characters"))
    for name in json_columns:
        text, columns[name] = columns[name], variants.parse(columns[name])
        reasons.append((text.isNotNull() & columns[name].isNull(), f"{name} is not JSON"))
    reason = F.coalesce(*[F.when(wrong, F.lit(said)) for wrong, said in reasons])
    verdict = lines.withColumn("row", row).withColumn("reason", reason)
    good = F.col("reason").isNull()
    return verdict.select(
        *[F.when(good, value).alias(name) for name, value in columns.items()],
        F.when(~good, F.struct("file", F.col("value").alias("line"), "reason")).alias("refusal"),
        (~good).alias("refused"),
    )


def load_csv_or_refuse(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    target: str,
    options: Mapping[str, str] | None = None,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load the good lines of a directory, and keep the others with their reasons instead of failing.

    One write stores both, in two folders of the new table at ``target``: what is loaded and what is
    refused together are all lines that this write has read. Returns the loaded rows and the refused
    ``file, line, reason``.
    """
    judged = judged_lines(spark, directory, schema, options, json_columns, max_lengths)
    stored = tables.write_new(judged, target, ["refused"])
    loaded = stored.filter(~F.col("refused")).drop("refusal", "refused")
    return loaded, stored.filter("refused").select("refusal.*")


def load_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    target: str,
    options: Mapping[str, str] | None = None,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Load a directory into a new parquet table at ``target`` and return that table."""
    rows = read_csv(spark, directory, schema, options)
    return tables.write_new(conform(rows, json_columns, max_lengths), target)


def load_more_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    target: str,
    options: Mapping[str, str] | None = None,
    json_columns: Iterable[str] = (),
    max_lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Load a directory into the table that is at ``target``, whose column types hold."""
    rows = read_csv(spark, directory, schema, options)
    return tables.append(conform(rows, json_columns, max_lengths), target)


def load_raw_table(
    spark: SparkSession,
    table: str,
    directory: str,
    target: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``load_csv`` for one of the declared raw tables."""
    return load_csv(
        spark,
        directory,
        schemas.file_schema(table),
        target,
        options,
        schemas.JSON_COLUMNS.get(table, ()),
        schemas.MAX_LENGTHS.get(table),
    )
