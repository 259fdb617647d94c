"""Parquet tables: write to a new path, append, copy, insert rows, count rows.

A table is never overwritten in place. A failed or retried job therefore cannot damage what
others read, and a lost executor only means that its tasks run again.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

PLAIN_VALUES = (str, bytes, bytearray, bool, int, float, Decimal, datetime.date, datetime.timedelta)


def write_new(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store ``rows`` at a path that does not exist yet and return the stored table."""
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store ``rows`` as a catalog table hashed on ``key``.

    Two tables stored with the same key and bucket count join on it without a shuffle.
    """
    rows.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).saveAsTable(table)
    return rows.sparkSession.table(table)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a table without partition columns, those in folders of loaded batches included."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(path)


def append(rows: DataFrame, path: str) -> DataFrame:
    """Add ``rows`` to the table at ``path``, matching columns by name; return the table."""
    schema = read_table(rows.sparkSession, path).schema
    as_stored(rows, schema).write.mode("append").parquet(path)
    return read_table(rows.sparkSession, path, schema)


def as_stored(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, each as a value that its type can hold."""
    types = {f.name: f.dataType for f in rows.schema}
    return rows.select(
        *[fitted(F.col(f.name), types[f.name], f.dataType).alias(f.name) for f in schema]
    )


def fitted(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``kind`` as ``target``; a fraction is rounded, half away from zero."""
    if isinstance(target, T.IntegralType) and isinstance(kind, (T.FractionalType, T.DecimalType)):
        value = F.round(value)
    return value.cast(target)


def copy_table(rows: DataFrame, path: str) -> DataFrame:
    """A full copy at a new path; later writes to either side do not reach the other."""
    return write_new(rows, path)


def create_as(rows: DataFrame, path: str, columns: Mapping[str, str]) -> DataFrame:
    """New table from a query: ``columns`` maps each new column to the SQL that fills it."""
    return write_new(rows.select(*[F.expr(sql).alias(name) for name, sql in columns.items()]), path)


def value_rows(spark: SparkSession, like: DataFrame, values: Iterable[Sequence]) -> DataFrame:
    """Literal rows with the column names and types of ``like``.

    Text given for another type is cast as by an insert, for example ``'2024-01-01'`` to a
    date. Text that does not fit its column fails. Other values keep their type until they are
    stored; dicts and lists become a VARIANT, and what has no literal is refused.
    """
    fields = like.schema.fields
    structs = [
        F.struct(*[_literal(v, f.dataType).alias(f.name) for f, v in zip(fields, row, strict=True)])
        for row in values
    ]
    if not structs:
        return like.limit(0)
    return like.limit(0).unionByName(spark.range(1).select(F.inline(F.array(*structs))))


def _literal(value: object, target: T.DataType) -> Column:
    if isinstance(value, (dict, list)) and isinstance(target, T.VariantType):
        return F.parse_json(F.lit(json.dumps(value)))
    if value is not None and not isinstance(value, PLAIN_VALUES):
        raise TypeError(f"no literal for {type(value).__name__}: {value!r}")
    if isinstance(value, (float, Decimal)):
        return fitted(F.lit(value), T.DoubleType(), target)
    return F.lit(value).cast(target)


def row_counts(named: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in named.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stored_row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per stored Parquet table: its name and its number of rows, from the file footers.

    Only the version-2 reader counts by footers. It is chosen in a session of its own, where nothing
    but these counts is read: that reader fails on the least or greatest value of a file of NULLs.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counted = row_counts({name: read_table(footers, path) for name, path in paths.items()})
    # Files without row groups add no number; a table of nothing else has a NULL sum of them.
    counts = [(row.table_name, row.row_count or 0) for row in counted.collect()]
    return spark.createDataFrame(counts, counted.schema)
