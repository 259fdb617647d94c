"""The training-text pipeline: five operators one after another over the documents.

All stages take nulls in any column, empty and very long texts, repeated rows and other columns, which
they hand on; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, mixing, ngram_join, quality_rules, sharding
from ledgerloom.llm.shipping import ship
from ledgerloom.llm.stored import stored

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or blank text fails them, repeats are judged alike."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by similar word n-grams, that of the least id.

    Rows without words stay, each of them; of repeated rows one stays.
    """
    return ngram_join.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks; rows without words stay, as do all if there is no item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it; rows without words once."""
    return mixing.mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard of their id in one more column.

    Every row stays. A null id goes by the text. An input column named ``shard`` keeps its values, and
    the new column is then ``shard_``, or the like.
    """
    name, taken = "shard", {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    key = sharding.row_key("doc_id", "text")
    return docs.withColumn(name, sharding.shard_of(key, SHARDS))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources", mix),
    ("sharding", shards),
]

# MinHash signatures and string tiling have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read by the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
