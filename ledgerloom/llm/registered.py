"""The registered query of each operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    decontamination,
    language_id,
    lexical_search,
    masked_lm,
    mixing,
    ngram_join,
    oracles,
    quality_rules,
    sharding,
    substring_chains,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
)
from ledgerloom.llm.shipping import ship
from ledgerloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(function):
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(table(spark, folder, "documents"), lang_col="lang").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op2_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


@query
def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = scratch_path(spark, "token-files")
    token_files.write_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), files
    )
    return token_files.digests(spark, files).withColumnRenamed("id", "doc_id")


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"),
    )


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").alias("n_tiles"))


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = language_id.fold("doc_id", 4)
    model = language_id.fit(docs.filter(fold != 2))
    return language_id.predicted(docs, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    fold = language_id.fold("doc_id", 3)
    grammar = toxicity.learn(toxicity.labelled(docs, labels.filter(fold != 1), toxicity.TRAIN_ROWS))
    return toxicity.scored(docs, grammar).select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op6_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, folder, "documents"))


@query
def op4_substring_chains(spark: SparkSession, folder: str) -> DataFrame:
    return substring_chains.repeated_passages(table(spark, folder, "documents"))


@query
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})
