"""The queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, langid, minhash, mixing, quality, sharding, substring_dedup, suffix_dedup, toxicity
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train_quality(docs, table(spark, sf_dir, "labels")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), min_bytes=50)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.label_language(docs, langid.train_tagger(docs))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, table(spark, sf_dir, "labels")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=35)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), query_modulus=20, neighbours=20)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_quality, op2_suffix_dedup, op3_minhash, op4_language, op5_sharding, op6_toxicity, op7_substring_dedup, op8_decontamination, op9_neighbours, op10_mixing)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    exact = {"op2_suffix_dedup": suffix_dedup.SUFFIX_SQL, "op3_minhash": minhash.NEAR_SQL, "op7_substring_dedup": substring_dedup.SUBSTRING_SQL}
    return exact | {"op5_sharding": sharding.shard_sql(), "op10_mixing": mixing.MIX_SQL}
