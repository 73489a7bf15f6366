"""The training-data pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as
the next stage's docs. Stages never change a kept document's columns; the last adds ``slot`` and ``shard``.

Of all stages: an empty table gives an empty table; extra columns stay, whatever their names; texts count whole,
however long; a null text counts as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontaminate, minhash, mixing, quality, sharding
from corpusloom.llm.common import shared_dir, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts.

    Null and empty texts are scored like any other; repeated rows are judged alike; a null id changes nothing;
    without a positive label all stay.
    """
    return quality.keep_good(docs, quality.train_quality(docs, table(spark, sf_dir, "labels")))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more.

    The smallest id stays; of repeated rows one. Texts without words are like nothing and stay; so do null ids.
    """
    return minhash.keep_one(docs, width=5, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, a tenth of its characters may be edited.

    Null and empty texts and items match nothing; repeated rows are judged alike.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and fractional repetitions of each source, up to its target.

    A null source is a source of its own; rows of one id are taken or left together; a text without words counts
    as no words and comes as often as its source's whole repetitions.
    """
    return mixing.mix(docs, weights=(5, 2, 1), max_epochs=3)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard; rows of one id, also of the null id, share one."""
    return sharding.shard(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", keep_one_of_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources", mix_sources),
    ("sharding", place_on_shards),
]

#: A trained classifier and edit distances over substrings aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
