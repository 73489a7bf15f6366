"""An extension: the record filter and chunker over a folder of JSON lines that keeps growing.

The batch stages keep the best of each group, which later rows may change, so the stream keeps state in a
table: every micro-batch passes the hard rules row by row and is upserted by content hash with
``foreachBatch``; a hash seen before keeps its first row. Chunks are made of new rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import chunks, filtering

RECORD = "doc_id string, url string, raw_url string, seed_url string, title string, content string, char_count long, content_hash string, status string, source_priority string, crawl_type string, source_name string, topic_tags array<string>, level_1 string, level_2 string, github_path string, notes string, knowledge_domain string, ord long"


def read_records(spark: SparkSession, folder: str, schema: str = RECORD, files_each: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).json(folder)


def admitted(records: DataFrame) -> DataFrame:
    """The stateless part: hard rules and low-value paths; native expressions, no shuffle."""
    return filtering.with_effective(records).where(filtering.hard_reason().isNull() & filtering.low_value_reason().isNull())


def reason_counts(records: DataFrame) -> DataFrame:
    """A running count of admitted and rejected records by reason."""
    why = F.coalesce(filtering.hard_reason(), filtering.low_value_reason(), F.lit("kept"))
    return records.groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def start_intake(records: DataFrame, corpus: str, chunk_folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append new records to ``corpus`` (Parquet, partitioned by the hash's first two digits) and their chunks.

    Only the partitions of hashes that a batch brings are read to find what is known.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = chunks.first_of(batch, "effective_content_hash", "ord", "doc_id").withColumn("part", F.substring("effective_content_hash", 1, 2))
        try:
            known = spark.read.parquet(corpus)
        except Exception as error:  # noqa: BLE001 - there is no corpus before the first batch
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER" not in str(error):
                raise
            known = None
        if known is not None:
            # a batch that is run again after a failure replaces what its first run wrote
            fresh = fresh.join(known.where(F.col("batch") != number).select("part", "effective_content_hash"), ["part", "effective_content_hash"], "left_anti")
        staged = fresh.withColumn("batch", F.lit(number))
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "part").parquet(corpus)
        done = spark.read.parquet(corpus).where(F.col("batch") == number).drop("part", "batch")
        made, _ = chunks.chunk_documents(done)
        made.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(chunk_folder)

    writer = admitted(records).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
