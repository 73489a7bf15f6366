"""What the operators share: tables, held-out rows, sizes, and tables in the shared checkpoint folder."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import shared_folder as shared_dir  # noqa: F401
from ..plans.tables import written as materialise  # noqa: F401

#: Words are runs of characters other than these six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def size_in_bytes(df: DataFrame) -> int | None:
    """Catalyst's estimate of the input's bytes on disk; None where it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 58 else None


def parts_for(df: DataFrame, bytes_each: int, least: int = 8) -> int:
    """A number of partitions or buckets that grows with the input, so that none of them does."""
    size = size_in_bytes(df)
    if size is None:
        return max(least, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, math.ceil(size / bytes_each))
