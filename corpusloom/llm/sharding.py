"""Sharding by a permutation-filled lookup table; DataFrame operations only on the rows.

Each shard has its own preference order over the slots of a table of prime size: offset, offset + skip,
offset + 2 skip, ... The shards take turns, each claiming its next free preference, until the table is
full. A document's slot is a hash of its key, so placement is one lookup in a broadcast table, whose size
is a parameter (never the data's). Adding or dropping a shard moves few documents.

Defined cases: a null key is placed like the empty string; equal keys go to one shard; an empty table
gives an empty result; extra columns are kept, and of clashing names (``slot``, ``shard``) the new one wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 8191
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))
#: The lookup table is broadcast, so it may not have more slots than this.
MOST_SLOTS = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard number of each slot. ``slots`` must be prime and at least the number of shards."""
    if slots > MOST_SLOTS or slots < max(2, len(shards)) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards must be distinct names, at least one")
    place = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, filled = [-1] * slots, 0
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            table[place[i]] = i
            filled += 1
            if filled == slots:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 15 hex digits of its MD5, modulo the table's size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % slots).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    packed = ",".join(map(str, lookup_table(shards, slots)))
    names = F.split(F.lit("\n".join(shards)), "\n")
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(packed), ",")).alias("slot", "number"))
    return rows.select("slot", F.element_at(names, F.col("number").cast("int") + 1).alias("shard"))


def shard(docs: DataFrame, shards: Sequence[str] = SHARDS, slots: int = SLOTS, key_column: str = "doc_id") -> DataFrame:
    """docs with ``slot`` and ``shard``: a projection and a broadcast lookup, no shuffle."""
    kept = [c for c in docs.columns if c.lower() not in ("slot", "shard")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    keyed = docs.select(row.alias("_row"), slot_of(F.col(f"`{key_column}`"), slots).alias("slot"))
    joined = keyed.join(F.broadcast(table_frame(docs.sparkSession, shards, slots)), "slot")
    return joined.select(*(["_row.*"] if kept else []), "slot", "shard")


def shard_sql(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> str:
    numbers = ",".join(map(str, lookup_table(shards, slots)))
    names = ",".join(f"'{s}'" for s in shards)
    return f"""
WITH keyed AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {slots})::INT AS slot FROM documents)
SELECT doc_id, slot, ([{names}])[([{numbers}])[slot + 1] + 1] AS shard FROM keyed
"""
