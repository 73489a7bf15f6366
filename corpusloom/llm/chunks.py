"""Documents packed into chunk rows, so that Spark shuffles few large rows and NumPy sees whole blocks.

A chunk holds whole documents, some MiB of text or one longer document. Its id is the scan
partition and a serial number, so a recomputed task names its chunks alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import ship
from . import kernels as K
from .common import size_in_bytes

SCHEMA = "chunk long, payload binary"


@dataclass(frozen=True)
class Sizes:
    """Bytes of text in a chunk, partitions of chunks, and buckets that chunks ask."""

    chunk: int
    parts: int
    buckets: int


def sizes(docs: DataFrame) -> Sizes:
    """Chunks and buckets exchange a row each, so both grow with the square root of the input, up to a task's memory."""
    size = size_in_bytes(docs)
    if size is None:
        parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return Sizes(4 << 20, parts, parts)
    root = math.sqrt(size)
    between = lambda low, x, high: int(min(max(low, x), high))
    each = between(8 << 20, 200 * root, 256 << 20)
    return Sizes(between(1 << 20, 20 * root, 64 << 20), max(8, math.ceil(size / each)), max(8, math.ceil(size / between(4 << 20, 200 * root, 256 << 20))))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as raw low bytes and one byte for each step of the high part (255: a step of 255 and no key yet)."""
    rel = keys - keys[0]
    low = max(0, math.ceil((math.log2(int(rel[-1]) / len(keys) + 1) - 6) / 8))
    high = (rel >> np.uint64(8 * low)).astype(np.int64)
    step = np.diff(high, prepend=0)
    skips = step // 255
    steps = np.full(len(keys) + int(skips.sum()), 255, np.uint8)
    steps[np.cumsum(skips + 1) - 1] = step % 255
    head = np.array([len(keys), low], np.uint32).tobytes() + keys[:1].tobytes()
    return head + rel.view(np.uint8).reshape(-1, 8)[:, :low].tobytes() + steps.tobytes()


def packed_count(blob: bytes) -> int:
    return int(np.frombuffer(blob, np.uint32, 1)[0])


def unpack_sorted(blob: bytes) -> np.ndarray:
    n, low = map(int, np.frombuffer(blob, np.uint32, 2))
    out = np.zeros((n, 8), np.uint8)
    out[:, :low] = np.frombuffer(blob, np.uint8, n * low, 16).reshape(n, low)
    steps = np.frombuffer(blob, np.uint8, offset=16 + n * low)
    high = np.cumsum(steps, dtype=np.uint64)[steps != 255]
    return out.reshape(-1).view(np.uint64) + (high << np.uint64(8 * low)) + np.frombuffer(blob, np.uint64, 1, 8)


def compress(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame, each with its bytes transposed (high bytes together compress well)."""
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        code = a.dtype.str.encode().ljust(8)
        out += [code, np.array([len(a)], np.int64).tobytes(), a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def expand(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    count, at, arrays = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(count):
        dtype, n = np.dtype(raw[at : at + 8].decode().strip()), int(np.frombuffer(raw, np.int64, 1, at + 8)[0])
        at += 16
        body = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n).T
        arrays.append(np.ascontiguousarray(body).reshape(-1).view(dtype))
        at += n * dtype.itemsize
    return arrays


def _packer(limit: int, encode: Callable):
    def run(batches):
        K.tame_memory()
        context = TaskContext.get()
        serial = (context.partitionId() if context else 0) << 32
        ids, offsets, parts, held = [], [], [], 0
        for batch in batches:
            data, ends = K.buffers(batch.column(1))
            doc = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            for i, j in K.doc_slices(ends, limit):
                size = int(ends[j] - ends[i])
                if held and held + size > limit:
                    yield _chunk(serial, ids, offsets, parts, encode)
                    serial, ids, offsets, parts, held = serial + 1, [], [], [], 0
                ids.append(doc[i:j])
                offsets.append(np.diff(ends[i : j + 1]))
                parts.append(data[ends[i] : ends[j]])
                held += size
        if ids:
            yield _chunk(serial, ids, offsets, parts, encode)

    return run


def _chunk(serial, ids, lengths, parts, encode):
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    blob = compress(np.concatenate(ids), *encode(np.concatenate(parts), offsets))
    return pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), pa.array([blob], pa.binary())], ["chunk", "payload"])


def pack(docs: DataFrame, size: Sizes, encode: Callable, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Chunk rows of all documents, hash-partitioned by chunk: one exchange that later steps reuse.

    A payload holds the document ids and the arrays that ``encode(data, offsets)`` makes of their texts.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(_packer(size.chunk, encode), SCHEMA).repartition(size.parts, "chunk")


def answers(replies: DataFrame, size: Sizes, name: str) -> DataFrame:
    """The buckets' replies gathered by chunk, in order of bucket, partitioned as the chunks are."""
    pairs = F.array_sort(F.collect_list(F.struct("bucket", "reply")))
    return replies.repartition(size.parts, "chunk").groupBy("chunk").agg(F.transform(pairs, lambda x: x["reply"]).alias(name))
