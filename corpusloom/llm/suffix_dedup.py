"""Suffix-array deduplication: remove every byte that a long string shared with an earlier document covers.

Method: hash-compared suffix sort. Minimisers sample the suffixes that can start a shared string, and the
buckets of ``windowdup.py`` bring those together that share a minimiser. Where they aren't equal as a whole,
mergesort orders them by common extension, found by binary search over prefix polynomial hashes
(``suffixes.py``); repeats are neighbours of full extension and are verified on bytes. Matches never cross documents.

Defined cases: a null or empty text has no bytes and nothing removed; a text shorter than the window
keeps all; documents with equal ids count as one document (neither removes the other's bytes, and each
row is returned); an empty table gives an empty result; a null id takes part as the smallest id
and comes back null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .windowdup import CROWD, SLICE_UNITS, Scheme, Units, remove_repeats, runs_of, window_starts

U64 = np.uint64
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def byte_units(data, offsets) -> Units:
    return Units(K.byte_units(data), np.asarray(offsets, np.int64), data)


def minimisers(units: Units, length: int, gram: int) -> np.ndarray:
    """Each window's anchor: the leftmost smallest fingerprint among its grams of ``gram`` bytes; -1 where no window starts."""
    n = len(units.values)
    anchor = np.full(n, -1, np.int64)
    if n < length:
        return anchor
    key = units.prefix.windows(gram)
    low = U64((1 << 31) - 1)  # positions; equal upper bits go to the leftmost, so content alone decides
    least = K.sliding_min((key & ~low) | np.arange(len(key), dtype=U64), length - gram + 1) & low
    anchor[: len(least)] = least
    anchor[~window_starts(units.offsets, n, length)] = -1
    return anchor


@dataclass(frozen=True)
class Sampled(Units):
    """Bytes with their spans, which are found once, when chunks are made."""

    found: tuple = ()


def scheme_for(length: int, gram: int) -> Scheme:
    def encode(data, offsets):
        """Lengths and bytes of the documents, and of each span the gap before it, its windows and its anchor's place."""
        runs, base = [[np.zeros(0, np.int64)] * 3], 0
        for i, j in K.doc_slices(offsets, SLICE_UNITS):
            units = byte_units(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            first, count, lead = runs_of(minimisers(units, length, gram))
            runs.append((first + base, count, lead))
            base += len(units.data)
        first, count, lead = (np.concatenate(x) for x in zip(*runs, strict=True))
        gap = first - np.concatenate([[0], (first + count)[:-1]]) if len(first) else first
        return np.diff(offsets), data, gap.astype(np.uint32), count.astype(np.uint32), lead.astype(np.uint32)

    def blocks(arrays):
        lengths, data, gap, count, lead = arrays
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        count, lead = count.astype(np.int64), lead.astype(np.int64)
        first = np.cumsum(gap + count) - count
        for i, j in K.doc_slices(offsets, SLICE_UNITS):
            part = data[offsets[i] : offsets[j]]
            s, e = np.searchsorted(first, [offsets[i], offsets[j]])
            yield i, j, Sampled(K.byte_units(part), offsets[i : j + 1] - offsets[i], part, (first[s:e] - offsets[i], count[s:e], lead[s:e]))

    def spans(units, shared=None):
        first, count, lead = units.found
        at = first + lead
        return first, count, lead, units.prefix.slices(at, at + gram)

    return Scheme(length, True, encode, blocks, byte_units, spans)


def digest(ids, units: Units, gone) -> pa.RecordBatch:
    """Result rows of a block: sizes, removed runs and the SHA-256 of the kept bytes."""
    o = units.offsets
    removed = np.concatenate([[0], np.cumsum(gone)])
    opens = gone.copy()
    if len(gone):
        opens[1:] &= ~gone[:-1]
        inner = o[:-1][o[:-1] < len(gone)]
        opens[inner] = gone[inner]
    runs = np.concatenate([[0], np.cumsum(opens)])
    kept = units.data[~gone].tobytes()
    at = np.arange(len(removed)) - removed
    view = memoryview(kept)
    sha = [hashlib.sha256(view[at[s] : at[e]]).hexdigest() for s, e in zip(o[:-1], o[1:], strict=True)]
    doc = pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min)
    return pa.RecordBatch.from_arrays([doc, pa.array(np.diff(o)), pa.array(removed[o[1:]] - removed[o[:-1]]), pa.array(runs[o[1:]] - runs[o[:-1]]), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, min_bytes: int = 50, gram: int | None = None, id_column: str = "doc_id", text_column: str = "text", finish=digest, schema: str = SCHEMA, crowd: int = CROWD) -> DataFrame:
    """One row per document: bytes, bytes removed, removed runs and the hash of what is kept.

    ``finish(ids, units, covered)`` may make other rows, such as the kept texts (:func:`kept_texts`). Keys of more
    than ``crowd`` unlike spans are split over buckets.
    """
    gram = gram or max(1, min_bytes // 2)
    return remove_repeats(docs, scheme_for(min_bytes, gram), finish, schema, id_column, text_column, crowd)


def kept_texts(ids, units: Units, gone) -> pa.RecordBatch:
    """Another ``finish``: the kept bytes themselves (schema ``doc_id long, kept binary``)."""
    kept = [units.data[s:e][~gone[s:e]].tobytes() for s, e in zip(units.offsets[:-1], units.offsets[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min), pa.array(kept, pa.binary())], ["doc_id", "kept"])


#: DuckDB SQL of the query, with windows of 50 bytes.
SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, doc_id, i, b[i + 1:i + 50] AS s FROM (SELECT *, unnest(range(octet_length(b) - 49)) AS i FROM d)),
seen AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.r, w.i FROM w JOIN seen USING (s) WHERE seen.least < w.doc_id),
cut AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM hit),
run AS (SELECT r, min(i) AS s, max(i) + 50 AS e FROM (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS k FROM cut) GROUP BY r, k),
part AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS z FROM run
  UNION ALL SELECT d.r, coalesce(max(run.e), 0), any_value(octet_length(d.b)) FROM d LEFT JOIN run USING (r) GROUP BY d.r),
kept AS (SELECT r, string_agg(hex(d.b[p.a + 1:p.z]), '' ORDER BY p.a) AS x FROM part p JOIN d USING (r) WHERE p.z > p.a GROUP BY r),
gone AS (SELECT r, sum(e - s)::BIGINT AS n, count(*) AS spans FROM run GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone.n, 0) AS n_removed, coalesce(gone.spans, 0) AS n_spans, sha256(unhex(coalesce(kept.x, ''))) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""
