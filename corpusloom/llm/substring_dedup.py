"""Substring deduplication by recompression: remove every word that a window seen elsewhere covers.

Method: rounds name runs of equal symbols and then pairs of neighbouring symbols, up to symbols as long as
a window can surely hold whole. A pair (a, b) is joined where a falls into the left and b into the right
half of a hash partition that changes with the round; that depends on a and b alone, so equal word
sequences get equal symbols but near their ends, by a margin that each round widens by the longest symbol
before it (a run round by its own). A name is a fingerprint of what it stands for, so all tasks name alike.

Spark rounds count the names globally: all runs and lower pairs first, and a window with a symbol in its
undisturbed middle that occurs nowhere else is dropped. The last round names the highest-level symbol of a
window's middle together with the words that every window around it holds; where that name recurs, spans
are compared, and windows are verified word by word (``windowdup.py``).

Defined cases: null and empty texts have no words; texts shorter than a window keep all; a window that
recurs in the same document counts, overlapping or not; repeated rows repeat each other; an empty table
gives an empty result; extra columns are ignored.
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
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def margins(rounds) -> list[tuple[int, int]]:
    """After each round, the words at either end of a sequence that its surroundings can disturb, and the longest symbol."""
    longest, lost, out = 1, 0, []
    for kind, cap in rounds:
        lost += cap if kind == "run" else longest
        longest = max(longest, cap)
        out.append((lost, longest))
    return out


def rounds_for(length: int) -> tuple:
    """As many rounds, each of twice as long symbols, as leave a whole symbol in the middle of every window."""
    rounds = [("run", 2)]
    while True:
        lost, longest = margins(rounds)[-1]
        if length - 2 * lost - longest + 1 < longest:
            return tuple(rounds[:-1])
        rounds.append(("pair", 2 * rounds[-1][1]))


@dataclass(frozen=True)
class Words(Units):
    """Words as units: ``word`` numbers each among the distinct ones, whose bytes and a space each are ``data``."""

    word: np.ndarray
    begin: np.ndarray  # of each distinct word
    size: np.ndarray  # with its space

    def texts(self, first, count):
        sizes = self.size[self.word]
        total = np.concatenate([[0], np.cumsum(sizes)])
        word = self.word[K.ranges(first, count)]
        return self.data[K.ranges(self.begin[word], self.size[word])], total[first + count] - total[first]

    def same(self, a, b, length):
        out = np.empty(len(a), bool)
        for s in range(0, len(a), 1 << 13):
            size = np.full(len(a[s : s + (1 << 13)]), length)
            x, y = (self.word[K.ranges(at[s : s + (1 << 13)], size)] for at in (a, b))
            equal = x == y  # distinct words differ in bytes
            out[s : s + (1 << 13)] = equal.reshape(-1, length).all(1)
        return out


def word_table(data, offsets):
    """Of each word its number, and the distinct words: their sizes and their bytes, a space after each; word offsets of documents.

    Words are numbered by hash; a word whose bytes aren't those of its number's first gets a number of its own.
    """
    start, end, docs = K.words(data, offsets)
    hashes, size = K.word_hashes(data, start, end), end - start
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    if len(word):
        mine = np.where(size == size[first[word]], size, 0)
        unlike = (size != mine) | (mine > 0) & (np.add.reduceat(np.append(data[K.ranges(start, mine)] != data[K.ranges(start[first[word]], mine)], 0), np.minimum(np.cumsum(mine) - mine, mine.sum())) > 0)
        other = np.flatnonzero(unlike)
        word[other] = len(first) + np.arange(len(other))
        first = np.append(first, other)
    sizes = size[first] + 1
    text = np.append(data, np.uint8(32))[K.ranges(start[first], sizes)]
    text[np.cumsum(sizes) - 1] = 32
    return word, sizes, text, docs.astype(np.int64)


def words_of(word, sizes, text, offsets) -> Words:
    after = np.cumsum(sizes)
    begin = after - sizes
    return Words(K.word_hashes(text, begin, after - 1)[word], offsets, text, word, begin, sizes)


def word_units(data, offsets) -> Words:
    return words_of(*word_table(data, offsets))


def encode(data, offsets):
    """Words of the documents, numbers of words, and the distinct words."""
    word, sizes, text, docs = word_table(data, offsets)
    return np.diff(docs), word.astype(np.uint32), sizes.astype(np.uint32), text


def blocks(arrays):
    counts, word, sizes, text = arrays
    offsets, word, sizes = np.concatenate([[0], np.cumsum(counts)]), word.astype(np.int64), sizes.astype(np.int64)
    whole = words_of(np.arange(len(sizes)), sizes, text, offsets)
    for i, j in K.doc_slices(offsets, SLICE_UNITS):
        part = word[offsets[i] : offsets[j]]
        yield i, j, Words(whole.values[part], offsets[i : j + 1] - offsets[i], text, part, whole.begin, sizes)


def recompress(units: Units, rounds) -> list[tuple]:
    """After each round: name, first word and number of words of every symbol, and which ones the round made.

    Symbols never cross documents.
    """
    n = len(units.values)
    names, starts, sizes = units.values, np.arange(n), np.ones(n, np.int64)
    doc = np.repeat(np.arange(len(units.offsets) - 1), np.diff(units.offsets))
    levels = []
    for number, (kind, cap) in enumerate(rounds):
        n = len(names)
        joins = doc[1:] == doc[:-1]
        name, size, keep, fresh = names.copy(), sizes.copy(), np.ones(n, bool), np.zeros(n, bool)
        if kind == "run":
            keep[1:] = ~(joins & (names[1:] == names[:-1]))
            at = np.flatnonzero(keep)
            length = np.diff(np.append(at, n))
            whole = (length > 1) & (length * sizes[at] <= cap)
            keep |= ~np.repeat(whole, length)
            at, length = at[whole], length[whole]
            name[at] = K.mix(names[at] ^ K.mix(length.astype(U64) + U64(number << 32)))
            size[at] *= length
        else:
            side = (K.mix(names ^ U64(0xA5A5 + 977 * number)) >> U64(40)) & U64(1)
            at = np.flatnonzero(joins & (side[:-1] == 0) & (side[1:] == 1) & (sizes[:-1] + sizes[1:] <= cap))
            name[at] = K.mix(names[at] * U64(0x9E3779B97F4A7C15) + K.mix(names[at + 1] + U64(number + 1)))
            size[at] += sizes[at + 1]
            keep[at + 1] = False
        fresh[at] = True
        names, starts, sizes, doc, fresh = name[keep], starts[keep], size[keep], doc[keep], fresh[keep]
        levels.append((names, starts, sizes, fresh))
    return levels


def lower_names(rounds):
    """The names that all rounds but the last make, for the first global count."""

    def run(units: Units) -> np.ndarray:
        return np.concatenate([names[fresh] for names, _, _, fresh in recompress(units, rounds)[:-1]])

    return run


def symbol_anchors(length: int, rounds):
    lost, longest = margins(rounds)[-1] if rounds else (0, 1)
    first, last = lost, length - lost - longest
    width = last - first + 1
    assert width >= longest, "the window is too short for these rounds"
    low = U64((1 << 31) - 1)  # positions; equal upper bits go to the leftmost, so content alone decides

    def run(units: Units, shared=None):
        """Spans of windows with one anchor, and each anchor's key."""
        n = len(units.values)
        anchor, key = np.full(n, -1, np.int64), np.zeros(n, U64)
        if n >= length:
            levels = recompress(units, rounds) or [(units.values, np.arange(n), np.ones(n, np.int64), None)]
            names, starts, sizes, _ = levels[-1]
            # the longest symbol that starts in the middle, of equal ones the smallest name
            value = np.full(n, ~U64(0))
            value[starts] = (np.minimum(longest - sizes, 254).astype(U64) << U64(56)) | ((K.mix(names) >> U64(8)) & ~low) | starts.astype(U64)
            windows = n - length + 1
            anchor[:windows] = K.sliding_min(value[first:], width)[:windows] & low
            anchor[~window_starts(units.offsets, n, length)] = -1
            if shared is not None:
                anchor[:windows][_around_lone(levels[:-1], shared, windows, length, rounds)] = -1
            key[starts] = names
        window, count, lead = runs_of(anchor)
        at = window + lead
        # the symbol's name, and the words that each of its windows holds
        return window, count, lead, K.mix(key[at] + units.prefix.slices(at - first, at + length - last))

    return run


def _around_lone(levels, shared: np.ndarray, windows: int, length: int, rounds) -> np.ndarray:
    """Windows whose undisturbed middle holds a symbol that occurs nowhere else."""
    delta, seen = np.zeros(windows + 1, np.int64), 0
    for (_, starts, sizes, fresh), (lost, _) in zip(levels, margins(rounds), strict=False):
        s, e = starts[fresh], (starts + sizes)[fresh]
        lone = ~shared[seen : seen + len(s)]
        seen += len(s)
        begin, end = np.maximum(e[lone] - (length - lost), 0), np.minimum(s[lone] - lost, windows - 1)
        some = begin <= end
        np.add.at(delta, begin[some], 1)
        np.add.at(delta, end[some] + 1, -1)
    return np.cumsum(delta[:-1]) > 0


def digest(ids, units: Units, gone) -> pa.RecordBatch:
    """Result rows of a block: words, removed words and the SHA-256 of the kept words joined by one space."""
    removed = np.concatenate([[0], np.cumsum(gone)])
    o = units.offsets
    sha = [hashlib.sha256(text).hexdigest() for text in _kept(units, gone)]
    doc = pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min)
    return pa.RecordBatch.from_arrays([doc, pa.array(np.diff(o)), pa.array(removed[o[1:]] - removed[o[:-1]]), pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _kept(units: Words, gone):
    """The kept words of each document of a block, joined by one space."""
    word = units.word[~gone]
    view = memoryview(units.data[K.ranges(units.begin[word], units.size[word])].tobytes())
    at = np.concatenate([[0], np.cumsum(np.where(gone, 0, units.size[units.word]))])
    bounds = at[units.offsets]
    return [bytes(view[s : max(s, e - 1)]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def kept_texts(ids, units: Units, gone) -> pa.RecordBatch:
    """Another ``finish``: the kept words themselves (schema ``doc_id long, kept string``)."""
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min), pa.array([t.decode() for t in _kept(units, gone)])], ["doc_id", "kept"])


def scheme_for(window: int) -> Scheme:
    rounds = rounds_for(window)
    return Scheme(window, False, encode, blocks, word_units, symbol_anchors(window, rounds), lower_names(rounds) if len(rounds) > 1 else None)


def substring_dedup(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text", finish=digest, schema: str = SCHEMA, crowd: int = CROWD) -> DataFrame:
    """One row per document: words, words removed and the hash of what is kept.

    ``finish(ids, units, covered)`` may make other rows, such as the kept texts (:func:`kept_texts`). Keys of more
    than ``crowd`` unlike spans are split over buckets.
    """
    return remove_repeats(docs, scheme_for(window), finish, schema, id_column, text_column, crowd)


#: DuckDB SQL of the query, with windows of 35 words.
SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS b FROM documents),
w AS (SELECT r, i, array_to_string(b[i + 1:i + 35], ' ') AS s FROM (SELECT *, unnest(range(len(b) - 34)) AS i FROM d)),
seen AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT w.r, w.i FROM w JOIN seen USING (s)),
cut AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 35 THEN 0 ELSE 1 END AS opens FROM hit),
run AS (SELECT r, min(i) AS s, max(i) + 35 AS e FROM (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS k FROM cut) GROUP BY r, k),
part AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS z FROM run
  UNION ALL SELECT d.r, coalesce(max(run.e), 0), any_value(len(d.b)) FROM d LEFT JOIN run USING (r) GROUP BY d.r),
kept AS (SELECT r, string_agg(array_to_string(d.b[p.a + 1:p.z], ' '), ' ' ORDER BY p.a) AS x FROM part p JOIN d USING (r) WHERE p.z > p.a GROUP BY r),
gone AS (SELECT r, sum(e - s)::BIGINT AS n FROM run GROUP BY r)
SELECT doc_id, len(b)::BIGINT AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(kept.x, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""
