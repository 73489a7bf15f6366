"""Exact repeats of fixed-length windows, found through sampled anchors. Serves substring and suffix deduplication.

1. Every window of ``length`` units has one *anchor* that its own content chooses, so equal windows
   have equal anchors at equal offsets. Consecutive windows with one anchor form a *span*.
2. Each chunk of documents asks the hash buckets, in steps, about ever fewer of its spans:
   *names* (only where the scheme has rounds): which symbols occur elsewhere, so that windows around
   symbols that occur once are dropped;
   *keys*: which anchors occur elsewhere;
   *kinds*: of those, which spans are equal as a whole (by key, length and a 64-bit fingerprint);
   *texts*: of unlike spans that share a key, one of each kind sends its text, and the bucket sorts the
   windows of each key as suffixes and compares neighbours byte by byte.
3. Keys with more than ``crowd`` kinds, such as the edges of a passage that a third of all documents share,
   are split: their windows go to buckets of their own fingerprints, so that no task gathers a hot key.

An answer is a bit or three for each entry, in the order in which the chunk sent them. A chunk and a bucket
exchange one row, and both grow with the square root of the input (:func:`chunks.sizes`), so that rows keep
hundreds of keys at 30 GB and a dozen at 100 TB. No row, candidate or group is capped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from . import kernels as K
from .suffixes import repeat_classes

U64 = np.uint64
KEY_BITS = 48
CROWD = 128
SLICE_UNITS = 1 << 17


@dataclass(frozen=True)
class Units:
    """The units of a block of documents: 64-bit values and document offsets. Here units are bytes; see also ``Words``."""

    values: np.ndarray
    offsets: np.ndarray
    data: np.ndarray

    @cached_property
    def prefix(self) -> K.Prefix:
        return K.Prefix(self.values)

    def light(self) -> Units:
        """Without the values, which only searching needs."""
        return replace(self, values=self.values[:0])

    def texts(self, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ranges of units, and their sizes; cut by :attr:`Scheme.units` they are these units again."""
        return self.data[K.ranges(first, count)], count

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the bytes of windows at a and b are equal."""
        out = np.empty(len(a), bool)
        for s in range(0, len(a), 1 << 15):
            e = min(s + (1 << 15), len(a))
            size = np.full(e - s, length)
            out[s:e] = (self.data[K.ranges(a[s:e], size)] == self.data[K.ranges(b[s:e], size)]).reshape(-1, length).all(1)
        return out


@dataclass(frozen=True)
class Scheme:
    """What distinguishes the two operators.

    ``encode(data, offsets)`` makes the arrays of a chunk, ``blocks(arrays)`` yields its blocks of documents as
    (first document, last document, units), ``units(data, offsets)`` cuts texts; ``spans(units, shared)`` gives runs of
    windows with one anchor: first window, number of windows, anchor's place in the first, and key.
    ``names(units)``, if any, are the symbols asked about first; ``shared`` says of each whether it occurs elsewhere.
    ``across`` is True if a repeat counts only from a smaller document id, False if it counts from anywhere.
    """

    length: int
    across: bool
    encode: Callable
    blocks: Callable
    units: Callable
    spans: Callable
    names: Callable | None = None


def window_starts(offsets: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n units start a window that ends in their document."""
    delta = np.zeros(n + 1, np.int8)
    has = np.diff(offsets) >= length
    np.add.at(delta, offsets[:-1][has], 1)
    np.add.at(delta, offsets[1:][has] - length + 1, -1)
    return np.cumsum(delta[:-1], dtype=np.int8) > 0


def runs_of(anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and place of the anchor of each run of windows with one anchor (-1: no window)."""
    cut = np.flatnonzero(heads(anchor))
    count = np.diff(np.append(cut, len(anchor)))
    live = anchor[cut] >= 0
    first = cut[live]
    return first, count[live], anchor[first] - first


def heads(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before in any of the columns."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def bucket_slices(keys: np.ndarray, buckets: int, base: int = 0):
    """``bucket, first, last`` of the ranges of sorted keys that fall into each bucket that has any."""
    if not len(keys):
        return
    bucket = keys * U64(buckets) >> U64(KEY_BITS) if buckets < 1 << 15 else (keys >> U64(16)) * U64(buckets) >> U64(KEY_BITS - 16)
    cut = np.flatnonzero(heads(bucket))
    for s, e in zip(cut, np.append(cut[1:], len(keys)), strict=True):
        yield base + int(bucket[s]), int(s), int(e)


class Keys:
    """Sorted distinct keys of a chunk, whether the chunk alone makes each a repeat, and each entry's place among them."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, across: bool):
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        head = heads(key)
        at = np.flatnonzero(head)
        self.keys = key[at]
        self.place = np.empty(len(key), np.int64)
        self.place[order] = np.cumsum(head) - 1
        if not len(at):
            self.multi = np.zeros(0, bool)
        elif across:
            self.multi = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        else:
            self.multi = np.diff(np.append(at, len(key))) > 1

    def rows(self, buckets: int):
        for b, s, e in bucket_slices(self.keys, buckets):
            yield b, C.pack_sorted(self.keys[s:e]) + np.packbits(self.multi[s:e]).tobytes()

    def flags(self, buckets: int, replies) -> np.ndarray:
        """The answers, for each entry."""
        bits = np.zeros(len(self.keys), bool)
        for (_, s, e), reply in zip(bucket_slices(self.keys, buckets), replies, strict=True):
            bits[s:e] = np.unpackbits(np.frombuffer(reply, np.uint8), count=e - s)
        return bits[self.place]


class Kinds:
    """The distinct (key, count, print) among entries. ``slot`` is each entry's kind, ``rep`` an entry of least document."""

    def __init__(self, key, count, mark, doc):
        order = np.lexsort((doc, mark, count, key))
        head = heads(key[order], count[order], mark[order])
        self.slot = np.empty(len(key), np.int64)
        self.slot[order] = np.cumsum(head) - 1
        self.rep = order[head]
        self.key, self.count, self.mark, self.least = key[self.rep], count[self.rep], mark[self.rep], doc[self.rep]
        self.many = np.bincount(self.slot, minlength=len(self.rep)) > 1

    def rows(self, buckets: int, base: int = 0):
        for b, s, e in bucket_slices(self.key, buckets, base):
            yield b, C.compress(self.key[s:e], self.count[s:e].astype(np.uint32), self.mark[s:e], self.least[s:e], self.many[s:e].view(np.uint8))

    def codes(self, buckets: int, replies) -> np.ndarray:
        """Three answers of each kind: covered, send the text, send the windows."""
        out = np.zeros((3, len(self.rep)), bool)
        for (_, s, e), reply in zip(bucket_slices(self.key, buckets), replies, strict=True):
            out[:, s:e] = np.unpackbits(np.frombuffer(reply, np.uint8), count=3 * (e - s)).reshape(3, -1)
        return out


class Work:
    """One chunk at some step: what the replies so far say about its spans."""

    def __init__(self, scheme: Scheme, buckets: int, payload: bytes, replies: list):
        self.scheme, self.buckets = scheme, buckets
        self.ids, *self.arrays = C.expand(payload)
        replies = [r or [] for r in replies]
        shared = None
        if scheme.names:
            found, cuts = [], [0]
            for _, _, units in scheme.blocks(self.arrays):
                found.append(scheme.names(units))
                cuts.append(cuts[-1] + len(found[-1]))
            key = K.mix(np.concatenate(found)) >> U64(64 - KEY_BITS) if found else np.zeros(0, U64)
            self.asked = Keys(key, key, False)
            if not replies:
                return
            bits = self.asked.flags(buckets, replies.pop(0))
            shared = [bits[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        self._find_spans(shared)
        self.asked = Keys(self.key, self.doc, scheme.across)
        if not replies:
            return
        # spans of anchors that occur once end here
        self._keep(self.asked.flags(buckets, replies.pop(0)))
        self.kinds = Kinds(self.key, self.count, self.mark, self.doc)
        if not replies:
            return
        self.covered, text, windows = self.kinds.codes(buckets, replies.pop(0))
        self.text, self.hot = np.flatnonzero(text), np.flatnonzero(windows)
        if len(self.hot):
            self._find_windows()
        if replies:
            self._judge(replies.pop(0))

    def _find_spans(self, shared) -> None:
        parts: dict[str, list] = {n: [] for n in COLUMNS}
        self.blocks = []
        for n, (i, j, units) in enumerate(self.scheme.blocks(self.arrays)):
            first, count, lead, key = self.scheme.spans(units, shared[n] if shared else None)
            mark = units.prefix.slices(first, first + count + self.scheme.length - 1)
            doc = self.ids[np.searchsorted(units.offsets, first, "right") - 1 + i]
            # mixed anew: anchors may be minima of the same hash, whose small values would crowd the first buckets
            for name, column in zip(COLUMNS, (K.mix(key) >> U64(64 - KEY_BITS), mark, doc, first, count, lead, np.full(len(first), n)), strict=True):
                parts[name].append(column)
            self.blocks.append((i, j, units.light()))
        for name in COLUMNS:
            setattr(self, name, np.concatenate(parts[name]) if parts[name] else np.zeros(0, U64 if name in ("key", "mark") else np.int64))

    def _keep(self, wanted) -> None:
        for name in COLUMNS:
            setattr(self, name, getattr(self, name)[wanted])

    def _texts_of(self, span: np.ndarray):
        """The bytes of spans and their sizes."""
        found, place = [], np.empty(len(span), np.int64)
        block = self.block[span]
        order = np.argsort(block, kind="stable")
        cut = np.searchsorted(block[order], np.arange(len(self.blocks) + 1))
        for n, (_, _, units) in enumerate(self.blocks):
            mine = span[order[cut[n] : cut[n + 1]]]
            if len(mine):
                found.append(units.texts(self.first[mine], self.count[mine] + self.scheme.length - 1))
        place[order] = np.arange(len(span))
        if not found:
            return np.zeros(0, np.uint8), np.zeros(0, np.int64)
        data, size = (np.concatenate(x) for x in zip(*found, strict=True))
        begin = np.cumsum(size) - size
        return data[K.ranges(begin[place], size[place])], size[place]

    def _find_windows(self) -> None:
        """The windows of the spans of crowded keys, as entries of their own: every span, or the least of each kind."""
        span = self.kinds.rep[self.hot]
        text, size = self._texts_of(span)
        units = self.scheme.units(text, np.concatenate([[0], np.cumsum(size)]))
        count = self.count[span]
        at = K.ranges(units.offsets[:-1], count)
        mark = units.prefix.slices(at, at + self.scheme.length)
        key, doc = np.repeat(self.key[span], count), np.repeat(self.doc[span], count)
        self.windows = Kinds(mark >> U64(64 - KEY_BITS), np.ones(len(mark), np.int64), K.mix(mark ^ key), doc)

    def rows(self, step: str):
        if step in ("names", "keys"):
            yield from self.asked.rows(self.buckets)
        elif step == "kinds":
            yield from self.kinds.rows(self.buckets)
        else:
            kinds = self.kinds
            texts, sizes = self._texts_of(kinds.rep[self.text])
            begin = np.concatenate([[0], np.cumsum(sizes)])
            for b, s, e in bucket_slices(kinds.key[self.text], self.buckets):
                some = self.text[s:e]
                span, size, text = kinds.rep[some], sizes[s:e], texts[begin[s] : begin[e]]
                yield b, C.compress(kinds.key[some], kinds.least[some], self.count[span].astype(np.uint32), self.lead[span].astype(np.uint32), kinds.many[some].view(np.uint8), size.astype(np.int32), text)
            if len(self.hot):
                yield from self.windows.rows(self.buckets, self.buckets)

    def _judge(self, replies) -> None:
        """``bits``: whether each window of the kinds that sent their texts or windows repeats elsewhere; ``at``: of each kind, its first."""
        kinds = self.kinds
        judged = np.concatenate([self.text, self.hot])
        count = kinds.count[judged]
        self.at = np.full(len(kinds.rep), -1)
        self.at[judged] = np.cumsum(count) - count
        replies, parts = iter(replies), []
        for _, s, e in bucket_slices(kinds.key[self.text], self.buckets):
            parts.append(np.unpackbits(C.expand(next(replies))[0], count=int(kinds.count[self.text[s:e]].sum())).astype(bool))
        if len(self.hot):
            w = self.windows
            covered = w.codes(self.buckets, replies)[0]
            mine = np.repeat(kinds.least[self.hot], kinds.count[self.hot])
            parts.append(covered[w.slot] | (mine > w.least[w.slot] if self.scheme.across else w.many[w.slot]))
        self.bits = np.concatenate(parts) if parts else np.zeros(0, bool)

    def result(self):
        """For each block of documents: its ids, its units, and which units are covered."""
        kinds, length = self.kinds, self.scheme.length
        whole = self.covered[self.kinds.slot] | (self.doc > kinds.least[kinds.slot] if self.scheme.across else kinds.many[kinds.slot])
        some = np.flatnonzero(~whole & (self.at[kinds.slot] >= 0))
        hit = self.bits[K.ranges(self.at[kinds.slot[some]], self.count[some])]
        # covered ranges of units: of spans that repeat as a whole, and of single windows
        first = np.concatenate([self.first[whole], K.ranges(self.first[some], self.count[some])[hit]])
        last = np.concatenate([(self.first + self.count - 1)[whole], first[int(whole.sum()) :]]) + length
        block = np.concatenate([self.block[whole], np.repeat(self.block[some], self.count[some])[hit]])
        order = np.argsort(block, kind="stable")
        cut = np.searchsorted(block[order], np.arange(len(self.blocks) + 1))
        for n, (i, j, units) in enumerate(self.blocks):
            mine, size = order[cut[n] : cut[n + 1]], int(units.offsets[-1]) + 1
            delta = np.bincount(first[mine], minlength=size) - np.bincount(last[mine], minlength=size)
            yield self.ids[i:j], units, np.cumsum(delta[:-1]) > 0


COLUMNS = ("key", "mark", "doc", "first", "count", "lead", "block")
ROWS = "bucket int, chunk long, blob binary"
REPLY = "chunk long, bucket int, reply binary"


def _sender(scheme: Scheme, buckets: int, step: str):
    def run(batches):
        K.tame_memory()
        for batch in batches:
            for chunk, payload, *replies in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                rows = list(Work(scheme, buckets, payload.as_py(), [r.as_py() for r in replies]).rows(step))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "chunk", "blob"])
                K.tame_memory()

    return run


def _replies(table: pa.Table, replies: list[bytes]) -> pa.Table:
    return pa.table({"chunk": table.column("chunk").cast(pa.int64()), "bucket": table.column("bucket").cast(pa.int32()), "reply": pa.array(replies, pa.binary())})


def _read_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = C.packed_count(blob)
    bits = len(blob) - (n + 7) // 8
    return C.unpack_sorted(blob[:bits]), np.unpackbits(np.frombuffer(blob, np.uint8, offset=bits), count=n).astype(bool)


def _answer_keys(table: pa.Table) -> pa.Table:
    """For each chunk's keys of a bucket, one bit: the key occurs elsewhere."""
    K.tame_memory()
    read = [_read_keys(b.as_py()) for b in table.column("blob")]
    key, multi = np.concatenate([k for k, _ in read]), np.concatenate([m for _, m in read])
    order = np.argsort(key, kind="stable")
    head = heads(key[order])
    at = np.flatnonzero(head)
    shared = np.diff(np.append(at, len(key))) > 1
    shared |= np.logical_or.reduceat(multi[order], at)
    flag = np.empty(len(key), bool)
    flag[order] = shared[np.cumsum(head) - 1]
    ends = np.cumsum([len(k) for k, _ in read])
    return _replies(table, [np.packbits(flag[e - len(k) : e]).tobytes() for e, (k, _) in zip(ends, read, strict=True)])


def _answer_kinds(scheme: Scheme, crowd: int):
    """For each kind a chunk sent: does it repeat as a whole, and is its text or are its windows wanted?"""

    def run(table: pa.Table) -> pa.Table:
        K.tame_memory()
        read = [C.expand(b.as_py()) for b in table.column("blob")]
        sizes = np.array([len(r[0]) for r in read])
        key, count, mark, doc, many = (np.concatenate(x) for x in zip(*read, strict=True))
        del read
        order = np.lexsort((np.repeat(table.column("chunk").to_numpy(), sizes), doc, mark, count, key))
        key, doc, many = key[order], doc[order], many[order].astype(bool)
        first = heads(key)
        head = first | heads(count[order], mark[order])
        kind, group = np.cumsum(head) - 1, np.cumsum(first) - 1
        at, starts = np.flatnonzero(head), np.flatnonzero(first)
        least, entries = doc[at], np.diff(np.append(at, len(key)))
        unlike = np.add.reduceat(head.astype(np.int64), starts)
        crowded = unlike > 1
        if scheme.across:
            crowded &= np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
            covered = doc > least[kind]
            sends = ~covered & crowded[group]  # rows of one id may tie
        else:
            covered = ((entries > 1) | np.logical_or.reduceat(many, at))[kind]
            sends = head & crowded[group]
        hot = sends & (unlike > crowd)[group]
        code = np.empty((3, len(key)), bool)
        code[:, order] = covered, sends & ~hot, hot
        ends = np.cumsum(sizes)
        return _replies(table, [np.packbits(code[:, e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)])

    return run


def _answer_texts(scheme: Scheme, buckets: int, crowd: int):
    """Texts: one bit a window, it repeats; keys are worked through in order, a slice at a time. Windows: as kinds."""
    windows = _answer_kinds(scheme, crowd)

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            return windows(table)
        K.tame_memory()
        read = [C.expand(b.as_py()) for b in table.column("blob")]
        lengths = [len(r[0]) for r in read]
        key, doc, count, lead, many, size, text = (np.concatenate(x) for x in zip(*read, strict=True))
        del read
        count, lead = count.astype(np.int64), lead.astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        first = np.concatenate([[0], np.cumsum(count)])
        bits = np.zeros(first[-1], bool)
        order = np.argsort(key, kind="stable")
        edges = np.append(np.flatnonzero(heads(key[order])), len(order))
        for s, e in _slices(edges, np.concatenate([[0], np.cumsum(size[order], dtype=np.int64)])):
            at = order[s:e]
            units = scheme.units(text[K.ranges(begin[at], size[at])], np.concatenate([[0], np.cumsum(size[at], dtype=np.int64)]))
            bits[K.ranges(first[at], count[at])] = window_repeats(scheme, units, key[at], doc[at], count[at], lead[at])
        edge = first[np.concatenate([[0], np.cumsum(lengths)])]
        return _replies(table, [C.compress(np.packbits(bits[s:e])) for s, e in zip(edge[:-1], edge[1:], strict=True)])

    return run


def _slices(edges: np.ndarray, weight: np.ndarray, limit: int = 1 << 18):
    """Ranges between edges of groups of about ``limit`` weight; a group, of at most ``crowd`` spans, stays whole."""
    i = 0
    while i < len(edges) - 1:
        j = int(np.searchsorted(weight[edges], weight[edges[i]] + limit, "right")) - 1
        j = min(max(j, i + 1), len(edges) - 1)
        yield int(edges[i]), int(edges[j])
        i = j


def window_repeats(scheme: Scheme, units: Units, key, doc, count, lead) -> np.ndarray:
    """Whether each window of each span (spans in order, windows in order) has a qualifying equal elsewhere.

    Windows can be equal only if they share the key and the anchor's place; those are sorted as suffixes.
    """
    window = K.ranges(units.offsets[:-1], count)
    owner = np.repeat(np.arange(len(count)), count)
    place = lead[owner] - K.ranges(np.zeros(len(count), np.int64), count)
    group = (np.cumsum(heads(key)) - 1)[owner] * scheme.length + place
    order = np.argsort(group, kind="stable")
    head = heads(group[order])
    lone = head & np.append(head[1:], True)
    at = order[~lone]
    out = np.zeros(len(window), bool)
    if len(at):
        kind = repeat_classes(units, window[at], group[at], scheme.length)
        if scheme.across:
            mine = doc[owner[at]]
            low = np.full(kind.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(low, kind, mine)
            out[at] = low[kind] < mine
        else:
            out[at] = np.bincount(kind)[kind] > 1
    return out


def remove_repeats(docs: DataFrame, scheme: Scheme, finish: Callable, schema: str, id_column: str, text_column: str, crowd: int = CROWD) -> DataFrame:
    """``finish(ids, units, covered)`` makes the result rows of a block of documents."""
    size = C.sizes(docs)
    steps = {"names": _answer_keys, "keys": _answer_keys, "kinds": _answer_kinds(scheme, crowd), "texts": _answer_texts(scheme, size.buckets, crowd)}
    if not scheme.names:
        del steps["names"]
    asked = C.pack(docs, size, scheme.encode, id_column, text_column)
    for step, answer in steps.items():
        rows = asked.mapInArrow(_sender(scheme, size.buckets, step), ROWS)
        # one bucket a task
        replies = rows.repartitionById(size.buckets * (2 if step == "texts" else 1), F.col("bucket")).groupBy("bucket").applyInArrow(answer, REPLY)
        asked = asked.join(C.answers(replies, size, step).hint("shuffle_hash"), "chunk", "left")

    def run(batches):
        K.tame_memory()
        for batch in batches:
            for payload, *replies in zip(*batch.columns[1:], strict=True):
                for ids, units, gone in Work(scheme, size.buckets, payload.as_py(), [r.as_py() for r in replies]).result():
                    yield finish(ids, units, gone)
                K.tame_memory()

    return asked.mapInArrow(run, schema)
