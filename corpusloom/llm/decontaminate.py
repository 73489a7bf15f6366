"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ from a passage by k = floor(error_rate * n) edits. Cut into k + 1
pieces, at least one piece then occurs unchanged. An Aho-Corasick automaton finds all pieces of all items
in one pass over each whole text; every hit names a diagonal, and the text around it is verified with
Myers' bit-parallel edit distance. Texts and items are compared in lower case with white space squeezed.

Where the pieces are shorter than ``min_piece`` characters, they hit often. Of an item's disjoint blocks of
four characters k edits spoil at most k, so the text around a hit is verified only if no more are missing.
The budget k and the matches don't depend on ``min_piece``.

The automaton is broadcast, so its size is checked: items are taken in blocks of at most
``block_bytes`` of text, each block in its own pass over the documents.

Defined cases: null and blank items match nothing; an item so short that a tenth is less than one
character gets no errors, and none may lose all its characters; null and empty texts match nothing; repeated items
count under each id, and items with a null id mark a text without being listed; repeated rows are
judged alike; empty tables give no matches; extra columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import ship


BLOCK = 4


def normalise(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(n: int, errors: int) -> list[tuple[int, int]]:
    """The ends of errors + 1 pieces of nearly equal length."""
    cuts = [round(i * n / (errors + 1)) for i in range(errors + 2)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def myers(pattern: str, text: str, most: int, masks: dict[str, int] | None = None) -> int:
    """Least edit distance of the pattern to any substring of text, bit-parallel; stops at the first within ``most``."""
    m = len(pattern)
    if not m:
        return 0
    masks = masks or pattern_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full  # a match may start anywhere: row 0 stays 0
        down = (down << 1) & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if score < best:
            best = score
            if best <= most:
                return best
    return best


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


@dataclass(frozen=True)
class Items:
    """Normalised items, the errors that each may have, and whether its pieces are short."""

    ids: tuple[int | None, ...]
    texts: tuple[str, ...]
    errors: tuple[int, ...]
    short: tuple[bool, ...]

    @staticmethod
    def of(rows, error_rate: float, min_piece: int) -> Items:
        kept = [(i, t) for i, t in ((r[0], normalise(r[1])) for r in rows) if t]
        errors = tuple(min(math.floor(error_rate * len(t)), len(t) - 1) for _, t in kept)
        short = tuple(len(t) < min_piece * (e + 1) for (_, t), e in zip(kept, errors, strict=True))
        return Items(tuple(i for i, _ in kept), tuple(t for _, t in kept), errors, short)


class Matcher:
    def __init__(self, items: Items):
        self.items = items
        self.masks: dict[int, dict[str, int]] = {}
        self.blocks: dict[int, list[str]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (text, errors) in enumerate(zip(items.texts, items.errors, strict=True)):
            for s, e in pieces(len(text), errors):
                found.setdefault(text[s:e], []).append((k, e))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, owners)
        self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[int]:
        """Numbers of the items that occur in the text."""
        text = normalise(text)
        if not text or not len(self.automaton):
            return []
        spots: dict[int, list[int]] = {}
        for end, owners in self.automaton.iter(text):
            for k, offset in owners:
                spots.setdefault(k, []).append(end + 1 - offset)
        return sorted(k for k, starts in spots.items() if self._verify(k, text, starts))

    def _verify(self, k: int, text: str, starts: list[int]) -> bool:
        item, errors = self.items.texts[k], self.items.errors[k]
        n = len(item)
        if any(text.startswith(item, s) for s in starts if s >= 0):
            return True
        if not errors:
            return False
        low = high = None
        for s in sorted(set(starts)):  # windows that overlap are read once
            a, b = max(0, s - errors), s + n + errors
            if high is not None and a <= high:
                high = b
                continue
            if high is not None and self._near(k, text[low:high]):
                return True
            low, high = a, b
        return self._near(k, text[low:high])

    def _near(self, k: int, window: str) -> bool:
        """Whether the window holds item k within its errors."""
        item, errors = self.items.texts[k], self.items.errors[k]
        if self.items.short[k]:
            blocks = self.blocks.get(k) or self.blocks.setdefault(k, [item[i : i + BLOCK] for i in range(0, len(item) - BLOCK + 1, BLOCK)])
            missing = 0
            for block in blocks:
                if block not in window:
                    missing += 1
                    if missing > errors:
                        return False
        masks = self.masks.get(k) or self.masks.setdefault(k, pattern_masks(item))
        return myers(item, window, errors, masks) <= errors


def item_blocks(benchmark: DataFrame, block_bytes: int, error_rate: float, min_piece: int, id_column: str, text_column: str) -> list[Items]:
    """The items in blocks that are each small enough to broadcast."""
    rows = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (block_bytes // 2)))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    found = []
    for b in range(blocks):
        part = rows.where(place == b) if blocks > 1 else rows
        items = Items.of(sorted(part.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1])), error_rate, min_piece)
        if items.texts:
            found.append(items)
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.1, min_piece: int = 12, block_bytes: int = 8 << 20, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """Per document: ``doc_id, n_items, item_ids`` (sorted) ``, contaminated``."""
    ship(docs.sparkSession)
    out = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.lit(0).cast("long").alias("n_items"), F.array().cast("array<long>").alias("item_ids"))
    for items in item_blocks(benchmark, block_bytes, error_rate, min_piece, item_column, text_column):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value)
            for batch in batches:
                hits = [matcher.matches(t.as_py()) for t in batch.column(1)]
                ids = [sorted([*old, *(matcher.items.ids[k] for k in h if matcher.items.ids[k] is not None)]) for old, h in zip(batch.column(3).to_pylist(), hits, strict=True)]
                count = [old + len(h) for old, h in zip(batch.column(2).to_pylist(), hits, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "text", "n_items", "item_ids"])

        out = out.mapInArrow(run, "doc_id long, text string, n_items long, item_ids array<long>")
    return out.select("doc_id", "n_items", "item_ids", (F.col("n_items") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.1, min_piece: int = 12, block_bytes: int = 8 << 20, text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The rows of docs that hold no item: a filter in the scan's own stage, no shuffle."""
    ship(docs.sparkSession)
    at, out = docs.columns.index(text_column), docs
    for items in item_blocks(benchmark, block_bytes, error_rate, min_piece, item_column, text_column):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
