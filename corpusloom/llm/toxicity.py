"""Toxicity: a support vector machine on a subsequence string kernel, with Nystrom landmarks.

The kernel of two words sums, over all four-letter subsequences that span at most ``SPAN`` letters (a word's edges count as letters),
the products of decay^(letters spanned); so an insult keeps most of its subsequences when letters are
inserted or left out. Landmark words give the Nystrom map z(x) = K_mm^-1/2 k(x, landmarks) and a linear
SVM is trained on z. Since k(x, l) is a sum over the subsequences of l, the decision w z(x) + b is a sum of
one table entry per subsequence of x: scoring costs ten table lookups a letter and no kernel matrix.

Sentences are judged by their worst word, texts by their worst sentence. Labels are given per text, so
training is by multiple instances: every word of a clean text is a clean example, and each toxic text
has a worst word that is found, trained on, and found again. Runs of single letters are read as a word.

Learning uses at most ``toxic`` + ``clean`` labelled texts, those of smallest id hash; scoring reads every
whole text. Letters are compared without ASCII case; other signs within words are skipped.

Defined cases: null and empty texts, and texts without a word of two letters, score as a text whose
words share nothing with any landmark; labels repeated for an id count as their maximum; without toxic
or clean training texts every score is 0; a null id counts as held out; repeated rows score alike; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import ship
from . import kernels as K
from .common import held_out

SPAN, DECAY = 6, 0.7
_GAPS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]  # later letters, from the first
_EDGE, _END = 63, 62
_LETTER = np.zeros(256, np.uint32)  # 0: skipped; 1 to 61: a letter class
_LETTER[97:123] = _LETTER[65:91] = np.arange(1, 27)
_LETTER[48:58] = np.arange(27, 35)[np.arange(10) % 8]
_LETTER[128:192] = 35 + ((np.arange(128, 192) & 0x3F) | 0x20) % 27  # second bytes, capitals as small letters
_TABLE_BITS = 21
_TABLE_SIZE = 1 << _TABLE_BITS


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Words as letter classes between edge marks: classes, word offsets, and the word range of each document.

    Three or more one-letter words in a row become one word.
    """
    start, end, docs = K.words(data, offsets)
    cls = _LETTER[data[K.ranges(start, end - start)]]
    kept = cls > 0
    count = np.concatenate([[0], np.cumsum(kept)])
    at = count[np.concatenate([[0], np.cumsum(end - start)])]
    cls = cls[kept]
    single = np.diff(at) == 1
    if single.any():
        doc = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
        joins = np.zeros(len(single), bool)
        joins[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
        head = np.flatnonzero(~joins)
        run = np.diff(np.append(head, len(single)))
        keep = ~joins | ~np.repeat(run >= 3, run)
        docs = np.concatenate([[0], np.cumsum(keep)])[docs]
        at = np.append(at[:-1][keep], at[-1])
    n = len(at) - 1
    marked = np.empty(len(cls) + 2 * n, np.uint32)
    first = at[:-1] + 2 * np.arange(n)
    body = np.ones(len(marked), bool)
    body[first] = False
    after = at[1:] + 2 * np.arange(n) + 1
    body[after] = False
    marked[first], marked[after], marked[body] = _EDGE, _END, cls
    return marked, at + 2 * np.arange(n + 1), docs


def subsequences(cls: np.ndarray, at: np.ndarray):
    """For every gap pattern: positions of first letters, table index and weight."""
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(cls))
    for a, b, c in _GAPS:
        i = np.flatnonzero(left > c)
        u = (cls[i] << np.uint32(18)) | (cls[i + a] << np.uint32(12)) | (cls[i + b] << np.uint32(6)) | cls[i + c]
        yield i, (u * np.uint32(0x9E3779B1)) >> np.uint32(32 - _TABLE_BITS), DECAY ** (c + 1)


def sums(table: np.ndarray, cls: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum over each word's subsequences of weight x table entry."""
    total = np.zeros(len(cls) + 1)
    for i, index, weight in subsequences(cls, at):
        total[i] += weight * table[index]
    run = np.concatenate([[0], np.cumsum(total)])
    return run[at[1:]] - run[at[:-1]]


def vectors(cls: np.ndarray, at: np.ndarray):
    """Sparse kernel features of words: word, table index and weight, merged and sorted; and their norms."""
    words, index, weight = [], [], []
    for i, u, w in subsequences(cls, at):
        words.append(np.searchsorted(at, i, "right") - 1)
        index.append(u)
        weight.append(np.full(len(i), w))
    key = (np.concatenate(words).astype(np.int64) << _TABLE_BITS) | np.concatenate(index).astype(np.int64)
    key, inverse = np.unique(key, return_inverse=True)
    value = np.bincount(inverse, weights=np.concatenate(weight), minlength=len(key))
    word = key >> _TABLE_BITS
    norm = np.sqrt(np.bincount(word, weights=value**2, minlength=len(at) - 1))
    return word, key & (_TABLE_SIZE - 1), value, np.maximum(norm, 1e-9)


def _take(cls, at, rows):
    """The words ``rows`` as their own classes and offsets."""
    size = np.diff(at)[rows]
    return cls[K.ranges(at[:-1][rows], size)], np.concatenate([[0], np.cumsum(size)])


def word_prints(cls, at) -> np.ndarray:
    return K.Prefix(cls.astype(np.uint64) + np.uint64(7)).slices(at[:-1], at[1:])


@dataclass(frozen=True)
class Machine:
    """Table entries that aren't zero, the intercept, and the logistic of a text's worst decision value."""

    index: np.ndarray
    value: np.ndarray
    intercept: float
    slope: float
    shift: float

    def table(self) -> np.ndarray:
        t = np.zeros(_TABLE_SIZE)
        t[self.index] = self.value
        return t

    def decide(self, table, cls, at) -> np.ndarray:
        """Decision value of each word. Norms are needed only where the sum is above zero."""
        out = np.full(len(at) - 1, self.intercept)
        for i in range(0, len(out), 1 << 15):  # some words at a time, to bound memory
            j = min(len(out), i + (1 << 15))
            some, edges = cls[at[i] : at[j]], at[i : j + 1] - at[i]
            s = sums(table, some, edges)
            up = np.flatnonzero(s > 0.02)
            if len(up):
                *_, norm = vectors(*_take(some, edges, up))
                out[i + up] += s[up] / norm
        return out

    def texts(self, data, offsets, table) -> np.ndarray:
        """Score of each text: distinct words of the block are judged once."""
        cls, at, docs = tokens(data, offsets)
        worst = np.full(len(offsets) - 1, self.intercept)
        if len(at) > 1:
            _, first, inverse = np.unique(word_prints(cls, at), return_index=True, return_inverse=True)
            each = self.decide(table, *_take(cls, at, first))[inverse]
            full = np.flatnonzero(np.diff(docs))
            worst[full] = np.maximum(np.maximum.reduceat(each, docs[:-1][full]), self.intercept)
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -40, 40)))


def _project(row, column, value, basis, rows: int, step: int = 512) -> np.ndarray:
    """Sparse rows (sorted by row) times a dense basis, some rows at a time."""
    out = np.zeros((rows, basis.shape[1]))
    edges = np.searchsorted(row, np.arange(0, rows + step, step))
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        if e > s:
            part = value[s:e, None] * basis[column[s:e]]
            heads = np.flatnonzero(np.concatenate([[True], row[s:e][1:] != row[s:e][:-1]]))
            out[row[s:e][heads]] = np.add.reduceat(part, heads, axis=0)
    return out


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 200, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear SVM, squared hinge loss, full-batch Adam."""
    w, b = np.zeros(z.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (z @ w + b))
        pull = -2 * weight * y * slack
        g = np.append(z.T @ pull + l2 * w, pull.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9) * 0.5 * (1 + np.cos(np.pi * t / steps))
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _first_guess(cls, at, uid, doc_of, toxic_doc) -> np.ndarray:
    """Log-odds with which a word's letter 4- to 6-grams point to toxic texts, for every distinct word; the best gram counts."""
    n = len(at) - 1
    best = np.full(n, -9.0)
    prefix = K.Prefix(cls.astype(np.uint64))
    for size in (4, 5, 6):
        grams = prefix.windows(size)
        left = np.repeat(at[1:], np.diff(at))[: len(grams)] - np.arange(len(grams))
        position = np.flatnonzero(left >= size)
        gram = (grams[position] >> np.uint64(42)).astype(np.int64)
        word = np.searchsorted(at, position, "right") - 1
        by_word = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])
        many = np.diff(by_word)
        t, c = np.zeros(1 << 22, np.int32), np.zeros(1 << 22, np.int32)
        cuts = np.searchsorted(doc_of, np.arange(0, len(toxic_doc) + 256, 256))
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):  # some texts at a time; each counts a gram once
            ids = uid[s:e]
            pairs = np.unique((np.repeat(doc_of[s:e], many[ids]) << 22) | gram[K.ranges(by_word[:-1][ids], many[ids])])
            g, is_toxic = pairs & ((1 << 22) - 1), toxic_doc[pairs >> 22]
            np.add.at(t, g[is_toxic], 1)
            np.add.at(c, g[~is_toxic], 1)
        odds = np.log((t + 0.05) / (toxic_doc.sum() + 1)) - np.log((c + 0.5) / ((~toxic_doc).sum() + 1))
        odds[t < 2] = -9
        np.maximum.at(best, word, odds[gram])
    return best


def fit_toxicity(texts, toxic: np.ndarray, landmarks: int = 160, rounds: int = 4, seed: int = 3) -> Machine | None:
    """``texts``: an Arrow string column; ``toxic``: a flag for each."""
    if not toxic.any() or toxic.all():
        return None
    rng = np.random.default_rng(seed)
    data, offsets = K.buffers(texts)
    cls, at, docs = tokens(data, offsets)
    doc_of = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    K.tame_memory()
    _, first, uid = np.unique(word_prints(cls, at), return_index=True, return_inverse=True)
    cls, at = _take(cls, at, first)
    keys = np.unique((doc_of.astype(np.int64) << 32) | uid)
    doc_of, uid = keys >> 32, keys & 0xFFFFFFFF
    del data, offsets, first, keys
    n = len(at) - 1
    if not n:
        return None
    in_clean = np.bincount(uid[~toxic[doc_of]], minlength=n) > 0
    score = _first_guess(cls, at, uid, doc_of, toxic)
    score[in_clean] = -99
    head = np.flatnonzero(np.concatenate([[True], doc_of[1:] != doc_of[:-1]]))
    bags = np.flatnonzero(toxic[doc_of[head]])
    ends = np.append(head[1:], len(doc_of))
    machine, hard = None, np.zeros(0, np.int64)
    clean_words = np.flatnonzero(in_clean & (np.diff(at) >= 4))
    for turn in range(rounds):
        worst = np.array([head[b] + np.argmax(score[uid[head[b] : ends[b]]]) for b in bags])
        found, times = np.unique(uid[worst][score[uid[worst]] > (0 if turn else -9)], return_counts=True)
        if not len(found) or not len(clean_words):
            return machine
        some = np.unique(np.concatenate([rng.choice(clean_words, min(4000, len(clean_words)), replace=False), hard]))
        rows = np.concatenate([found, some])
        y = np.concatenate([np.ones(len(found)), -np.ones(len(some))])
        weight = np.concatenate([times / times.sum() * 0.3, np.full(len(some), 0.7 / len(some))])
        # landmarks: the most frequent worst words, and some clean ones
        marks = np.concatenate([found[np.argsort(-times, kind="stable")[: landmarks * 3 // 4]], rng.choice(some, min(landmarks // 4, len(some)), replace=False)])
        lw, lu, lv, ln = vectors(*_take(cls, at, marks))
        used, column = np.unique(lu, return_inverse=True)
        land = np.zeros((len(marks), len(used)))
        land[lw, column] = lv / ln[lw]
        xw, xu, xv, xn = vectors(*_take(cls, at, rows))
        where = np.searchsorted(used, xu)
        hit = (where < len(used)) & (used[np.minimum(where, len(used) - 1)] == xu)
        value, basis = np.linalg.eigh(land @ land.T)
        good = value > 1e-6 * value.max()
        half = basis[:, good] / np.sqrt(value[good])  # K_mm^-1/2 up to a rotation
        z = _project(xw[hit], where[hit], (xv / xn[xw])[hit], land.T @ half, len(rows))
        w, b = _svm(z, y, weight)
        entry = land.T @ (half @ w)
        machine = Machine(used.astype(np.int64), entry, b, 1.0, 0.0)
        score = machine.decide(machine.table(), cls, at)
        top = clean_words[np.argsort(-score[clean_words], kind="stable")[:2000]]
        hard = np.unique(np.concatenate([hard, top]))
    top = np.maximum.reduceat(score[uid], head)
    return _calibrate(machine, top, toxic[doc_of[head]])


def _calibrate(machine: Machine, top: np.ndarray, toxic: np.ndarray) -> Machine:
    """Logistic regression of the label on a text's worst value (Platt), by Newton steps."""
    a, b = 2.0, 0.0
    y = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    x = np.column_stack([top, np.ones(len(top))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ [a, b], -30, 30)))
        g = x.T @ (p - y) + np.array([1e-3 * a, 0])
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return Machine(machine.index, machine.value, machine.intercept, float(max(a, 0.1)), float(b))


def train_toxicity(docs: DataFrame, labels: DataFrame, toxic: int = 1000, clean: int = 1600, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Machine | None:
    ship(docs.sparkSession)
    marks = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")).where(~held_out(4, 2, "id"))
    order = [F.xxhash64("id"), F.col("id")]
    ids = marks.where("y = 1").orderBy(*order).limit(toxic).union(marks.where("y = 0").orderBy(*order).limit(clean))
    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = named.join(F.broadcast(ids), "id").toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    return fit_toxicity(rows.column("text"), rows.column("y").to_numpy() == 1) if rows.num_rows else None


def score_toxicity(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document: one scan, no shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        K.tame_memory()
        table = machine.table() if machine is not None else None
        for batch in batches:
            data, offsets = K.buffers(batch.column(2))
            parts = [np.zeros(0)]
            for i, j in K.doc_slices(offsets, 1 << 20):
                parts.append(machine.texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], table) if machine is not None else np.zeros(j - i))
            score = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(4, 2, id_column).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
