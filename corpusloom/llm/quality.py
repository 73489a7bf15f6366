"""Quality classifier by positive-unlabelled learning (non-negative unbiased risk).

The model never sees a labelled bad document as a negative. It learns from trusted positives (label 1),
from web text as it comes, whose labels aren't looked at, and from the class prior, estimated as the share of label 1 among labelled
training rows. The unbiased risk of an unlabelled set, R = pi R_P+ + R_U- - pi R_P-, may fall below zero when a
flexible model overfits; the non-negative form clips the part that estimates the negatives' risk and,
where it is clipped, ascends on it.

Inputs of a score are style features of the whole text: shares of character classes, class bigrams,
repetition of words and lines. The network has one hidden layer and is fitted on the driver from at
most ``positives`` + ``unlabelled`` feature rows, those of smallest id hash; that bound is a parameter.

Defined cases: a null or empty text gets features of an empty text and a score like any other; labels
repeated for an id count as their minimum, null labels as none; without a positive every score is 0.5; repeated rows are scored alike; a null id counts as held out; an empty table
gives an empty result; extra columns are ignored by :func:`score_quality` and kept by :func:`keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import ship
from . import kernels as K
from .common import held_out

# character classes: lower, upper, digit, space, newline, other UTF-8 bytes, . and , and then rarer signs
_CLASS = np.full(256, 8, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 32]], _CLASS[[10, 13]], _CLASS[128:] = 3, 4, 5
_CLASS[[44, 46]], _CLASS[[33, 63]] = 6, 7
_CLASS[[124, 60, 62, 123, 125, 91, 93, 92]] = 9
N_CLASS = 10
N_FEATURES = N_CLASS + N_CLASS * N_CLASS + 9


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of float32 features per document."""
    n = len(offsets) - 1
    sizes = np.maximum(np.diff(offsets), 1).astype(float)
    cls = _CLASS[data]
    # two-byte capitals (À to Þ, Ç, Ñ, ...) are upper case, too
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        cls[:-1][capital] = 1
        cls[1:][capital] = 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    single = np.bincount(doc * N_CLASS + cls, minlength=n * N_CLASS).reshape(n, N_CLASS)
    pair = np.zeros(0, np.int64)
    if len(data) > 1:
        inside = doc[1:] == doc[:-1]
        pair = (doc[:-1] * N_CLASS * N_CLASS + cls[:-1] * N_CLASS + cls[1:])[inside]
    double = np.bincount(pair, minlength=n * N_CLASS * N_CLASS).reshape(n, -1)
    start, end, docs = K.words(data, offsets)
    h = K.word_hashes(data, start, end)
    count = np.diff(docs)
    words = np.maximum(count, 1).astype(float)
    owner = np.repeat(np.arange(n), count)
    same = np.zeros(n)
    if len(h) > 1:
        same = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    order = np.lexsort((h, owner))
    fresh = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])]) if len(h) else np.zeros(0, bool)
    distinct = np.bincount(owner[order][fresh], minlength=n)
    lines, line_doc = _lines(data, offsets)
    line_order = np.lexsort((lines, line_doc))
    l_fresh = np.concatenate([[True], (lines[line_order][1:] != lines[line_order][:-1]) | (line_doc[line_order][1:] != line_doc[line_order][:-1])]) if len(lines) else np.zeros(0, bool)
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    long_words = np.bincount(owner[(end - start) > 12], minlength=n)
    extra = [
        np.log1p(count) / 8,
        np.log1p(sizes) / 10,
        np.bincount(owner, weights=end - start, minlength=n) / words / 8,
        same / words,
        distinct / np.maximum(words, 1),
        np.minimum(distinct / np.sqrt(words), 20) / 10,
        np.bincount(line_doc[line_order][l_fresh], minlength=n) / n_lines,
        np.log1p(sizes / n_lines) / 6,
        long_words / words,
    ]
    return np.column_stack([single / sizes[:, None], double / sizes[:, None], *extra]).astype(np.float32)


def _lines(data, offsets):
    """Fingerprint and document of every non-empty line."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    s, e = edges[:-1], edges[1:]
    keep = e - s > 1
    s, e = s[keep], e[keep]
    return K.Prefix(K.byte_units(data)).slices(s, e), np.searchsorted(offsets, s, "right") - 1


SLICE = 1 << 20


def featurise(column) -> np.ndarray:
    data, offsets = K.buffers(column)
    parts = [features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in K.doc_slices(offsets, SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float32)


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, starts: int = 6, seed: int = 11) -> Network:
    """The network of least non-negative risk of several random starts, with its boundary set."""
    found = [_fit_once(positive, unlabelled, prior, seed=seed + i) for i in range(starts)]
    best = min(found, key=lambda n: risk(n.score(positive), n.score(unlabelled), prior))
    return replace(best, b2=best.b2 - _boundary(best.margin(positive), best.margin(unlabelled), prior))


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The non-negative risk of scores with the sigmoid loss."""
    return float(prior * (1 - positive).mean() + max(0.0, unlabelled.mean() - prior * positive.mean()))


def gradient(p: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float, decay: float = 1e-4) -> tuple[float, list[np.ndarray]]:
    """The part of the risk that a step descends on, and its gradient by the network's four parameters.

    That part is pi R_P+ + (R_U- - pi R_P-) while the bracket, the negatives' risk, isn't below zero, and else
    minus the bracket: the step ascends on it. Both with the parameters' decay.
    """
    x = np.concatenate([positive, unlabelled])
    hid = np.tanh(x @ p[0] + p[1])
    s = 1 / (1 + np.exp(-np.clip(hid @ p[2] + p[3][0], -30, 30)))
    sp, su = s[: len(positive)], s[len(positive) :]
    negative = su.mean() - prior * sp.mean()
    plus = np.concatenate([-prior * sp * (1 - sp) / len(sp), np.zeros(len(su))])  # d(pi R_P+)/dz
    minus = np.concatenate([-prior * sp * (1 - sp) / len(sp), su * (1 - su) / len(su)])  # d(R_U- - pi R_P-)/dz
    grad = plus + minus if negative >= 0 else -minus
    value = prior * (1 - sp).mean() + negative if negative >= 0 else -negative
    back = grad[:, None] * p[2] * (1 - hid**2)
    value += decay / 2 * float((p[0] ** 2).sum() + (p[2] ** 2).sum())
    return float(value), [x.T @ back + decay * p[0], back.sum(0), hid.T @ grad + decay * p[2], np.array([grad.sum()])]


def _fit_once(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, epochs: int = 80, batch: int = 1024, rate: float = 0.01, seed: int = 11) -> Network:
    """Minimise the non-negative risk with Adam and the sigmoid loss, whose bound keeps the clipping from noise."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
    xp, xu = (np.clip((x - mean) / scale, -8, 8).astype(float) for x in (positive, unlabelled))
    p = [rng.standard_normal((xp.shape[1], hidden)) / xp.shape[1] ** 0.5, np.zeros(hidden), rng.standard_normal(hidden) / hidden**0.5, np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    steps = max(1, max(len(xp), len(xu)) // batch)
    for epoch in range(epochs):
        lr = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for _ in range(steps):
            bp, bu = xp[rng.integers(0, len(xp), min(batch, len(xp)))], xu[rng.integers(0, len(xu), min(batch, len(xu)))]
            g = gradient(p, bp, bu, prior)[1]
            t += 1
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                p[i] = p[i] - lr * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))


def _boundary(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """Where to cut the margins. Clipping leaves the risk flat between the classes, so its zero may be off.

    Between the lower edge of the trusted positives (0.1 %), and nearer to it, and the upper edge of the unlabelled
    negatives, of whom the prior tells the number; fewer of them are trusted where the edges overlap. At
    last, the cut that rejects the negatives' share, but never a percent of the trusted positives.
    """
    low = np.quantile(positive, 0.001)
    for part in (0.97, 0.9, 0.8, 0.6):
        high = np.quantile(unlabelled, part * (1 - prior))
        if high < low:
            return float(0.35 * high + 0.65 * low)
    return float(min(np.quantile(unlabelled, 1 - prior), np.quantile(positive, 0.01)))


def _sampled_features(docs: DataFrame, ids: DataFrame, id_column: str, text_column: str) -> np.ndarray:
    """Features of the rows whose ids are given; at most a bounded number of ids, so they are broadcast."""

    def run(batches):
        K.tame_memory()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(featurise(batch.column(1))), pa.list_(pa.float32()))], ["id", "f"])

    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = named.join(F.broadcast(ids), "id").mapInArrow(run, "id long, f array<float>").toArrow()
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    values = rows.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, np.float32)
    return values.reshape(-1, N_FEATURES)[order]


def train_quality(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 12000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Network | None:
    ship(docs.sparkSession)
    order = [F.xxhash64("id"), F.col("id")]
    marks = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    train = marks.where(~held_out(3, 1, "id"))
    counts = train.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not counts[0] or not counts[1]:
        return None
    prior = min(max(counts[1] / counts[0], 0.05), 0.98)
    ids = docs.select(F.col(id_column).cast("long").alias("id")).where("id is not null").distinct()
    good = ids.join(train.where("y = 1"), "id", "left_semi").orderBy(*order).limit(positives)
    plain = ids.orderBy(*order).limit(unlabelled)  # the text as it comes: labels play no part
    rows = [_sampled_features(docs, x, id_column, text_column) for x in (good, plain)]
    if not len(rows[0]) or not len(rows[1]):
        return None
    return fit_nnpu(*rows, prior)


def score_quality(docs: DataFrame, model: Network | None, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document: one scan, no shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        K.tame_memory()
        for batch in batches:
            x = featurise(batch.column(2))
            score = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(3, 1, id_column).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Network | None, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of docs that the classifier accepts, unchanged: a filter in the scan's own stage."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_column)

    def run(batches):
        K.tame_memory()
        for batch in batches:
            if model is None:
                yield batch
            else:
                yield batch.filter(pa.array(model.score(featurise(batch.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
