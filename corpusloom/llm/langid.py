"""Language identification of words by a linear-chain conditional random field.

Each line is a chain of words. A word's emission scores sum learned weights of its hashed features: the
word itself (lexicon), prefixes and suffixes of 1 to 3 bytes, and 1- to 4-grams. Transitions are learned,
too, from lines of one language and from spliced lines in which the language changes, so code-switched
text is labelled word by word. Forward-backward gives each word's posterior over languages; a text's
language has the largest sum of posteriors, and its share of that sum is the score.

Learning uses at most ``per_language`` texts of each language, those of smallest id hash, on the driver;
labelling reads every whole text. A line of more than ``CHAIN`` words is labelled as several chains.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any training text
every prediction is ``und``; a null id counts as held out; repeated rows are labelled alike; an empty table
gives an empty result; extra columns are ignored.
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

BUCKETS = 1 << 17
CHAIN = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and feature buckets of words, sorted by word."""
    data = _LOWER[data]
    prefix = K.Prefix(K.byte_units(data))
    n = len(start)
    size = end - start
    every = np.arange(n)
    words, keys = [every], [prefix.slices(start, end)]
    for k in (1, 2, 3):
        w = np.flatnonzero(size > k)
        words += [w, w]
        keys += [prefix.slices(start[w], start[w] + k) ^ np.uint64(0x11 + k), prefix.slices(end[w] - k, end[w]) ^ np.uint64(0x21 + k)]
    for k in (1, 2, 3, 4):
        many = np.maximum(size - k + 1, 0)
        at = K.ranges(start, many)
        words.append(np.repeat(every, many))
        keys.append(prefix.slices(at, at + k) ^ np.uint64(0x31 + k))
    word, key = np.concatenate(words), np.concatenate(keys)
    order = np.argsort(word, kind="stable")
    return word[order], (K.mix(key[order]) >> np.uint64(47)).astype(np.int64)


def sliced_features(data, start, end, step: int = 1 << 15):
    """Feature buckets of words and each word's offset in them, some words at a time."""
    keys, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for s in range(0, len(start), step):
        word, key = word_features(data, start[s : s + step], end[s : s + step])
        keys.append(key.astype(np.int32))
        counts.append(np.bincount(word, minlength=min(step, len(start) - s)))
    return np.concatenate(keys), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def chains(data, start, end, docs, offsets) -> np.ndarray:
    """Start of each chain in the list of words: a new document, a new line, or CHAIN words."""
    n = len(start)
    breaks = np.zeros(n + 1, bool)
    line = np.searchsorted(np.flatnonzero(data == 10), start)
    breaks[1:n] = line[1:] != line[:-1]
    breaks[docs] = True
    heads = np.flatnonzero(breaks[:n])
    length = np.diff(np.append(heads, n))
    pieces = -(-length // CHAIN)
    return K.ranges(np.zeros(len(heads), np.int64), pieces) * CHAIN + np.repeat(heads, pieces)


def posteriors(emission: np.ndarray, heads: np.ndarray, transition: np.ndarray, initial: np.ndarray, pairs: bool = False):
    """Forward-backward over all chains in step, chains of similar length together. ``emission`` is in logs.

    Returns each word's posteriors and, on request, the summed posteriors of neighbouring label pairs,
    the initial ones and the log-likelihood's normaliser.
    """
    n, m = emission.shape
    out = np.empty_like(emission)
    peak = emission.max(1, keepdims=True)
    e = np.exp(emission - peak)
    a, first = np.exp(transition), np.exp(initial)
    length = np.diff(np.append(heads, n))
    order = np.argsort(-length, kind="stable")
    heads, length = heads[order], length[order]
    edges, counts = np.zeros((m, m)), np.zeros(m)
    log_z = float(peak.sum())
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), "left")  # chains longer than t
    alpha, scale = [], []
    for t in range(longest):
        k = alive[t]
        x = first * e[heads[:k]] if t == 0 else (alpha[-1][:k] @ a) * e[heads[:k] + t]
        s = x.sum(1, keepdims=True)
        alpha.append(x / s)
        scale.append(s)
        log_z += float(np.log(s).sum())
    beta = None
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        b = np.ones((k, m), emission.dtype)
        if beta is not None:
            step = e[heads[: len(beta)] + t + 1] * beta / scale[t + 1]
            if pairs:
                edges += a * (alpha[t][: len(beta)].T @ step)
            b[: len(beta)] = step @ a.T
        g = alpha[t] * b
        out[heads[:k] + t] = g / g.sum(1, keepdims=True)
        beta = b
    if pairs:
        counts = out[heads].sum(0)
    return (out, edges, counts, log_z) if pairs else out


@dataclass(frozen=True)
class Tagger:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages
    transition: np.ndarray
    initial: np.ndarray

    def emissions(self, data, start, end) -> np.ndarray:
        word, key = word_features(data, start, end)
        heads = np.searchsorted(word, np.arange(len(start)))
        return np.add.reduceat(self.weights[key], heads, axis=0) if len(start) else np.zeros((0, len(self.languages)), np.float32)

    def tag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of every word, and the words' offsets by document. Distinct words are scored once."""
        start, end, docs = K.words(data, offsets)
        if not len(start):
            return np.zeros((0, len(self.languages)), np.float32), docs
        _, first, inverse = np.unique(K.word_hashes(_LOWER[data], start, end), return_index=True, return_inverse=True)
        emission = self.emissions(data, start[first], end[first])[inverse]
        return posteriors(emission, chains(data, start, end, docs, offsets), self.transition, self.initial), docs

    def texts(self, data, offsets) -> tuple[np.ndarray, np.ndarray]:
        """Language number and score of each text; -1 where the text has no letter."""
        n = len(offsets) - 1
        best, score = np.full(n, -1), np.zeros(n)
        p, docs = self.tag(data, offsets)
        full = np.flatnonzero(np.diff(docs))
        if len(full):
            total = np.add.reduceat(p.astype(np.float64), docs[:-1][full], axis=0)
            best[full] = total.argmax(1)
            score[full] = total.max(1) / total.sum(1)
        sure = np.concatenate([[0], np.cumsum(_ALPHA[data])])
        for d in full[sure[offsets[1:][full]] == sure[offsets[:-1][full]]]:
            if not any(c.isalpha() for c in data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")):
                best[d], score[d] = -1, 0.0
        return best, score


def fit_tagger(texts, languages: list[str], steps: int = 240, batch_words: int = 6000, rate: float = 0.05, seed: int = 2) -> Tagger | None:
    """Stochastic gradient training of all weights jointly, on whole and on spliced lines."""
    names = tuple(sorted(set(languages)))
    if not names:
        return None
    m = len(names)
    data, offsets = K.buffers(texts)
    start, end, docs = K.words(data, offsets)
    if not len(start):
        return None
    label = np.repeat(np.searchsorted(names, languages).astype(np.int16), np.diff(docs))
    heads = chains(data, start, end, docs, offsets)
    length = np.diff(np.append(heads, len(start)))
    _, first, uid = np.unique(K.word_hashes(_LOWER[data], start, end), return_index=True, return_inverse=True)
    key, at = sliced_features(data, start[first], end[first])
    uid = uid.astype(np.int32)
    del data, start, end, first
    K.tame_memory()
    rng = np.random.default_rng(seed)
    w = np.zeros((BUCKETS, m), np.float32)
    square = np.full(BUCKETS, 1e-2, np.float32)
    trans, init = np.zeros((m, m)), np.zeros(m)
    t2, i2 = np.full((m, m), 1e-2), np.full(m, 1e-2)
    each = max(1, int(batch_words / max(1.0, length.mean())))
    for _ in range(steps):
        pick = rng.integers(0, len(heads), each)
        # half of the lines are spliced: the second half of another line follows the first half
        other = rng.integers(0, len(heads), each)
        splice = rng.random(each) < 0.4
        one = np.where(splice, (length[pick] + 1) // 2, length[pick])
        two = np.where(splice, length[other] // 2, 0)
        parts_start = np.stack([heads[pick], heads[other] + length[other] - two], 1).reshape(-1)
        parts_len = np.stack([one, two], 1).reshape(-1)
        row = K.ranges(parts_start, parts_len)
        chain = np.concatenate([[0], np.cumsum(one + two)])[:-1]
        y = label[row].astype(np.int64)
        ids, inverse = np.unique(uid[row], return_inverse=True)
        many = at[ids + 1] - at[ids]
        feats = key[K.ranges(at[ids], many)]
        owner = np.repeat(np.arange(len(ids)), many)
        emission = np.add.reduceat(w[feats], np.concatenate([[0], np.cumsum(many)[:-1]]), axis=0)[inverse]
        p, edges, firsts, _ = posteriors(emission.astype(np.float64), chain, trans, init, pairs=True)
        g = p.copy()
        g[np.arange(len(y)), y] -= 1
        per_word = np.stack([np.bincount(inverse, weights=g[:, c], minlength=len(ids)) for c in range(m)], 1)
        used, slot = np.unique(feats, return_inverse=True)
        grad = np.stack([np.bincount(slot, weights=per_word[owner, c], minlength=len(used)) for c in range(m)], 1) / len(y) * 50
        square[used] += (grad**2).mean(1)
        w[used] -= rate * grad / np.sqrt(square[used])[:, None]
        inner = np.ones(len(y), bool)
        inner[chain] = False
        gold = np.bincount(y[np.flatnonzero(inner) - 1] * m + y[inner], minlength=m * m).reshape(m, m)
        g_t, g_i = (edges - gold) / len(y) * 20, (firsts - np.bincount(y[chain], minlength=m)) / len(chain)
        t2 += g_t**2
        i2 += g_i**2
        trans -= rate * 2 * g_t / np.sqrt(t2)
        init -= rate * g_i / np.sqrt(i2)
    return Tagger(names, w, trans.astype(np.float32), init.astype(np.float32))


def train_tagger(docs: DataFrame, per_language: int = 300, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> Tagger | None:
    ship(docs.sparkSession)
    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"), F.col(language_column).cast("string").alias("lang"))
    named = named.where("id is not null and text is not null and lang is not null").where(~held_out(3, 1, "id"))
    # the ids first, from narrow columns; as many rows as languages times per_language
    pairs = named.select("lang", "id").distinct()
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    ids = pairs.withColumn("r", rank).where(F.col("r") <= per_language).select("lang", "id")
    rows = named.join(F.broadcast(ids), ["lang", "id"]).select("id", "lang", "text").toArrow().sort_by([("id", "ascending"), ("lang", "ascending"), ("text", "ascending")])
    return fit_tagger(rows.column("text"), rows.column("lang").to_pylist()) if rows.num_rows else None


def label_language(docs: DataFrame, tagger: Tagger | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document: one scan, no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # its size is fixed by BUCKETS and the languages

    def run(batches):
        K.tame_memory()
        model = shared.value
        names = np.array([*(model.languages if model else ()), "und"], object)
        for batch in batches:
            data, offsets = K.buffers(batch.column(2))
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for i, j in K.doc_slices(offsets, 1 << 20):
                b, s = model.texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) if model else (np.full(j - i, -1), np.zeros(j - i))
                best.append(b)
                score.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score))], ["doc_id", "held_out", "lang_pred", "score"])

    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(3, 1, id_column).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
