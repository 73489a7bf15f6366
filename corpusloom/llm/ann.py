"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Vectors get one more component, sqrt(M^2 - |x|^2), and queries a zero, so that the largest inner product
is the smallest Euclidean distance. Each table hashes a vector to the cell floor((a_i x + b_i) / W) of
Gaussian projections, as many as leave about ``cell_rows`` rows in a cell. A query visits perturbed cells by
their estimated success, the chance that they hold a neighbour against the chance that they hold just any
row, down to a level that is fitted on a sample; all rows of visited cells are compared exactly. Cells are
enumerated by extending the best choices for the first projections, so the cost is that of the cells visited.

The fit (dimension, norm bound, projection scale, neighbour correlation, levels) uses at most ``sample``
vectors; every row is indexed. Large cells are split over salts that queries visit all, so a cell with a
third of all rows is spread over many tasks; no cell or candidate list is capped. A query that finds fewer
than ``neighbours`` rows is compared with all rows, in blocks.

Defined cases: vectors that are null, zero, hold null or non-finite components, or differ from the
sample's usual length take no part; a null id takes no part; equal scores go to the smaller id; rows of
equal id are one candidate if their vectors are equal, and no row is a neighbour of its own id; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import ship
from . import kernels as K
from .common import materialise

STEPS = np.arange(-2, 3)


@dataclass(frozen=True)
class Index:
    dim: int
    bound: float  # M
    planes: np.ndarray  # tables x bits x (dim + 1)
    shifts: np.ndarray  # tables x bits
    width: float
    spread: float  # standard deviation of projections
    rho: float  # correlation of a query's projection with a neighbour's
    least: int  # cell number of the first entry of ``prior``
    prior: np.ndarray  # tables x bits x cells: log share of the sample's rows
    level: float = -np.inf  # log success that a visited cell has at least
    floor: float = -np.inf  # log chance of a neighbour that a visited cell has at least

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """tables x rows x bits."""
        norm = np.linalg.norm(x, axis=1)
        if query:
            x = x * (self.bound / np.maximum(norm, 1e-300))[:, None]
            last = np.zeros(len(x))
        else:
            last = np.sqrt(np.maximum(self.bound**2 - norm**2, 0))
        return np.einsum("nd,tbd->tnb", np.column_stack([x, last]), self.planes)

    def places(self, x: np.ndarray) -> np.ndarray:
        """tables x rows x bits: the cell number of each vector in each projection."""
        return np.floor((self.project(x, False) + self.shifts[:, None]) / self.width).astype(np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """tables x rows: the cell of each vector."""
        places = self.places(x)
        name = np.zeros(places.shape[:2], np.uint64)
        for i in range(places.shape[2]):
            name = _extend(name, places[:, :, i], i)
        return name.view(np.int64)

    def chances(self, x: np.ndarray):
        """For the five cells around each query's likeliest, in each projection: number, log chance and log success."""
        mean = self.project(x, True) * self.rho
        deviation = self.spread * max(1e-4, 1 - self.rho**2) ** 0.5
        home = np.floor((mean + self.shifts[:, None]) / self.width).astype(np.int64)
        place = home[..., None] + STEPS
        low = place * self.width - self.shifts[:, None, :, None]
        chance = np.log(np.maximum(_normal((low + self.width - mean[..., None]) / deviation) - _normal((low - mean[..., None]) / deviation), 1e-12))
        t, b = np.ogrid[: len(self.planes), : self.planes.shape[1]]
        prior = self.prior[t[:, None, :, None], b[:, None, :, None], np.clip(place - self.least, 0, self.prior.shape[2] - 1)]
        return place, chance, chance - prior

    def visits(self, x: np.ndarray):
        """``query, table, cell`` of every cell that a query visits."""
        place, chance, success = self.chances(x)
        out = []
        for t in range(len(self.planes)):
            # the best that later projections can add
            rest = [np.cumsum(a[t].max(2)[:, ::-1], axis=1)[:, ::-1] for a in (chance, success)]
            who, name = np.arange(len(x)), np.zeros(len(x), np.uint64)
            c, s = np.zeros(len(x)), np.zeros(len(x))
            for i in range(place.shape[2]):
                c, s = c[:, None] + chance[t, who, i], s[:, None] + success[t, who, i]
                more = [r[who, i + 1, None] if i + 1 < place.shape[2] else 0 for r in rest]
                row, step = np.nonzero((c + more[0] >= self.floor) & (s + more[1] >= self.level))
                c, s = c[row, step], s[row, step]
                name, who = _extend(name[row], place[t, who[row], i, step], i), who[row]
            out.append((who, np.full(len(who), t), name.view(np.int64)))
        return tuple(np.concatenate(a) for a in zip(*out, strict=True))


def _extend(name: np.ndarray, place: np.ndarray, i: int) -> np.ndarray:
    return K.mix(name * np.uint64(31) + place.astype(np.uint64) + np.uint64(i + 1))


def _normal(z: np.ndarray) -> np.ndarray:
    """The standard normal distribution function (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / (2 * np.pi) ** 0.5 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, 1 - tail, tail)


def fit(vectors: list[list[float]], rows: int, neighbours: int = 20, tables: int = 2, recall: float = 0.94, seed: int = 7, cell_rows: int = 64) -> Index | None:
    """Fit on sampled vectors for a table of about ``rows`` rows."""
    lengths = np.array([len(v) for v in vectors])
    if not len(lengths) or not lengths.max():
        return None
    dim = int(np.bincount(lengths).argmax())
    x = np.array([v for v in vectors if len(v) == dim], float)
    bound = float(np.linalg.norm(x, axis=1).max())
    bits = max(3, round(np.log2(max(rows / cell_rows, 1)) / 1.3))  # a projection's cell tells some 1.3 bits
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((tables, bits, dim + 1))
    bare = Index(dim, bound, planes, np.zeros((tables, bits)), 1.0, 1.0, 0.5, 0, np.zeros((tables, bits, 1)))
    spread = float(bare.project(x, False).std()) or 1.0
    width = 2.5 * spread
    index = replace(bare, shifts=rng.uniform(0, width, (tables, bits)), width=width, spread=spread)
    places = index.places(x)
    least = int(places.min())
    counts = (places[..., None] == np.arange(least, places.max() + 1)).sum(1)
    index = replace(index, least=least, prior=np.log((counts + 0.5) / (len(x) + 1)))
    # a sample's nearest few stand for the nearest of all rows
    near = min(max(1, round(neighbours * len(x) / max(rows, 1))), len(x) - 1)
    if near < 1:
        return index
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    norm = np.linalg.norm(x, axis=1) * bound
    rho = float(np.clip(np.mean(np.take_along_axis(scores, best, 1) / norm[:, None]), 0.05, 0.999))
    index = replace(index, rho=rho)
    # log chance and log success of the cells in which the sample's true neighbours lie
    place, chance, success = index.chances(x)
    step = places[:, best] - place[:, :, None, :, 2] + 2  # tables x rows x near x bits
    away = ((step < 0) | (step >= len(STEPS))).any(3)
    step = np.clip(step, 0, len(STEPS) - 1)
    at = lambda a: np.where(away, -np.inf, np.take_along_axis(a[:, :, None], step[..., None], 4)[..., 0].sum(3))
    chance, success = at(chance), at(success)
    seen = chance.max(0)
    floor = float(np.quantile(seen, 0.01)) if np.isfinite(np.quantile(seen, 0.01)) else -np.inf
    level = float(np.quantile(np.where(chance >= floor, success, -np.inf).max(0), 1 - recall, method="lower"))
    return replace(index, level=level - 1e-9, floor=floor - 1e-9)


def _matrix(column, dim: int) -> np.ndarray:
    values = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


FOUND = "query_id long, vec_id long, score double"


def _best(qid, q, ids, x, pairs, k: int) -> pa.Table:
    """The k best rows of each query among ``pairs``: (numbers of queries, range of rows) to compare."""
    out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for who, s, e in pairs:
        for a in range(0, len(who), 512):
            for b in range(s, e, 4096):
                _keep(q, qid, who[a : a + 512], x[b : min(e, b + 4096)], ids[b : min(e, b + 4096)], k, out_q, out_v, out_s)
    who, vec, score = np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)
    order = np.lexsort((vec, -score, who))
    who, vec, score = who[order], vec[order], score[order]
    again = np.zeros(len(who), bool)
    again[1:] = (who[1:] == who[:-1]) & (vec[1:] == vec[:-1]) & (score[1:] == score[:-1])
    who, vec, score = who[~again], vec[~again], score[~again]
    heads = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, np.int64)
    top = np.arange(len(who)) - np.repeat(heads, np.diff(np.append(heads, len(who)))) < k
    return pa.table({"query_id": pa.array(qid[who[top]], pa.int64()), "vec_id": pa.array(vec[top], pa.int64()), "score": pa.array(score[top], pa.float64())})


def _keep(q, qid, w, x, ids, k, out_q, out_v, out_s):
    score = q[w] @ x.T
    score[qid[w][:, None] == ids[None, :]] = -np.inf
    least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if score.shape[1] > k else np.full(len(w), -np.inf)
    # the product's rounding depends on the block: what is within it of the k-th stays for the exact score
    least = np.where(np.isfinite(least), least - 1e-9 * np.abs(score, where=np.isfinite(score), out=np.zeros_like(score)).max(1, initial=0), least)
    i, j = np.nonzero((score >= least[:, None]) & (score > -np.inf))
    out_q.append(w[i])
    out_v.append(ids[j])
    out_s.append(np.einsum("nd,nd->n", q[w[i]], x[j]))  # one fixed order of summation, whatever the block


def _exact(part_rows: pa.Table, part_queries: pa.Table, dim: int, k: int) -> pa.Table:
    """The k best of a part's rows for each of its queries, among rows of cells that the query visits."""
    ids, cell = part_rows.column("vec_id").to_numpy(), part_rows.column("cell").to_numpy()
    x, q = _matrix(part_rows.column("v"), dim), _matrix(part_queries.column("v"), dim)
    order = np.argsort(cell, kind="stable")
    x, ids, cell = x[order], ids[order], cell[order]
    heads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    lists = part_queries.column("cells").combine_chunks()
    visit = lists.flatten().to_numpy(zero_copy_only=False)
    who = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
    by = np.argsort(visit, kind="stable")
    visit, who = visit[by], who[by]
    pairs = ((who[np.searchsorted(visit, cell[s], "left") : np.searchsorted(visit, cell[s], "right")], s, e) for s, e in zip(heads, np.append(heads[1:], len(ids)), strict=True))
    return _best(part_queries.column("query_id").to_numpy(), q, ids, x, pairs, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; tables and parts may find a row twice. Ranks are cut before they are shuffled."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, query_modulus: int = 20, neighbours: int = 20, tables: int = 2, recall: float = 0.94, sample: int = 2000, seed: int = 7, id_column: str = "vec_id", vector_column: str = "embedding", rows_each: int = 8192, cell_rows: int = 64) -> DataFrame:
    """For every row whose id divides by ``query_modulus``, its nearest other rows: ``query_id, rank, vec_id, score``."""
    spark = ship(vectors.sparkSession)
    v = F.col("v")
    kind = "array<float>" if dict(vectors.dtypes)[vector_column] == "array<float>" else "array<double>"
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(kind).alias("v")).where(F.col("vec_id").isNotNull() & good)
    count = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    index = fit([r[0] for r in picked], count, neighbours, tables, recall, seed, cell_rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == index.dim)
    dim, parts = index.dim, max(4, -(-count * tables // rows_each))

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                found = index.cells(_matrix(batch.column(1), dim))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(found.T.reshape(-1)), found.shape[0]).cast(pa.list_(pa.int64()))], ["vec_id", "v", "cells"])

    def visits(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                part = batch.slice(s, 64)
                who, table, cell = index.visits(_matrix(part.column(1), dim))
                yield pa.RecordBatch.from_arrays([part.column(2).take(pa.array(who)), pa.array(table, pa.int32()), pa.array(cell)], ["query", "t", "cell"])

    indexed = rows.mapInArrow(cells, f"vec_id long, v {kind}, cells array<long>").select("vec_id", "v", F.posexplode("cells").alias("t", "cell"))
    sizes = indexed.groupBy("t", "cell").agg(F.ceil(F.count(F.lit(1)) / (rows_each // 4)).cast("int").alias("salts"))
    part = F.pmod(F.xxhash64("t", "cell", "salt"), F.lit(parts)).cast("int")
    placed = indexed.join(sizes, ["t", "cell"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")).select(part.alias("part"), "vec_id", "v", F.xxhash64("t", "cell").alias("cell"))
    asked = rows.where(F.col("vec_id") % query_modulus == 0).dropDuplicates(["vec_id", "v"]).withColumn("query", F.xxhash64("vec_id", "v"))
    # cells that hold rows, by part; the query's vector joins once a part, not once a cell
    visited = asked.mapInArrow(visits, "query long, t int, cell long").join(sizes, ["t", "cell"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    visited = visited.select(part.alias("part"), "query", F.xxhash64("t", "cell").alias("cell")).groupBy("part", "query").agg(F.collect_set("cell").alias("cells"))
    visited = visited.join(asked.select("query", F.col("vec_id").alias("query_id"), "v"), "query").select("part", "query_id", "v", "cells")
    exact = lambda left, right: _exact(left, right, dim, neighbours)
    best = _ranked(placed.groupBy("part").cogroup(visited.groupBy("part")).applyInArrow(exact, FOUND), neighbours)
    best = materialise(best, "ann-best")
    full = best.where(F.col("rank") == neighbours).select(F.col("query_id").alias("vec_id"))
    short = materialise(asked.join(full, "vec_id", "left_anti").select(F.col("vec_id").alias("query_id"), "v"), "ann-short")
    if not short.limit(1).count():
        return best
    again = short.select("query_id", "v", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    blocks = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), "vec_id", "v")
    whole = lambda left, right: _best(right.column("query_id").to_numpy(), _matrix(right.column("v"), dim), left.column("vec_id").to_numpy(), _matrix(left.column("v"), dim), [(np.arange(right.num_rows), 0, left.num_rows)], neighbours)
    rest = _ranked(blocks.groupBy("part").cogroup(again.groupBy("part")).applyInArrow(whole, FOUND), neighbours)
    return best.join(short.select("query_id").distinct(), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").unionByName(rest)
