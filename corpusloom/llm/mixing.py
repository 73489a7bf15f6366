"""Mixing sources to target weights by capped water-filling; DataFrame operations only.

Every source has a weight; sources share the total in proportion, but none takes more than
``max_epochs`` times its own size. What a clamped source leaves is shared again by weight, until no
source is above its cap. A target of r whole sizes and a fraction is met by taking every document r
times, and once more those documents that come first in a seeded order, as long as they fit. One more
document fills the rest where that brings the source nearer to its target.

The seeded order is cut into 4096 x 4096 hash buckets, whose sizes are summed first, so that a source
with a third of all rows is never sorted in one task: only the bucket at the edge is.

Defined cases: a null source is a source of its own, the last; a null or empty text has size 0 and is
taken 0 words; rows with equal ids are taken or left together; a source of size 0 has target 0; an
empty table gives an empty result; extra columns are ignored by :func:`mix_plan` and kept by :func:`mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

SALTS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: str, id_column: str, text: Column) -> Column:
    """Hex digits that order documents at random; a document without id is ordered by its text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.md5(F.coalesce(text, F.lit("")))))) 


def source_key(source: Column) -> Column:
    """A never-null text that sorts as sources do: by code point, null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string")))


def water_fill(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``k, source_size`` -> also ``target``. One row per source, so the windows here are small.

    Sources clamp in the order of size over weight. With the first m clamped, the level is what is left
    over the weights left; the level holds from the first m where the next source isn't above its cap.
    """
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    one = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(one.orderBy("k")) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    order = one.orderBy((F.col("cap").cast("double") / F.col("w")).asc(), F.col("k"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(one))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("w").over(one) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("rank", F.row_number().over(order))
    )
    # cap >= w * left / weight_left, in whole numbers
    fits = F.col("cap").cast("decimal(38,0)") * F.col("weight_left") >= F.col("w").cast("decimal(38,0)") * F.col("left")
    ranked = ranked.withColumn("edge", F.min(F.when(fits, F.struct("rank", "left", "weight_left"))).over(one))
    share = (F.col("w") * F.col("edge.left")).cast("double") / F.col("edge.weight_left")
    target = F.when(F.col("edge").isNull() | (F.col("rank") < F.col("edge.rank")), F.col("cap").cast("double")).otherwise(share)
    return ranked.select("k", "source_size", target.alias("target"))


def _prefix(rows: DataFrame, by: Sequence[str], need: DataFrame) -> DataFrame:
    """For each source: the first bucket whose running total exceeds ``need``, and the total before it."""
    running = F.sum("size").over(Window.partitionBy("k").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    summed = rows.groupBy("k", *by).agg(F.sum("size").alias("size")).join(need, "k").withColumn("to", running + F.col("have"))
    over = summed.where(F.col("to") > F.col("need")).groupBy("k").agg(F.min(F.struct(*by, (F.col("to") - F.col("size")).alias("before"))).alias("edge"))
    return over.select("k", *[F.col(f"edge.{b}") for b in by], F.col("edge.before").alias("have"))


def _facts(docs: DataFrame, weights, max_epochs, seed, id_column, text_column, source_column) -> tuple[DataFrame, DataFrame]:
    text = F.col(text_column).cast("string")
    narrow = docs.select(source_key(F.col(source_column)).alias("k"), word_count(text).alias("size"), order_key(seed, id_column, text).alias("h"))
    narrow = materialise(narrow.groupBy("k", "h").agg(F.sum("size").alias("size")), "mix")  # a unit: rows of equal id
    sources = water_fill(narrow.groupBy("k").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = materialise(sources, "mix-sources")
    rows = narrow.withColumn("b1", F.substring("h", 1, 3)).withColumn("b2", F.substring("h", 4, 3))
    need = sources.select("k", "need", F.lit(0).cast("long").alias("have"))
    first = _prefix(rows, ["b1"], need)
    edge1 = first.join(sources.select("k", "need"), "k")
    second = _prefix(rows.join(first.select("k", "b1"), ["k", "b1"]), ["b2"], edge1.select("k", "need", "have"))
    edge2 = second.join(edge1.select("k", "b1", "need"), "k")
    last = rows.join(edge2.select("k", "b1", "b2"), ["k", "b1", "b2"])
    third = _prefix(last, ["h"], edge2.select("k", "need", "have"))
    # h of the first unit that no longer fits, and the words taken before it
    edge = materialise(third.withColumnRenamed("h", "stop").join(sources, "k", "right"), "mix-edges")
    rest = rows.join(edge.select("k", "stop", (F.col("need") - F.col("have")).alias("gap")), "k").where(
        (F.col("h") >= F.col("stop")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap"))
    )
    filler = rest.groupBy("k").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "h")).alias("f")).select("k", F.col("f.h").alias("filler"))
    return edge.join(filler, "k", "left"), narrow


def _decide(docs: DataFrame, weights, max_epochs, seed, id_column, text_column, source_column) -> DataFrame:
    """``_row`` (a row of docs), ``_size, _source_size, _target, _times``. The join is salted: a source may be hot."""
    facts, _ = _facts(docs, weights, max_epochs, seed, id_column, text_column, source_column)
    text = F.col(text_column).cast("string")
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("k", "_k")
    salted = materialise(salted.select("_k", "_salt", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("whole").alias("_whole"), F.col("stop").alias("_stop"), F.col("filler").alias("_filler")), "mix-facts")  # so that the planner knows its size: small, it is broadcast
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), source_key(F.col(source_column)).alias("_k"), word_count(text).alias("_size"), order_key(seed, id_column, text).alias("_h"))
    keyed = keyed.withColumn("_salt", F.pmod(F.crc32("_h"), F.lit(SALTS)).cast("int"))
    joined = keyed.join(salted, ["_k", "_salt"])
    extra = F.when(F.col("_stop").isNotNull() & ((F.col("_h") < F.col("_stop")) | F.coalesce(F.col("_h") == F.col("_filler"), F.lit(False))), 1).otherwise(0)
    return joined.withColumn("_times", F.col("_whole") + extra)


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Per document: its size, its source's size and target in words, and the words the mix takes of it."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(source_column).alias("source"))
    out = _decide(narrow, weights, max_epochs, seed, "doc_id", "text", "source")
    return out.select("_row.doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_times") * F.col("_size")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mixed documents: each row as many times as the mix takes it, with its own columns."""
    out = _decide(docs, weights, max_epochs, seed, id_column, text_column, source_column)
    copies = out.where(F.col("_times") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return copies.select("_row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS h
  FROM documents),
units AS (SELECT k, h, sum(size)::BIGINT AS size FROM sized GROUP BY k, h),
src AS (SELECT k, sum(size)::BIGINT AS source_size FROM units GROUP BY k),
weighted AS (SELECT *, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM src),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, k) AS rk,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wlft
  FROM weighted),
edge AS (SELECT rk, lft, wlft FROM ranked WHERE cap * wlft >= w * lft ORDER BY rk LIMIT 1),
targets AS (
  SELECT r.k, r.source_size, CASE WHEN e.rk IS NULL OR r.rk < e.rk THEN r.cap::DOUBLE ELSE (r.w * e.lft)::DOUBLE / e.wlft END AS target
  FROM ranked r LEFT JOIN edge e ON true),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
needs AS (SELECT *, target - whole * source_size AS need FROM plan),
cum AS (SELECT u.*, n.need, sum(u.size) OVER (PARTITION BY u.k ORDER BY u.h) AS upto FROM units u JOIN needs n USING (k)),
stops AS (SELECT k, min(h) AS stop FROM cum WHERE upto > need GROUP BY k),
gaps AS (SELECT c.k, any_value(c.need) - coalesce(sum(c.size) FILTER (WHERE c.h < s.stop), 0) AS gap FROM cum c JOIN stops s USING (k) GROUP BY c.k),
fill AS (
  SELECT k, h AS filler FROM (
    SELECT u.k, u.h, row_number() OVER (PARTITION BY u.k ORDER BY abs(u.size - g.gap), u.h) AS rn
    FROM units u JOIN stops s USING (k) JOIN gaps g USING (k) WHERE u.h >= s.stop AND u.size > 0 AND u.size < 2 * g.gap) WHERE rn = 1)
SELECT d.doc_id, d.size, n.source_size::BIGINT AS source_size, n.target,
  (d.size * (n.whole + CASE WHEN s.stop IS NOT NULL AND (d.h < s.stop OR coalesce(d.h = f.filler, false)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN needs n USING (k) LEFT JOIN stops s USING (k) LEFT JOIN fill f USING (k)
"""
