"""Frequency tables, distributions and statistics, each in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_default


def most_common(rows: DataFrame, key: Column, order: str = "ord") -> DataFrame:
    """``key, n, first_ord``; sort by n descending, then first_ord, for the usual table."""
    return rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_ord"))


def distributions(rows: DataFrame, fields: Sequence[str], empty: str = "N/A", by: Sequence[str] = (), order: str = "ord") -> DataFrame:
    """``field, key, n, first_ord`` for several fields in one pass: each row is spread over its fields.

    The spread rows are pre-aggregated before the shuffle, so what moves is fields x values a task.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), or_default(F.col(f), empty).alias("key")) for f in fields])
    spread = rows.select(*by, order, F.explode(pairs).alias("p")).select(*by, order, "p.field", "p.key")
    return spread.groupBy(*by, "field", "key").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_ord"))


def top_of(rows: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    """The ``limit`` largest n of each group, ties by first appearance, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("first_ord")))
    return rows.withColumn("rank", rank).where(F.col("rank") <= limit)


def length_stats(rows: DataFrame, length: str) -> DataFrame:
    """``n, min_len, median_len, avg_len, p95_len, max_len``; the upper median and p95 without interpolation.

    Lengths are counted by value first, so the ordered step sees distinct values, not rows.
    """
    counted = rows.groupBy(F.col(length).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    running = counted.withColumn("upto", F.sum("c").over(Window.orderBy("v")))
    total = F.sum("c").over(Window.partitionBy())
    whole = running.withColumn("total", total)
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col("v")))
    p95 = F.least(F.col("total") - 1, F.floor(F.col("total") * 0.95))
    return whole.agg(F.max("total").alias("n"), F.min("v").alias("min_len"), at(F.floor(F.col("total") / 2)).alias("median_len"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("avg_len"), at(p95).alias("p95_len"), F.max("v").alias("max_len"))


def top_with_other(counts: DataFrame, top: int = 12, other: str = "other") -> DataFrame:
    """``key, n, percent``: the largest ``top`` keys and the rest as one. ``counts`` has key, n, first_ord."""
    first = counts.orderBy(F.desc("n"), F.asc("first_ord")).limit(top).select("key", "n")
    total = counts.agg(F.sum("n").alias("total"))
    rest = total.crossJoin(first.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("head"))).select(F.lit(other).alias("key"), (F.col("total") - F.col("head")).alias("n")).where("n > 0")  # one row by one row
    both = first.unionByName(rest)
    return both.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def documents_by_chunks(chunks: DataFrame, limit: int = 30) -> DataFrame:
    """Documents with the most chunks, with their last title and URL."""
    grouped = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"), F.max_by("title", "ord").alias("title"), F.max_by("url", "ord").alias("url"))
    return grouped.orderBy(F.desc("n"), F.asc("first_ord")).limit(limit)


def filter_stats(decided: DataFrame) -> DataFrame:
    """``section, key, n`` of a decided table: removals by reason, kept and removed totals, kept by field.

    One pass: a row is spread over what it counts towards; distinct values are counted once each.
    """
    kept = F.col("filter_decision") == "kept"
    none = F.lit(None).cast("string")

    def entry(section, key, value=none):
        return F.struct(F.lit(section).alias("section"), (F.lit(key) if isinstance(key, str) else key).alias("key"), value.alias("value"))

    why = F.coalesce("reasons", F.array().cast("array<string>"))
    final = [entry("totals", "final_records"), *[entry(f"final_by_{c}", F.coalesce(F.col(c), F.lit("None"))) for c in ("level_1", "source_priority", "crawl_type")]]
    uniques = {"unique_urls_final": F.col("effective_url"), "unique_content_hashes_final": F.col("effective_content_hash")}
    final += [F.when(v.isNotNull(), entry("totals", k, v)) for k, v in uniques.items()]
    entries = F.concat(
        F.array(entry("totals", "input_records")), F.when(kept, F.array(*final)).otherwise(F.filter(F.array(entry("", "")), lambda x: F.lit(False))),
        F.transform(why, lambda r: entry("removed_by_reason", r)), F.transform(why, lambda r: entry("totals", "removed_records")),
    )
    spread = decided.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("x")).groupBy("x.section", "x.key", "x.value").agg(F.count(F.lit(1)).alias("n"))
    spread = spread.select("section", "key", F.when(F.col("value").isNull(), F.col("n")).otherwise(1).alias("n"))
    names = ["input_records", "final_records", "removed_records", *uniques]
    zero = decided.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k) for k in names])).alias("key")).select(F.lit("totals").alias("section"), "key", F.lit(0).cast("long").alias("n"))
    return spread.unionByName(zero).groupBy("section", "key").agg(F.sum("n").alias("n"))


def crawl_summary(records: DataFrame) -> DataFrame:
    """``section, key, n``: totals by outcome and counts by status, type, priority, domain and level."""
    ok = F.count_if(F.coalesce(F.col("status") == "ok", F.lit(False)))
    part = F.count_if(F.coalesce(F.col("status") == "partial", F.lit(False)))
    totals = records.agg(F.count(F.lit(1)).alias("total"), ok.alias("ok"), part.alias("partial"), (F.count(F.lit(1)) - ok - part).alias("other"))
    flat = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in totals.columns])).alias("p")).select(F.lit("totals").alias("section"), "p.key", "p.n")
    fields = ["status", "crawl_type", "source_priority", "knowledge_domain", "level_1"]
    spread = F.explode(F.array(*[F.struct(F.lit(c).alias("section"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("key")) for c in fields]))
    return flat.unionByName(records.select(spread.alias("p")).groupBy("p.section", "p.key").agg(F.count(F.lit(1)).alias("n")))


def _tally(rows: DataFrame, entries: Column) -> DataFrame:
    """``section, key, n`` of the (section, key) structs that each row counts towards, in one pass."""
    return rows.select(F.explode(entries).alias("x")).groupBy("x.section", "x.key").agg(F.count(F.lit(1)).alias("n"))


def _entry(section: str, key: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), F.coalesce(key.cast("string"), F.lit("")).alias("key"))


def discovery_summary(records: DataFrame, discovered: DataFrame, rejected: DataFrame) -> DataFrame:
    """``section, key, n`` of site crawls: records by depth, pages by quality flag, links by outcome and reason."""
    flags = F.coalesce("content_quality_flags", F.array().cast("array<string>"))
    depth = F.filter(F.array(F.when(F.col("discovery_depth").isNotNull(), _entry("discovery_depth_records", F.col("discovery_depth")))), lambda x: x.isNotNull())
    out = _tally(records, F.concat(depth, F.transform(flags, lambda f: _entry("content_quality_flags", f))))
    out = out.unionByName(_tally(rejected, F.array(_entry("rejected_link_reasons", F.col("reason")), _entry("links", F.lit("rejected")))))
    return out.unionByName(_tally(discovered, F.array(_entry("links", F.lit("accepted")))))


def seed_summary(selected: DataFrame, disabled: DataFrame) -> DataFrame:
    """``section, key, n`` of a dry run: how many seeds, and the selected by priority, type and coin."""
    fields = [_entry(f"selected_by_{c}", F.col(c)) for c in ("source_priority", "crawl_type", "coin")]
    out = _tally(selected, F.array(_entry("totals", F.lit("selected_sources")), *fields))
    return out.unionByName(_tally(disabled, F.array(_entry("totals", F.lit("disabled_sources_skipped")))))


def cap_stats(decided: DataFrame, caps: Sequence[tuple[str, int, str]]) -> DataFrame:
    """``source_group, matched, max_keep, kept, removed, priority_override`` of each (name, keep, priority) in ``caps``, in one pass.

    A record that a cap kept may be removed by a later one; it counts as kept where it was kept.
    """
    hits = F.coalesce("cap_reasons", F.array().cast("array<string>"))
    chosen = F.coalesce("caps_kept", F.array().cast("array<string>"))
    counts = [(F.count_if(F.array_contains(chosen, name)), F.count_if(F.array_contains(hits, f"source_limit_exceeded_{name}"))) for name, _, _ in caps]
    flat = decided.agg(*[c.alias(f"{kind}{i}") for i, pair in enumerate(counts) for kind, c in zip("kr", pair, strict=True)])
    rows = [F.struct(F.lit(name).alias("source_group"), (F.col(f"k{i}") + F.col(f"r{i}")).alias("matched"), F.lit(keep).cast("long").alias("max_keep"), F.col(f"k{i}").alias("kept"), F.col(f"r{i}").alias("removed"), F.lit(priority).alias("priority_override")) for i, (name, keep, priority) in enumerate(caps)]
    return flat.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def capped_documents(chunks: DataFrame, limit: int = 100) -> tuple[list[str], int]:
    """The first ``limit`` ids of documents that lost chunks to a cap, in order, and how many more there are."""
    capped = chunks.where("doc_capped").select("doc_id").distinct()
    first = [r[0] for r in capped.orderBy("doc_id").limit(limit).collect()]
    return first, max(0, capped.count() - len(first))


def report(metrics: DataFrame, title: str) -> str:
    """A plain-text report of a ``section, key, n`` table, whose size is that of its sections' vocabularies."""
    lines, last = [title], None
    for row in metrics.orderBy("section", F.desc("n"), "key").toLocalIterator():
        if row["section"] != last:
            lines += ["", f"{row['section']}:"]
            last = row["section"]
        lines.append(f"- {row['key']}: {row['n']}")
    return "\n".join(lines) + "\n"
