"""Site crawl over a snapshot of pages: a bounded, scored breadth-first search, one join per level.

Each level is a join of the frontier with the snapshot, and all sources advance together. Order within a level is
(parent's place, score descending, URL), which is the order of a first-in-first-out queue that takes each
page's links best first. Page budgets and the queue bound are running counts in that order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import extract_html
from ..functions.scoring import link_score, metadata_confidence, page_quality
from ..functions.text import text_of
from ..functions.urls import admission, normalize_url
from ..plans.session import ship
from ..plans.tables import written


@dataclass(frozen=True)
class CrawlLimits:
    max_pages: int = 50
    max_depth: int = 1
    least_link: int = 55  # hundredths
    least_quality: int = 45
    least_chars: int = 300
    follow_poor: bool = False
    strict_deny: bool = True


def _own(sources: DataFrame, name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in sources.columns else F.lit(default)


def crawl_site(sources: DataFrame, pages: DataFrame | Callable[[DataFrame], DataFrame], limits: CrawlLimits = CrawlLimits()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``records, discovered, rejected`` of all sources.

    ``sources``: source_id, seed_url and optionally source_priority, source_authority, knowledge_domain, and a
    source's own limits: max_pages, max_depth, min_link_score, min_content_quality_score, follow_low_quality_pages,
    min_good_content_chars, path_prefix, link_score_keywords, link_penalty_keywords, deny_extensions.
    ``pages``: url, html, or a function that gives these for a table of ``url``. A page that is missing is a
    failed record and uses up budget.
    """
    spark = ship(sources.sparkSession)
    lookup = pages if callable(pages) else lambda urls: pages
    lists = ["path_prefix", "link_score_keywords", "link_penalty_keywords", "deny_extensions"]
    own_lists = [(F.col(c) if c in sources.columns else F.lit(None)).cast("array<string>").alias(c) for c in lists]
    hundredths = lambda c, default: F.round(_own(sources, c, default / 100) * 100).cast("int").alias(c)
    own = [hundredths("min_link_score", limits.least_link), hundredths("min_content_quality_score", limits.least_quality), _own(sources, "follow_low_quality_pages", limits.follow_poor).alias("follow_low_quality_pages"), _own(sources, "min_good_content_chars", limits.least_chars).cast("int").alias("min_good_content_chars")]
    base = sources.select(*own_lists, *own, "source_id", normalize_url("seed_url", F.lit(None).cast("string")).alias("seed"), *[text_of(F.col(c) if c in sources.columns else F.lit("")).alias(c) for c in ("source_priority", "source_authority", "knowledge_domain")], _own(sources, "max_pages", limits.max_pages).cast("int").alias("max_pages"), _own(sources, "max_depth", limits.max_depth).cast("int").alias("max_depth"))
    base = written(base, "crawl-sources")
    meta = ["source_priority", "source_authority", "knowledge_domain", "max_pages", "max_depth", "seed", *lists, "min_link_score", "min_content_quality_score", "follow_low_quality_pages", "min_good_content_chars"]
    frontier = base.where("seed is not null").select("source_id", F.col("seed").alias("url"), F.lit(None).cast("string").alias("parent_url"), F.lit("").alias("anchor_text"), F.lit(0).alias("depth"), F.lit(100).alias("link_hundredths"), F.lit(1).cast("long").alias("place"))
    refused = base.where("seed is null").select("source_id", F.lit("").alias("url"), F.lit("failed").alias("status"), F.lit("invalid seed_url").alias("error"))
    seen = [frontier.select("source_id", "url")]  # a table a level
    taken = base.select("source_id", F.lit(0).cast("long").alias("used"))
    records, found, dropped = [], [], []
    deepest = base.agg(F.max("max_depth")).first()[0] or 0
    for depth in range(deepest + 1):
        frontier = frontier.join(base.select("source_id", *meta), "source_id").join(taken, "source_id")
        why = admission(F.col("url"), strict_deny=limits.strict_deny, own_deny=F.col("deny_extensions"))
        frontier = frontier.withColumn("why", why)
        dropped.append(frontier.where("why is not null").select("source_id", "url", "parent_url", F.lit(depth).alias("discovery_depth"), "anchor_text", "link_hundredths", F.col("why").alias("reason")))
        order = Window.partitionBy("source_id").orderBy("place")
        level = frontier.where("why is null").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= F.col("max_pages") - F.col("used"))
        if callable(pages):
            level = written(level, f"crawl-frontier-{depth}")  # fetched once
        snapshot = lookup(level.select("url").distinct()).select("url", "html").dropDuplicates(["url"])
        level = level.join(snapshot, "url", "left").withColumn("x", extract_html("html", "url"))
        missing = F.col("html").isNull()
        quality = page_quality(F.col("x.title"), F.col("x.content"), F.col("html"), F.col("x.link_count"), F.col("min_good_content_chars"))
        level = level.withColumn("q", F.when(missing, F.struct(F.lit(0).alias("hundredths"), F.array(F.lit("fetch_failed")).alias("flags"))).otherwise(quality))
        level = level.withColumn("sure", metadata_confidence(F.col("url"), F.when(missing, "").otherwise(F.col("x.title")), F.col("source_priority"), F.col("depth"), F.col("link_hundredths")))
        level = written(level.withColumn("missing", missing).drop("html", "why"), f"crawl-level-{depth}")
        status = F.when(F.col("missing"), "failed").when(F.col("x.content") != "", "ok").otherwise("partial")
        review = F.when(F.col("missing"), F.col("sure.review") | (F.col("depth") > 0)).otherwise(F.col("sure.review"))
        records.append(level.select("source_id", F.col("seed").alias("seed_url"), "url", "parent_url", F.when(F.col("missing"), "").otherwise(F.col("x.title")).alias("title"), F.when(F.col("missing"), "").otherwise(F.col("x.content")).alias("content"), status.alias("status"), F.when(F.col("missing"), "not in snapshot").otherwise("").alias("error"), F.col("depth").alias("discovery_depth"), (F.col("link_hundredths") / 100).alias("link_score"), (F.col("q.hundredths") / 100).alias("content_quality_score"), F.col("q.flags").alias("content_quality_flags"), F.when(F.col("missing"), 0).otherwise(F.size("x.links")).alias("link_count"), (F.col("sure.hundredths") / 100).alias("metadata_confidence"), review.alias("needs_metadata_review"), F.col("place")))
        if depth == deepest:
            break
        good = level.where(~F.col("missing") & (F.col("depth") < F.col("max_depth")))
        good = good.where(F.col("follow_low_quality_pages") | (F.col("q.hundredths") >= F.col("min_content_quality_score")))
        links = good.select("source_id", *meta, F.col("url").alias("parent_url"), F.col("place").alias("parent_place"), F.explode("x.links").alias("l"))
        links = links.withColumn("url", normalize_url(normalize_url("l.url", F.lit(None).cast("string")), F.lit(None).cast("string"))).withColumn("anchor_text", F.col("l.anchor_text")).where("url is not null")
        for older in seen:
            links = links.join(older, ["source_id", "url"], "left_anti")
        links = links.dropDuplicates(["source_id", "parent_url", "url"])
        scored = link_score(F.col("url"), F.col("anchor_text"), F.col("source_priority"), F.col("source_authority"), F.col("knowledge_domain"), F.lit(depth + 1), F.col("path_prefix"), F.col("link_score_keywords"), F.col("link_penalty_keywords"))
        links = links.withColumns({"s": scored, "why": admission(F.col("url"), strict_deny=limits.strict_deny, own_deny=F.col("deny_extensions"))})
        links = links.withColumn("why", F.coalesce("why", F.when(F.col("s.hundredths") < F.col("min_link_score"), "link_score_below_min")))
        # a link that an earlier page of this level queued is invisible to later pages
        first = F.row_number().over(Window.partitionBy("source_id", "url").orderBy(F.col("why").isNotNull(), "parent_place"))
        links = links.withColumn("nth_parent", first)
        queued = links.where("why is null and nth_parent = 1")
        rank = Window.partitionBy("source_id").orderBy("parent_place", F.desc("s.hundredths"), "url")
        sizes = level.groupBy("source_id").agg(F.count(F.lit(1)).alias("level_size"))
        queued = queued.withColumn("place", F.row_number().over(rank).cast("long")).join(sizes, "source_id").join(taken, "source_id")
        queued = written(queued.withColumn("fits", F.col("place") <= F.greatest(F.lit(0), 3 * F.col("max_pages") - F.col("used") - F.col("level_size"))), f"crawl-queue-{depth}")
        visible = links.join(queued.where("fits").select("source_id", "url", F.col("parent_place").alias("at")), ["source_id", "url"], "left").where(F.col("at").isNull() | (F.col("parent_place") <= F.col("at")))
        edge = ["source_id", F.col("seed").alias("seed_url"), "url", "parent_url", F.lit(depth + 1).alias("discovery_depth"), "anchor_text"]
        found.append(visible.where("why is null").select(*edge, (F.col("s.hundredths") / 100).alias("link_score"), F.col("s.reasons").alias("link_score_reasons")))
        dropped.append(visible.where("why is not null").select("source_id", "url", "parent_url", F.lit(depth + 1).alias("discovery_depth"), "anchor_text", F.when(F.col("why") == "link_score_below_min", F.col("s.hundredths")).alias("link_hundredths"), F.col("why").alias("reason")))
        frontier = queued.where("fits").select("source_id", "url", "parent_url", "anchor_text", F.lit(depth + 1).alias("depth"), F.col("s.hundredths").alias("link_hundredths"), "place")
        seen.append(frontier.select("source_id", "url"))
        taken = taken.join(sizes, "source_id", "left").select("source_id", (F.col("used") + F.coalesce("level_size", F.lit(0))).alias("used"))
    out = records[0]
    for r in records[1:]:
        out = out.unionByName(r)
    out = out.unionByName(refused, allowMissingColumns=True)
    rejected = dropped[0]
    for r in dropped[1:]:
        rejected = rejected.unionByName(r)
    empty = spark.createDataFrame([], "source_id string, seed_url string, url string, parent_url string, discovery_depth int, anchor_text string, link_score double, link_score_reasons array<string>")
    discovered = empty
    for r in found:
        discovered = discovered.unionByName(r)
    return out, discovered, rejected
