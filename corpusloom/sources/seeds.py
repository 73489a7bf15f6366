"""Seed lists: scan, defaults, selection, and the record projection."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import as_list, first_filled, strip, text_of, whole_number

#: Seed fields by type, and the ones that every record of a seed carries on.
TEXT = "id source_id name source_name group type crawl_type url normalized_url branch level_1 level_2 coin chain asset_type knowledge_domain knowledge_category source_authority source_priority notes".split()
LISTS = "topic_tags extensions deny_extensions path_prefix link_score_keywords link_penalty_keywords".split()
WHOLE = "max_files max_pages max_depth min_good_content_chars topic_count".split()
SHARES = "min_link_score min_content_quality_score".split()
FLAGS = "same_domain crawl_enabled follow_low_quality_pages".split()
CARRIED = "id level_1 level_2 coin chain asset_type knowledge_domain knowledge_category source_authority source_priority crawl_enabled topic_tags topic_count normalized_url notes".split()


def load_seeds(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list, or an object with a list under ``sources``; other entries than objects are dropped.

    Raises FileNotFoundError, or ValueError for another top-level shape. A seed list is a configuration
    file, so the driver reads it.
    """
    loaded = json.loads(Path(path).read_text(encoding="utf-8"))
    entries = loaded.get("sources") if isinstance(loaded, dict) else loaded
    if not isinstance(entries, list):
        raise ValueError("a seed list is a JSON list or an object with a list named sources")
    rows = [(i, json.dumps(e)) for i, e in enumerate(entries) if isinstance(e, dict)]
    raw = spark.createDataFrame(rows, "ord long, json string")
    m = F.col("_m")
    typed = [m[c].alias(c) for c in TEXT] + [F.when(m[c].isNotNull(), as_list(m[c])).alias(c) for c in LISTS] + [whole_number(m[c]).alias(c) for c in WHOLE]
    typed += [m[c].try_cast("double").alias(c) for c in SHARES] + [F.when(m[c].isNotNull(), ~F.lower(m[c]).isin("false", "", "0", "0.0", "[]", "{}")).alias(c) for c in FLAGS]
    seeds = raw.withColumn("_m", F.from_json("json", "map<string,string>")).select("ord", *typed)
    return with_defaults(seeds)


def with_defaults(seeds: DataFrame) -> DataFrame:
    return seeds.withColumns({
        "normalized_url": F.coalesce(first_filled(F.col("normalized_url"), F.col("url")), F.lit("")),
        "crawl_type": F.coalesce(first_filled(F.col("crawl_type"), F.col("type")), F.lit("html")),
        "source_name": F.coalesce(first_filled(F.col("source_name"), F.col("name")), F.lit("")),
    })


def select_seeds(seeds: DataFrame, include_disabled: bool = False, limit: int = 0, **only: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``selected, disabled``: switched-off seeds leave first; then case-insensitive filters by column; then the first ``limit``."""
    enabled = F.coalesce(F.col("crawl_enabled"), F.lit(True))
    disabled = seeds.where(~enabled) if not include_disabled else seeds.limit(0)
    chosen = seeds if include_disabled else seeds.where(enabled)
    for column, values in only.items():
        if values:
            chosen = chosen.where(F.upper(text_of(F.col(column))).isin([v.upper() for v in values]))
    return (chosen.orderBy("ord").limit(limit) if limit else chosen), disabled


def source_id(seed_id: Column, other_id: Column, normalized_url: Column, url: Column, name: Column) -> Column:
    own = strip(F.coalesce(first_filled(seed_id, other_id), F.lit("")))
    key = F.coalesce(first_filled(normalized_url, url, name), F.lit(""))
    return F.when(own != "", own).otherwise(F.concat(F.lit("SRC_"), F.left(F.sha2(key, 256), F.lit(12))))


def document_id(source: Column, url: Column, seed_url: Column, suffix: Column | None = None) -> Column:
    """The source's id for its own URL, else with a suffix. Both URLs come normalised (null is a URL that isn't one)."""
    by_url = F.when(url.eqNullSafe(seed_url), source).otherwise(F.concat(source, F.lit("__"), F.left(F.sha2(text_of(url), 256), F.lit(10))))
    if suffix is None:
        return by_url
    clean = F.substring(F.regexp_replace(suffix, "[^0-9a-zA-Z._-]+", "_"), 1, 80)
    return F.when(text_of(suffix) == "", by_url).otherwise(F.concat(source, F.lit("__"), clean))


def record(url: Column, title: Column, content: Column, status: Column, error: Column) -> dict[str, Column]:
    """The columns that every record derives from its text."""
    text = text_of(content)
    return {"url": url, "title": text_of(title), "content": text, "content_hash": F.sha2(text, 256), "char_count": F.length(text).cast("long"), "status": status, "error": text_of(error)}


def dispatch(seeds: DataFrame) -> DataFrame:
    """``family`` of each seed: html, html_crawl, pdf, github_file, github_repo, or null for an unknown type."""
    kind = F.lower(F.col("crawl_type"))
    family = F.when(kind.isin("html", "api_doc", "interactive_html", "html_exact"), "html").when(kind == "github_markdown", "github_file").when(kind.isin("html_crawl", "pdf", "github_repo"), kind)
    return seeds.withColumns({"family": family, "error": F.when(family.isNull(), F.concat(F.lit("unknown crawl_type: "), F.col("crawl_type")))})


EXTENSIONS = (".md", ".txt", ".rst", ".mediawiki", ".adoc")


def repository_files(tree: DataFrame, extensions: Sequence[str] = EXTENSIONS, max_files: int = 200) -> DataFrame:
    """The first ``max_files`` blobs of each repository tree with a wanted suffix, in the tree's order.

    ``tree``: owner, repo, json (the tree API's answer), and optionally a seed's own ``extensions`` and
    ``max_files``; its other columns stay. bitcoin/bips keeps at least 500 unless the seed sets a number.
    """
    entries = F.from_json(F.get_json_object("json", "$.tree"), "array<struct<path:string,type:string>>")
    most = F.when((F.lower("owner") == "bitcoin") & (F.lower("repo") == "bips"), F.greatest(F.lit(500), F.lit(max_files))).otherwise(F.lit(max_files))
    wanted_ends = F.array(*[F.lit(x) for x in extensions])
    if "max_files" in tree.columns:
        most = F.coalesce(F.col("max_files").cast("int"), most)
    if "extensions" in tree.columns:
        wanted_ends = F.coalesce("extensions", wanted_ends)
    wanted = lambda e: (e["type"] == "blob") & F.exists(wanted_ends, lambda x: F.lower(e["path"]).endswith(F.lower(x)))
    others = [c for c in tree.columns if c not in ("json", "extensions", "max_files")]
    return tree.select(*others, F.posexplode(F.slice(F.filter(entries, wanted), F.lit(1), most)).alias("nth", "e")).select(*others, "nth", F.col("e.path").alias("path"))


def default_branch(answer: Column) -> Column:
    return F.coalesce(F.nullif(F.get_json_object(answer, "$.default_branch"), F.lit("")), F.lit("master"))
