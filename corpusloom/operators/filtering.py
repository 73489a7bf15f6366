"""The record filter: hard rules, keep-best deduplication, low-value paths, source caps, order of the kept.

Every rejected row keeps a reason. Ranking moves narrow columns only; texts stay out of the windows.
"First" and "last" always mean input order, the column ``ord``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_filled, let, strip, text_of
from ..functions.urls import canonical_url
from ..plans.tables import written

LEAST_CHARS = 500
SIZE_CAP = 80_000
#: Words that make a path or title more valuable, and (word, cost) that make a path less so.
VALUED = ("account|api|bips|developer|enums|errors|faq|fee|fees|filters|general-info|getting started|getting-started|glossary|protocol|readme|rest api|rest-api|"
          "smart contracts|smart-contract|token|transaction|transactions|user-data-stream|wallet|web-socket-api|web-socket-streams|whitepaper").split("|")
#: (reason suffix, pattern) in order; the first that matches names the reason.
LOW_VALUE = (
    ("terms", "(^|[/_" + r"\-.])terms([-_ ]?of[-_ ]?(use|service))?($|[/_\-.])"),
    ("release_notes_or_changelog", "changelog|release[-_ ]?(process|notes)"),
    ("test_or_benchmark", "(^|/)(qa|tests?)(/|$)|benchmark|fuzzing|testgen|test[-_]?data"),
    ("contrib", "(^|/)contrib(/|$)"),
    ("seed_nodes", "(^|/)seeds(/|$)|chainparamsseeds|dnsseed|nodes_(test|main)|seed[-_ ]?nodes"),
    ("repo_meta", r"issue_template|(^|/)\.github/"),
    ("build_or_localization", "build[-_]|(^|/)depends(/|$)|gitian|translation(_process|_strings|[_-])|travis[-_]?ci"),
)


@dataclass(frozen=True)
class SourceCap:
    """A large source: at most ``keep`` records stay, with their priority lowered to ``priority``."""

    name: str
    keep: int
    test: Column | None = None
    priority: str = "C"


def source_caps() -> list[SourceCap]:
    """The caps in order; built per session, as their tests are Columns."""

    def repo(owner: str, name: str) -> Column:
        return (F.lower(text_of(F.col("github_owner"))) == owner) & (F.lower(text_of(F.col("github_repo"))) == name)

    joined = F.lower(F.concat_ws(" ", text_of(F.col("url")), text_of(F.col("seed_url")), text_of(F.col("source_name"))))
    return [
        SourceCap("doge_github", 12, repo("dogecoin", "dogecoin")),
        SourceCap("binance_github", 20, repo("binance", "binance-spot-api-docs")),
        SourceCap("okx_api", 10, F.contains(joined, F.lit("okx.com"))),
    ]


def effective_chars() -> Column:
    """The declared count if it is a whole number other than zero, else the text's own length."""
    declared = F.expr("try_cast(char_count AS bigint)")
    return F.coalesce(F.nullif(declared, F.lit(0).cast("long")), F.length(text_of(F.col("content"))).cast("long"))


def hard_reason(columns: list[str] | None = None) -> Column:
    """Why a record is rejected at once, or null."""
    why = F.when(F.col("_parse_error").isNotNull(), "invalid_json") if columns and "_parse_error" in columns else None
    test = F.col("status").isNull() | (F.col("status") != "ok")
    why = why.when(test, "status_not_ok") if why is not None else F.when(test, "status_not_ok")
    return why.when(strip(text_of(F.col("content"))) == "", "empty_content").when(effective_chars() < LEAST_CHARS, "char_count_lt_500")


def with_effective(records: DataFrame) -> DataFrame:
    return records.withColumns({
        "effective_char_count": effective_chars(),
        "effective_url": F.when(text_of(F.col("url")) == "", "").otherwise(canonical_url(F.col("url"))),
        "effective_content_hash": F.coalesce(first_filled(F.col("content_hash")), F.sha2(text_of(F.col("content")), 256)),
    })


def rank_columns() -> dict[str, Column]:
    """The lexicographic rank of a record, larger is better: priority, topic, size, earlier line."""
    path = F.lower(F.coalesce(first_filled(F.col("github_path"), F.col("url")), F.lit("")))
    title = F.lower(text_of(F.col("title")))
    either = F.concat(path, F.lit("\n"), title)  # no word holds a newline
    topic = let(either, lambda t: reduce(lambda a, w: a + F.when(F.contains(t, F.lit(w)), 2).otherwise(0), VALUED, F.lit(0)))
    topic = topic - F.when(path.rlike(r"/cn($|/)|_cn\.md$|_cn\b"), 3).otherwise(0) - F.when(F.contains(path, F.lit("testnet")), 2).otherwise(0)
    noise = F.contains(path, F.lit("security")) | F.contains(path, F.lit("install")) | F.contains(path, F.lit("privatekeynotes"))
    topic = topic - F.when(noise, 1).otherwise(0) - F.when(path.startswith("src/"), 2).otherwise(0)
    priority = F.when(F.col("source_priority") == "A", 3).when(F.col("source_priority") == "B", 2).when(F.col("source_priority") == "C", 1).otherwise(0)
    size = F.least(F.coalesce(F.expr("try_cast(char_count AS bigint)"), F.lit(0)), F.lit(SIZE_CAP))
    return {"r_priority": priority, "r_topic": topic, "r_size": size.cast("long"), "r_line": -F.coalesce(F.col("_line_number"), F.lit(0)).cast("long")}


def _best_first() -> list[Column]:
    return [F.col("r_priority").desc(), F.col("r_topic").desc(), F.col("r_size").desc(), F.col("r_line").desc(), F.col("ord")]


def keep_best(rows: DataFrame, key: str, reason: str) -> DataFrame:
    """Mark all but the best row of each key: ``is_best``, ``reason``, ``kept_doc_id``, ``kept_url``, ``<key>_removed_count``.

    The best is an aggregate, combined before the shuffle, so a key that a third of all rows share costs a
    row a task. It is joined back on the key; the sides are narrow and the planner splits a skewed key.
    """
    rank = F.struct(*[(-F.col(c)).alias(c) for c in ("r_priority", "r_topic", "r_size", "r_line")], "ord", "doc_id", "url")
    best = rows.groupBy(key).agg(F.min(rank).alias("_best"), (F.count(F.lit(1)) - 1).alias(f"{key}_removed_count"))
    marked = rows.join(best, key).withColumns({"is_best": F.col("ord") == F.col("_best.ord"), "kept_doc_id": F.col("_best.doc_id"), "kept_url": F.col("_best.url")})
    return marked.withColumn("reason", F.when(~F.col("is_best"), reason)).drop("_best")


def group_lists(rows: DataFrame, key: str) -> DataFrame:
    """``key, doc_id, merged_ids, loser_urls, n_removed`` for keys of several rows.

    ``merged_ids`` are those after the first in input order, ``loser_urls`` those after the best in rank
    order; one list a group, as the kept record carries it.
    """
    better = [(-F.col(c)).alias(c) for c in ("r_priority", "r_topic", "r_size", "r_line")]
    grouped = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("ord", "doc_id"))).alias("by_order"),
        F.array_sort(F.collect_list(F.struct(*better, "ord", "url", "doc_id"))).alias("by_rank"),
    ).where("n > 1")
    rest = lambda c, field: F.filter(F.transform(F.slice(c, F.lit(2), F.col("n").cast("int")), lambda x: x[field]), lambda x: x.isNotNull() & (x != ""))
    return grouped.select(key, F.col("by_rank")[0]["doc_id"].alias("doc_id"), rest("by_order", "doc_id").alias("merged_ids"), rest("by_rank", "url").alias("loser_urls"), (F.col("n") - 1).alias("n_removed"))


def merged_tags(rows: DataFrame, key: str) -> DataFrame:
    """``key, topic_tags``: the tags and level pairs of a group, first seen first, for groups of several rows.

    Tags are reduced to the first place of each before they are listed, so a list is as long as its vocabulary.
    """
    pair = F.when(first_filled(F.col("level_1"), F.col("level_2")).isNotNull(), F.array(F.concat(text_of(F.col("level_1")), F.lit("/"), text_of(F.col("level_2"))))).otherwise(F.array().cast("array<string>"))
    tags = F.filter(F.transform(F.concat(F.coalesce(F.col("topic_tags"), F.array().cast("array<string>")), pair), strip), lambda x: x != "")
    spread = rows.select(key, "ord", F.posexplode_outer(tags).alias("p", "t"))
    counted = F.count_if(F.coalesce("p", F.lit(0)) == 0)  # each row has one first tag, or none at all
    firsts = spread.groupBy(key, "t").agg(F.min(F.struct("ord", "p")).alias("at"), counted.alias("n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("at", "t"))))
    return firsts.groupBy(key).agg(F.sum("n").alias("n"), F.transform(listed, lambda x: x["t"]).alias("topic_tags")).where("n > 1").drop("n")


def low_value_reason() -> Column:
    fields = ["url", "raw_url", "seed_url", "title", "github_path", "source_name", "notes"]
    return fields_reason([F.col(c) for c in fields])


def fields_reason(fields: list[Column]) -> Column:
    text = F.lower(F.concat_ws(" ", *[text_of(c) for c in fields]))

    def judge(t: Column) -> Column:
        why = F.lit(None).cast("string")
        for name, pattern in reversed(LOW_VALUE):
            why = F.when(t.rlike(pattern), f"low_value_{name}").otherwise(why)
        return why

    return let(text, judge)


def apply_caps(rows: DataFrame, caps: list[SourceCap] | None = None) -> DataFrame:
    """Mark capped rows with ``cap_reasons`` (a row may hit several) and lower the priority of the rest.

    The caps fold in order: each ranks with the priorities that the earlier ones left, and rows that one
    rejected still compete in the next. The kept of a cap are a distributed top-k, at most ``keep`` rows,
    which are broadcast back; no window gathers a large source in one task.
    """
    none = F.lit(None).cast("string")
    rows = rows.withColumns({"cap_reasons": F.array().cast("array<string>"), "source_priority_original": none, "source_limit_group": none, "source_limit_max_keep": F.lit(None).cast("long"), "filter_priority_note": none, "caps_kept": F.array().cast("array<string>")})
    for cap in caps or source_caps():
        rows = rows.withColumn("_hit", F.coalesce(cap.test, F.lit(False)))
        best = rows.where("_hit").orderBy(*_best_first()).limit(cap.keep).select("ord", F.lit(True).alias("_stays"))
        rows = rows.join(F.broadcast(best), "ord", "left").withColumns({"_over": F.col("_hit") & F.col("_stays").isNull(), "_stays": F.coalesce("_stays", F.lit(False))})
        lowered = F.lit({"A": 3, "B": 2, "C": 1}.get(cap.priority, 0))
        new = {
            "source_priority_original": F.col("source_priority"), "source_limit_group": F.lit(cap.name), "source_limit_max_keep": F.lit(cap.keep).cast("long"),
            "filter_priority_note": F.lit(f"Downgraded by large-source rule: {cap.name}"), "source_priority": F.lit(cap.priority), "r_priority": lowered,
        }
        changed = {c: F.when(F.col("_stays"), v).otherwise(F.col(c)) for c, v in new.items()}
        changed["source_limit_max_keep"] = F.when(F.col("_stays") | F.col("_over"), F.lit(cap.keep).cast("long")).otherwise(F.col("source_limit_max_keep"))
        changed["cap_reasons"] = F.when(F.col("_over"), F.array_append("cap_reasons", F.lit(f"source_limit_exceeded_{cap.name}"))).otherwise(F.col("cap_reasons"))
        changed["caps_kept"] = F.when(F.col("_stays"), F.array_append("caps_kept", F.lit(cap.name))).otherwise(F.col("caps_kept"))
        rows = rows.withColumns(changed).drop("_hit", "_stays", "_over")
    return rows


NARROW = ["ord", "doc_id", "url", "effective_url", "effective_content_hash", "effective_char_count", "source_priority", "level_1", "level_2", "crawl_type", "github_owner", "github_repo", "seed_url", "source_name", "low_reason", "r_priority", "r_topic", "r_size", "r_line"]


def decide(records: DataFrame) -> DataFrame:
    """One row per record: ``ord``, ``step`` and ``reasons`` of a rejection, and of the kept the final columns.

    Texts are read once and do not enter a shuffle; join the result to the records by ``ord`` for whole rows.
    """
    raw = records if "raw_url" in records.columns else records.withColumn("raw_url", F.lit(None).cast("string"))
    ready = with_effective(raw).withColumns({"hard": hard_reason(raw.columns), "low_reason": low_value_reason(), **rank_columns()})
    narrow = written(ready.select("hard", *NARROW), "filter-narrow")  # texts are read and matched once
    rejected = [narrow.where("hard is not null").select("ord", "doc_id", "effective_char_count", F.array("hard").alias("reasons"))]
    current = narrow.where("hard is null").drop("hard")
    for key, reason in (("effective_url", "duplicate_url"), ("effective_content_hash", "duplicate_content_hash")):
        marked = keep_best(current, key, reason)
        rejected.append(marked.where("not is_best").select("ord", "doc_id", "kept_doc_id", "kept_url", F.array("reason").alias("reasons")))
        current = marked.where("is_best").drop("is_best", "kept_doc_id", "kept_url", "reason")
    rejected.append(current.where("low_reason is not null").select("ord", "doc_id", F.array("low_reason").alias("reasons")))
    capped = apply_caps(written(current.where("low_reason is null").drop("low_reason"), "filter-deduped"))
    kept = F.size("cap_reasons") == 0
    out = capped.withColumns({"filter_decision": F.when(kept, "kept").otherwise("removed"), "reasons": F.when(~kept, F.col("cap_reasons")), "kept_doc_id": F.lit(None).cast("string"), "kept_url": F.lit(None).cast("string")})
    for r in rejected:
        out = out.unionByName(r.withColumn("filter_decision", F.lit("removed")), allowMissingColumns=True)
    return out


def order_kept(kept: DataFrame) -> DataFrame:
    """``filter_run_order`` 1..n by level_1, level_2, url as text (null reads None), then input order.

    A global number needs a global order. Rows are range-sorted in parallel; only each partition's count
    goes through one task, so no partition holds all rows.
    """
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("level_1", "level_2", "url")]
    return number_rows(kept, [*keys, F.col("ord")], "filter_run_order")


def number_rows(rows: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Rows numbered 1..n in order of keys: a range sort, then offsets from per-partition counts."""
    named = rows.withColumns({f"_k{i}": k for i, k in enumerate(keys)})
    order = [f"_k{i}" for i in range(len(keys))]
    # ranges of the leading key alone may be skewed, so all keys cut the ranges
    cut = named.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # written, as the ranges of a second run might be cut elsewhere
    placed = written(cut.withColumn("_local", local), "numbered")
    counts = placed.groupBy("_part").agg(F.max("_local").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_local") + F.col("_before")).cast("long")).drop("_part", "_local", "_before", *order)


def filtered_corpus(records: DataFrame) -> DataFrame:
    return order_kept(decide(records).where("filter_decision = 'kept'"))


def group_tags(records: DataFrame) -> DataFrame:
    """``ord, merged_tags`` and the lists of what was absorbed, by URL and then by content."""
    ready = with_effective(records).where(hard_reason(records.columns).isNull()).withColumns(rank_columns())
    fields = ["ord", "doc_id", "url", "effective_url", "effective_content_hash", "topic_tags", "level_1", "level_2", "r_priority", "r_topic", "r_size", "r_line"]
    current = written(ready.select(*fields), "filter-tags")
    found = []
    for key, column, name in (("effective_url", "merged_ids", "dedup_url_merged_doc_ids"), ("effective_content_hash", "loser_urls", "dedup_content_hash_duplicate_urls")):
        merged = merged_tags(current, key).withColumnRenamed("topic_tags", "merged")
        lists = group_lists(current, key).select(key, F.col(column).alias(name))
        best = keep_best(current, key, "").where("is_best").select(*fields, *found)
        current = best.join(merged, key, "left").join(lists, key, "left").withColumn("topic_tags", F.coalesce("merged", "topic_tags")).drop("merged")
        found.append(name)
    return current.select("ord", F.col("topic_tags").alias("merged_tags"), *found)


KEPT = ["filter_decision", "effective_url", "effective_content_hash", "source_priority_original", "source_limit_group", "source_limit_max_keep", "filter_priority_note"]


def filter_records(records: DataFrame, decided: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``kept, removed``: whole records with what the filter adds. Decisions are made on narrow rows and joined back."""
    decided = written(decide(records), "filter-decided") if decided is None else decided
    added = decided.where("filter_decision = 'kept'")
    counts = {"effective_url_removed_count": "dedup_url_removed_count", "effective_content_hash_removed_count": "dedup_content_hash_removed_count"}
    numbered = order_kept(added).select("ord", "filter_run_order", F.col("source_priority").alias("_priority"), *KEPT, *[F.nullif(F.col(old), F.lit(0)).alias(new) for old, new in counts.items()])
    kept = records.join(numbered, "ord").join(group_tags(records), "ord", "left")
    kept = kept.withColumns({"source_priority": F.col("_priority"), "topic_tags": F.coalesce("merged_tags", "topic_tags")}).withColumn("topic_count", F.size("topic_tags")).drop("_priority", "merged_tags")
    gone = decided.where("filter_decision = 'removed'").select("ord", "filter_decision", F.col("reasons").alias("filter_reasons"), "kept_doc_id", "kept_url", "effective_char_count", "source_limit_max_keep")
    return kept, records.join(gone, "ord")
