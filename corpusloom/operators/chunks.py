"""The chunk stage: eligibility, parameters by type, chunk rows with metadata, first-wins deduplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunking import chunk_document, normal_length
from ..functions.text import first_filled, first_nonzero, let, or_default, sanitize_id, strip
from ..plans.session import ship
from ..plans.tables import written


@dataclass(frozen=True)
class ChunkConfig:
    """Sizes and overlaps by kind of record; caps apply only where ``max_chunks`` is above 0."""

    fixed: bool = False
    default: tuple[int, int] = (2000, 250)
    api: tuple[int, int] = (2500, 300)
    pdf: tuple[int, int] = (2000, 250)
    github: tuple[int, int] = (1600, 200)
    min_doc_chars: int = 500
    min_chunk_chars: int = 300
    max_chunks: int = 0
    github_max: int = 60
    api_max: int = 120
    c_priority_max: int = 80
    require_ok: bool = False


def _kind(columns: list[str]) -> Column:
    names = [F.col(c) for c in ("crawl_type", "source_type") if c in columns]
    return F.lower(or_default(first_filled(*names)))


def chunk_params(columns: list[str], config: ChunkConfig = ChunkConfig()) -> Column:
    """struct(size, overlap)."""
    pair = lambda p: F.struct(F.lit(p[0]).alias("size"), F.lit(p[1]).alias("overlap"))
    if config.fixed:
        return pair(config.default)
    kind = _kind(columns)
    long_report = (kind == "pdf") | (F.lower(or_default(F.col("knowledge_domain"))) == "risk_regulation")
    return F.when(kind == "api_doc", pair(config.api)).when(kind.isin("github_repo", "github_markdown") & ~(kind == "pdf"), pair(config.github)).when(long_report, pair(config.pdf)).otherwise(pair(config.default))


def document_cap(columns: list[str], config: ChunkConfig = ChunkConfig()) -> Column:
    """Chunks that a document may keep; 0 is no limit."""
    if config.max_chunks <= 0:
        return F.lit(0)
    kind = _kind(columns)
    unlimited = F.lit(2**31 - 1)
    by_type = F.when(kind.isin("github_repo", "github_markdown"), config.github_max).when(kind == "api_doc", config.api_max).otherwise(unlimited)
    by_rank = F.when(F.upper(or_default(F.col("source_priority"))) == "C", config.c_priority_max).otherwise(unlimited)
    return F.least(F.lit(config.max_chunks), by_type, by_rank)


def skip_reason(length: Column, status: Column, config: ChunkConfig = ChunkConfig()) -> Column:
    why = F.when((or_default(status, "ok") != "ok") & F.lit(config.require_ok), "status_not_ok")
    return why.when(length == 0, "empty_content").when(length < config.min_doc_chars, "doc_too_short")


FALLBACKS = {
    "doc_id": ("doc_id", "id", "source_id"), "source_id": ("source_id", "id", "doc_id"), "seed_url": ("seed_url", "normalized_url", "url"),
    "url": ("url", "normalized_url", "seed_url"), "title": ("title", "source_name"), "crawl_type": ("crawl_type", "source_type"),
    "source_type": ("source_type", "crawl_type"), "content_hash": ("content_hash", "effective_content_hash"),
}
PLAIN = ("level_1", "level_2", "knowledge_domain", "knowledge_category", "source_name", "source_authority", "source_priority", "crawl_time", "source_group", "notes")


def metadata(columns: list[str]) -> dict[str, Column]:
    """The metadata columns of a chunk, each with its fallbacks."""
    has = lambda names: [F.col(c) for c in names if c in columns] or [F.lit(None).cast("string")]
    out = {name: or_default(first_filled(*has(chain))) for name, chain in FALLBACKS.items()}
    out |= {c: or_default(has([c])[0]) for c in PLAIN}
    out |= {c: or_default(has([c])[0], "N/A") for c in ("coin", "chain", "asset_type")}
    tags = F.col("topic_tags") if "topic_tags" in columns else F.array().cast("array<string>")
    tags = F.coalesce(F.filter(F.transform(tags, lambda x: or_default(x)), lambda x: x != ""), F.array().cast("array<string>"))
    count = [F.col("topic_count")] if "topic_count" in columns else []
    out["topic_tags"] = tags
    out["topic_count"] = F.coalesce(first_nonzero(*count, F.size(tags)), F.lit(0).cast("long"))
    own = [F.expr("try_cast(char_count AS bigint)")] if "char_count" in columns else []
    out["char_count"] = F.coalesce(first_nonzero(*own, F.length(or_default(F.col("content")))), F.lit(0).cast("long")) if "content" in columns else F.coalesce(first_nonzero(*own), F.lit(0).cast("long"))
    return out


def embedding_header() -> Column:
    """Metadata lines, without those that end in a colon."""
    said = [
        F.concat(F.lit("Title: "), F.col("title")),
        F.concat(F.lit("Coin: "), F.col("coin"), F.lit("; Chain: "), F.col("chain"), F.lit("; Domain: "), F.col("knowledge_domain"), F.lit("; Category: "), F.col("knowledge_category")),
        F.concat(F.lit("Source: "), F.col("source_name"), F.lit("; URL: "), F.col("url")),
        F.when(F.size("topic_tags") > 0, F.concat(F.lit("Topic Tags: "), F.array_join("topic_tags", ", "))),
    ]
    return F.concat_ws("\n", *[F.when(~strip(s).endswith(":"), strip(s)) for s in said])


def embedding_text(text: Column) -> Column:
    """The header, a blank line and the text of a chunk, stripped."""
    return strip(F.concat(embedding_header(), F.lit("\n\n"), text))


def chunk_documents(records: DataFrame, config: ChunkConfig = ChunkConfig(), once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chunk rows and skipped records. Texts are measured natively; those that are kept go once through an Arrow UDF, which
    holds a text and a block of chunks at a time. No shuffle; with ``once`` the rows with their chunks are written for both."""
    ship(records.sparkSession)
    cols = records.columns
    text = or_default(F.col("content"))
    measured = let(normal_length(text), lambda n: F.struct(n.alias("n"), skip_reason(n, F.col("status"), config).alias("why")))
    ready = records.withColumns({"_p": chunk_params(cols, config), "_cap": document_cap(cols, config), "_size": measured})
    cut = chunk_document(text, F.col("_p.size"), F.col("_p.overlap"), F.lit(config.min_chunk_chars), F.lit(config.min_doc_chars))
    ready = written(ready.withColumn("_all", cut), "chunks") if once else ready
    why, n = F.col("_size.why"), F.col("_size.n")
    skipped = ready.where(why.isNotNull()).select("ord", why.alias("reason"), F.when(why == "status_not_ok", F.col("status")).alias("status"), F.when(why == "doc_too_short", n).alias("char_count"), "url", "title", "doc_id")
    kept = ready.where(why.isNull())
    kept = kept if once else kept.withColumn("_all", cut)
    kept = kept.withColumn("_few", F.when((F.col("_cap") > 0) & (F.size("_all") > F.col("_cap")), F.slice("_all", F.lit(1), F.col("_cap"))).otherwise(F.col("_all")))
    meta = metadata(cols)
    flat = kept.select("ord", *[c.alias(n) for n, c in meta.items()], F.col("_p.size").alias("chunk_size_param"), F.col("_p.overlap").alias("overlap_param"), F.size("_all").alias("doc_original_chunk_count"), (F.size("_few") < F.size("_all")).alias("doc_capped"), F.size("_few").alias("chunk_count_in_doc"), F.posexplode("_few").alias("chunk_index", "chunk_text"))
    key = sanitize_id(F.coalesce(first_filled(F.col("doc_id"), F.col("source_id")), F.left(F.sha2(F.col("url"), 256), F.lit(16))))
    return flat.withColumns({"chunk_id": F.format_string("%s_CHUNK_%04d", key, F.col("chunk_index") + 1), "chunk_char_count": F.length("chunk_text"), "chunk_hash": F.sha2("chunk_text", 256), "content": F.col("chunk_text"), "embedding_text": embedding_text(F.col("chunk_text"))}), skipped


def first_of(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key. Keys and order are ranked without the other columns' bytes in the sort key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_first", rank).where("_first = 1").drop("_first")


def last_of(rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Upsert: the last value of each key, at the first value's place. An aggregate, combined before the shuffle."""
    others = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*others), F.col(order)).alias("_last")
    return rows.groupBy(key).agg(last, F.min(order).alias("first_ord")).select(key, "_last.*", "first_ord")
