"""The export stage: libraries of chunks, the balanced library, text blocks, and packing into parts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, meta_list, meta_value, normalize_export, text_of
from .chunks import first_of

DELIMITER = "---CHUNK_END---"
RISK_CATEGORIES = sorted("fincen_virtual_currency_guidance fatf_red_flags ofac_sanctioned_addresses exchange_compliance_reports onchain_analysis_reports privacy_mixer_transaction mev_arbitrage flash_loan approval_risk cross_chain_jump multi_hop_transfer peel_chain fund_splitting address_consolidation multi_input_multi_output high_frequency_small_amount".split())
RISK_AUTHORITIES = sorted("regulatory_authority industry_reference industry_report academic_paper".split())
RISK_DOMAINS = ["risk_regulation", "transaction_feature"]
RISK_LEVELS = ["风险", "监管"]
CORE_DOMAINS = sorted("transaction_type chain_model asset_profile basic_concept".split())
EXCHANGES = ["kraken", "coinbase", "okx", "binance"]
HEADER = "chunk_id doc_id source_id title url coin chain asset_type level_1 level_2".split() + "knowledge_domain knowledge_category source_name source_authority source_priority".split() + "crawl_type source_type topic_tags chunk_index chunk_char_count".split()


def _low(name: str) -> Column:
    return F.lower(meta_value(F.col(name)))


def library(columns: Sequence[str]) -> Column:
    """``cex``, ``risk`` or ``protocol``, in that order of precedence, or null: in no library."""
    has = lambda n: _low(n) if n in columns else F.lit("")
    exchange = F.lit(False)
    for name in EXCHANGES:
        exchange = exchange | F.contains(has("source_name"), F.lit(name))
    category, domain = has("knowledge_category"), has("knowledge_domain")
    cex = (has("source_authority") == "exchange_api") | (category == "cex_deposit_withdrawal") | (has("chain") == "off-chain/cex") | (has("asset_type") == "exchange") | exchange
    level = meta_value(F.col("level_1")) if "level_1" in columns else F.lit("")
    risk = domain.isin(RISK_DOMAINS) | category.isin(RISK_CATEGORIES) | has("source_authority").isin(RISK_AUTHORITIES)
    for word in RISK_LEVELS:
        risk = risk | F.contains(level, F.lit(word))
    return F.when(cex, "cex").when(risk, "risk").when(domain.isin(CORE_DOMAINS), "protocol")


def chunk_text(columns: Sequence[str], fallback: str = "export_text") -> Column:
    names = [c for c in ("chunk_text", "content", "text", fallback) if c in columns]
    return F.coalesce(*[F.nullif(normalize_export(F.col(c)), F.lit("")) for c in names], F.lit(""))


def block(columns: Sequence[str], delimiter: str = DELIMITER) -> Column:
    """A chunk as one delimited text block."""

    def value(name: str) -> Column:
        if name not in columns:
            return F.lit("")
        return meta_list(F.col(name)) if name == "topic_tags" else meta_value(F.col(name))

    # each value is made once: header and hint read it from a struct
    header_of = lambda v: F.concat_ws("\n", *[F.when(v[n] != "", F.concat(F.lit(f"[{n}="), v[n], F.lit("]"))) for n in HEADER])
    said = [("coin", "coin"), ("chain", "chain"), ("domain", "knowledge_domain"), ("category", "knowledge_category"), ("source", "source_name"), ("url", "url")]
    body = F.trim(F.replace(chunk_text(columns), F.lit(delimiter), F.lit(" ")))

    def build(v: Column) -> Column:
        hint = F.concat(F.lit("Document metadata: "), F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), v[n]) for k, n in said]), F.lit("."))
        title = F.when(v["title"] != "", F.concat(F.lit("Title: "), v["title"]))
        return F.concat_ws("\n", F.nullif(header_of(v), F.lit("")), hint, title, F.nullif(v["_body"], F.lit("")))

    values = F.struct(*[value(n).alias(n) for n in HEADER], body.alias("_body"))
    return F.concat(let(values, build), F.lit(f"\n{delimiter}\n"))


def balanced(chunks: DataFrame, max_cex: int = 250, max_cex_per_doc: int = 40, max_total: int = 0) -> DataFrame:
    """The balanced library: all of protocol and risk, and the best exchange chunks up to the caps.

    ``position`` orders the result: protocol, risk, exchange. Caps of 0 are no limit. Per-document ranks
    partition by document; only the rows within them, at most the cap a document, reach the total cap.
    """
    rows = chunks if "library" in chunks.columns else chunks.withColumn("library", library(chunks.columns))
    rank = F.upper(meta_value(F.coalesce(F.col("source_priority").cast("string"), F.lit("C"))))
    rank = F.when(rank == "A", 0).when(rank == "B", 1).when(rank == "C", 2).otherwise(9)
    index = F.coalesce(F.expr("try_cast(chunk_index AS bigint)"), F.lit(0))
    doc = meta_value(F.col("doc_id"))
    source = meta_value(F.col("source_id")) if "source_id" in rows.columns else F.lit("")
    rows = rows.withColumns({"_rank": rank, "_doc": doc, "_index": index, "_owner": F.coalesce(F.nullif(doc, F.lit("")), source)})
    order = ["_rank", "_doc", "_index", "ord"]
    cex = rows.where("library = 'cex'")
    if max_cex_per_doc:
        cex = cex.withColumn("_n", F.row_number().over(Window.partitionBy("_owner").orderBy(*order))).where(F.col("_n") <= max_cex_per_doc).drop("_n")
    if max_cex:
        cex = cex.orderBy(*order).limit(max_cex)
    rest = rows.where("library in ('protocol', 'risk')").withColumns({"_rank": F.lit(0), "_doc": F.lit(""), "_index": F.lit(0).cast("long")})
    group = F.when(F.col("library") == "protocol", 0).when(F.col("library") == "risk", 1).otherwise(2)
    both = rest.unionByName(cex).withColumn("_group", group)
    key = F.coalesce(F.nullif(meta_value(F.col("chunk_id")), F.lit("")), F.to_json(F.struct(*[F.col(c) for c in sorted(chunks.columns) if c != "ord"])))
    out = first_of(both.withColumn("_key", key), "_key", "_group", *order)
    if max_total:
        out = out.orderBy("_group", *order).limit(max_total)
    placed = out.withColumn("position", F.struct("_group", "_rank", "_doc", "_index", "ord"))
    return placed.drop("_key", "_group", "_owner", *order[:-1])


def library_distributions(chunks: DataFrame, fields: Sequence[str], limit: int = 30) -> DataFrame:
    """``library, field, key, n, rank`` over the three libraries and the balanced one."""
    from .analytics import distributions, top_of

    named = chunks.withColumn("library", library(chunks.columns)).where("library is not null")
    both = named.select("library", "ord", *fields).unionByName(balanced(named).select(F.lit("balanced").alias("library"), "ord", *fields))
    return top_of(distributions(both, fields, "<EMPTY>", by=["library"]), ["library", "field"], limit)


def pack_parts(blocks: DataFrame, max_bytes: int, text: str = "block", order: str = "ord", by: str = "library", place: str | None = None) -> DataFrame:
    """``part`` (from 1) of each block: next-fit packing in order of ``place``, a block larger than a part alone.

    A block counts with the blank line that follows it in a file. The running size restarts with every part, so it is a scan of one library in order. Only sizes enter
    it, in parallel over libraries, and blocks of a library are read in batches, not as one frame.
    """
    sizes = blocks.select(by, order, *([place] if place else []), (F.octet_length(text) + 1).cast("long").alias("size"))

    def scan(batches):
        name, part, held = None, 0, 0
        for pdf in batches:
            parts = []
            for who, size in zip(pdf[by], pdf["size"], strict=True):
                if who != name:
                    name, part, held = who, 1, 0
                elif held and held + size > max_bytes:
                    part, held = part + 1, 0
                held += size
                parts.append(part)
            yield pd.DataFrame({by: pdf[by], order: pdf[order], "part": parts})

    ordered = sizes.repartition(by).sortWithinPartitions(by, place or order).select(by, order, "size")
    return ordered.mapInPandas(scan, f"{by} string, {order} long, part long")
