"""Adapters from the driver's tables to records and chunks: the same SQL text for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _cases(subject: str, values: dict[int, str], default: str) -> str:
    return f"case {subject} " + " ".join(f"when {k} then '{v}'" for k, v in values.items()) + f" else {default} end"


ID = "cast(doc_id as string)"
RECORD = {
    "ord": "doc_id + 1",
    "_line_number": "doc_id + 1",
    "doc_id": f"concat('DOC_', {ID})",
    "source_id": "source",
    "url": f"concat('https://', source, '.example.org/', lang, '/', {ID})",
    "seed_url": "concat('https://', source, '.example.org/')",
    "raw_url": "cast(null as string)",
    "title": _cases("doc_id % 7", {0: "API reference", 1: "Wallet FAQ", 2: "Protocol glossary"}, f"concat('Document ', {ID})"),
    "content": "text",
    "char_count": "n_chars",
    "content_hash": "sha256_of(text)",
    "status": "case when doc_id % 23 = 0 then 'failed' when doc_id % 29 = 0 then 'partial' else 'ok' end",
    "source_priority": _cases("doc_id % 4", {0: "A", 1: "B", 2: "C"}, "'D'"),
    "crawl_type": _cases("doc_id % 5", {0: "api_doc", 1: "pdf", 2: "github_repo", 3: "github_markdown"}, "'html'"),
    "github_owner": "case when doc_id % 11 = 0 then 'dogecoin' when doc_id % 13 = 0 then 'binance' end",
    "github_repo": "case when doc_id % 11 = 0 then 'dogecoin' when doc_id % 13 = 0 then 'binance-spot-api-docs' end",
    "github_path": "case when doc_id % 17 = 0 then 'doc/release-notes/x.md' when doc_id % 19 = 0 then 'doc/contrib/x.md' end",
    "source_name": "case when doc_id % 14 = 0 then 'OKX API (okx.com)' else source end",
    "topic_tags": "list_of(lang, source)",
    "level_1": "lang",
    "level_2": "source",
    "coin": "case doc_id % 3 when 0 then 'BTC' when 1 then 'ETH' end",
    "chain": "case when doc_id % 31 = 0 then 'off-chain/cex' end",
    "knowledge_domain": _cases("doc_id % 6", {0: "basic_concept", 1: "asset_profile", 2: "chain_model", 3: "transaction_type", 4: "risk_regulation"}, "'misc'"),
    "knowledge_category": "case when doc_id % 37 = 0 then 'mev_arbitrage' end",
    "source_authority": "case when doc_id % 10 = 0 then 'exchange_api' end",
    "asset_type": "cast(null as string)",
    "notes": "cast(null as string)",
}
VARIANTS = {"records": {}, "records_ok": {"status": "'ok'"}}


def _spark(sql: str) -> str:
    return sql.replace("sha256_of(text)", "sha2(text, 256)").replace("list_of(lang, source)", "array(lang, source)")


def _duck(sql: str) -> str:
    return sql.replace("sha256_of(text)", "sha256(text)").replace("list_of(lang, source)", "[lang, source]").replace("as string)", "as varchar)")


def records(spark: SparkSession, sf_dir: str, variant: str = "records") -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    again = variant == "records_recrawl"
    fields = RECORD | VARIANTS.get(variant, VARIANTS["records_ok"])
    out = docs.selectExpr(*[f"{_spark(e)} as {c}" for c, e in fields.items()])
    if not again:
        return out
    copy = RECRAWL | {}
    second = docs.where("doc_id % 10 = 3").selectExpr(*[f"{_spark(copy.get(c, fields[c]))} as {c}" for c in fields])
    return out.unionByName(second)


RECRAWL = {"ord": "doc_id + 1000001", "_line_number": "doc_id + 1000001", "url": f"concat({RECORD['url']}, '/?utm_source=feed')", "doc_id": f"concat({RECORD['doc_id']}, 'R')", "status": "'ok'", "source_priority": "'B'"}


def records_cte(variant: str = "records") -> str:
    """``records AS (...)`` for DuckDB."""
    fields = RECORD | VARIANTS.get(variant, VARIANTS["records_ok"])
    sql = "SELECT " + ", ".join(f"{_duck(e)} AS {c}" for c, e in fields.items()) + " FROM documents"
    if variant == "records_recrawl":
        sql += " UNION ALL SELECT " + ", ".join(f"{_duck(RECRAWL.get(c, fields[c]))} AS {c}" for c in fields) + " FROM documents WHERE doc_id % 10 = 3"
    return f"records AS ({sql})"


META = "doc_id source_id url seed_url title source_priority crawl_type source_name level_1 level_2 coin chain knowledge_domain knowledge_category source_authority asset_type".split()


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of records as chunks: enough for analytics and export without the chunker."""
    rows = records(spark, sf_dir, "records_ok")
    flat = rows.selectExpr(*META, "ord as doc_ord", "posexplode(split(content, '\\n')) as (chunk_index, chunk_text)")
    return flat.selectExpr("*", "concat(doc_id, '_L', cast(chunk_index as string)) as chunk_id", "doc_ord * 1000000 + chunk_index as ord", "length(chunk_text) as chunk_char_count", "sha2(chunk_text, 256) as chunk_hash")


CHUNKS_CTE = records_cte("records_ok") + """,
lines AS (SELECT *, string_split(content, chr(10)) AS parts FROM records),
chunks AS (
  SELECT """ + ", ".join(META) + """, CAST(i AS INTEGER) AS chunk_index, parts[i + 1] AS chunk_text,
    concat(doc_id, '_L', CAST(i AS VARCHAR)) AS chunk_id, ord * 1000000 + i AS ord,
    length(parts[i + 1]) AS chunk_char_count, sha256(parts[i + 1]) AS chunk_hash
  FROM (SELECT *, unnest(range(len(parts))) AS i FROM lines))"""
