"""Command line: ``python -m corpusloom {crawl,filter,chunk,export} ...``; every stage reads and writes folders of JSON lines."""

from __future__ import annotations

import argparse
import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text, urls
from .operators import analytics, chunks, crawl, export, filtering
from .plans.tables import written
from .sources import files, remote, seeds

TEXTS = "doc_id source_id seed_url url raw_url title content content_hash status source_priority crawl_type source_type github_owner github_repo github_path source_name level_1 level_2 coin chain asset_type knowledge_domain knowledge_category source_authority source_group notes crawl_time".split()
RECORD = ", ".join([*(f"`{c}` string" for c in TEXTS), "char_count bigint", "topic_tags array<string>"])
CHUNK = ", ".join(f"`{c}` string" for c in "chunk_id chunk_text content text".split() + [c for c in TEXTS if c not in ("content", "chunk_id")]) + ", chunk_index bigint, chunk_char_count bigint, topic_tags array<string>"


def run_crawl(spark, a) -> None:
    listed = seeds.load_seeds(spark, a.config)
    only = {"source_priority": a.only_priority, "knowledge_domain": a.only_domain, "coin": a.only_coin, "level_1": a.only_level1, "crawl_type": a.only_crawl_type}
    chosen, disabled = seeds.select_seeds(listed, a.include_disabled, a.limit, **{k: [x for x in (v or "").split(",") if x] for k, v in only.items()})
    files.write_jsonl(disabled, f"{a.out}/disabled_sources", "ord")
    sid = seeds.source_id(F.col("id"), F.col("source_id"), F.col("normalized_url"), F.col("url"), F.col("name"))
    sources = seeds.dispatch(chosen).withColumns({"source_id": sid, "seed_url": F.col("normalized_url"), "url": F.col("normalized_url")})
    if a.dry_run:
        files.write_jsonl(sources.drop("family", "error"), f"{a.out}/dry_run_sources", "ord")
        _report(a.out, "dry_run_report.txt", f"dry_run_time: {_now()}\n" + analytics.report(analytics.seed_summary(sources, disabled), "Dry run"))
        return
    if not a.live and not a.pages:
        raise SystemExit("crawl needs --pages or --live")
    pages = remote.fetched(a.delay) if a.live else spark.read.parquet(a.pages)
    sources = written(sources, "crawl-seeds")
    site, found, dropped = crawl.crawl_site(sources.where("family = 'html_crawl'"), pages)
    found, dropped = written(found, "crawl-found"), written(dropped, "crawl-dropped")
    single = remote.source_records(sources.where("coalesce(family, '') <> 'html_crawl'"), pages, a.github_extensions.split(","), a.github_max_files)
    both = site.unionByName(single.withColumn("place", F.coalesce("place", F.lit(0).cast("long"))), allowMissingColumns=True)
    records = written(_with_seed(both.drop("seed_url"), sources), "crawl-records")
    files.write_jsonl(records, f"{a.out}/records", "first_ord", without=["first_ord"])
    files.write_jsonl(records.where("status not in ('ok', 'partial')"), f"{a.out}/failed_records", "first_ord", without=["first_ord"])
    files.write_jsonl(found, f"{a.out}/discovered_links", "source_id", "discovery_depth", "url")
    files.write_jsonl(dropped, f"{a.out}/rejected_links", "source_id", "discovery_depth", "url")
    files.preview(records.drop("first_ord"), ["content"]).write.mode("overwrite").option("header", True).csv(f"{a.out}/preview")
    if a.sqlite:
        files.write_sqlite(records.drop("first_ord"), a.sqlite)
    if a.texts:
        names = F.when(F.col("github_path").isNotNull(), text.safe_name_from_path(F.col("github_path"), ".txt", F.col("source_id"))).otherwise(text.safe_name_from_url(F.col("url"), urls.parts(F.col("url"))["netloc"], urls.parts(F.col("url"))["path"], ".txt", F.col("source_id")))
        files.write_documents(records.where("content <> ''").withColumn("file_name", names), f"{a.out}/clean_text")
    metrics = analytics.crawl_summary(records).unionByName(analytics.discovery_summary(records, found, dropped)).unionByName(analytics.seed_summary(sources, disabled))
    _report(a.out, "crawl_report.txt", f"crawl_time: {_now()}\n" + analytics.report(metrics, "Crawl"))


def _now() -> str:
    return time.strftime("%Y-%m-%d %H:%M:%S")


def _with_seed(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Records with their seed's fields, document ids and the run's time; of one document the last stays, at the first's place."""
    tags = F.coalesce("topic_tags", F.array().cast("array<string>"))
    own = {"source_group": text.first_filled(F.col("knowledge_domain"), F.col("group")), "source_type": F.col("crawl_type"), "crawl_type": F.col("crawl_type"), "source_name": F.col("source_name"), "topic_tags": tags, "_seed": F.struct("ord")}
    carried = sources.select("source_id", F.col("seed_url"), *[F.col(c) for c in seeds.CARRIED if c not in own], *[v.alias(k) for k, v in own.items()]).dropDuplicates(["source_id"])
    names = [c for c in records.columns if c not in carried.columns or c == "source_id"]
    every = records.select(*names).join(carried, "source_id")
    absolute = lambda c: urls.normalize_url(c, F.lit(None).cast("string"))
    suffix = F.col("id_suffix") if "id_suffix" in names else None
    key = seeds.document_id(F.col("source_id"), absolute(F.col("url")), absolute(F.col("seed_url")), suffix)
    size = {"content_hash": F.sha2(text.text_of(F.col("content")), 256), "char_count": F.length(text.text_of(F.col("content"))).cast("long")}
    every = every.withColumns({"doc_id": key, "crawl_time": F.lit(_now()), "ord": F.struct(F.col("_seed.ord"), F.coalesce("place", F.lit(0).cast("long")), "url"), **size}).drop("_seed", "id_suffix", "place")
    return files.upsert(None, every).drop("ord")


def run_filter(spark, a) -> None:
    records = files.read_jsonl(spark, a.input, RECORD)
    decided = written(filtering.decide(records), "filter-decided")
    kept, removed = filtering.filter_records(records, decided)
    files.write_jsonl(kept.drop("ord"), f"{a.out_dir}/records_filtered", "filter_run_order")
    files.write_jsonl(removed, f"{a.out_dir}/records_removed", "ord")
    caps = [(c.name, c.keep, c.priority) for c in filtering.source_caps()]
    stats = analytics.cap_stats(decided, caps).select(F.lit("source_caps").alias("section"), F.explode(F.array(*[F.struct(F.concat("source_group", F.lit(f" {k}")).alias("key"), F.col(k).alias("n")) for k in ("matched", "max_keep", "kept", "removed")])).alias("x")).select("section", "x.key", "x.n")
    metrics = analytics.filter_stats(decided).unionByName(stats)
    _report(a.out_dir, "filter_report.md", analytics.report(metrics, "Filter report"))
    summary = {}
    for row in metrics.toLocalIterator():
        summary.setdefault(row["section"], {})[row["key"]] = row["n"]
    _report(a.out_dir, "filter_summary.json", json.dumps(summary, ensure_ascii=False, sort_keys=True, indent=1))


def run_chunk(spark, a) -> None:
    config = chunks.ChunkConfig(
        a.mode == "fixed", (a.chunk_size, a.overlap), (a.api_chunk_size, a.api_overlap), (a.pdf_chunk_size, a.pdf_overlap), (a.github_chunk_size, a.github_overlap),
        a.min_doc_chars, a.min_chunk_chars, a.max_chunks_per_doc, a.github_max_chunks, a.api_max_chunks, a.c_priority_max_chunks, a.require_ok_status,
    )
    made, skipped = chunks.chunk_documents(files.read_jsonl(spark, a.input, RECORD, False, text.parse_list), config, once=True)
    if not a.no_dedup:
        made = chunks.first_of(made, "chunk_hash", "ord", "chunk_index")
    files.write_jsonl(made, f"{a.out}/chunks", "ord", "chunk_index")
    files.write_jsonl(skipped, f"{a.out}/skipped", "ord")
    rows = spark.read.json(f"{a.out}/chunks")
    texts = files.preview(rows.drop("content").withColumn("topic_tags", F.array_join("topic_tags", "|")), ["chunk_text", "embedding_text"], a.preview_chars)
    texts.write.mode("overwrite").option("header", True).csv(f"{a.out}/preview")
    spread = analytics.distributions(rows, ["level_1", "knowledge_domain", "knowledge_category", "coin", "chain", "source_priority", "crawl_type", "source_authority"])
    stats = json.dumps(analytics.length_stats(rows, "chunk_char_count").first().asDict())
    first, more = analytics.capped_documents(rows)
    capped = [f"- {d}" for d in first] + [f"... and {more} more"] * (more > 0)
    head = f"chunk_time: {_now()}\nlengths: {stats}\ncapped documents: {len(first) + more}\n" + "".join(f"{x}\n" for x in capped)
    top = "".join(f"- {r['n']} | {r['title']} | {r['url']}\n" for r in analytics.documents_by_chunks(rows).collect())
    _report(a.out, "chunk_report.txt", head + analytics.report(spread.select(F.col("field").alias("section"), "key", "n"), "Chunks") + "\nmost chunks:\n" + top)


def run_export(spark, a) -> None:
    rows = files.read_jsonl(spark, a.input, CHUNK, False, text.split_list).drop("_line_number", "_extra")
    rows = rows.withColumn("library", export.library(rows.columns)).where(export.chunk_text(rows.columns) != "")
    balanced = export.balanced(rows, a.balanced_max_cex_chunks, a.balanced_max_cex_per_doc, a.balanced_max_total_chunks)
    place = F.struct(F.lit(0).alias("_group"), F.lit(0).alias("_rank"), F.lit("").alias("_doc"), F.lit(0).cast("long").alias("_index"), "ord")
    named = chunks.first_of(rows.where("library is not null").withColumn("_key", F.concat_ws("\n", "library", F.coalesce("chunk_id", F.col("ord").cast("string")))), "_key", "ord").drop("_key").withColumn("position", place)
    both = named.unionByName(balanced.select(*[F.lit("balanced").alias("library") if c == "library" else F.col(c) for c in named.columns]))
    both = both.withColumn("block", export.block([c for c in rows.columns if c != "library"], a.delimiter))
    for name in ("protocol", "risk", "cex", "balanced"):
        files.write_library(both.where(F.col("library") == name), f"{a.out}/{name}", ["position"])
    spread = export.library_distributions(rows, ["source_priority", "level_1", "knowledge_domain", "crawl_type", "coin", "chain", "source_name"])
    _report(a.out, "export_report.txt", f"export_time: {_now()}\n" + analytics.report(spread.select(F.concat_ws(" ", "library", "field").alias("section"), "key", "n"), "Libraries"))
    if a.max_file_mb > 0:
        # a library of more than the limit also comes in parts, next to its whole file
        most = int(a.max_file_mb * 1024 * 1024)
        large = both.groupBy("library").agg(F.sum(F.octet_length("block") + 1).alias("bytes")).where(F.col("bytes") > most).select("library")
        some = both.join(large, "library", "left_semi")
        parts = export.pack_parts(some, most, place="position")
        files.write_parts(some.join(parts, ["library", "ord"]).select("library", "part", "position", "block"), f"{a.out}/parts")


def _report(folder: str, name: str, text: str) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text(text, encoding="utf-8")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusloom")
    stages = top.add_subparsers(dest="stage", required=True)
    c = stages.add_parser("crawl")
    c.add_argument("--config", required=True)
    c.add_argument("--pages", default="", help="snapshot table of url and html (and body, bytes, for PDF), Parquet")
    c.add_argument("--live", action="store_true", help="fetch pages instead")
    c.add_argument("--delay", type=float, default=1.0)
    c.add_argument("--sqlite", default="", help="also insert or replace the records in this database")
    c.add_argument("--texts", action="store_true", help="also write one text file a record")
    c.add_argument("--github-max-files", type=int, default=200)
    c.add_argument("--github-extensions", default=",".join(seeds.EXTENSIONS))
    c.add_argument("--out", required=True)
    c.add_argument("--include-disabled", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--limit", type=int, default=0)
    for flag in ("priority", "domain", "coin", "level1", "crawl-type"):
        c.add_argument(f"--only-{flag}", default="")
    f = stages.add_parser("filter")
    f.add_argument("input")
    f.add_argument("--out-dir", default=".")
    k = stages.add_parser("chunk")
    k.add_argument("--input", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--mode", choices=("auto", "fixed"), default="auto")
    for prefix, size, overlap in (("", 2000, 250), ("api-", 2500, 300), ("pdf-", 2000, 250), ("github-", 1600, 200)):
        k.add_argument(f"--{prefix}chunk-size", type=int, default=size)
        k.add_argument(f"--{prefix}overlap", type=int, default=overlap)
    for flag, value in (("min-doc-chars", 500), ("min-chunk-chars", 300), ("max-chunks-per-doc", 0), ("github-max-chunks", 60), ("api-max-chunks", 120), ("c-priority-max-chunks", 80)):
        k.add_argument(f"--{flag}", type=int, default=value)
    k.add_argument("--require-ok-status", action="store_true")
    k.add_argument("--no-dedup", action="store_true")
    k.add_argument("--preview-chars", type=int, default=1200)
    e = stages.add_parser("export")
    e.add_argument("--input", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--max-file-mb", type=float, default=14.0)
    for flag, value in (("chunks", 250), ("per-doc", 40)):
        e.add_argument(f"--balanced-max-cex-{flag}", type=int, default=value)
    e.add_argument("--balanced-max-total-chunks", type=int, default=0)
    e.add_argument("--delimiter", default=export.DELIMITER)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusloom").getOrCreate()
    {"crawl": run_crawl, "filter": run_filter, "chunk": run_chunk, "export": run_export}[a.stage](spark, a)


if __name__ == "__main__":
    main()
