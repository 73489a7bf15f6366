"""Pages, repository files and PDF documents as records: from a snapshot table, or fetched where a network is.

Fetching runs on the executors, one partition a host, so that pacing holds for each host and hosts proceed in
parallel. A fetch never raises: it gives bytes or an error text.
"""

from __future__ import annotations

import io
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import extract_html
from ..functions.text import normalize_lines
from ..functions.urls import github_file, github_repo, parts
from ..plans.session import ship
from ..plans.tables import written
from .seeds import EXTENSIONS, default_branch, record, repository_files

RETRIED = frozenset({429, 500, 502, 503, 504})


def fetch(url: str, timeout: float = 60, retries: int = 3, backoff: float = 0.8, agent: str = "corpusloom", opener: Callable = urllib.request.urlopen, pause: Callable = time.sleep) -> tuple[bytes | None, str, str]:
    """``(body, content type, error)`` of a GET; overload and server errors are tried again."""
    error = ""
    for attempt in range(retries + 1):
        try:
            with opener(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
                return answer.read(), answer.headers.get("Content-Type", ""), ""
        except urllib.error.HTTPError as e:
            error = f"HTTP {e.code}"
            if e.code not in RETRIED:
                break
        except (OSError, ValueError) as e:
            error = f"{type(e).__name__}: {e}"
        if attempt < retries:
            pause(backoff * 2**attempt)
    return None, "", error


def fetch_pages(urls: DataFrame, delay: float = 1.0, hosts: int = 64, get: Callable = fetch) -> DataFrame:
    """``url, body, content_type, error`` of the distinct ``url`` values."""
    ship(urls.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                rows.append((url, *get(url)))
                time.sleep(delay)
            yield pd.DataFrame(rows, columns=["url", "body", "content_type", "error"])

    by_host = urls.select("url").where("url is not null").distinct().repartition(hosts, parts(F.col("url"))["netloc"])
    return by_host.mapInPandas(run, "url string, body binary, content_type string, error string")


def fetched(delay: float = 1.0, hosts: int = 64, get: Callable = fetch) -> Callable[[DataFrame], DataFrame]:
    """A live source of pages: a function from a table of ``url`` to ``url, html, body``, each URL fetched once."""

    def pages(urls: DataFrame) -> DataFrame:
        got = written(fetch_pages(urls, delay, hosts, get), "fetched")
        return got.where("body is not null").select("url", F.decode("body", F.lit("UTF-8")).alias("html"), "body")

    return pages


def page_records(sources: DataFrame, pages: DataFrame) -> DataFrame:
    """One record per source from its page: ``source_id, url, source_name`` joined with ``url, html``; a miss is ``failed``."""
    ship(sources.sparkSession)
    found = sources.join(pages.select("url", "html").dropDuplicates(["url"]), "url", "left").withColumn("x", extract_html("html", "url"))
    miss = F.col("html").isNull()
    title = F.when(miss, F.col("source_name")).otherwise(F.coalesce(F.nullif(F.col("x.title"), F.lit("")), F.col("source_name")))
    status = F.when(miss, "failed").when(F.col("x.content") == "", "partial").otherwise("ok")
    made = record(F.col("url"), title, F.when(miss, "").otherwise(F.col("x.content")), status, F.when(miss, "not in snapshot"))
    return found.select("source_id", *[v.alias(k) for k, v in made.items()], F.when(miss, 0).otherwise(F.size("x.links")).alias("link_count"))


API = "https://api.github.com/repos/"


def repository_records(sources: DataFrame, pages: Callable[[DataFrame], DataFrame], extensions: Sequence[str] = EXTENSIONS, max_files: int = 200) -> DataFrame:
    """Records of repositories: ``source_id, url, source_name`` and optionally ``branch, extensions, max_files``.

    The tree answer, the default branch where none is set, and every wanted file come from ``pages``.
    """
    r = github_repo(F.col("url"))
    own = [c for c in ("extensions", "max_files") if c in sources.columns]
    branch = F.trim(F.coalesce(F.col("branch"), F.lit(""))) if "branch" in sources.columns else F.lit("")
    repos = sources.select("source_id", "url", "source_name", *own, r["owner"].alias("owner"), r["repo"].alias("repo"), branch.alias("branch")).where("owner is not null")
    about = F.when(F.col("branch") == "", F.concat(F.lit(API), "owner", F.lit("/"), "repo"))
    named = _body(repos.withColumn("_at", about), pages).withColumn("branch", F.when(F.col("branch") == "", default_branch(F.col("_text"))).otherwise(F.col("branch"))).drop("_at", "_text")
    trees = written(_body(named.withColumn("_at", F.concat(F.lit(API), "owner", F.lit("/"), "repo", F.lit("/git/trees/"), "branch", F.lit("?recursive=1"))), pages).drop("_at"), "repository-trees")
    broken = F.get_json_object("_text", "$").isNull()
    made = record(F.col("url"), F.col("source_name"), F.lit(""), F.lit("failed"), F.when(F.col("_text").isNull(), "not in snapshot").otherwise("not a tree answer"))
    lost = trees.where(broken).select("source_id", *[v.alias(k) for k, v in made.items()])
    listed = repository_files(trees.where(~broken).withColumnRenamed("_text", "json").drop("url", "source_name"), extensions, max_files)
    raw = F.concat(F.lit("https://raw.githubusercontent.com/"), F.concat_ws("/", "owner", "repo", "branch", "path"))
    page = F.concat(F.lit("https://github.com/"), F.concat_ws("/", "owner", "repo", F.lit("blob"), "branch", "path"))
    files = _body(listed.withColumn("_at", raw), pages)
    text = normalize_lines(F.col("_text"))
    status = F.when(F.col("_text").isNull(), "failed").when(text == "", "partial").otherwise("ok")
    made = record(page, F.col("path"), text, status, F.when(F.col("_text").isNull(), "not in snapshot").when(text == "", "empty text file"))
    names = {"owner": "github_owner", "repo": "github_repo", "branch": "github_branch", "path": "github_path", "_at": "raw_url"}
    found = files.select("source_id", *[v.alias(k) for k, v in made.items()], *[F.col(k).alias(v) for k, v in names.items()], F.left(F.sha2("path", 256), F.lit(10)).alias("id_suffix"), F.col("nth").cast("long").alias("place"))
    return found.unionByName(lost, allowMissingColumns=True)


def _body(rows: DataFrame, pages: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``_text``: the page at ``_at``, null where there is none."""
    got = pages(rows.select(F.col("_at").alias("url")).where("url is not null").distinct()).select(F.col("url").alias("_at"), F.col("html").alias("_text")).dropDuplicates(["_at"])
    return rows.join(got, "_at", "left")


def source_records(sources: DataFrame, pages: DataFrame | Callable[[DataFrame], DataFrame], extensions: Sequence[str] = EXTENSIONS, max_files: int = 200) -> DataFrame:
    """Records of the dispatched sources that aren't site crawls: ``family, source_id, url, source_name`` and own settings.

    Pages, repository files and repositories whose URL isn't one are read as plain pages; an unknown
    type is a failed record.
    """
    look = pages if callable(pages) else lambda urls: pages
    one = F.col("family")
    is_file, is_repo = github_file(F.col("url")).isNotNull(), github_repo(F.col("url")).isNotNull()
    plain = sources.where((one == "html") | ((one == "github_file") & ~is_file) | ((one == "github_repo") & ~is_repo))
    out = page_records(plain, look(plain.select("url").distinct()))
    files = sources.where((one == "github_file") & is_file)
    raw = files.select(github_file(F.col("url"))["raw_url"].alias("url")).distinct()
    out = out.unionByName(repository_file_records(files, look(raw).select("url", F.col("html").alias("text"))), allowMissingColumns=True)
    out = out.unionByName(repository_records(sources.where((one == "github_repo") & is_repo), look, extensions, max_files), allowMissingColumns=True)
    papers = sources.where(one == "pdf")
    bodies = look(papers.select("url").distinct())
    bodies = bodies.select("url", (F.col("body") if "body" in bodies.columns else F.lit(None).cast("binary")).alias("body")).dropDuplicates(["url"])
    out = out.unionByName(pdf_records(papers.join(bodies, "url", "left"), "url", "body"), allowMissingColumns=True)
    made = record(F.col("url"), F.col("source_name"), F.lit(""), F.lit("failed"), F.col("error"))
    unknown = sources.where(one.isNull()).select("source_id", *[v.alias(k) for k, v in made.items()])
    return out.unionByName(unknown, allowMissingColumns=True)


def repository_file_records(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Records of blob or raw URLs: ``source_id, url`` joined with ``url, text`` by raw URL; the record's URL is the page's."""
    f = sources.withColumn("f", github_file(F.col("url"))).where("f is not null")
    found = f.join(files.select(F.col("url").alias("_raw"), "text").dropDuplicates(["_raw"]), F.col("f.raw_url") == F.col("_raw"), "left")
    text = normalize_lines(F.col("text"))
    status = F.when(F.col("text").isNull(), "failed").when(text == "", "partial").otherwise("ok")
    made = record(F.col("f.page_url"), F.col("f.path"), text, status, F.when(F.col("text").isNull(), "not in snapshot").when(text == "", "empty text file"))
    return found.select("source_id", *[v.alias(k) for k, v in made.items()], F.col("f.owner").alias("github_owner"), F.col("f.repo").alias("github_repo"), F.col("f.branch").alias("github_branch"), F.col("f.path").alias("github_path"), F.col("f.raw_url").alias("raw_url"))


def pdf_text(data: bytes | None) -> tuple[str, str]:
    """``(text, error)``: pages under ``[Page i]`` marks, blank ones left out. Needs pypdf."""
    try:
        from pypdf import PdfReader
    except ImportError:
        return "", "pypdf is not installed"
    try:
        out = []
        for i, page in enumerate(PdfReader(io.BytesIO(data or b"")).pages, 1):
            try:
                text = page.extract_text() or ""
            except Exception as e:  # noqa: BLE001 - one bad page must not lose the others
                text = f"extraction failed: {e}"
            if text.strip():
                out.append(f"[Page {i}]\n{text}")
        return "\n\n".join(out), ""
    except Exception as e:  # noqa: BLE001 - a broken file is a failed record
        return "", f"{type(e).__name__}: {e}"


def pdf_records(files: DataFrame, url: str = "path", body: str = "content") -> DataFrame:
    """Records of PDF bytes, as a ``binaryFile`` scan gives them (``path, content``), with the bytes' SHA-256.

    ``partial`` without text, ``failed`` without bytes; ``source_id`` and ``source_name`` stay where present.
    """
    ship(files.sparkSession)
    kept = [c for c in ("source_id", "source_name") if c in files.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [("", "not in snapshot") if b is None else pdf_text(b) for b in batch["_body"]]
            yield batch[[*kept, "_url"]].assign(file_sha256=batch["_sha"], text=[p[0] for p in pairs], error=[p[1] for p in pairs])

    named = files.select(*kept, F.col(url).alias("_url"), F.col(body).alias("_body"), F.sha2(body, 256).alias("_sha"))
    read = named.mapInPandas(run, ", ".join([*(f"{c} string" for c in kept), "_url string, file_sha256 string, text string, error string"]))
    status = F.when(F.col("file_sha256").isNull(), "failed").when(F.trim("text") != "", "ok").otherwise("partial")
    title = F.regexp_extract("_url", "([^/]+)$", 1)
    title = F.coalesce(F.nullif(F.col("source_name"), F.lit("")), title) if "source_name" in kept else title
    made = record(F.col("_url"), title, F.col("text"), status, F.col("error"))
    return read.select(*[c for c in kept if c == "source_id"], "file_sha256", *[v.alias(k) for k, v in made.items()])
