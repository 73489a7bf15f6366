"""URL functions. Absolute URLs are handled by native expressions, relative references by an Arrow UDF."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urldefrag, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import contains_any, strip, text_of

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
BLOCKED_EXTENSIONS = tuple(f".{x}" for x in "7z css csv doc docx gif gz ico jpeg jpg js json mp3 mp4 pdf png ppt pptx rar svg tar wasm webp woff woff2 xlsx xml zip".split())


def parts(url: Column) -> dict[str, Column]:
    """Scheme, host, path and query of a URL by the generic syntax; empty where missing."""
    return {name: F.regexp_extract(url, _PARTS, i) for i, name in enumerate(("scheme", "netloc", "path", "query"), 1)}


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no utm_ parameters, query encoded anew, no slashes at the end, no fragment."""
    u = strip(text_of(url))
    p = parts(u)

    def again(x: Column) -> Column:
        plain = F.replace(x, F.lit("+"), F.lit(" "))
        coded = F.url_encode(F.coalesce(F.try_url_decode(x), plain))
        return F.replace(F.replace(coded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    pairs = F.filter(F.split(p["query"], "&"), lambda x: x != "")
    pairs = F.transform(pairs, lambda x: F.concat(again(F.substring_index(x, "=", 1)), F.lit("="), again(F.when(F.contains(x, F.lit("=")), _after(x)).otherwise(""))))
    query = F.array_join(F.filter(pairs, lambda x: ~F.lower(x).startswith("utm_")), "&")
    path = F.when(p["path"] == "/", "/").otherwise(F.regexp_replace(p["path"], "/+$", ""))
    scheme = F.when(p["scheme"] == "", "").otherwise(F.concat(F.lower(p["scheme"]), F.lit(":")))
    host = F.when(p["netloc"] == "", "").otherwise(F.concat(F.lit("//"), F.lower(p["netloc"])))
    return F.concat(scheme, host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _after(x: Column) -> Column:
    """What follows the first equals sign."""
    return F.substr(x, F.instr(x, F.lit("=")) + 1)


def normalize_reference(url: str | None, base: str | None = None) -> str | None:
    """An href as an absolute http(s) URL without fragment and without one slash at the end; else None."""
    text = "" if url is None else str(url).strip()
    if not text or text.startswith(("mailto:", "javascript:", "tel:", "data:")):
        return None
    try:
        text = urldefrag(urljoin(base, text) if base else text)[0]
        seen = urlparse(text)
    except ValueError:
        return None
    if seen.scheme not in ("http", "https"):
        return None
    return text[:-1] if text.endswith("/") and seen.path not in ("", "/") else text


@F.pandas_udf(StringType())
def normalize_url(url: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([normalize_reference(u, b) for u, b in zip(url, base, strict=True)], dtype=object)


def admission(url: Column, deny_extensions: Sequence[str] = BLOCKED_EXTENSIONS, strict_deny: bool = True, own_deny: Column | None = None) -> Column:
    """Why a crawl rejects a normalised URL, or null. With ``strict_deny`` an extension anywhere in the URL rejects, too.

    ``own_deny``, a list column, takes the place of the extensions in rows where it isn't empty.
    """
    if own_deny is not None:
        ends = F.transform(own_deny, lambda e: F.lower(F.when(e.startswith("."), e).otherwise(F.concat(F.lit("."), e))))
        ended, held = F.exists(ends, lambda e: F.lower(parts(url)["path"]).endswith(e)), F.exists(ends, lambda e: F.contains(F.lower(url), e))
        own = F.when(url.isNull(), "invalid_url").when(ended, "blocked_extension").when(held & F.lit(strict_deny), "deny_url_pattern")
        return F.when(F.coalesce(F.size(own_deny) > 0, F.lit(False)), own).otherwise(admission(url, deny_extensions, strict_deny))
    exts = [e.lower() if e.startswith(".") else f".{e.lower()}" for e in deny_extensions]
    path = F.lower(parts(url)["path"])
    blocked = F.lit(False)
    for e in exts:
        blocked = blocked | path.endswith(e)
    why = F.when(url.isNull(), "invalid_url").when(blocked, "blocked_extension")
    return why.when(contains_any(url, exts), "deny_url_pattern") if strict_deny else why


def admission_by_prefix(url: Column, seed: Column, prefix: Column, same_domain: Column, extensions: Sequence[str] = BLOCKED_EXTENSIONS) -> Column:
    """The older rule, as a boolean: same host unless switched off, path prefix if given, extension not blocked."""
    p, s = parts(url), parts(seed)
    path = F.lower(p["path"])
    ok = url.isNotNull() & (~F.coalesce(same_domain, F.lit(True)) | (p["netloc"] == s["netloc"]))
    ok = ok & ((text_of(prefix) == "") | p["path"].startswith(prefix))
    for e in extensions:
        ok = ok & ~path.endswith(e)
    return ok


def github_repo(url: Column) -> Column:
    """struct(owner, repo) of a repository page, else null."""
    p = parts(url)
    seg = F.filter(F.split(p["path"], "/"), lambda x: x != "")
    owner, repo = F.get(seg, F.lit(0)), F.get(seg, F.lit(1))
    good = (F.lower(p["netloc"]) == "github.com") & (F.size(seg) >= 2) & ~owner.isin("orgs", "marketplace", "topics") & ~repo.isin("issues", "pulls")
    return F.when(good, F.struct(owner.alias("owner"), repo.alias("repo")))


def github_file(url: Column) -> Column:
    """struct(owner, repo, branch, path, raw_url, page_url) of a blob or raw URL, else null."""
    p = parts(url)
    host = F.lower(p["netloc"])
    seg = F.filter(F.split(p["path"], "/"), lambda x: x != "")
    blob = (host == "github.com") & (F.size(seg) >= 5) & (F.get(seg, F.lit(2)) == "blob")
    raw = (host == "raw.githubusercontent.com") & (F.size(seg) >= 4)
    owner, repo = F.get(seg, F.lit(0)), F.get(seg, F.lit(1))
    branch = F.when(blob, F.get(seg, F.lit(3))).otherwise(F.get(seg, F.lit(2)))
    path = F.array_join(F.filter(seg, lambda x, i: F.when(blob, i >= 4).otherwise(i >= 3)), "/")
    raw_url = F.when(raw, url).otherwise(F.concat(F.lit("https://raw.githubusercontent.com/"), owner, F.lit("/"), repo, F.lit("/"), branch, F.lit("/"), path))
    page = F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo, F.lit("/blob/"), branch, F.lit("/"), path)
    fields = {"owner": owner, "repo": repo, "branch": branch, "path": path, "raw_url": raw_url, "page_url": page}
    return F.when(blob | raw, F.struct(*[v.alias(k) for k, v in fields.items()]))
