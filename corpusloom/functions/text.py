"""Text functions as Column expressions: stripping, coalescing of falsy values, normalisation, lists, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip removes: Unicode white space and the four ASCII separators.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """A set of characters trimmed from both ends; no regular expression is run."""
    return F.btrim(c, F.lit(SPACES))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(c: Column) -> Column:
    """The value as text, null as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor the empty text (``a or b or ...``)."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns])


def first_nonzero(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c.cast("long"), F.lit(0).cast("long")) for c in columns])


def or_default(c: Column, default: str = "") -> Column:
    """Stripped text, or the default where nothing is left."""
    return F.coalesce(F.nullif(strip(c.cast("string")), F.lit("")), F.lit(default))


def newlines(c: Column) -> Column:
    """Text with newlines for all line ends, blanks for hard ones, and no zero-width ones."""
    c = F.replace(F.replace(text_of(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), F.lit("\u200b"), F.lit(""))


def normalize_lines(c: Column) -> Column:
    """Stripped, non-blank lines; of equal neighbours one stays."""
    lines = F.split(F.regexp_replace(newlines(c), r"[ \t\x0B\f]+", " "), "\n")
    filled = F.filter(F.transform(lines, strip), lambda x: x != "")
    # bound once: a name inside the lambda would be computed again for every line
    kept = let(filled, lambda lines: F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1))))
    return F.array_join(kept, "\n")


def normalize_export(c: Column) -> Column:
    """Spaces and tabs squeezed, at most one blank line in a row, ends stripped."""
    squeezed = F.regexp_replace(newlines(c), r"[ \t]+", " ")
    return strip(F.regexp_replace(squeezed, r"\n{3,}", "\n\n"))


def meta_value(c: Column) -> Column:
    """A text value on one line."""
    return strip(F.replace(F.replace(text_of(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" ")))


def meta_list(c: Column) -> Column:
    """A list value on one line, joined by a bar."""
    parts = F.filter(F.transform(c, lambda x: strip(x.cast("string"))), lambda x: x != "")
    return F.coalesce(F.array_join(parts, " | "), F.lit(""))


def sanitize_id(c: Column, fallback: str = "DOC") -> Column:
    squeezed = F.regexp_replace(F.regexp_replace(or_default(c, fallback), r"[^0-9a-zA-Z_\-]+", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(squeezed, "^_+|_+$", ""), F.lit("")), F.lit(fallback))


def _pieces(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def split_list(c: Column) -> Column:
    """A delimited text as a list: any run of , ; | and their full-width forms splits."""
    return _pieces(F.split(text_of(c), "[,;|，；、]+"))


def as_list(c: Column) -> Column:
    """A list field read as text: a JSON list as it is, else split as :func:`split_list` does."""
    loaded = F.from_json(strip(text_of(c)), "array<string>", {"mode": "PERMISSIVE"})
    return F.when(strip(text_of(c)).startswith("[") & loaded.isNotNull(), _pieces(loaded)).otherwise(split_list(c))


def parse_list(c: Column) -> Column:
    """A list kept as text: JSON if bracketed, else split on the first separator present of | ； ; ， and comma."""
    s = strip(text_of(c))
    loaded = F.from_json(s, "array<string>", {"mode": "PERMISSIVE"})
    split = F.array(s)
    for sep in (",", "，", ";", "；", "|"):
        split = F.when(F.contains(s, F.lit(sep)), _pieces(F.split(s, f"\\{sep}" if sep == "|" else sep))).otherwise(split)
    return F.when(s == "", F.array().cast("array<string>")).when(s.startswith("[") & s.endswith("]") & loaded.isNotNull(), _pieces(loaded)).otherwise(split)


def tag_list(c: Column) -> Column:
    """Tags as a list: a JSON list as it is, another JSON value as one tag, else split at any of ; , and |."""
    s = text_of(c)
    loaded = F.from_json(strip(s), "array<string>", {"mode": "PERMISSIVE"})
    scalar = strip(s).rlike(r'^("([^"\\]|\\.)*"|-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false|null|\{.*\})$')
    split = F.when(scalar, F.array(s)).otherwise(F.split(s, r"\s*[;,|]\s*"))
    tags = F.when(strip(s).startswith("[") & loaded.isNotNull(), loaded).otherwise(split)
    return F.when(strip(s) == "", F.array().cast("array<string>")).otherwise(_pieces(tags))


def whole_number(c: Column) -> Column:
    """A text as a whole number, also one with a fraction, which is cut; else null."""
    s = strip(c.cast("string"))
    cut = F.when(s.rlike(r"^[+-]?\d+\.\d*([eE][+-]?\d+)?$"), s.try_cast("double").try_cast("bigint"))
    return F.coalesce(s.try_cast("bigint"), cut)


def contains_any(c: Column, words: Sequence[str], lowered: bool = False) -> Column:
    """Whether any non-blank word occurs, in any case. Constant words become one folded chain of tests."""
    low = c if lowered else F.lower(c)
    found = [F.contains(low, F.lit(w.lower())) for w in words if w.strip()]
    out = F.lit(False)
    for f in found:
        out = out | f
    return out


def matched_words(c: Column, words: Column) -> Column:
    """The distinct words that occur in an already lower-cased text, sorted."""
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (w != "") & F.contains(c, F.lower(w)))))


def safe_name_from_url(url: Column, netloc: Column, path: Column, suffix: str = ".txt", prefix: Column | None = None) -> Column:
    raw = F.coalesce(F.nullif(F.regexp_replace(F.concat(netloc, path), "^/+|/+$", ""), F.lit("")), F.lit("index"))
    return _named(F.substring(F.regexp_replace(raw, "[^0-9a-zA-Z._-]+", "_"), 1, 120), url, suffix, prefix)


def safe_name_from_path(path: Column, suffix: str = ".txt", prefix: Column | None = None) -> Column:
    raw = F.replace(F.regexp_replace(path, "^/+|/+$", ""), F.lit("/"), F.lit("__"))
    raw = F.regexp_replace(F.coalesce(F.nullif(raw, F.lit("")), F.lit("index")), "[^0-9a-zA-Z._-]+", "_")
    return _named(F.right(raw, F.lit(140)), path, suffix, prefix)


def _named(raw: Column, key: Column, suffix: str, prefix: Column | None) -> Column:
    tail = suffix if suffix.startswith(".") else f".{suffix}"
    head = F.lit("") if prefix is None else F.when(text_of(prefix) == "", "").otherwise(F.concat(F.substring(F.regexp_replace(strip(prefix), "[^0-9a-zA-Z._-]+", "_"), 1, 60), F.lit("__")))
    return F.concat(head, raw, F.lit("_"), F.left(F.sha2(key, 256), F.lit(12)), F.lit(tail))


def unique_line_ratio(c: Column) -> Column:
    lines = _pieces(F.split(F.regexp_replace(text_of(c), "\r\n?", "\n"), "\n"))
    return F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))
