"""Link, page and metadata scores as Column expressions. Sums are kept in whole hundredths, so they are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any, let, matched_words, strip, text_of
from .urls import parts

GOOD_WORDS = "account address allowance aml api approval block blocks bridge compliance consensus contract deposit developers docs fee fees gas liquidity mev mixer privacy protocol red-flag red-flags reference risk sanctions smart-contract smart-contracts staking swap token transaction transactions transfer wallet withdraw".split()
POOR_WORDS = "about author blog brand careers community contact cookie cookies events jobs log-in login media news newsletter partners press pricing privacy-policy privacy_preferences rss search sign-in sign-up signin signup sitemap subscribe tag terms".split()
TRUSTED = "developer docs official protocol standard".split()
DOMAINS = sorted("transaction_type transaction_feature risk_regulation chain_model basic_concept asset_profile".split())
NAVIGATION_TITLES = "learn docs resources developers documentation".split() + ["developer docs"]


def _list(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _clamp(hundredths: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), hundredths))


def _signed(label, hundredths: Column) -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    size = F.abs(hundredths)
    return F.concat(label, F.when(hundredths < 0, ":-").otherwise(":+"), _two_places(size))


def _two_places(hundredths: Column) -> Column:
    return F.concat((hundredths / 100).cast("int").cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))


def link_score(url: Column, anchor: Column, priority: Column, authority: Column, domain: Column, depth: Column, prefixes: Column | None = None, more_good: Column | None = None, more_poor: Column | None = None) -> Column:
    """struct(score in hundredths, reasons) of a discovered link."""
    full = F.lower(F.concat(url, F.lit(" "), text_of(anchor)))
    rank = F.upper(text_of(priority))
    parsed = parts(url)["path"]
    good = matched_words(full, F.concat(_list(GOOD_WORDS), F.coalesce(more_good, F.array().cast("array<string>"))) if more_good is not None else _list(GOOD_WORDS))
    poor = matched_words(full, F.concat(_list(POOR_WORDS), F.coalesce(more_poor, F.array().cast("array<string>"))) if more_poor is not None else _list(POOR_WORDS))
    by_rank = F.when(rank == "A", 8).when(rank == "B", 3).when(rank == "C", -4).otherwise(0)
    known = F.lower(text_of(domain))
    inside = F.exists(prefixes, lambda p: parsed.startswith(p)) if prefixes is not None else F.lit(False)
    steps = [
        (F.concat(F.lit("priority_"), rank), by_rank),
        (F.lit("trusted_authority"), F.when(contains_any(text_of(authority), TRUSTED), 5).otherwise(0)),
        (F.concat(F.lit("knowledge_domain_"), known), F.when(known.isin(DOMAINS), 3).otherwise(0)),
        (F.lit("inside_path_prefix"), F.when(F.coalesce(inside, F.lit(False)), 4).otherwise(0)),
        (F.concat(F.lit("positive_keywords("), F.array_join(F.slice(good, 1, 8), ","), F.lit(")")), F.least(F.lit(24), F.size(good) * 4)),
        (F.concat(F.lit("penalty_keywords("), F.array_join(F.slice(poor, 1, 8), ","), F.lit(")")), -F.least(F.lit(40), F.size(poor) * 8)),
        (F.concat(F.lit("depth_"), depth.cast("string")), -F.least(F.lit(20), F.greatest(depth, F.lit(0)) * 5)),
        (F.lit("non_seed_root_page"), F.when(parsed.isin("", "/") & (depth > 0), -10).otherwise(0)),
    ]
    total = F.lit(45)
    for _, value in steps:
        total = total + value
    total = _clamp(total)
    said = F.filter(F.array(*[F.when(v != 0, _signed(label, v)) for label, v in steps], F.concat(F.lit("final:"), _two_places(total))), lambda x: x.isNotNull())
    return F.struct(total.cast("int").alias("hundredths"), said.alias("reasons"))


def page_quality(title: Column, content: Column, html: Column, links: Column, least_chars: Column | int = 300) -> Column:
    """struct(score in hundredths, flags) of a page; ``links`` is its number of anchors with an href."""
    text = text_of(content)
    n = F.length(text)
    least = least_chars if isinstance(least_chars, Column) else F.lit(least_chars)
    marks = F.array(F.lower(F.concat(text_of(title), F.lit("\n"), text)), F.lower(text_of(html)))

    def words_in(t: Column) -> Column:
        """The word tests, in one pass over a text that is lower-cased once."""
        both, page = F.get(t, F.lit(0)), F.get(t, F.lit(1))
        tests = {
            "script": F.contains(both, F.lit("enable javascript")) | F.contains(page, F.lit("enable javascript")),
            "shell": contains_any(page, ["id='root'", 'id="root"', "id='__next'", 'id="__next"', "window.__"], lowered=True),
            "cookie": contains_any(both, ["consent", "cookies", "manage preferences", "privacy preferences"], lowered=True),
            "access": contains_any(both, ["too many requests", "request blocked", "forbidden", "captcha", "access denied"], lowered=True),
            "login": contains_any(both, ["login", "log in", "sign in"], lowered=True),
        }
        return F.struct(*[v.alias(k) for k, v in tests.items()])

    def line_counts(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))

    filled = F.filter(F.transform(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"), strip), lambda x: x != "")
    facts = let(F.struct(let(marks, words_in).alias("w"), let(filled, line_counts).alias("l"), n.alias("n"), (strip(text) == "").alias("blank")), lambda f: _judge(f, title, links, least))
    return facts


def _judge(f: Column, title: Column, links: Column, least: Column) -> Column:
    n, lines, blank, word = f["n"], f["l"], f["blank"], f["w"]
    named = F.lower(strip(text_of(title))).isin(NAVIGATION_TITLES)
    steps = [
        ("empty_content", blank, 90),
        ("content_too_short", ~blank & (n < least), 25),
        ("likely_js_shell", word["script"] | ((n < 200) & word["shell"]), 35),
        ("likely_cookie_or_consent_page", word["cookie"] & (n < 1200), 30),
        ("likely_access_denied", word["access"], 55),
        ("low_unique_line_ratio", (lines["n"] >= 20) & (lines["distinct"] / F.greatest(lines["n"], F.lit(1)) < 0.45), 15),
        ("too_many_links_low_text", (links >= 80) & (n / F.greatest(links, F.lit(1)) < 60), 20),
        ("likely_navigation_page", (named & (links >= 30) & (n < 2500)) | ((links >= 120) & (n < 4000)), 25),
        ("likely_login_page", word["login"], 25),
    ]
    total, flags = F.lit(100), []
    for name, test, cost in steps:
        total = total - F.when(test, cost).otherwise(0)
        flags.append(F.when(test, name))
    found = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return F.struct(_clamp(total).cast("int").alias("hundredths"), F.when(F.size(found) == 0, F.array(F.lit("ok"))).otherwise(found).alias("flags"))


def metadata_confidence(url: Column, title: Column, priority: Column, depth: Column, link_hundredths: Column) -> Column:
    """struct(confidence in hundredths, review): how far a page's inherited metadata can be trusted."""
    noisy = contains_any(F.concat(text_of(url), F.lit(" "), text_of(title)), ["/press", "/terms", "/career", "/news", "/blog", "privacy-policy"])
    weak = (link_hundredths < 60) & (depth > 0)
    base = F.when(depth <= 0, 100).when(depth == 1, 80).otherwise(60)
    sure = _clamp(base - F.when(noisy, 20).otherwise(0) - F.when(weak, 10).otherwise(0))
    review = (depth >= 2) | weak | ((F.upper(text_of(priority)) == "C") & (depth > 0)) | (sure < 70)
    return F.struct(sure.cast("int").alias("hundredths"), review.alias("review"))
