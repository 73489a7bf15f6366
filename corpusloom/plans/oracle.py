"""DuckDB SQL with the results that the catalog's queries must have, written from the rules, not from the plans."""

from __future__ import annotations

from ..functions import scoring as S
from ..functions.urls import BLOCKED_EXTENSIONS
from ..operators import export as E
from ..operators import filtering as R
from .adapters import CHUNKS_CTE, records_cte


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(map(_q, values))})"


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {_q(w)})" for w in words) + ")"


EFFECTIVE = "CASE WHEN coalesce(char_count, 0) <> 0 THEN char_count ELSE length(content) END"
HARD = f"CASE WHEN status IS DISTINCT FROM 'ok' THEN 'status_not_ok' WHEN trim(coalesce(content, ''), ' ' || chr(9) || chr(10)) = '' THEN 'empty_content' WHEN {EFFECTIVE} < 500 THEN 'char_count_lt_500' END"
PATH = "lower(coalesce(nullif(github_path, ''), nullif(url, ''), ''))"
TOPIC = " + ".join(f"CASE WHEN contains({PATH}, {_q(w)}) OR contains(lower(coalesce(title, '')), {_q(w)}) THEN 2 ELSE 0 END" for w in R.VALUED)
TOPIC += f" - CASE WHEN contains({PATH}, 'testnet') THEN 2 ELSE 0 END - CASE WHEN {_any(PATH, ['install', 'security', 'privatekeynotes'])} THEN 1 ELSE 0 END - CASE WHEN starts_with({PATH}, 'src/') THEN 2 ELSE 0 END"
PRIORITY = "CASE source_priority WHEN 'A' THEN 3 WHEN 'B' THEN 2 WHEN 'C' THEN 1 ELSE 0 END"
LOW_TEXT = "lower(concat_ws(' ', coalesce(url, ''), coalesce(raw_url, ''), coalesce(seed_url, ''), coalesce(title, ''), coalesce(github_path, ''), coalesce(source_name, ''), coalesce(notes, '')))"
LOW = "CASE " + " ".join(f"WHEN regexp_matches({LOW_TEXT}, {_q(p)}) THEN {_q('low_value_' + n)}" for n, p in R.LOW_VALUE) + " END"
BEST = "p DESC, t DESC, s DESC, ln DESC, ord"


def _ready(variant: str) -> str:
    """Records past the hard rules, with rank columns p, t, s, ln and the canonical URL of the adapter's forms."""
    return f"""WITH {records_cte(variant)},
judged AS (SELECT *, {HARD} AS hard, {EFFECTIVE} AS eff, regexp_replace(regexp_replace(url, '[?]utm_source=feed$', ''), '/+$', '') AS eu,
  {PRIORITY} AS p, {TOPIC} AS t, least(coalesce(char_count, 0), 80000) AS s, -coalesce(_line_number, 0) AS ln, {LOW} AS low FROM records),
ready AS (SELECT * FROM judged WHERE hard IS NULL)"""


def _decided(variant: str) -> str:
    return _ready(variant) + f""",
u AS (SELECT *, row_number() OVER (PARTITION BY eu ORDER BY {BEST}) AS ur FROM ready),
h AS (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY {BEST}) AS hr FROM u WHERE ur = 1),
g0 AS (SELECT * FROM h WHERE hr = 1 AND low IS NULL),
m1 AS (SELECT *, lower(coalesce(github_owner, '')) = 'dogecoin' AND lower(coalesce(github_repo, '')) = 'dogecoin' AS hit FROM g0),
c1 AS (SELECT *, CASE WHEN hit THEN row_number() OVER (PARTITION BY hit ORDER BY {BEST}) END AS r1 FROM m1),
g1 AS (SELECT * EXCLUDE (p), CASE WHEN r1 <= 12 THEN 1 ELSE p END AS p FROM c1),
m2 AS (SELECT * EXCLUDE (hit), lower(coalesce(github_owner, '')) = 'binance' AND lower(coalesce(github_repo, '')) = 'binance-spot-api-docs' AS hit FROM g1),
c2 AS (SELECT *, CASE WHEN hit THEN row_number() OVER (PARTITION BY hit ORDER BY {BEST}) END AS r2 FROM m2),
g2 AS (SELECT * EXCLUDE (p), CASE WHEN r2 <= 20 THEN 1 ELSE p END AS p FROM c2),
m3 AS (SELECT * EXCLUDE (hit), contains(lower(concat_ws(' ', coalesce(url, ''), coalesce(seed_url, ''), coalesce(source_name, ''))), 'okx.com') AS hit FROM g2),
c3 AS (SELECT *, CASE WHEN hit THEN row_number() OVER (PARTITION BY hit ORDER BY {BEST}) END AS r3 FROM m3),
capped AS (SELECT *, concat_ws(',', CASE WHEN r1 > 12 THEN 'source_limit_exceeded_doge_github' END, CASE WHEN r2 > 20 THEN 'source_limit_exceeded_binance_github' END, CASE WHEN r3 > 10 THEN 'source_limit_exceeded_okx_api' END) AS why,
  CASE WHEN r1 <= 12 OR r2 <= 20 OR r3 <= 10 THEN 'C' ELSE source_priority END AS final_priority FROM c3),
decided AS (
  SELECT doc_id, hard AS reasons FROM judged WHERE hard IS NOT NULL
  UNION ALL SELECT doc_id, 'duplicate_url' FROM u WHERE ur > 1
  UNION ALL SELECT doc_id, 'duplicate_content_hash' FROM h WHERE hr > 1
  UNION ALL SELECT doc_id, low FROM h WHERE hr = 1 AND low IS NOT NULL
  UNION ALL SELECT doc_id, why FROM capped)"""


def _meta(c: str) -> str:
    return f"trim(replace(replace(coalesce(CAST({c} AS VARCHAR), ''), chr(10), ' '), chr(13), ' '))"


CEX = f"(lower({_meta('source_authority')}) = 'exchange_api' OR lower({_meta('knowledge_category')}) = 'cex_deposit_withdrawal' OR lower({_meta('chain')}) = 'off-chain/cex' OR lower({_meta('asset_type')}) = 'exchange' OR {_any('lower(' + _meta('source_name') + ')', E.EXCHANGES)})"
RISK = f"({_in('lower(' + _meta('knowledge_domain') + ')', E.RISK_DOMAINS)} OR {_in('lower(' + _meta('knowledge_category') + ')', E.RISK_CATEGORIES)} OR {_in('lower(' + _meta('source_authority') + ')', E.RISK_AUTHORITIES)} OR {_any(_meta('level_1'), E.RISK_LEVELS)})"
LIBRARY = f"CASE WHEN {CEX} THEN 'cex' WHEN {RISK} THEN 'risk' WHEN {_in('lower(' + _meta('knowledge_domain') + ')', E.CORE_DOMAINS)} THEN 'protocol' END"
NORMAL = r"trim(regexp_replace(regexp_replace({c}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))"
BALANCED = f""",
named AS (SELECT *, {LIBRARY} AS library FROM chunks),
cex AS (SELECT *, CASE upper(source_priority) WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 ELSE 9 END AS pr FROM named WHERE library = 'cex'),
per_doc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pr, doc_id, chunk_index, ord) AS n FROM cex) WHERE n <= 40),
best AS (SELECT * FROM per_doc ORDER BY pr, doc_id, chunk_index, ord LIMIT 250),
balanced AS (SELECT chunk_id FROM named WHERE library IN ('protocol', 'risk') UNION SELECT chunk_id FROM best)"""
DIST = ["level_1", "knowledge_domain", "knowledge_category", "coin", "chain", "source_priority", "crawl_type", "source_authority"]
LIB_FIELDS = ["source_priority", "level_1", "knowledge_domain", "crawl_type", "coin", "chain", "source_name"]
SEEDS = """WITH seeds AS (SELECT doc_id AS ord, concat('S', doc_id) AS id, CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'b' ELSE 'C' END AS source_priority, lang AS level_1, doc_id % 9 <> 0 AS crawl_enabled,
  CASE doc_id % 6 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' WHEN 2 THEN 'html_crawl' WHEN 3 THEN 'github_repo' WHEN 4 THEN 'github_markdown' ELSE 'ftp' END AS crawl_type FROM documents)"""
LINKS = """WITH links AS (SELECT doc_id, concat('https://', source, '.example.org/', CASE doc_id % 8 WHEN 0 THEN 'docs/api/' WHEN 1 THEN 'blog/news' WHEN 2 THEN 'file.PDF' WHEN 3 THEN 'next.js/intro' WHEN 4 THEN 'wallet/fees/gas' WHEN 5 THEN 'login' WHEN 6 THEN '' ELSE 'a' END) AS url,
  CASE doc_id % 3 WHEN 0 THEN 'Token transfer' WHEN 1 THEN 'Sign up' ELSE '' END AS anchor, CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS priority,
  CASE WHEN doc_id % 5 = 0 THEN 'official site' ELSE '' END AS authority, CASE WHEN doc_id % 6 = 0 THEN 'chain_model' ELSE 'misc' END AS domain, CAST(doc_id % 4 AS INT) AS depth FROM documents)"""


def _hits(words) -> str:
    return f"list_sort(list_filter([{', '.join(map(_q, words))}], lambda w: contains(full_text, w)))"


LINK_SQL = LINKS + f""",
a AS (SELECT *, lower(url || ' ' || anchor) AS full_text FROM links),
b AS (SELECT *, {_hits(S.GOOD_WORDS)} AS good, {_hits(S.POOR_WORDS)} AS poor FROM a),
c AS (SELECT *, CASE priority WHEN 'A' THEN 8 WHEN 'B' THEN 3 WHEN 'C' THEN -4 ELSE 0 END AS v1, CASE WHEN authority <> '' THEN 5 ELSE 0 END AS v2, CASE WHEN domain = 'chain_model' THEN 3 ELSE 0 END AS v3,
  least(24, 4 * len(good)) AS v4, -least(40, 8 * len(poor)) AS v5, -least(20, 5 * depth) AS v6, CASE WHEN depth > 0 AND doc_id % 8 = 6 THEN -10 ELSE 0 END AS v7 FROM b),
d AS (SELECT *, greatest(0, least(100, 45 + v1 + v2 + v3 + v4 + v5 + v6 + v7)) AS total FROM c)
SELECT doc_id, CAST(total AS INT) AS score_hundredths, concat_ws(' ',
  CASE WHEN v1 <> 0 THEN 'priority_' || priority || CASE WHEN v1 < 0 THEN ':-' ELSE ':+' END || printf('0.%02d', abs(v1)) END,
  CASE WHEN v2 <> 0 THEN 'trusted_authority:+0.05' END, CASE WHEN v3 <> 0 THEN 'knowledge_domain_chain_model:+0.03' END,
  CASE WHEN v4 <> 0 THEN 'positive_keywords(' || array_to_string(good[1:8], ',') || '):+' || printf('0.%02d', v4) END,
  CASE WHEN v5 <> 0 THEN 'penalty_keywords(' || array_to_string(poor[1:8], ',') || '):-' || printf('0.%02d', -v5) END,
  CASE WHEN v6 <> 0 THEN 'depth_' || depth || ':-' || printf('0.%02d', -v6) END, CASE WHEN v7 <> 0 THEN 'non_seed_root_page:-0.10' END,
  'final:' || printf('%d.%02d', total // 100, total % 100)) AS reasons FROM d"""

PAGE_SQL = """WITH p AS (SELECT doc_id, text AS content, CASE doc_id % 6 WHEN 0 THEN 'Docs' WHEN 1 THEN 'Access denied' WHEN 2 THEN 'Sign in' ELSE 'Page' END AS title,
  CASE doc_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS page, CAST(doc_id % 150 AS INT) AS links FROM documents),
q AS (SELECT *, lower(title || chr(10) || content) AS both_text, length(content) AS n, list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM p),
f AS (SELECT *, [
  CASE WHEN trim(content) = '' THEN 'empty_content' END, CASE WHEN trim(content) <> '' AND n < 300 THEN 'content_too_short' END,
  CASE WHEN contains(both_text, 'enable javascript') OR page = 2 OR (page = 1 AND n < 200) THEN 'likely_js_shell' END,
  CASE WHEN n < 1200 AND (contains(both_text, 'cookies') OR contains(both_text, 'privacy preferences') OR contains(both_text, 'consent') OR contains(both_text, 'manage preferences')) THEN 'likely_cookie_or_consent_page' END,
  CASE WHEN contains(both_text, 'access denied') OR contains(both_text, 'forbidden') OR contains(both_text, 'captcha') OR contains(both_text, 'too many requests') OR contains(both_text, 'request blocked') THEN 'likely_access_denied' END,
  CASE WHEN len(lines) >= 20 AND len(list_distinct(lines)) / len(lines)::DOUBLE < 0.45 THEN 'low_unique_line_ratio' END,
  CASE WHEN links >= 80 AND n / links::DOUBLE < 60 THEN 'too_many_links_low_text' END,
  CASE WHEN (title = 'Docs' AND links >= 30 AND n < 2500) OR (links >= 120 AND n < 4000) THEN 'likely_navigation_page' END,
  CASE WHEN contains(both_text, 'sign in') OR contains(both_text, 'log in') OR contains(both_text, 'login') THEN 'likely_login_page' END] AS raw FROM q),
g AS (SELECT doc_id, list_filter(raw, lambda x: x IS NOT NULL) AS flags FROM f)
SELECT doc_id, CAST(greatest(0, 100 - coalesce(list_sum(list_transform(flags, lambda x: CASE x WHEN 'empty_content' THEN 90 WHEN 'likely_js_shell' THEN 35 WHEN 'likely_cookie_or_consent_page' THEN 30 WHEN 'likely_access_denied' THEN 55
  WHEN 'low_unique_line_ratio' THEN 15 WHEN 'too_many_links_low_text' THEN 20 ELSE 25 END)), 0)) AS INT) AS score_hundredths, CASE WHEN len(flags) = 0 THEN 'ok' ELSE array_to_string(flags, ',') END AS flags FROM g"""


def oracle_sql() -> dict[str, str]:
    block_header = ", ".join(f"CASE WHEN {_meta(c)} <> '' THEN '[{c}=' || {_meta(c)} || ']' END" for c in E.HEADER if c not in ("source_type", "topic_tags"))
    dist = " UNION ALL ".join(f"SELECT '{f}' AS field, coalesce(nullif(trim({f}), ''), 'N/A') AS key, ord FROM chunks" for f in DIST)
    lib = " UNION ALL ".join(f"SELECT library, '{f}' AS field, coalesce(nullif(trim({f}), ''), '<EMPTY>') AS key, ord FROM both_libs" for f in LIB_FIELDS)
    exts = " OR ".join(f"ends_with(lower(url), '{e}')" for e in BLOCKED_EXTENSIONS)
    clean_url = r"regexp_replace(regexp_replace({u}, '#.*$', ''), '[?&]utm_[^&]*', '', 'g')"
    by_field = " UNION ALL ".join(f"SELECT 'final_by_{c}' AS section, coalesce({e}, 'None') AS key, count(*) AS n FROM capped WHERE why = '' GROUP BY ALL" for c, e in (("level_1", "level_1"), ("source_priority", "final_priority"), ("crawl_type", "crawl_type")))
    summary = " UNION ALL ".join(f"SELECT '{c}' AS section, coalesce({c}, 'None') AS key, count(*) AS n FROM records GROUP BY ALL" for c in ("status", "crawl_type", "source_priority", "knowledge_domain", "level_1"))
    squeezed = r"list_filter(list_transform(string_split(regexp_replace(replace(text, chr(13), chr(10)), '[ \t\v\f]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    block_parts = f"b AS (SELECT chunk_id, ord, {LIBRARY} AS library, concat_ws(chr(10), {block_header}) AS head, {_meta('title')} AS t, trim({NORMAL.format(c='chunk_text')}) AS body, 'Document metadata: coin=' || coalesce(coin, '') || '; chain=' || coalesce(chain, '') || '; domain=' || coalesce(knowledge_domain, '') || '; category=' || coalesce(knowledge_category, '') || '; source=' || source_name || '; url=' || url || '.' AS hint FROM chunks)"
    block_text = f"concat_ws(chr(10), head, hint, 'Title: ' || t, nullif(body, '')) || chr(10) || '{E.DELIMITER}' || chr(10)"
    return {
        "chunk_skips": f"WITH {records_cte()}" + r""", split AS (SELECT doc_id, ord, list_transform(string_split(regexp_replace(replace(replace(replace(replace(trim(coalesce(content, '')), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(8203), ''), chr(160), ' '), '[ \t\v\f]+', ' ', 'g'), chr(10)), lambda x: trim(x)) AS l FROM records),
            flat AS (SELECT doc_id, ord, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM split),
            told AS (SELECT *, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY ord ORDER BY i) AS blanks FROM flat),
            fresh AS (SELECT * FROM (SELECT *, lag(line) OVER (PARTITION BY ord ORDER BY i) AS before FROM told WHERE line <> '') WHERE before IS NULL OR before <> line),
            glue AS (SELECT ord, length(line) + CASE WHEN lag(blanks) OVER w IS NULL THEN 0 WHEN blanks > lag(blanks) OVER w THEN 2 ELSE 1 END AS n FROM fresh WINDOW w AS (PARTITION BY ord ORDER BY i)),
            sized AS (SELECT doc_id, coalesce((SELECT sum(n) FROM glue WHERE glue.ord = split.ord), 0) AS n FROM split)
            SELECT doc_id, CASE WHEN n = 0 THEN 'empty_content' ELSE 'doc_too_short' END AS reason, CAST(CASE WHEN n > 0 THEN n END AS INT) AS char_count FROM sized WHERE n < 500""",
        "part_packing": f"WITH RECURSIVE {CHUNKS_CTE}, {block_parts}" + f""", s AS MATERIALIZED (SELECT library, ord, row_number() OVER (PARTITION BY library ORDER BY ord) AS rn, octet_length(encode({block_text})) + 1 AS size FROM b WHERE library IS NOT NULL),
            c AS (SELECT *, sum(size) OVER (PARTITION BY library ORDER BY rn) AS upto FROM s),
            leap AS MATERIALIZED (SELECT library, rn, rn + count(*) OVER (PARTITION BY library ORDER BY upto RANGE BETWEEN CURRENT ROW AND greatest(0, 200000 - size) FOLLOWING) AS nxt FROM c),
            starts AS (SELECT library, 1::BIGINT AS rn, 1::BIGINT AS part FROM s GROUP BY library UNION ALL SELECT l.library, l.nxt, starts.part + 1 FROM starts JOIN leap l ON l.library = starts.library AND l.rn = starts.rn)
            SELECT s.library, s.ord, max(starts.part) AS part FROM s JOIN starts ON starts.library = s.library AND starts.rn <= s.rn GROUP BY s.library, s.ord""",
        "hard_filter_reasons": f"WITH {records_cte()} SELECT doc_id, coalesce({HARD}, 'kept') AS reason, {EFFECTIVE} AS effective_char_count FROM records",
        "url_dedup_keep_best": _ready("records_recrawl") + f" SELECT doc_id, eu AS effective_url, CASE WHEN row_number() OVER w = 1 THEN 'kept' ELSE 'duplicate_url' END AS decision, first_value(doc_id) OVER w AS kept_doc_id FROM ready WINDOW w AS (PARTITION BY eu ORDER BY {BEST})",
        "content_dedup_keep_best": _ready("records_ok") + f" SELECT doc_id, CASE WHEN row_number() OVER w = 1 THEN 'kept' ELSE 'duplicate_content_hash' END AS decision, first_value(doc_id) OVER w AS kept_doc_id, count(*) OVER (PARTITION BY content_hash) - 1 AS n_removed FROM ready WINDOW w AS (PARTITION BY content_hash ORDER BY {BEST})",
        "dedup_backrefs": _ready("records_recrawl") + f" SELECT list(doc_id ORDER BY {BEST})[1] AS doc_id, array_to_string(list(doc_id ORDER BY ord)[2:], ',') AS merged_doc_ids, array_to_string(list(url ORDER BY {BEST})[2:], ',') AS duplicate_urls, count(*) - 1 AS n_removed FROM ready GROUP BY eu HAVING count(*) > 1",
        "topic_tag_merge": _ready("records_ok") + ", t AS (SELECT content_hash, unnest([level_1, level_2, level_1 || '/' || level_2]) AS tag FROM ready WHERE content_hash IN (SELECT content_hash FROM ready GROUP BY content_hash HAVING count(*) > 1)) SELECT content_hash AS effective_content_hash, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags, CAST(count(DISTINCT tag) AS INT) AS topic_count FROM t GROUP BY content_hash",
        "low_value_reasons": f"WITH {records_cte()} SELECT doc_id, coalesce({LOW}, 'none') AS reason FROM records",
        "source_caps": _decided("records_ok") + " SELECT doc_id, CASE WHEN why = '' THEN 'kept' ELSE why END AS decision, CASE WHEN why <> '' THEN '' WHEN r3 IS NOT NULL THEN 'okx_api' WHEN r2 IS NOT NULL THEN 'binance_github' WHEN r1 IS NOT NULL THEN 'doge_github' ELSE '' END AS source_limit_group, CASE WHEN why <> '' THEN '' ELSE final_priority END AS source_priority, CASE WHEN why <> '' OR coalesce(r1, r2, r3) IS NULL THEN '' WHEN (r1 IS NOT NULL)::INT + (r2 IS NOT NULL)::INT + (r3 IS NOT NULL)::INT > 1 THEN 'C' ELSE source_priority END AS source_priority_original FROM capped",
        "filtered_corpus": _decided("records") + " SELECT doc_id, url, level_1, level_2, final_priority AS source_priority, eff AS effective_char_count, row_number() OVER (ORDER BY coalesce(level_1, 'None'), coalesce(level_2, 'None'), coalesce(url, 'None'), ord) AS filter_run_order FROM capped WHERE why = ''",
        "filter_decisions": _decided("records_recrawl") + " SELECT doc_id, CASE WHEN reasons = '' THEN 'kept' ELSE 'removed' END AS filter_decision, reasons FROM decided",
        "filter_stats": _decided("records") + f""", flat AS (SELECT unnest(string_split(reasons, ',')) AS key FROM decided WHERE reasons <> '')
            SELECT 'removed_by_reason' AS section, key, count(*) AS n FROM flat GROUP BY key UNION ALL {by_field}
            UNION ALL SELECT 'totals', 'input_records', count(*) FROM decided UNION ALL SELECT 'totals', 'final_records', count(*) FROM capped WHERE why = '' UNION ALL SELECT 'totals', 'removed_records', count(*) FROM flat
            UNION ALL SELECT 'totals', 'unique_urls_final', count(DISTINCT eu) FROM capped WHERE why = '' UNION ALL SELECT 'totals', 'unique_content_hashes_final', count(DISTINCT content_hash) FROM capped WHERE why = ''""",
        "frequency_most_common": f"WITH {CHUNKS_CTE} SELECT level_2 AS key, count(*) AS n, min(ord) AS first_ord FROM chunks GROUP BY 1",
        "field_distributions": f"WITH {CHUNKS_CTE}, flat AS ({dist}) SELECT field, key, count(*) AS n, min(ord) AS first_ord FROM flat GROUP BY 1, 2",
        "chunk_params_and_caps": f"WITH {records_cte()} SELECT doc_id, CASE crawl_type WHEN 'api_doc' THEN 2500 WHEN 'github_repo' THEN 1600 WHEN 'github_markdown' THEN 1600 ELSE 2000 END AS chunk_size, CASE crawl_type WHEN 'api_doc' THEN 300 WHEN 'github_repo' THEN 200 WHEN 'github_markdown' THEN 200 ELSE 250 END AS overlap, least(100, CASE WHEN crawl_type IN ('github_repo', 'github_markdown') THEN 60 ELSE 100 END, CASE WHEN crawl_type = 'api_doc' THEN 120 ELSE 100 END, CASE WHEN source_priority = 'C' THEN 80 ELSE 100 END) AS doc_cap FROM records",
        "line_dedup_first": f"WITH {CHUNKS_CTE} SELECT arg_min(chunk_id, ord) AS chunk_id, chunk_hash FROM chunks GROUP BY chunk_hash",
        "chunk_length_stats": f"WITH {CHUNKS_CTE}, s AS (SELECT list(chunk_char_count ORDER BY chunk_char_count) AS l, avg(chunk_char_count) AS a FROM chunks) SELECT CAST(len(l) AS BIGINT) AS n, l[1] AS min_len, l[len(l) // 2 + 1] AS median_len, round(a, 6) AS avg_len, l[least(len(l), CAST(floor(len(l) * 0.95) AS BIGINT) + 1)] AS p95_len, l[len(l)] AS max_len FROM s",
        "top_docs": f"WITH {CHUNKS_CTE} SELECT doc_id, count(*) AS n, arg_max(title, ord) AS title, arg_max(url, ord) AS url FROM chunks GROUP BY doc_id ORDER BY n DESC, min(ord) LIMIT 30",
        "chunks_per_document": f"WITH {CHUNKS_CTE}, c AS (SELECT count(*) AS c FROM chunks GROUP BY doc_id) SELECT count(*) AS documents, max(c) AS max_chunks, round(avg(c), 6) AS avg_chunks FROM c",
        "embedding_text": f"WITH {records_cte()} SELECT doc_id, sha256(concat_ws(chr(10), 'Title: ' || title, CASE WHEN coalesce(knowledge_category, '') <> '' THEN 'Coin: ' || coalesce(coin, 'N/A') || '; Chain: ' || coalesce(chain, 'N/A') || '; Domain: ' || knowledge_domain || '; Category: ' || knowledge_category END, 'Source: ' || source_name || '; URL: ' || url, 'Topic Tags: ' || level_1 || ', ' || level_2) || chr(10) || chr(10) || rtrim(content, ' ' || chr(10) || chr(9))) AS embedding_sha, CAST(2 AS BIGINT) AS topic_count, char_count FROM records",
        "normalize_lines": f"WITH s AS (SELECT doc_id, {squeezed} AS l FROM documents), k AS (SELECT doc_id, array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10)) AS t FROM s) SELECT doc_id, length(t) AS n, sha256(t) AS sha FROM k",
        "text_normalize_export": f"SELECT doc_id, sha256({NORMAL.format(c='text')}) AS sha, length(trim(replace(text, chr(10), ' '))) AS one_line_chars FROM documents",
        "line_uniqueness": "WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents) SELECT doc_id, round(len(list_distinct(l)) / greatest(len(l), 1)::DOUBLE, 9) AS unique_line_ratio FROM s",
        "library_classification": f"WITH {CHUNKS_CTE} SELECT chunk_id, coalesce({LIBRARY}, 'none') AS library FROM chunks",
        "export_blocks": f"WITH {CHUNKS_CTE}, {block_parts} SELECT chunk_id, sha256({block_text}) AS block_sha FROM b",
        "balanced_library": f"WITH {CHUNKS_CTE}{BALANCED} SELECT chunk_id, library FROM named WHERE chunk_id IN (SELECT chunk_id FROM balanced)",
        "library_distributions": f"WITH {CHUNKS_CTE}{BALANCED}, both_libs AS (SELECT * FROM named WHERE library IS NOT NULL UNION ALL SELECT * REPLACE ('balanced' AS library) FROM named WHERE chunk_id IN (SELECT chunk_id FROM balanced)), flat AS ({lib}), counted AS (SELECT library, field, key, count(*) AS n, min(ord) AS first_ord FROM flat GROUP BY ALL), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY library, field ORDER BY n DESC, first_ord) AS INT) AS rank FROM counted) SELECT * FROM ranked WHERE rank <= 30",
        "topn_with_other": f"WITH {CHUNKS_CTE}, c AS (SELECT level_2 AS key, count(*) AS n, min(ord) AS f FROM chunks GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, f) AS rn FROM c), m AS (SELECT CASE WHEN rn <= 12 THEN key ELSE 'other' END AS key, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1) SELECT key, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percent FROM m",
        "seed_selection": SEEDS + " SELECT id, 'disabled' AS outcome FROM seeds WHERE NOT crawl_enabled UNION ALL (SELECT id, 'selected' FROM seeds WHERE crawl_enabled AND upper(source_priority) IN ('A', 'B') AND upper(level_1) IN ('EN', 'DE') ORDER BY ord LIMIT 200)",
        "crawl_dispatch": SEEDS + " SELECT id, CASE WHEN crawl_type = 'ftp' THEN 'failed' WHEN crawl_type = 'github_markdown' THEN 'github_file' ELSE crawl_type END AS family, CASE WHEN crawl_type = 'ftp' THEN 'unknown crawl_type: ftp' ELSE '' END AS error FROM seeds",
        "record_projection": f"WITH {records_cte()}, s AS (SELECT *, CASE WHEN ord % 2 = 0 THEN source_id ELSE 'SRC_' || left(sha256(seed_url), 12) END AS sid, CASE WHEN ord % 5 = 0 THEN seed_url ELSE url END AS u FROM records) SELECT doc_id AS row_id, CASE WHEN u = seed_url THEN sid ELSE sid || '__' || left(sha256(u), 10) END AS doc_id, sid AS source_id, sha256(content) AS content_hash, length(content) AS char_count FROM s",
        "upsert_keep_last": f"WITH {records_cte('records_recrawl')} SELECT regexp_replace(doc_id, 'R$', '') AS key, arg_max(doc_id, ord) AS doc_id, arg_max(source_priority, ord) AS source_priority, min(ord) AS first_ord FROM records GROUP BY 1",
        "safe_names": f"WITH {records_cte()} SELECT doc_id, source_id || '__' || regexp_replace(substr(url, 9), '[^0-9a-zA-Z._-]+', '_', 'g') || '_' || left(sha256(url), 12) || '.html' AS url_name, CASE WHEN github_path IS NULL THEN 'index' ELSE regexp_replace(replace(github_path, '/', '__'), '[^0-9a-zA-Z._-]+', '_', 'g') END || '_' || left(sha256(coalesce(github_path, '/')), 12) || '.txt' AS path_name FROM records",
        "canonical_urls": f"SELECT page_id, regexp_replace({clean_url.format(u='url')}, '/+$', '') AS canonical FROM pages",
        "github_url_parts": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source WHEN 2 THEN source ELSE '' END AS repo_owner, CASE doc_id % 4 WHEN 0 THEN 'main' WHEN 1 THEN 'dev' ELSE '' END AS branch, CASE doc_id % 4 WHEN 0 THEN concat('doc/', doc_id, '.md') WHEN 1 THEN concat('x/', doc_id, '.md') ELSE '' END AS path, CASE doc_id % 4 WHEN 0 THEN concat('https://raw.githubusercontent.com/', source, '/', lang, '/main/doc/', doc_id, '.md') WHEN 1 THEN concat('https://raw.githubusercontent.com/', source, '/', lang, '/dev/x/', doc_id, '.md') ELSE '' END AS raw_url, CASE doc_id % 4 WHEN 0 THEN concat('https://github.com/', source, '/', lang, '/blob/main/doc/', doc_id, '.md') WHEN 1 THEN concat('https://github.com/', source, '/', lang, '/blob/dev/x/', doc_id, '.md') ELSE '' END AS page_url FROM documents",
        "link_admission": LINKS + f" SELECT doc_id, CASE WHEN {exts} THEN 'blocked_extension' WHEN {_any('lower(url)', BLOCKED_EXTENSIONS)} THEN 'deny_url_pattern' ELSE 'admitted' END AS reason FROM links",
        "link_scores": LINK_SQL,
        "page_quality": PAGE_SQL,
        "metadata_confidence": LINKS + ", m AS (SELECT *, greatest(0, CASE WHEN depth = 0 THEN 100 WHEN depth = 1 THEN 80 ELSE 60 END - CASE WHEN contains(url, '/blog') OR contains(url, '/news') THEN 20 ELSE 0 END - CASE WHEN doc_id % 100 < 60 AND depth > 0 THEN 10 ELSE 0 END) AS c FROM links) SELECT doc_id, CAST(c AS INT) AS confidence_hundredths, depth >= 2 OR (depth > 0 AND doc_id % 100 < 60) OR (priority = 'C' AND depth > 0) OR c < 70 AS needs_review FROM m",
        "crawl_summary": f"WITH {records_cte()} SELECT 'totals' AS section, 'total' AS key, count(*) AS n FROM records UNION ALL SELECT 'totals', 'ok', count(*) FROM records WHERE status = 'ok' UNION ALL SELECT 'totals', 'partial', count(*) FROM records WHERE status = 'partial' UNION ALL SELECT 'totals', 'other', count(*) FROM records WHERE status NOT IN ('ok', 'partial') UNION ALL {summary}",
    }
