"""Small hand-derived cases."""

import hashlib
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusloom.functions import chunking, scoring, text, urls
from corpusloom.functions.html import extract
from corpusloom.operators import analytics, chunks, crawl, export, filtering
from corpusloom.plans import adapters
from corpusloom.sources import files, seeds


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("url,base,expected", [
    ("https://Ex.com/a/", None, "https://Ex.com/a"), ("https://ex.com/", None, "https://ex.com/"), ("https://ex.com/a#t", None, "https://ex.com/a"),
    ("mailto:x@y", None, None), ("ftp://x/y", None, None), ("", None, None), (None, None, None), ("/b/", "https://ex.com/a/c", "https://ex.com/b"),
    ("https://ex.com/a//", None, "https://ex.com/a/"), ("https://ex.com/a?x=/", None, "https://ex.com/a?x="),
])
def test_normalize_reference(url, base, expected):
    assert urls.normalize_reference(url, base) == expected


@pytest.mark.parametrize("url,expected", [
    ("HTTP://Ex.COM/a//?utm_Source=1&b=2#f", "http://ex.com/a?b=2"), ("https://ex.com/?a", "https://ex.com/?a="), ("https://ex.com/a?q=x%20y", "https://ex.com/a?q=x+y"),
    ("https://ex.com/a?q=~*&r=%7E", "https://ex.com/a?q=~%2A&r=~"), ("http://h", "http://h"), ("http://h/", "http://h/"), ("", ""),
])
def test_canonical_url(spark, url, expected):
    assert one(spark, urls.canonical_url(F.col("u")), u=url) == expected


def test_texts(spark):
    assert one(spark, text.normalize_lines(F.col("t")), t="a\r\n\r\n a \nb") == "a\nb"
    assert one(spark, text.normalize_lines(F.col("t")), t="x\u00a0 y\u200b\n\x0bz") == "x y\nz"
    assert one(spark, text.sanitize_id(F.col("t")), t="--a b//c__d_") == "--a_b_c_d"
    assert one(spark, text.split_list(F.col("t")), t="a;b,c") == ["a", "b", "c"]
    assert one(spark, text.parse_list(F.col("t")), t="a;b,c") == ["a", "b,c"]
    assert one(spark, text.parse_list(F.col("t")), t='["x", " y "]') == ["x", "y"]
    assert one(spark, text.or_default(F.col("t"), "N/A"), t=" \x1c ") == "N/A"


def test_chunker():
    assert chunking.normalize_document("a\n\na\nb") == "a\n\nb"
    assert chunking.chunks_of("", 100, 10) == []
    words = "Sentence number one is here. " * 200
    made = chunking.chunks_of(words, 500, 50, 100)
    assert len(made) > 5 and all(len(c) <= 750 for c in made)
    assert chunking.chunks_of("short", 500, 50, 100) == ["short"]
    assert chunking.cut_window("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    assert chunking.overlap_of("abc. defgh ijklmnop", 10) == "ijklmnop"  # after the space in "h ijklmnop"
    assert chunking.overlap_of("one. two three four", 14) == "three four" and chunking.overlap_of("short", 10) == "short"
    assert chunking.overlap_of("any", 0) == "" and chunking.overlap_of("x" * 20, 5) == "xxxxx"


def test_chunks_by_hand():
    """Packing, overlaps, a cut of what outgrows 1.5 sizes, and the short end, worked out from the rules."""
    a, b, c = "a" * 40, "b" * 40, "c" * 40
    assert chunking.chunks_of(f"{a}\n\n{b}\n\n{c}", 90, 0, 10) == [f"{a}\n\n{b}", c]
    assert chunking.chunks_of(f"{a}\n\n{b}\n\n{c}", 90, 0, 50) == [f"{a}\n\n{b}\n\n{c}"]  # the end is short: it joins
    assert chunking.chunks_of(f"{a}\n\n{b}\n\n{c}", 50, 10, 10) == [a, "a" * 10 + f"\n\n{b}", "b" * 10 + f"\n\n{c}"]
    assert chunking.chunks_of("One two. Three four. Five six.", 12, 0, 3) == ["One two.", "Three four.", "Five six."]
    # overlap and unit make 49 of size 30: cut at the last space beyond 55 %
    assert chunking.chunks_of("p" * 29 + "\n\n" + "q" * 27, 30, 20, 5) == ["p" * 29, "p" * 20, "q" * 27]
    assert chunking.chunks_of("tiny\n\n" + "z" * 30, 30, 0, 10) == ["z" * 30]
    assert chunking.normalize_document(" A \n\n\nA\n\u200bB\tC\n\nB C") == "A\n\nB C"


def test_length_stats_and_frequencies(spark):
    got = analytics.length_stats(spark.createDataFrame([(v,) for v in (4, 1, 3, 2)], "v int"), "v").first()
    assert (got.median_len, got.p95_len, got.min_len, got.max_len) == (3, 4, 1, 4)
    rows = spark.createDataFrame(list(enumerate("baabc")), "ord long, k string")
    table = analytics.most_common(rows, F.col("k")).orderBy(F.desc("n"), "first_ord").collect()
    assert [(r["key"], r["n"]) for r in table] == [("b", 2), ("a", 2), ("c", 1)]


def _record(**change):
    base = dict(ord=1, doc_id="d", url="https://e.org/x", raw_url=None, seed_url="https://e.org/", title="t", content="x" * 600, char_count=600, content_hash=None, status="ok", source_priority="A", crawl_type="html", github_owner=None, github_repo=None, github_path=None, source_name="s", topic_tags=["x"], level_1="p", level_2="q", notes=None, _line_number=5)
    return base | change


SCHEMA = "ord long, doc_id string, url string, raw_url string, seed_url string, title string, content string, char_count long, content_hash string, status string, source_priority string, crawl_type string, github_owner string, github_repo string, github_path string, source_name string, topic_tags array<string>, level_1 string, level_2 string, notes string, _line_number long"


def frame(spark, *rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def test_filter_rules(spark):
    rank = frame(spark, _record(title="API FAQ", char_count=900)).select(*[c.alias(n) for n, c in filtering.rank_columns().items()]).first()
    assert tuple(rank) == (3, 4, 900, -5)
    why = lambda **k: frame(spark, _record(**k)).select(filtering.hard_reason(), filtering.effective_chars()).first()
    assert tuple(why(char_count=10)) == ("char_count_lt_500", 10)
    assert tuple(why(char_count=0)) == (None, 600)
    low = lambda **k: frame(spark, _record(**k)).select(filtering.low_value_reason()).first()[0]
    assert low(github_path="contrib/x.md") is None
    assert low(github_path="doc/contrib/x.md") == "low_value_contrib"


def test_filter_keeps_every_record_once(spark):
    rows = [_record(ord=i, doc_id=f"d{i}", url=f"https://e.org/{i % 3}", content="y" * (600 + i % 4), content_hash=None, _line_number=i) for i in range(12)]
    decided = filtering.decide(frame(spark, *rows)).collect()
    assert sorted(r["doc_id"] for r in decided) == sorted(r["doc_id"] for r in rows)
    assert filtering.decide(frame(spark, *rows).limit(0)).count() == 0


def test_tags_in_first_seen_order(spark):
    rows = spark.createDataFrame([("k", 1, ["x", "y"], "p", "q"), ("k", 2, ["y", " z "], None, None), ("solo", 3, ["a"], None, None)], "k string, ord long, topic_tags array<string>, level_1 string, level_2 string")
    assert [tuple(r) for r in filtering.merged_tags(rows, "k").collect()] == [("k", ["x", "y", "p/q", "z"])]


def test_admission_and_scores(spark):
    assert one(spark, urls.admission(F.col("u")), u="https://x.org/next.js/intro") == "deny_url_pattern"
    assert one(spark, urls.admission(F.col("u"), strict_deny=False), u="https://x.org/next.js/intro") is None
    conf = one(spark, scoring.metadata_confidence(F.col("u"), F.lit("t"), F.lit("A"), F.lit(1), F.lit(56)), u="https://x.org/a")
    assert (conf["hundredths"], conf["review"]) == (70, True)


def test_embedding_text_drops_empty_headers(spark):
    row = spark.createDataFrame([("T", "N/A", "N/A", "", "", "", "", [])], "title string, coin string, chain string, knowledge_domain string, knowledge_category string, source_name string, url string, topic_tags array<string>")
    assert row.select(chunks.embedding_text(F.lit("x"))).first()[0] == "Title: T\n\nx"


PAGE = '<nav><a href="/login">Log in</a></nav><main><h1>Docs</h1><p>' + "neutral words. " * 27 + '</p><a href="/docs/api/">API</a><a href="/x.pdf">P</a></main>'


def test_html():
    page = extract(PAGE, "https://w.test/docs")
    assert page["title"] == "Docs" and [x["url"] for x in page["links"]] == ["https://w.test/docs/api", "https://w.test/login", "https://w.test/x.pdf"]
    assert extract("<table><tr><td>a<td>b</table>", None)["content"] == "a | b"
    assert extract(None, None)["content"] == "" and extract("<p>a<p><b>c", None)["content"] == "a\nc"
    assert [x["url"] for x in extract(PAGE, "https://w.test/docs", links_after_pruning=True)["links"]] == ["https://w.test/docs/api", "https://w.test/x.pdf"]


def test_mini_web(spark):
    sources = spark.createDataFrame([("S1", "https://w.test/docs/", "A", 3, 1)], "source_id string, seed_url string, source_priority string, max_pages int, max_depth int")
    pages = spark.createDataFrame([("https://w.test/docs", PAGE)], "url string, html string")
    records, found, dropped = crawl.crawl_site(sources, pages)
    got = {r["url"]: r for r in records.collect()}
    assert set(got) == {"https://w.test/docs", "https://w.test/docs/api"}
    home, api = got["https://w.test/docs"], got["https://w.test/docs/api"]
    assert (home["status"], home["link_score"], home["content_quality_score"], home["content_quality_flags"], home["link_count"]) == ("ok", 1.0, 1.0, ["ok"], 3)
    assert (api["status"], api["link_score"], api["content_quality_score"], api["content_quality_flags"], api["needs_metadata_review"]) == ("failed", 0.56, 0.0, ["fetch_failed"], True)
    assert [(r["url"], r["link_score"]) for r in found.collect()] == [("https://w.test/docs/api", 0.56)]
    assert sorted((r["url"], r["reason"], r["link_hundredths"]) for r in dropped.collect()) == [("https://w.test/login", "link_score_below_min", 40), ("https://w.test/x.pdf", "blocked_extension", None)]


def test_balanced_cap_and_parts(spark):
    rows = spark.createDataFrame([(i, f"c{i}", "d", i, "A", "exchange_api", "body") for i in range(41)], "ord long, chunk_id string, doc_id string, chunk_index int, source_priority string, source_authority string, chunk_text string")
    kept = {r["chunk_id"] for r in export.balanced(rows).collect()}
    assert len(kept) == 40 and "c40" not in kept
    blocks = spark.createDataFrame([(i, "l", "x" * n) for i, n in enumerate((6, 6, 20, 3))], "ord long, library string, block string")
    assert [r["part"] for r in export.pack_parts(blocks, 10).orderBy("ord").collect()] == [1, 2, 3, 4]


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"a":1}\n\n[1]\nx\n{"a":2}\n')
    rows = files.read_jsonl(spark, str(path), "a long").orderBy("ord").collect()
    assert [(r["_line_number"], r["a"], r["_parse_error"] is None) for r in rows] == [(1, 1, True), (3, None, False), (4, None, False), (5, 2, True)]
    assert files.read_jsonl(spark, str(path), "a long", keep_bad=False).count() == 2


def test_jsonl_of_several_files_and_blocks(spark, tmp_path):
    """``ord`` runs through all files by name, also where a file is read in blocks; no line comes back twice."""
    sizes = {"part-00000.json": 700, "part-00001.json": 1, "part-00002.json": 900}
    nth, expected = 0, []
    for name, lines in sizes.items():
        (tmp_path / name).write_text("".join(f'{{"a": {nth + i}, "pad": "{"x" * 40}"}}\n' for i in range(lines)))
        expected += [(nth + i + 1, i + 1, nth + i) for i in range(lines)]
        nth += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = files.read_jsonl(spark, str(tmp_path), "a bigint")
        assert rows.rdd.getNumPartitions() > 3
        assert [(r["ord"], r["_line_number"], r["a"]) for r in rows.orderBy("ord").collect()] == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_jsonl_takes_fields_of_any_type(spark, tmp_path):
    lines = [
        {"char_count": "600", "topic_tags": "x; y,z", "title": 7}, {"char_count": 600.9, "topic_tags": ["a", 1]}, {"char_count": "many", "topic_tags": '["p", "q"]', "own": [1, "b"]},
        {"char_count": None, "topic_tags": None, "_line_number": 40}, {"char_count": 5, "topic_tags": '{"k": 1}', "_extra": '{"old": "1"}', "own": 2},
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n[1]\n\"text\"\n{broken\n")
    rows = files.read_jsonl(spark, str(tmp_path / "in.jsonl"), "char_count bigint, topic_tags array<string>, title string").orderBy("ord").collect()
    assert [r["char_count"] for r in rows[:5]] == [600, 600, None, None, 5]
    assert [r["topic_tags"] for r in rows[:5]] == [["x", "y", "z"], ["a", "1"], ["p", "q"], [], ['{"k": 1}']]
    assert rows[0]["title"] == "7" and rows[3]["_line_number"] == 40 and [r["_parse_error"] is None for r in rows] == [True] * 5 + [False] * 3
    assert [r["_extra"] and json.loads(r["_extra"]) for r in rows[2:5]] == [{"own": '[1,"b"]'}, None, {"own": "2", "old": "1"}]


def test_sinks(spark, tmp_path):
    import sqlite3

    rows = spark.createDataFrame([("a", 1, ["x"]), ("b", 2, None)], "doc_id string, n long, tags array<string>")
    files.write_sqlite(rows, str(tmp_path / "t.db"))
    files.write_sqlite(rows.withColumn("n", F.col("n") + 1).where("doc_id = 'a'"), str(tmp_path / "t.db"))
    with sqlite3.connect(tmp_path / "t.db") as db:
        assert sorted(db.execute("select doc_id, n, tags from documents")) == [("a", 2, '["x"]'), ("b", 2, None)]
    old = spark.createDataFrame([("a", 1, "old"), ("c", 2, "old")], "doc_id string, ord long, v string")
    new = spark.createDataFrame([("a", 1, "new")], "doc_id string, ord long, v string")
    assert sorted((r["doc_id"], r["v"]) for r in files.upsert(old, new).collect()) == [("a", "new"), ("c", "old")]
    files.write_jsonl(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert files.preview(rows, ["doc_id"], 1).columns == ["doc_id_preview", "n", "tags"]


def test_seeds(spark, tmp_path):
    path = tmp_path / "seeds.json"
    entries = [{"name": "A", "url": "https://a.org/x", "type": "pdf"}, "no", {"id": "B", "crawl_enabled": False, "owner": "o"}]
    path.write_text(json.dumps({"sources": entries}))
    loaded = seeds.load_seeds(spark, str(path))
    assert [(r["ord"], r["crawl_type"], r["normalized_url"], r["source_name"]) for r in loaded.orderBy("ord").collect()] == [(0, "pdf", "https://a.org/x", "A"), (2, "html", "", "")]
    chosen, disabled = seeds.select_seeds(loaded, crawl_type=["PDF"])
    assert chosen.count() == 1 and disabled.count() == 1
    path.write_text('"x"')
    with pytest.raises(ValueError):
        seeds.load_seeds(spark, str(path))
    tree = spark.createDataFrame([("bitcoin", "bips", json.dumps({"tree": [{"path": "a.MD", "type": "blob"}, {"path": "d", "type": "tree"}, {"path": "b.py", "type": "blob"}]}))], "owner string, repo string, json string")
    assert [r["path"] for r in seeds.repository_files(tree).collect()] == ["a.MD"]
    assert one(spark, seeds.default_branch(F.col("j")), j='{"default_branch": "dev"}') == "dev"


def test_rest_of_the_library_runs_without_optional_parts():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = "import sys\nclass B:\n def find_spec(self, n, p=None, t=None):\n  if n.startswith('corpusloom.llm') or n == 'corpus_pipeline': raise ImportError(n)\nsys.meta_path.insert(0, B())\nimport __spark_entry__ as e\nassert not any(k.startswith('op') and k[2].isdigit() for k in e.queries()) and len(e.queries()) > 30"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_word_lists():
    """The lists that queries and their SQL share, against digests taken once from the documented lists."""
    digest = lambda words: hashlib.sha256("\n".join(sorted(set(words))).encode()).hexdigest()[:16]
    assert digest(scoring.GOOD_WORDS) == "dfec577956a4e72e" and digest(scoring.POOR_WORDS) == "61409e1e14d066af"
    assert digest(urls.BLOCKED_EXTENSIONS) == "63cfb1db36e4bc80" and digest(filtering.VALUED) == "8743ffbf7c200dda"
    assert digest(export.RISK_CATEGORIES) == "ba0252eb67ce2704" and digest(export.RISK_AUTHORITIES) == "868a9fadc480f228" and digest(export.CORE_DOMAINS) == "16fcb0f5fc336e3a"


def test_a_text_is_measured_without_python(spark):
    pieces = ["a", "b c", " ", "\t", "\n", "\n\n", "\r", "\r\n", "\xa0", "\u200b", "\u3000", "\x0b", "\x1c", "\x85", "\xe9", "\U0001f600", "a\na"]
    draw = random.Random(7)
    texts = [None, "", *("".join(draw.choices(pieces, k=draw.randrange(1, 30))) for _ in range(2000))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = dict(map(tuple, rows.select("i", chunking.normal_length(F.col("t"))).collect()))
    assert found == {i: len(chunking.normalize_document(t)) for i, t in enumerate(texts)}


def test_skips_run_no_python_and_chunks_run_it_once(spark, sf):
    made, skipped = chunks.chunk_documents(adapters.records(spark, sf))
    kinds = [df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") for df in (made, skipped)]
    assert kinds == [1, 0]


def test_chunks_are_returned_in_blocks():
    text = "Some words of it. " * 10_000
    batch = (pa.array([text] * 40), pa.array([2000] * 40), pa.array([250] * 40), pa.array([300] * 40), pa.array([500] * 40))
    blocks = list(chunking._chunked(iter([batch])))
    assert len(blocks) > 3 and max(map(len, blocks)) < 10
    assert [x for b in blocks for x in b.to_pylist()] == [chunking.chunks_of(chunking.normalize_document(text), 2000, 250, 300)] * 40
