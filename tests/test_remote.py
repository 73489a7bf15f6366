import hashlib
import io
import urllib.error

from corpusloom.sources import remote


class Answer(io.BytesIO):
    headers = {"Content-Type": "text/html"}


def test_fetch_retries_and_never_raises():
    calls = []

    def flaky(request, timeout):
        calls.append(request.full_url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {}, None)
        return Answer(b"ok")

    assert remote.fetch("http://x.test/a", opener=flaky, pause=lambda s: None) == (b"ok", "text/html", "")
    assert len(calls) == 3

    def gone(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 404, "gone", {}, None)

    assert remote.fetch("http://x.test/a", opener=gone, pause=lambda s: None) == (None, "", "HTTP 404")
    assert remote.fetch("no url")[0] is None


def test_page_and_file_records(spark):
    sources = spark.createDataFrame([("s1", "https://x.test/a", "One"), ("s2", "https://x.test/b", "Two")], "source_id string, url string, source_name string")
    pages = spark.createDataFrame([("https://x.test/a", "<p>hello</p>")], "url string, html string")
    got = {r["source_id"]: (r["status"], r["title"], r["content"]) for r in remote.page_records(sources, pages).collect()}
    assert got == {"s1": ("ok", "One", "hello"), "s2": ("failed", "Two", "")}
    sources = spark.createDataFrame([("g", "https://github.com/o/r/blob/main/doc/x.md"), ("n", "https://github.com/o/r")], "source_id string, url string")
    files = spark.createDataFrame([("https://raw.githubusercontent.com/o/r/main/doc/x.md", "text")], "url string, text string")
    rows = remote.repository_file_records(sources, files).collect()
    assert [(r["source_id"], r["status"], r["title"], r["url"]) for r in rows] == [("g", "ok", "doc/x.md", "https://github.com/o/r/blob/main/doc/x.md")]


def test_pdf_records_keep_going(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"not a pdf")
    row = remote.pdf_records(spark.read.format("binaryFile").load(str(tmp_path))).first()
    assert row["status"] == "partial" and row["file_sha256"] == hashlib.sha256(b"not a pdf").hexdigest() and row["error"]
