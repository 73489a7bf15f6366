import json

from corpusloom.streaming import intake


def test_intake_keeps_first_of_each_text(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def drop(name, *records):
        (folder / name).write_text("\n".join(json.dumps(r) for r in records))

    base = dict(status="ok", url="https://e.org/a", title="t", crawl_type="html", level_1="x", level_2="y", source_name="s", topic_tags=["k"])
    long = "Some sentence that is long enough to count. " * 40
    drop("1.json", base | dict(doc_id="a", content=long, ord=1), base | dict(doc_id="b", content=long, ord=2), base | dict(doc_id="c", content="short", ord=3))

    def run():
        records = intake.read_records(spark, str(folder))
        intake.start_intake(records, str(tmp_path / "corpus"), str(tmp_path / "chunks"), str(tmp_path / "state")).awaitTermination()
        return sorted(r["doc_id"] for r in spark.read.parquet(str(tmp_path / "corpus")).collect())

    assert run() == ["a"]
    drop("2.json", base | dict(doc_id="d", content=long, ord=4), base | dict(doc_id="e", content=long + "And an end.", ord=5))
    assert run() == ["a", "e"]
    assert spark.read.parquet(str(tmp_path / "chunks")).select("doc_id").distinct().count() == 2
