"""Every corpus query with SQL gives DuckDB's rows; every other one runs with a stable schema."""

import duckdb
import pytest

from corpusloom.plans import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, name):
    with duckdb.connect() as db:
        for table in ("documents", "pages"):
            db.execute(f"create view {table} as select * from read_parquet('{sf}/{table}.parquet')")
        expected = db.execute(SQL[name]).df()
    found = catalog.queries()[name](spark, sf).toPandas()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = [sorted(map(tuple, x[columns].astype(object).astype(str).values)) for x in (found, expected)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_other_queries_run(spark, sf, name):
    assert catalog.queries()[name](spark, sf).limit(5).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_embedding_text_of_blank_records_equals_its_sql(spark, tmp_path):
    texts = ["", "  ", "\n\n", "a b", "a b \n\t", "a b\r", "a b\u3000", None]
    rows = [(i, t, "en", "s", None if t is None else i % 2 * len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        expected = db.execute(f"select doc_id, embedding_sha, topic_count, char_count from ({SQL['embedding_text']})").fetchall()
    found = catalog.queries()["embedding_text"](spark, str(tmp_path)).select("doc_id", "embedding_sha", "topic_count", "char_count")
    assert sorted(map(tuple, found.collect())) == sorted(expected)
