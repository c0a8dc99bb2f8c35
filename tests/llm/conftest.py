import duckdb
import pytest

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Documents from (doc_id, text[, source]) with all columns of the table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sql(query):
    return duckdb.sql(query.replace("{sf}", SF)).fetchall()


@pytest.fixture(scope="session")
def sf_docs():
    return sql("select doc_id, text from '{sf}/documents.parquet' order by doc_id")
