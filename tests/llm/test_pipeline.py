"""The pipeline and the registered queries on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from tideway.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    had = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows) > 0.5 * docs.count() and {r["doc_id"] for r in rows} <= had, name
        docs = spark.createDataFrame(rows, out.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_awkward_tables(spark):
    """Null ids and texts, repeated rows and columns named like those the stages make themselves; and no rows at all."""
    texts = [None, "", "  \n ", "one line of words here\nanother line of other words", "one line of words here\nanother line of other words",
             *[" ".join(f"w{i}x{j}" for j in range(30 + i)) for i in range(20)]]
    rows = [(None if i == 8 else i, t, "en" if i % 2 else None, "src", 10, 100 + i, 200 + i, 300 + i, 400 + i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[10:11], "doc_id long, text string, lang string, source string, n_chars long, _row long, _source long, of long, _left long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert 0 < len(kept) <= len(rows) + 1 and all(r["_row"] == r["_left"] - 300 == r["_source"] - 100 == r["of"] - 200 for r in kept), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    pack = corpus_pipeline.STAGES[-1][1]
    assert pack(spark, docs, SF).agg({"length": "sum"}).first()[0] > 0 and pack(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns) and rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_numbers():
    assert {n for q in entry.queries() if (n := q.split("_")[0])[:2] == "op"} == {f"op{n}" for n in range(1, 14)}
