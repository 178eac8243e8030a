"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import sys

import duckdb
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
from __spark_entry__ import entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402
from tideway.plans import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    wanted_columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(wanted_columns)
    assert rows_of(df.columns, df.collect()) == rows_of(wanted_columns, cursor.fetchall())


ORDERED = [
    "q_extract_timestamp", "q_fold_ordered", "q_reduce_changelog", "q_window_sliding_sum", "q_window_sliding_minmax",
    "q_session_reduce", "q_window_retention", "q_join_table_asof", "q_left_join_table_asof", "q_join_tables_changelog",
    "q_changelog_regroup", "q_produce_offsets", "q_repartition_topic",
]


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_hot_keys(spark, duck, small_chunks, name):
    """The same answers when nearly every key is cut into chunks."""
    test_query(spark, duck, name)


def test_entry(spark):
    assert entry(spark).count() > 0
