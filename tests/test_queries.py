"""Every registered query against its SQL."""

import pytest
from oracle import connect, rows_of, spark_rows, sql_rows

import __spark_entry__ as entry

# The text operators have tests of their own; where they are installed, their SQL is checked here too.
TEXT = {n for n in entry.queries() if n == "pipeline" or n.startswith("op")} - set(entry.oracle_sql())
QUERIES, ORACLE = {n: q for n, q in entry.queries().items() if n not in TEXT}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    columns, got = spark_rows(QUERIES[name](spark, sf))
    assert got
    if name in ORACLE:
        wanted_columns, wanted = sql_rows(con, ORACLE[name])
        assert columns == wanted_columns
        assert got == wanted


def test_entry(spark):
    df = entry.entry(spark)
    con = connect(entry.FLAGSHIP_DIR)
    columns, wanted = sql_rows(con, ORACLE[entry.FLAGSHIP])
    assert sorted(df.columns) == columns
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"network_history", "pca_knn_scores"}
