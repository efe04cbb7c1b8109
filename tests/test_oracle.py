"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "topic", "topic_count", "rank"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from tools.check_oracle import digest
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    db_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(db_rows)
    assert digest(rows, df.columns)[0] == digest(db_rows, rel.columns)[0]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF001)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)
