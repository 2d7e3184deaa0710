"""Every registered query against its DuckDB oracle on the smallest tables
(the same comparison the driver makes at sf0.01)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_of_the_library_has_an_oracle():
    from shardlake.queries import oracle_sql, queries
    assert set(queries()) == set(oracle_sql()) and set(oracle_sql()) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["logstore", "topic", "n_logs", "n_sources", "retried", "n_ok", "avg_value",
                          "max_value", "first_time"]
