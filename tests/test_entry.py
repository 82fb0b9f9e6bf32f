"""Every registered query of the trade pipeline against its DuckDB SQL on sf0.001."""

import duckdb
import pytest
from oracle_check import TABLES, canon

import __spark_entry__ as E
from tradelake import workloads

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"minute", "symbol", "chunk", "n_trades", "prices"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(workloads.oracle_sql()) == set(workloads.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(workloads.queries()))
def test_query_matches_oracle(spark, con, name):
    got = workloads.queries()[name](spark, SF)
    res = con.execute(workloads.oracle_sql()[name])
    want = canon(res.fetchall(), [d[0] for d in res.description])
    assert canon([tuple(r) for r in got.collect()], got.columns) == want
