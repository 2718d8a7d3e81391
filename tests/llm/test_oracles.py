"""Every training-data query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

from flowstat.llm import queries

from ..conftest import SF0001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from oracle_check import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = queries.QUERIES[name](spark, SF0001).toPandas()
    assert digest(got) == digest(con.execute(queries.ORACLES[name]).df())
