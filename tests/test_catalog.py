"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from flowstat.plans import catalog  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

from .conftest import SF0001  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rn", "item_id", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF0001).toPandas()
    if name not in E.oracle_sql():
        assert len(sp) > 0
        return
    assert digest(sp) == digest(con.execute(E.oracle_sql()[name]).df())
