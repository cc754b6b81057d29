"""Every query with an oracle equals its DuckDB text on the driver tables (sf0.001;
``ORACLE_SF_DIR=/root/testdata/sf0.01`` reproduces the driver's gate)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from .conftest import SF_SMALL as _SMALL

SF_SMALL = os.environ.get("ORACLE_SF_DIR", _SMALL)

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 70


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.sql(ORACLES[name]).df()
    gc, gr = rows_of(got)
    ec, er = rows_of(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["topic", "partition_id", "batch_no", "batch_size", "failed", "rolled_back",
                          "dead_letters", "commit_offset"]
