"""Every query key against its DuckDB oracle at sf0.01 (the correctness gate)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from newsbeam.plans.keys import QUERIES
from newsbeam.sources.tables import TABLES
from tools.check_oracle import rows_of

from .conftest import SF001, SF01

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF01, t + '.parquet')}')")
    return c


def test_every_key_has_an_oracle():
    assert set(E.oracle_sql()) >= set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", KEYS)
def test_key_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "rank", "symbol", "score"]
    assert df.count() > 0
    assert os.path.isdir(SF001)
