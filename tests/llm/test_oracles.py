"""Operators that SQL can express against their DuckDB SQL at sf0.01."""

import duckdb
import pytest

from newsbeam.llm.registry import ORACLE, QUERIES
from tests.conftest import SF01
from tools.check_oracle import rows_of


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    df = QUERIES[name](spark, SF01)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())
