"""Queries of this subpackage that have SQL, against DuckDB."""

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows
from vitals.llm.catalog import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        df = QUERIES[name](spark, SF_SMALL)
        cur = con.execute(ORACLE_SQL[name])
        cols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(cols)
        assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(cols, cur.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
