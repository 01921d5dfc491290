"""The registered queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from searchlake.llm import queries as llm
from searchlake.plans.compare import diff
from searchlake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = llm.QUERIES[name](spark, SF)
    res = con.execute(llm.ORACLES[name])
    assert diff(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in res.description], res.fetchall()) is None
