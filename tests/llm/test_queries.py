"""The registered queries over the sf0.001 tables: against SQL where there is one."""

import os
import re

import pytest

from ledgerloom.llm import queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name not in queries.SQL:
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    rel = con.sql(queries.SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    key = lambda r: str(sorted(r.items(), key=lambda x: x[0]))
    assert sorted((r.asDict() for r in rows), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", ["op2_source_mixing", "op9_url_filter"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
