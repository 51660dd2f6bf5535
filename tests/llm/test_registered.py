"""The registered queries: one per operator, and equal to their DuckDB texts where they have one."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare_oracle import _rows
from quarry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert "pipeline" in entry.queries() and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())
