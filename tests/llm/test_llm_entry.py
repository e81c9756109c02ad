"""Registration, and DuckDB SQL of the queries that have it."""

import math

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as E
from partyfold.llm.queries import oracle_queries, registry


def test_all_operators_are_registered():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in registry()) == list(range(1, 14))
    assert "pipeline" in names and set(registry()) <= set(names) and set(oracle_queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.execute(oracle_queries()[name])
    columns = [c[0] for c in want.description]
    want = sorted(map(str, (dict(zip(columns, r, strict=True)) for r in want.fetchall())))
    got = registry()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    rows = [{c: r[c] for c in columns} for r in got.collect()]
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r.values())
    assert sorted(map(str, rows)) == want
