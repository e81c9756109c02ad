"""Spark queries against the DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

CHECK = ["errors_sales", "standardize_name_card", "dedupe_company_crm", "upsert_company_crm",
         "attach_company_code", "mint_company_codes", "manual_merge_apply", "candidates_domain",
         "error_trend", "daily_slice"]


def _norm(v):
    return "<null>" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "supplier", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", CHECK)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())


def test_every_query_of_the_masters_has_an_oracle():
    from partyfold.oracle import oracle_queries
    from partyfold.plans.queries import registry
    assert set(registry()) == set(oracle_queries())
    assert set(registry()) <= set(E.queries()) and set(oracle_queries()) <= set(E.oracle_sql())
