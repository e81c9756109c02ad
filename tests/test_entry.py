"""Driver contract and small plan properties."""

import __spark_entry__ as E


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "company_code"
    codes = [r.company_code for r in rows]
    assert len(codes) == len(set(codes))          # codes stay unique after the upsert


def test_scan_is_pruned(spark):
    from conftest import SMALL
    from pyspark.sql import functions as F
    from partyfold.sources.fixtures import _base, feed_columns
    derived = _base(spark, SMALL, "sales").select(F.col("k").alias("seq"), *feed_columns("sales"))
    plan = derived._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_standardised_feed_reads_its_columns_only(spark):
    from conftest import SMALL
    from partyfold.plans.queries import registry
    plan = registry()["standardize_sales"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan
    assert "customer_person_name" in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_daily_slice_filter_reaches_scan(spark):
    from conftest import SMALL
    from partyfold.operators.slice import day_filter
    from partyfold.sources.fixtures import sales_lake_by_order_date, SLICE_DAY
    lake = sales_lake_by_order_date(spark, SMALL)
    plan = lake.filter(day_filter(lake, SLICE_DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_entry_works_without_the_training_data_package(tmp_path):
    """With the package and its tests gone (the pipeline file still there), the queries of
    the masters are all there; checked in a copy, by a process that never saw the package."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    shutil.copytree(os.path.join(root, "partyfold"), tmp_path / "partyfold",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = ("import __spark_entry__ as E; from partyfold.plans.queries import registry; "
            "assert set(E.queries()) == set(E.oracle_sql()) == set(registry()) and 'pipeline' not in E.queries()")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
