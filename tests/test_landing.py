"""A1-A6 and the streaming landing, with real files."""

import os
import tempfile

from partyfold.sources.fixtures import run_time_lit
from partyfold.functions.fixed import CSV_COLUMNS
from partyfold.sources.landing import read_feed_csv
from partyfold.operators.manual_merge import read_instructions


def _write(path, header, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",".join(header) + "\n")
        for line in lines:
            fh.write(",".join(line) + "\n")


def test_csv_keeps_leading_zeros_and_types(spark):
    d = tempfile.mkdtemp(prefix="land-")
    cols = list(CSV_COLUMNS["crm"])
    row = {c: "" for c in cols}
    row.update(company_name="取引先", phone_number="0312345678", employees_volume="12",
               contact_permission="True", register_datetime="2025-12-14 13:00:00", email="x@y")
    # header in another order: columns are taken by name
    header = list(reversed(cols))
    _write(os.path.join(d, "crm.csv"), header, [[row[c] for c in header]])
    df = read_feed_csv(spark, "crm", os.path.join(d, "crm.csv"), run_time_lit())
    r = df.collect()[0]
    assert r.phone_number == "0312345678" and r.employees_volume == 12 and r.contact_permission is True
    assert r.register_datetime.year == 2025 and r.insert_datetime.year == 1997


def test_missing_file_lands_nothing(spark):
    df = read_feed_csv(spark, "sales", "/nonexistent/sales_ledger.csv", run_time_lit())
    assert df.count() == 0 and "update_datetime" in df.columns


def test_instruction_file_needs_two_columns(spark):
    d = tempfile.mkdtemp(prefix="instr-")
    p = os.path.join(d, "m.csv")
    with open(p, "w") as fh:
        fh.write("0000000001,0000000007\n0000000013,0000000019\n")
    assert read_instructions(spark, p).count() == 2
    with open(p, "w") as fh:
        fh.write("a,b,c\n")
    try:
        read_instructions(spark, p)
        raise AssertionError("three columns must be refused")
    except ValueError:
        pass


def test_streaming_landing_is_exactly_once(spark):
    from partyfold.streaming.landing import land_new_files
    root = tempfile.mkdtemp(prefix="stream-")
    drop, lake, ckpt = (os.path.join(root, x) for x in ("drop", "lake", "ckpt"))
    os.makedirs(drop)
    cols = list(CSV_COLUMNS["invoice"])
    _write(os.path.join(drop, "d1.csv"), cols, [["A", "0312345678", "", "a@b", "東京都", "T1234567890123", "", ""]])
    land_new_files(spark, "invoice", drop, lake, ckpt)
    _write(os.path.join(drop, "d2.csv"), cols, [["B", "0312345679", "", "b@b", "大阪府", "T1234567890124", "", ""]])
    land_new_files(spark, "invoice", drop, lake, ckpt)
    land_new_files(spark, "invoice", drop, lake, ckpt)
    got = sorted(r.invoice_issuer for r in spark.read.parquet(lake).collect())
    assert got == ["A", "B"]


def _land(spark, text, prefix=""):
    import datetime as dt
    import tempfile
    from pyspark.sql import functions as F
    path = os.path.join(tempfile.mkdtemp(prefix="land-"), "crm.csv")
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    return read_feed_csv(spark, "crm", prefix + path, F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz"))


def test_quoted_values_stay_whole(spark):
    head = "company_name,email,phone_number\n"
    rows = _land(spark, head + '"A\nB",a@b,03\n"say ""hi"", ltd",c@d,04\n').collect()
    assert [(r.company_name, r.email, r.phone_number) for r in rows] == [("A\nB", "a@b", "03"), ('say "hi", ltd', "c@d", "04")]


def test_numbers_extra_columns_and_uris(spark):
    text = "company_name,employees_volume,annual_revenue,note,phone_number\nA,12.0,abc,kept,0312345678\nNA,,1000,nan,\n"
    rows = _land(spark, text, "file://").collect()
    assert [(r.company_name, r.employees_volume, r.annual_revenue, r.note, r.phone_number) for r in rows] == [
        ("A", 12, None, "kept", "0312345678"), ("NA", None, 1000, "nan", None)]


def test_unreadable_numbers_are_counted(spark):
    import tempfile
    from pyspark.sql import functions as F
    from partyfold.sources.landing import land_feed
    root = tempfile.mkdtemp(prefix="land-")
    with open(os.path.join(root, "crm.csv"), "w", encoding="utf-8") as fh:
        fh.write("company_name,employees_volume,annual_revenue\nA,12.0,abc\nB,x,1\nC,,\n")
    got = land_feed(spark, "crm", "file://" + root, os.path.join(root, "lake"), F.current_timestamp().cast("timestamp_ntz"))
    assert got == {"landed": 3, "unreadable": 2}
    assert land_feed(spark, "sales", root, os.path.join(root, "lake"), F.current_timestamp().cast("timestamp_ntz")) == {"landed": 0, "unreadable": 0}


def test_only_a_missing_path_lands_nothing(spark):
    import pytest
    from partyfold.sources.tables import read_or_none
    assert read_or_none(spark, "/tmp/no-such-folder-at-all") is None
    with pytest.raises(Exception):
        read_or_none(spark, "nosuchscheme://x/y")


def test_conf_of_any_size_from_stored_tables(spark):
    import tempfile
    from pyspark.sql import functions as F
    from partyfold.functions import text as tx
    from partyfold.sources.conf import Conf, store_conf
    root = tempfile.mkdtemp(prefix="conf-")
    store_conf(spark, root)
    got, want = Conf.stored(spark, root), Conf.default()
    assert got.replaces == want.replaces and set(got.prefectures) == set(want.prefectures)
    assert {k: set(v) for k, v in got.keywords.items()} == {k: set(v) for k, v in want.keywords.items()}
    pairs = [(f"k{i:04}", f"v{i}") for i in range(5000)]
    df = spark.createDataFrame([("k0000-k4999-k2500 x",), (None,), ("plain",)], "v string")
    assert [r[0] for r in df.select(tx.replace_partial("v", pairs)).collect()] == ["v0-v4999-v2500 x", "", "plain"]
    few = pairs[:tx.NESTED_REPLACES - 1]
    text = spark.range(40).select(F.concat(F.lit("k00"), F.lpad("id", 2, "0")).alias("v"))
    long = text.select(tx.replace_partial("v", pairs[:40]).alias("a"), tx.replace_partial("v", few).alias("b")).collect()
    assert [r.a for r in long] == [f"v{i}" for i in range(40)] and [r.b for r in long][:len(few)] == [f"v{i}" for i in range(len(few))]


def test_manual_merge_is_all_or_nothing(spark):
    import tempfile
    import pytest
    from conftest import SMALL
    from partyfold.operators.manual_merge import BadInstructions, run_manual_merge
    from partyfold.sources.fixtures import seed_company_master
    root = tempfile.mkdtemp(prefix="merge-")
    master = os.path.join(root, "m0")
    seed_company_master(spark, SMALL).write.parquet(master)
    before = spark.read.parquet(master).count()

    def put(text):
        path = os.path.join(tempfile.mkdtemp(prefix="instr-"), "merge.csv")
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(text)
        return path
    with pytest.raises(BadInstructions) as e:
        run_manual_merge(spark, put("0000000001,0000000007\n0000000013,8888888888\n"), master, os.path.join(root, "m1"))
    assert [tuple(r) for r in e.value.problems.collect()] == [("absorbed", "8888888888", "unknown_code")]
    assert not os.path.exists(os.path.join(root, "m1"))
    with pytest.raises(Exception):
        run_manual_merge(spark, os.path.join(root, "none.csv"), master, os.path.join(root, "m1"))
    with pytest.raises(ValueError):
        run_manual_merge(spark, put("0000000001,0000000007,x\n"), master, os.path.join(root, "m1"))
    done = run_manual_merge(spark, put("0000000001\t,\u30000000000007\n"), master, os.path.join(root, "m1"))
    assert done == {"instructions": 1, "company_rows": before - 1, "company_updated": 1, "company_deleted": 1,
                    "company_untouched": before - 2}
    left = {r[0] for r in spark.read.parquet(os.path.join(root, "m1")).select("company_code").collect()}
    assert "0000000001" in left and "0000000007" not in left


def test_one_day_of_the_lake_is_read_alone(spark, tmp_path):
    """Only the day's folder: its partition filter is in the plan, and a column that another day's
    files have does not show."""
    import datetime as dt
    from pyspark.sql import functions as F
    from partyfold.operators.slice import daily_slice
    from partyfold.sources.landing import LANDED_ON, lake, lake_day, replace_day
    days = [dt.date(2025, 12, d) for d in (1, 2, 3)]
    for d in days:
        rows = spark.createDataFrame([(f"c{i}", dt.datetime.combine(d, dt.time(12))) for i in range(d.day)], "company_name string, update_datetime timestamp_ntz")
        if d.day == 2:
            rows = rows.withColumn("campaign", F.lit("x"))
        replace_day(rows.withColumn(LANDED_ON, F.lit(d)), str(tmp_path / "crm"))
    assert "campaign" in lake(spark, "crm", str(tmp_path)).columns
    third = lake_day(spark, "crm", str(tmp_path), days[2])
    assert sorted(third.columns) == ["company_name", "landed_on", "update_datetime"] and third.count() == 3
    assert "campaign" in lake_day(spark, "crm", str(tmp_path), days[1]).columns
    assert lake_day(spark, "crm", str(tmp_path), dt.date(2025, 12, 9)) is None
    whole = lake(spark, "crm", str(tmp_path))
    wanted = daily_slice(whole, days[2], [("company_name", "name"), (None, "upper(company_name) AS upper_name")], ["company_name"], partition=LANDED_ON)
    assert sorted(tuple(r) for r in wanted.collect()) == [(1, "c0", "C0"), (2, "c1", "C1"), (3, "c2", "C2")]
    from partyfold.operators.slice import day_filter
    plan = whole.filter((F.col(LANDED_ON) == F.lit(days[2])) & day_filter(whole, days[2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_on" in plan
