"""The daily batch on real CSV files, twice (second day numbers errors on)."""

import datetime as dt
import os
import tempfile

from partyfold.plans.daily import run_daily
from partyfold.functions.fixed import CSV_COLUMNS


def _csv(path, feed, rows):
    cols = CSV_COLUMNS[feed]
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",".join(cols) + "\n")
        for r in rows:
            fh.write(",".join(r.get(c, "") for c in cols) + "\n")


def test_two_days(spark):
    from conftest import SMALL
    from partyfold.sources.fixtures import seed_company_master, seed_person_master
    root = tempfile.mkdtemp(prefix="daily-")
    m0c, m0p = os.path.join(root, "mc0"), os.path.join(root, "mp0")
    seed_company_master(spark, SMALL).limit(0).write.parquet(m0c)
    seed_person_master(spark, SMALL).limit(0).write.parquet(m0p)
    csv = os.path.join(root, "csv")
    os.makedirs(csv)
    _csv(os.path.join(csv, "crm.csv"), "crm", [
        dict(company_name="（株）テスト", name="山田 太郎", email="taro@test.example", phone_number="090-1111-2222",
             prefecture="東京都", address="千代田区1丁目2番地", job_post="代表取締役"),
        dict(company_name="株式会社テスト", name="山田太郎", email="taro@test.example", phone_number="0312345678",
             prefecture="東京都", address="千代田区1丁目2番地", job_post="代表取締役社長"),
        dict(company_name="悪い", name="x", email="no-at", phone_number="03", prefecture="東京", address="a"),
    ])
    _csv(os.path.join(csv, "invoice.csv"), "invoice", [
        dict(invoice_issuer="㈱テスト", tel_number="03-1234-5678", email="info@test.example",
             address="〒100-0001東京都千代田区1丁目2番地", invoice_company_number="T1234567890123"),
    ])
    day1 = dt.datetime(2025, 12, 14, 13, 0)
    counts = run_daily(spark, csv, os.path.join(root, "lake"), os.path.join(root, "error"), m0c, m0p,
                       os.path.join(root, "mc1"), os.path.join(root, "mp1"), day1)
    assert counts["landed_crm"] == 3 and counts["landed_sales"] == 0
    mc = spark.read.parquet(os.path.join(root, "mc1")).collect()
    assert len(mc) == 1                                   # both CRM rows and the invoice are one company
    c = mc[0]
    assert c.company_name == "株式会社テスト" and c.full_address == "東京都千代田区1-2"
    assert c.customer_flag is True and c.payment_flag is True and c.main_phone_number == "0312345678"
    assert c.invoice_company_number == "T1234567890123" and c.postal_code == "1000001"
    mp = spark.read.parquet(os.path.join(root, "mp1")).collect()
    assert len(mp) == 1 and mp[0].company_code == c.company_code
    assert c.president_person_id == mp[0].person_id
    errs = spark.read.parquet(os.path.join(root, "error", "crm")).collect()
    assert sorted(e.error_seq for e in errs) == [1, 2, 3]
    # day 2: the same files again -> lake keeps growing, only day-2 rows are sliced
    day2 = dt.datetime(2025, 12, 15, 13, 0)
    run_daily(spark, csv, os.path.join(root, "lake"), os.path.join(root, "error"), os.path.join(root, "mc1"),
              os.path.join(root, "mp1"), os.path.join(root, "mc2"), os.path.join(root, "mp2"), day2)
    assert spark.read.parquet(os.path.join(root, "mc2")).count() == 1
    errs = spark.read.parquet(os.path.join(root, "error", "crm")).collect()
    assert sorted(e.error_seq for e in errs) == list(range(1, 7))
    # the second day once more (a retry): nothing lands twice, numbers stay
    again = run_daily(spark, csv, os.path.join(root, "lake"), os.path.join(root, "error"), os.path.join(root, "mc1"),
                      os.path.join(root, "mp1"), os.path.join(root, "mc3"), os.path.join(root, "mp3"), day2)
    assert again["landed_crm"] == 3 and again["work_crm"] == 3 and again["errors_crm"] == 3 and again["company_rows"] == 1
    assert spark.read.parquet(os.path.join(root, "lake", "crm")).count() == 6
    errs = spark.read.parquet(os.path.join(root, "error", "crm")).collect()
    assert sorted(e.error_seq for e in errs) == list(range(1, 7))


def _company(i, **more):
    return dict(company_name=f"株式会社会社{i}", name=f"担当{i}", email=f"p{i}@c{i}.example", phone_number=f"0901111{i:04d}",
                prefecture="東京都", address=f"千代田区{i}丁目", job_post="社長" if i % 2 else "課長") | more


def test_days_on_kept_indexes_equal_days_from_plain_masters(spark):
    """Two days, once with the indexes each run leaves for the next, once indexing the masters anew."""
    from conftest import SMALL
    from pyspark.sql import functions as F
    from partyfold.operators.reports import error_trend
    from partyfold.sources.fixtures import seed_company_master, seed_person_master
    root = tempfile.mkdtemp(prefix="daily-")
    at = lambda *names: os.path.join(root, *names)
    seed_company_master(spark, SMALL).write.parquet(at("c0"))
    seed_person_master(spark, SMALL).write.parquet(at("p0"))
    days = [dt.datetime(2025, 12, 14, 13, 0), dt.datetime(2025, 12, 15, 13, 0)]
    feeds = [[_company(i) for i in range(1, 7)] + [_company(8, email="no-at")],
             [_company(i, job_post="課長", url="https://new.example") for i in range(3, 9)] + [_company(9, prefecture="東京", phone_number="1")]]
    results = {}
    for kind in ("plain", "kept"):
        index = None
        for n, day in enumerate(days, start=1):
            csv = at(f"csv{n}")
            os.makedirs(csv, exist_ok=True)
            _csv(os.path.join(csv, "crm.csv"), "crm", feeds[n - 1])
            before = lambda x: at(f"{x}0") if n == 1 else at(f"{kind}-{x}{n - 1}")
            counts = run_daily(spark, csv, at(f"{kind}-lake"), at(f"{kind}-error"), before("c"), before("p"), at(f"{kind}-c{n}"),
                               at(f"{kind}-p{n}"), day, index_in=index, index_out=at(f"{kind}-index{n}"), buckets=4,
                               run_log=at(f"{kind}-log"))
            index = at(f"{kind}-index{n}") if kind == "kept" else None
            results[kind, n] = (counts, *(sorted(map(str, spark.read.parquet(at(f"{kind}-{x}{n}")).collect())) for x in "cp"))
    links = ("company_updated", "company_untouched")      # masters that are indexed anew are linked as a whole
    for n in (1, 2):
        (a, *plain), (b, *kept) = results["plain", n], results["kept", n]
        assert plain == kept and {k: v for k, v in a.items() if k not in links} == {k: v for k, v in b.items() if k not in links}
    counts = results["kept", 2][0]
    known = spark.read.parquet(at("kept-c1")).count()
    assert counts["company_rows"] == known + counts["company_inserted"] == counts["company_inserted"] + counts["company_updated"] + counts["company_untouched"]
    assert counts["company_inserted"] == 2 and 4 <= counts["company_updated"] <= 6 and counts["errors_crm"] == 2
    logged = {(r.run_time, r.step): r.row_count for r in spark.read.parquet(at("kept-log")).collect()}
    assert logged == {(d, k): v for n, d in enumerate(days, start=1) for k, v in results["kept", n][0].items()}
    # errors by day from the count table; a second run of the day replaces its counts
    trend = sorted(tuple(r) for r in error_trend(spark, at("kept-error", "daily_counts")).collect())
    assert [(r[0], r[2], r[3]) for r in trend] == [(days[0].date(), "INVALID_MAIL_ADDRESS_FORMAT", 1), (days[1].date(), "INVALID_PHONE_NUMBER", 1),
                                                   (days[1].date(), "INVALID_PREFECTURE", 1)]
    _csv(at("csv2", "crm.csv"), "crm", feeds[1][:-1])
    again = run_daily(spark, at("csv2"), at("kept-lake"), at("kept-error"), at("kept-c1"), at("kept-p1"), at("again-c"), at("again-p"), days[1],
                      index_in=at("kept-index1"), buckets=4)
    assert again["errors_crm"] == 0
    assert error_trend(spark, at("kept-error", "daily_counts"), first_day=days[1].date()).count() == 0
    assert spark.read.parquet(at("kept-error", "crm")).filter(F.col("landed_on") == F.lit(days[1].date())).count() == 0
