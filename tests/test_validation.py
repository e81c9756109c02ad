"""C1-C12 edge cases."""

from partyfold.functions import rules
from partyfold.operators.validate import clean_rows, error_records
from partyfold.sources.fixtures import run_time_lit

from conftest import one_col


def flags(spark, values, fn):
    return [r[0] for r in one_col(spark, values).select(fn("v")).collect()]


def test_mail(spark):
    assert flags(spark, [None, "", "a.b", "a@b"], rules.bad_mail) == [False, True, True, False]


def test_phone(spark):
    assert flags(spark, ["なし", "090-1234-5678", "03-123", None, "123456789012"], rules.bad_phone) == \
        [False, False, True, False, True]


def test_prefecture(spark, conf):
    got = flags(spark, ["東京都府中市1", "京都府京都市", "北海道札幌市", "札幌市", None],
                lambda c: rules.bad_prefecture(c, conf))
    assert got == [True, False, False, True, True]


def test_name_only(spark, conf):
    df = spark.createDataFrame([(None, "03-1111-2222"), ("info@x", "03-1111-2222"),
                                ("INFO@x", "03-1111-2222"), ("info@x", "090-1111-2222")], "m string, p string")
    got = [r[0] for r in df.select(rules.name_only("m", ["p"], conf)).collect()]
    assert got == [False, True, False, False]


def test_invoice_number(spark):
    assert flags(spark, ["T1234567890123", "T123", None], rules.bad_invoice_number) == [False, True, False]


def test_two_bad_phones_give_two_rows(spark, conf):
    df = spark.createDataFrame(
        [(1, "x", "y", "03-1", "04-2", "taro@x", "東京都港区"),
         (2, "x", "y", "0312345678", None, "taro@x", "東京都港区")],
        "seq bigint, customer_company_name string, customer_person_name string, phone_number1 string, "
        "phone_number2 string, email_address string, address string")
    from partyfold.plans.specs import FEEDS
    errs = error_records(df, FEEDS["sales"].checks, conf, run_time_lit()).collect()
    assert [(r.error_seq, r.error_reason) for r in sorted(errs, key=lambda r: r.error_seq)] == \
        [(1, "INVALID_PHONE_NUMBER"), (2, "INVALID_PHONE_NUMBER")]
    assert [r.seq for r in clean_rows(df, FEEDS["sales"].checks, conf).collect()] == [2]


def test_error_seq_continues(spark, conf):
    df = spark.createDataFrame([(1, "bad"), (2, "ok@x"), (3, "bad2")], "seq bigint, email string")
    errs = error_records(df, [("mail", "email")], conf, run_time_lit(), max_existing_seq=41).collect()
    assert sorted((r.error_seq, r.email) for r in errs) == [(42, "bad"), (43, "bad2")]
    assert "seq" not in errs[0].asDict()


def test_every_row_is_clean_or_error(spark, conf):
    from partyfold.sources.fixtures import work_feed
    from partyfold.plans.specs import FEEDS
    from conftest import SMALL
    from pyspark.sql import functions as F
    for feed in FEEDS:
        work = work_feed(spark, SMALL, feed)
        checks = FEEDS[feed].checks
        clean = clean_rows(work, checks, conf).select("seq")
        from partyfold.operators.validate import failing_rows
        bad = failing_rows(work, checks, conf).select("seq").distinct()
        assert clean.join(bad, "seq").count() == 0
        assert clean.count() + bad.count() == work.count()
