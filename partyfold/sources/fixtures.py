"""Test feeds derived from the driver's tables (FIXTURES.md section 2).

Every feed, seed master and instruction list is computed by Spark from
``customer``, ``supplier`` or ``orders``, so its size grows with theirs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import M_COMPANY_COLUMNS, M_PERSON_COLUMNS
from .tables import read_table, stored

# ---- FIXED VALUES: run time and slice day of the test batch --------------
RUN_TIME = dt.datetime(1997, 1, 15, 13, 0, 0)
SLICE_DAY = dt.date(1997, 1, 15)

FW_DIGITS = "０１２３４５６７８９"


def run_time_lit() -> Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def _base(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    if feed in ("crm", "name_card"):
        k = F.col("c_custkey")
        df = read_table(spark, sf_dir, "customer").select(k.alias("k"), (k - k % 3).alias("e"))
    elif feed in ("purchase", "invoice"):
        k = F.col("s_suppkey")
        df = read_table(spark, sf_dir, "supplier").select(k.alias("k"), ((k - k % 2) * 3).alias("e"))
    elif feed == "sales":
        df = read_table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("k"),
            (F.col("o_custkey") - F.col("o_custkey") % 3).alias("e"),
            F.col("o_orderdate").alias("_day"))
    else:
        raise KeyError(feed)
    return df.withColumn("es", _s(F.col("e")))


def _kes():
    return F.col("k"), F.col("e"), F.col("es")


def PREF() -> Column:
    k, e, es = _kes()
    return (F.when(e % 4 == 0, "東京都").when(e % 4 == 1, "大阪府")
            .when(e % 4 == 2, "北海道").otherwise("神奈川県"))


def STREET() -> Column:
    k, e, es = _kes()
    return F.concat(F.lit("中央区"), _s(e % 9 + 1), F.lit("丁目"), _s(e % 20 + 1), F.lit("番地"),
                    _s(e % 30 + 1), F.lit("号"))


def CNAME() -> Column:
    k, e, es = _kes()
    return (F.when(k % 3 == 0, F.concat(F.lit("株式会社取引先"), es))
            .when(k % 3 == 1, F.concat(F.lit("（株）取引先"), F.translate(es, "0123456789", FW_DIGITS)))
            .otherwise(F.concat(F.lit("㈱ 取引先"), es)))


def PNO() -> Column:
    """Number in a person's name and mail: some rows are the person of the row before."""
    k, e, es = _kes()
    return _s(F.when(k % 10 == 1, k - 1).otherwise(k))


def DOM() -> Column:
    """Number of the mail domain, which four companies share."""
    k, e, es = _kes()
    return _s(e - e % 12)


def EMAIL() -> Column:
    k, e, es = _kes()
    return (F.when(k % 37 == 0, F.lit("bad.example"))
            .when(k % 4 == 0, F.concat(F.lit("INFO@e"), DOM(), F.lit(".example")))
            .when(k % 41 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("taro"), PNO(), F.lit("@e"), es, F.lit(".example"))))


def PHONE() -> Column:
    k, e, es = _kes()
    return (F.when(k % 31 == 0, F.lit("0312"))
            .when(k % 5 == 0, F.concat(F.lit("090-"), _pad(k % 10000, 4), F.lit("-0000")))
            .when(k % 43 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("03-"), _pad(e % 10000, 4), F.lit("-1111"))))


def POST() -> Column:
    k, e, es = _kes()
    return F.concat(F.lit("〒"), _pad(e % 1000, 3), F.lit("-"), _pad(e % 10000, 4))


def INVNO() -> Column:
    k, e, es = _kes()
    return F.when(k % 23 == 0, F.lit("T12")).otherwise(F.concat(F.lit("T"), F.lpad(es, 13, "0")))


def JOB() -> Column:
    k, e, es = _kes()
    return (F.when(k % 6 == 0, "代表取締役").when(k % 6 == 1, "-")
            .when(k % 6 == 2, F.lit(None).cast("string")).otherwise("課長"))


def _company_phone(suffix: str) -> Column:
    k, e, es = _kes()
    return F.concat(F.lit("03-"), _pad(e % 10000, 4), F.lit(suffix))


def feed_columns(feed: str) -> list[Column]:
    """The work columns of a derived feed (without seq)."""
    k, e, es = _kes()
    if feed == "crm":
        return [
            CNAME().alias("company_name"), F.lit("営業部").alias("department"),
            F.concat(F.lit("山田 太郎"), PNO()).alias("name"), F.lit("やまだ ﾀﾛｳ").alias("name_kana"),
            JOB().alias("job_post"), EMAIL().alias("email"), PHONE().alias("phone_number"),
            F.concat(F.lit("https://e"), es, F.lit(".example")).alias("url"),
            F.lit(None).cast("string").alias("postal_code"),
            F.when(k % 29 == 0, F.lit("東京")).otherwise(PREF()).alias("prefecture"),
            STREET().alias("address"), F.lit("ＩＴ").alias("industry"),
            F.when(k % 3 != 0, (e % 500).cast("bigint")).alias("employees_volume"),
            (e % 1000 * 1000).cast("bigint").alias("annual_revenue"),
            (k % 2 == 0).alias("contact_permission"),
        ]
    if feed == "name_card":
        return [
            F.lit("山田").alias("family_name"),
            F.when(k % 11 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("太郎"), PNO())).alias("first_name"),
            F.lit("やまだ").alias("family_name_kana"), F.lit("ﾀﾛｳ").alias("first_name_kana"),
            F.lit("営業１部").alias("department_name"), JOB().alias("position_name"),
            F.lpad(es, 7, "0").alias("postal_code"), CNAME().alias("company_name"),
            F.concat(PREF(), STREET()).alias("address"),
            F.when(k % 2 == 0, F.concat(F.lit("ＡＢＣビル"), _s(k % 9), F.lit("Ｆ"))).alias("building"),
            PHONE().alias("phone_number"), _company_phone("-1111").alias("company_phone_number"),
            EMAIL().alias("email"),
            F.concat(F.lit("info@e"), DOM(), F.lit(".example")).alias("company_email"),
        ]
    if feed == "purchase":
        return [
            CNAME().alias("company_name"),
            F.concat(F.lit("佐藤　次郎"), PNO()).alias("opponent_staff_name"),
            PHONE().alias("phone_number"), EMAIL().alias("email_address"),
            F.concat(POST(), PREF(), STREET()).alias("address"),
            INVNO().alias("invoice_company_number"),
        ]
    if feed == "sales":
        return [
            CNAME().alias("customer_company_name"),
            F.concat(F.lit("鈴木 花子"), F.when(k % 7 == 0, es).otherwise(_s(k))).alias("customer_person_name"),
            F.when(k % 7 == 0, F.concat(F.lit("090-"), _pad(e % 10000, 4), F.lit("-0000")))
             .otherwise(PHONE()).alias("phone_number1"),
            F.when(k % 3 == 0, F.concat(F.lit("080-"), _pad(k % 10000, 4), F.lit("-2222")))
             .alias("phone_number2"),
            EMAIL().alias("email_address"),
            F.concat(POST(), F.lit(" "), PREF(), STREET()).alias("address"),
        ]
    if feed == "invoice":
        return [
            CNAME().alias("invoice_issuer"), PHONE().alias("tel_number"),
            F.when(k % 19 == 0, F.lit("1")).otherwise(_company_phone("-9999")).alias("fax_number"),
            F.concat(F.lit("info@e"), DOM(), F.lit(".example")).alias("email"),
            F.concat(POST(), PREF(), STREET()).alias("address"),
            INVNO().alias("invoice_company_number"),
        ]
    raise KeyError(feed)


def work_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's work rows: ``seq`` (= source key) + the feed's columns.

    The derived rows stand in for a landed lake table, so they are stored as one
    (parquet, in as many files as there are cores to read them); a query then reads
    just the columns it needs."""
    rows = _base(spark, sf_dir, feed).repartition(spark.sparkContext.defaultParallelism)
    return stored(rows.select(F.col("k").cast("bigint").alias("seq"), *feed_columns(feed)), f"feed-{feed}")


def lake_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Landed rows of a feed: the work rows stamped with the run time."""
    return work_feed(spark, sf_dir, feed).withColumns(
        {"insert_datetime": run_time_lit(), "update_datetime": run_time_lit()})


def sales_lake_by_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed as a lake whose rows were updated on their order date."""
    return _base(spark, sf_dir, "sales").select(
        F.col("k").alias("source_key"), *feed_columns("sales"),
        F.col("_day").cast("timestamp_ntz").alias("update_datetime"))


def _typed_master(df: DataFrame, layout, types: dict) -> DataFrame:
    present = set(df.columns)
    return df.select(*[
        F.col(c) if c in present else F.lit(None).cast(types.get(c, "string")).alias(c)
        for c in layout])


COMPANY_TYPES = {"employees_volume": "bigint", "annual_revenue": "bigint",
                 "contact_permission": "boolean", "customer_flag": "boolean",
                 "supplier_flag": "boolean", "payment_flag": "boolean",
                 "insert_datetime": "timestamp_ntz", "update_datetime": "timestamp_ntz"}
PERSON_TYPES = {"insert_datetime": "timestamp_ntz", "update_datetime": "timestamp_ntz"}


def seed_company_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e, es = _kes()
    c = F.col("c_custkey")
    base = read_table(spark, sf_dir, "customer").select(c.alias("e"))
    other = e % 6 != 0            # in the master, but matched by no feed
    df = base.select(
        _pad(e + 1, 10).alias("company_code"),
        F.when(other & (e % 6 == 2), F.concat(F.lit("休眠商亊"), _s(e - 1)))     # a variant of the name before
         .when(other, F.concat(F.lit("休眠商事"), _s(e))).when(e % 4 == 0, F.concat(F.lit("取引先"), _s(e)))
         .otherwise(F.concat(F.lit("株式会社取引先"), _s(e))).alias("company_name"),
        F.when(other, F.lit("")).otherwise(
            F.concat(PREF(), F.lit("中央区"), _s(e % 9 + 1), F.lit("-"), _s(e % 20 + 1), F.lit("-"),
                     _s(e % 30 + 1))).alias("full_address"),
        F.when(other | (e % 12 == 0), F.lit(""))
         .otherwise(F.concat(F.lit("03"), _pad(e % 10000, 4), F.lit("1111"))).alias("main_phone_number"),
        F.when(e % 30 == 0, F.concat(F.lit("info@e"), DOM(), F.lit(".example")))
         .otherwise(F.lit("")).alias("main_email_address"),
        (e % 4 * 100).cast("bigint").alias("employees_volume"),
        (e % 8 == 0).alias("supplier_flag"),
    )
    return _typed_master(df, M_COMPANY_COLUMNS, COMPANY_TYPES)


def seed_person_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e, es = _kes()
    c = F.col("c_custkey")
    base = read_table(spark, sf_dir, "customer").select(c.alias("k"))
    other = k % 2 != 0            # in the master, but matched by no feed
    df = base.select(
        _pad(k + 1, 10).alias("person_id"),
        F.concat(F.when(other, F.lit("休眠太郎")).otherwise(F.lit("山田太郎")), _s(k)).alias("name"),
        _pad(k - k % 6 + 1, 10).alias("company_code"),
        F.when(k % 18 == 0, F.lit("代表取締役社長")).otherwise(F.lit("課長")).alias("job_post"),
        F.when(k % 10 == 0, F.concat(F.lit("090"), _pad(k % 10000, 4), F.lit("0000")))
         .otherwise(F.lit("")).alias("phone_number"),
        F.when(other, F.lit("")).otherwise(
            F.concat(F.lit("taro"), _s(k), F.lit("@e"), _s(k - k % 3), F.lit(".example"))).alias("email_address"),
    )
    return _typed_master(df, M_PERSON_COLUMNS, PERSON_TYPES)


def merge_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(survivor, absorbed) rows; the last two are invalid on purpose."""
    c = F.col("c_custkey")
    valid = (read_table(spark, sf_dir, "customer").filter((c % 60 == 0) & (c > 0))
             .select(_pad(c + 1, 10).alias("survivor"), _pad(c + 7, 10).alias("absorbed")))
    bad = spark.createDataFrame([("9999999999", "0000000007"), (" 0000000013 ", "8888888888"),
                                 ("0000000025\t", "\u30000000000031"), ("\u3000 7777777777", "0000000037\t")],
                                "survivor string, absorbed string")
    return valid.unionByName(bad)
