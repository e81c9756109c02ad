"""R1-R19 edge cases (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from partyfold.functions import text as tx

from conftest import one_col


def run(spark, values, expr_fn):
    df = one_col(spark, values)
    return [r[0] for r in df.select(expr_fn("v")).collect()]


def test_remove_spaces_keeps_tabs(spark):
    assert run(spark, ["a b　c\td", None], tx.remove_spaces) == ["abc\td", ""]


def test_digits_keep_fullwidth(spark):
    assert run(spark, ["０３-12", None, "なし"], tx.digits_only) == ["０３12", "", ""]


def test_half_kana_to_full(spark):
    assert run(spark, ["ｶﾞﾊﾟｱｰｶ", "ｯ", "霞ヶ関", "ｯﾞ", "ｶﾟ", None], tx.kana_half_to_full) == \
        ["ガパアーカ", "ｯ", "霞ケ関", "ッ", "カﾟ", ""]


def test_hiragana_to_katakana(spark):
    assert run(spark, ["やまだタロウ", "ゔぁゖ"], tx.person_kana) == ["ヤマダタロウ", "ヴァヶ"]


def test_address(spark, conf):
    got = run(spark, ["丸の内1丁目2番地3号ビル4F", "1丁目2番3号", "-a--1--", "中央区１丁目２番地", None],
              lambda c: tx.address(c, conf))
    assert got == ["丸の内1-2-3ビル4F", "1-2番3", "a-1", "中央区1-2", ""]


def test_company_name(spark, conf):
    got = run(spark, ["（株）取引先１", "㈱ 取引先1", "株式会社取引先1", "ｱｲｳ(有)"], lambda c: tx.company_name(c, conf))
    assert got == ["株式会社取引先1", "株式会社取引先1", "株式会社取引先1", "アイウ有限会社"]


def test_job_post(spark, conf):
    got = run(spark, [None, "-", "課長", "", "ヒラ", " 平社員 "], lambda c: tx.job_post(c, conf))
    assert got == ["役職なし", "役職なし", "課長", "役職なし", "役職なし", "役職なし"]


def test_exact_chain_follows_later_pairs():
    assert tx.exact_chain([("a", "b"), ("b", "c"), ("c", "a")]) == {"a": "a", "b": "a", "c": "a"}
    assert tx.exact_chain([("b", "c"), ("a", "b")]) == {"b": "c", "a": "b"}


def test_postal_split(spark, conf):
    df = one_col(spark, ["〒100-0005東京都", "1000005東京都", "東京都", "〒〒１２３４５６７大阪府", None])
    rows = df.select(tx.postal_text("v", conf).alias("t")).select(
        tx.postal_part("t").alias("p"), tx.after_postal("t").alias("a")).collect()
    assert [(r.p, r.a) for r in rows] == [("1000005", "東京都"), ("1000005", "東京都"), ("", "東京都"),
                                          ("１２３４５６７", "大阪府"), ("", "")]


def test_prefecture_extract_and_code(spark, conf):
    df = one_col(spark, ["東京都府中市1", "京都府京都市", "北海道札幌市", "札幌市", None, "神奈川県横浜市"])
    rows = df.select(tx.extract_prefecture("v").alias("p")).select(
        "p", tx.prefecture_code("p", conf).alias("c")).collect()
    assert [(r.p, r.c) for r in rows] == [("東京都府", None), ("京都府", "26"), ("北海道", "01"), ("", None),
                                          ("", None), ("神奈川県", "14")]


def test_phone_and_mail_split(spark, conf):
    df = spark.createDataFrame([("09012345678", "info@x.jp"), ("0312345678", "taro@x.jp"), ("", "")],
                               "p string, m string")
    rows = df.select(tx.personal_phone("p", conf).alias("pp"), tx.company_phone("p", conf).alias("cp"),
                     tx.company_mail("m", conf).alias("cm"), tx.personal_mail("m", conf).alias("pm")).collect()
    assert [tuple(r) for r in rows] == [("09012345678", "", "info@x.jp", ""), ("", "0312345678", "", "taro@x.jp"),
                                        ("", "", "", "")]


def test_concat_blank_vs_strict(spark, conf):
    df = spark.createDataFrame([(None, "X"), ("X", None)], "a string, b string")
    rows = df.select(tx.address(tx.concat_strict("a", "b"), conf).alias("s"),
                     tx.address(tx.concat_blank("a", "b"), conf).alias("n")).collect()
    assert [(r.s, r.n) for r in rows] == [("", "X"), ("", "X")]
