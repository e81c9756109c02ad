"""Standardising jobs D1-D5: one ``select`` of nested built-ins per feed.

Output: ``seq``, the feed's ``normalized_*`` columns, and the raw columns the
master views still need. No shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..sources.conf import Conf


# Heavy intermediates (digits-only phone, standardised mail, the postal split,
# the cleaned job title) are computed once in a first select and referenced
# by name afterwards, so no expression tree is duplicated.

def _split_phone(digits: str, conf: Conf):
    return (tx.personal_phone(digits, conf).alias("normalized_personal_phone_number"),
            tx.company_phone(digits, conf).alias("normalized_company_phone_number"))


def _split_mail(mail: str, conf: Conf):
    return (tx.company_mail(mail, conf).alias("normalized_company_email"),
            tx.personal_mail(mail, conf).alias("normalized_personal_email"))


def _job(c, conf: Conf):
    return tx.department(c, conf).alias("_job")


def _job_final(conf: Conf):
    pairs = [("", fixed.NO_JOB_POST)] + list(conf.replaces_of(fixed.REPLACE_NO_JOB_POST))
    return tx.replace_exact("_job", pairs).alias("normalized_job_post")


def _postal_text(col: str, conf: Conf):
    return tx.postal_text(col, conf).alias("_ptext")


def _postal_and_address(conf: Conf):
    return (tx.postal_part("_ptext").alias("_postal"), tx.after_postal("_ptext").alias("_rest"))


def _postal_final(conf: Conf):
    return (tx.address("_rest", conf).alias("normalized_full_address"),
            tx.digits_only("_postal").alias("normalized_postal_code"))


def standardize_crm(df: DataFrame, conf: Conf) -> DataFrame:
    passthrough = ["postal_code", "prefecture", "employees_volume", "annual_revenue", "url",
                   "industry", "contact_permission"]
    # prefecture + address: null when either part is null, then "" (R12)
    stage = df.select(
        "seq", *passthrough,
        tx.digits_only("phone_number").alias("_phone"), tx.mail("email").alias("_mail"),
        tx.person_name("name").alias("normalized_personal_name"),
        tx.person_kana("name_kana").alias("normalized_personal_name_kana"),
        tx.company_name("company_name", conf).alias("normalized_company_name"),
        tx.address(tx.concat_strict("prefecture", "address"), conf).alias("normalized_full_address"),
        tx.department("department", conf).alias("normalized_department"),
        _job("job_post", conf))
    return stage.select(
        "seq", *_split_phone("_phone", conf), "normalized_personal_name",
        "normalized_personal_name_kana", "normalized_company_name", "normalized_full_address",
        *_split_mail("_mail", conf), "normalized_department", _job_final(conf), *passthrough)


def standardize_name_card(df: DataFrame, conf: Conf) -> DataFrame:
    # separate personal / company columns in this feed: no split needed
    stage = df.select(
        "seq",
        tx.digits_only("phone_number").alias("normalized_personal_phone_number"),
        tx.digits_only("company_phone_number").alias("normalized_company_phone_number"),
        tx.person_name(tx.concat_blank("family_name", "first_name")).alias("normalized_personal_name"),
        tx.person_kana(tx.concat_blank("family_name_kana", "first_name_kana"))
          .alias("normalized_personal_name_kana"),
        tx.company_name("company_name", conf).alias("normalized_company_name"),
        tx.address(tx.concat_blank("address", "building"), conf).alias("normalized_full_address"),
        tx.mail("email").alias("normalized_personal_email"),
        tx.mail("company_email").alias("normalized_company_email"),
        tx.department("department_name", conf).alias("normalized_department"),
        _job("position_name", conf),
        tx.digits_only("postal_code").alias("normalized_postal_code"))
    return stage.select(*[c for c in stage.columns if c != "_job"], _job_final(conf))


def standardize_purchase(df: DataFrame, conf: Conf) -> DataFrame:
    stage = df.select(
        "seq", "invoice_company_number",
        tx.company_name("company_name", conf).alias("normalized_company_name"),
        tx.person_name("opponent_staff_name").alias("normalized_personal_name"),
        tx.digits_only("phone_number").alias("_phone"), tx.mail("email_address").alias("_mail"),
        _postal_text("address", conf))
    stage = stage.select("*", *_postal_and_address(conf))
    return stage.select(
        "seq", "normalized_company_name", "normalized_personal_name",
        *_split_phone("_phone", conf), *_split_mail("_mail", conf), *_postal_final(conf),
        "invoice_company_number")


def standardize_sales(df: DataFrame, conf: Conf) -> DataFrame:
    stage = df.select(
        "seq",
        tx.company_name("customer_company_name", conf).alias("normalized_company_name"),
        tx.person_name("customer_person_name").alias("normalized_personal_name"),
        tx.digits_only("phone_number1").alias("_p1"), tx.digits_only("phone_number2").alias("_p2"),
        tx.mail("email_address").alias("_mail"), _postal_text("address", conf))
    stage = stage.select("*", *_postal_and_address(conf))

    def first_filled(a, b):
        return F.when(a != F.lit(""), a).otherwise(b)

    return stage.select(
        "seq", "normalized_company_name", "normalized_personal_name",
        first_filled(tx.personal_phone("_p1", conf), tx.personal_phone("_p2", conf))
          .alias("normalized_personal_phone_number"),
        first_filled(tx.company_phone("_p1", conf), tx.company_phone("_p2", conf))
          .alias("normalized_company_phone_number"),
        *_split_mail("_mail", conf), *_postal_final(conf))


def standardize_invoice(df: DataFrame, conf: Conf) -> DataFrame:
    stage = df.select(
        "seq", "invoice_company_number",
        tx.company_name("invoice_issuer", conf).alias("normalized_company_name"),
        tx.digits_only("tel_number").alias("normalized_company_phone_number"),
        tx.digits_only("fax_number").alias("normalized_company_fax_number"),
        tx.mail("email").alias("normalized_company_email"),
        _postal_text("address", conf))
    stage = stage.select("*", *_postal_and_address(conf))
    return stage.select(
        "seq", "normalized_company_name", "normalized_company_phone_number",
        "normalized_company_fax_number", "normalized_company_email", *_postal_final(conf),
        "invoice_company_number")


STANDARDIZERS = {
    "crm": standardize_crm,
    "name_card": standardize_name_card,
    "purchase": standardize_purchase,
    "sales": standardize_sales,
    "invoice": standardize_invoice,
}


def standardize(feed: str, df: DataFrame, conf: Conf) -> DataFrame:
    return STANDARDIZERS[feed](df, conf)


def normalized_only(df: DataFrame) -> DataFrame:
    """The normalised-table layout: seq + normalized_* columns."""
    return df.select("seq", *[c for c in df.columns if c.startswith("normalized_")])
