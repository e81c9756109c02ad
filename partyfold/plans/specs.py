"""Per-feed specifications: rules, master views and update column lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..sources.conf import Conf


@dataclass(frozen=True)
class FeedSpec:
    name: str
    priority: int                 # fold order: 1 is applied first (weakest)
    checks: tuple                 # validation rules, in order
    flag: str | None              # company flag the feed sets to true
    company_extra: tuple          # update columns beyond the base list
    has_person: bool
    raw_prefecture: bool = False  # prefecture code from the raw column (crm)


# ---- FIXED VALUES: rules, flags and update columns of each feed -----------------
BASE_COMPANY_UPDATE = ("company_name", "postal_code", "prefecture_code", "full_address",
                       "main_phone_number", "main_email_address", "update_datetime")

FEEDS = {
    "crm": FeedSpec(
        "crm", 1,
        (("mail", "email"), ("phone", "phone_number"), ("prefecture", "prefecture"),
         ("name_only", "email", ("phone_number",))),
        "customer_flag",
        ("employees_volume", "annual_revenue", "url", "industry", "contact_permission", "customer_flag"),
        True, raw_prefecture=True),
    "name_card": FeedSpec(
        "name_card", 2,
        (("mail", "email"), ("mail", "company_email"), ("phone", "phone_number"),
         ("phone", "company_phone_number"), ("prefecture", "address"),
         ("name_only", "email", ("phone_number",))),
        None, (), True),
    "purchase": FeedSpec(
        "purchase", 3,
        (("mail", "email_address"), ("phone", "phone_number"), ("prefecture", "address"),
         ("name_only", "email_address", ("phone_number",)),
         ("invoice_number", "invoice_company_number")),
        "supplier_flag", ("invoice_company_number", "supplier_flag"), True),
    "sales": FeedSpec(
        "sales", 4,
        (("mail", "email_address"), ("phone", "phone_number1"), ("phone", "phone_number2"),
         ("prefecture", "address"), ("name_only", "email_address", ("phone_number1", "phone_number2"))),
        "customer_flag", ("customer_flag",), True),
    "invoice": FeedSpec(
        "invoice", 5,
        (("mail", "email"), ("phone", "tel_number"), ("fax", "fax_number"), ("prefecture", "address"),
         ("invoice_number", "invoice_company_number")),
        "payment_flag", ("fax_number", "invoice_company_number", "payment_flag"), False),
}
FEED_ORDER = tuple(sorted(FEEDS, key=lambda f: FEEDS[f].priority))
PERSON_FEEDS = tuple(f for f in FEED_ORDER if FEEDS[f].has_person)


def company_update_columns(feed: str) -> tuple:
    """Columns a company update sets for this feed (flags are added by the OR rule)."""
    spec = FEEDS[feed]
    base = list(BASE_COMPANY_UPDATE[:-1]) + [c for c in spec.company_extra] + ["update_datetime"]
    return tuple(dict.fromkeys(base))


VIEW_TYPES = {"employees_volume": "bigint", "annual_revenue": "bigint"}


def _null(name: str) -> Column:
    return F.lit(None).cast(VIEW_TYPES.get(name, "string")).alias(name)


COMPANY_VIEW_COLUMNS = tuple(c for c in fixed.M_COMPANY_COLUMNS
                             if c not in ("company_code", "president_person_id"))


def company_view_parts(feed: str, std: DataFrame, conf: Conf, now: Column):
    """B5 + B7 split in two: (seq + the columns that vary per row, and the
    columns that are constant for the feed: flags, run time, absent ones).
    De-duplication only needs to carry the first part."""
    spec = FEEDS[feed]
    cols = set(std.columns)
    # standardised text is never null; coalesce states that in the schema, which lets
    # de-duplication carry these columns in one buffer
    std_col = lambda c: F.coalesce(F.col(c), F.lit(""))
    if spec.raw_prefecture:
        pref = tx.prefecture_code("prefecture", conf)
    else:
        pref = tx.prefecture_code(tx.Sql(tx.s_extract_prefecture(tx.ident("normalized_full_address"))), conf)
    postal = std_col("normalized_postal_code") if "normalized_postal_code" in cols else F.col("postal_code")
    varying = {
        "company_name": std_col("normalized_company_name"),
        "postal_code": postal,
        "prefecture_code": pref,
        "full_address": std_col("normalized_full_address"),
        "main_phone_number": std_col("normalized_company_phone_number"),
        "main_email_address": std_col("normalized_company_email"),
    }
    for raw in ("employees_volume", "annual_revenue", "url", "industry", "invoice_company_number",
                "contact_permission"):
        if raw in cols:
            varying[raw] = F.col(raw)
    if "normalized_company_fax_number" in cols:
        varying["fax_number"] = std_col("normalized_company_fax_number")
    constants = {"insert_datetime": now, "update_datetime": now}
    if "contact_permission" not in varying:
        constants["contact_permission"] = F.lit(False)
    for flag in ("customer_flag", "supplier_flag", "payment_flag"):
        constants[flag] = F.lit(spec.flag == flag)
    for c in COMPANY_VIEW_COLUMNS:
        if c not in varying and c not in constants:
            constants[c] = F.lit(None).cast(VIEW_TYPES.get(c, "string"))
    var_df = std.select("seq", *[varying[c].alias(c) for c in COMPANY_VIEW_COLUMNS if c in varying])
    return var_df, {c: constants[c] for c in COMPANY_VIEW_COLUMNS if c in constants}


def with_constants(df: DataFrame, constants: dict, layout) -> DataFrame:
    """Add constant columns back and restore the layout (extra columns kept at the end)."""
    present = set(df.columns)
    out = [F.col(c) if c in present else constants[c].alias(c) for c in layout]
    extra = [c for c in df.columns if c not in layout]
    return df.select(*out, *extra)


def company_view(feed: str, std: DataFrame, conf: Conf, now: Column) -> DataFrame:
    """B5 + B7: standardised rows in the master layout, with seq."""
    var_df, constants = company_view_parts(feed, std, conf, now)
    return with_constants(var_df, constants, ("seq",) + COMPANY_VIEW_COLUMNS)


PERSON_VIEW_COLUMNS = tuple(c for c in fixed.M_PERSON_COLUMNS if c != "person_id")


def person_view_parts(std_with_code: DataFrame, now: Column):
    """B6 split like ``company_view_parts``."""
    cols = set(std_with_code.columns)
    src = {
        "name": "normalized_personal_name", "name_kana": "normalized_personal_name_kana",
        "company_code": "company_code", "department": "normalized_department",
        "job_post": "normalized_job_post", "phone_number": "normalized_personal_phone_number",
        "email_address": "normalized_personal_email",
    }
    varying, constants = [], {}
    for c in PERSON_VIEW_COLUMNS:
        if c in ("insert_datetime", "update_datetime"):
            constants[c] = now
        elif src[c] in cols:
            value = F.col(src[c])
            varying.append((value if c == "company_code" else F.coalesce(value, F.lit(""))).alias(c))
        else:
            constants[c] = F.lit(None).cast("string")
    return std_with_code.select("seq", *varying), constants


def person_view(std_with_code: DataFrame, now: Column) -> DataFrame:
    """Standardised rows (with their attached company_code) in the person layout."""
    var_df, constants = person_view_parts(std_with_code, now)
    return with_constants(var_df, constants, ("seq",) + PERSON_VIEW_COLUMNS)
