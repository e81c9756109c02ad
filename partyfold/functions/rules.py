"""Validation rules (C1-C6) as boolean Column expressions: True means NG.

Rules read the raw work columns, before standardising.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import col_, company_mail_prefixes, digits_only, extract_prefecture, \
    personal_phone_prefixes
from ..sources.conf import Conf


def _ng(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


# Present and without "@"
def bad_mail(c) -> Column:
    c = col_(c)
    return _ng(c.isNotNull() & ~c.contains("@"))


# Some digits, but fewer than 10 or more than 11
def bad_phone(c) -> Column:
    n = F.length(digits_only(c))
    return _ng((n > 0) & ((n < fixed.PHONE_MIN_DIGITS) | (n > fixed.PHONE_MAX_DIGITS)))


# C4: the extracted prefecture is not a known one (no match / null is NG)
def bad_prefecture(c, conf: Conf) -> Column:
    names = list(dict.fromkeys(conf.prefecture_names))
    if not names:
        return F.lit(True)
    return _ng(~extract_prefecture(c).isin(names))


def _raw_starts_with_any(c: Column, prefixes) -> Column:
    prefixes = list(dict.fromkeys(prefixes))
    if not prefixes:
        return F.lit(False)
    hit = reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])
    # a hit only counts when it leaves a non-empty value behind
    return _ng(hit & (c != F.lit("")))


# A company mailbox and no personal phone -> only the name identifies the person
def name_only(mail_col, phone_cols, conf: Conf) -> Column:
    company_mail = _raw_starts_with_any(col_(mail_col), company_mail_prefixes(conf))
    prefixes = personal_phone_prefixes(conf)
    personal = [_raw_starts_with_any(col_(p), prefixes) for p in phone_cols]
    any_personal = reduce(lambda a, b: a | b, personal) if personal else F.lit(False)
    return company_mail & ~any_personal


# Present and not "T" + 13 digits
def bad_invoice_number(c) -> Column:
    c = col_(c)
    return _ng(c.isNotNull() & ~c.rlike(fixed.INVOICE_NO_PATTERN))
