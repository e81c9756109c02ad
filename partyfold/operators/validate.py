"""Validation fan-out (C7-C11), clean split (C12) and the error sink.

One pass over the work rows evaluates every rule; failing (row, rule) pairs
are exploded into error rows. No shuffle is needed except for numbering the
error rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, rules
from ..sources.conf import Conf
from .ordinal import with_global_ordinal

# rule kinds: (kind, column, [extra]) -> (NG expression, reason)


def check_columns(checks, conf: Conf) -> list[tuple[Column, str]]:
    out = []
    for check in checks:
        kind, col = check[0], check[1]
        if kind == "mail":
            out.append((rules.bad_mail(col), fixed.INVALID_MAIL))
        elif kind == "phone":
            out.append((rules.bad_phone(col), fixed.INVALID_PHONE))
        elif kind == "fax":
            out.append((rules.bad_phone(col), fixed.INVALID_FAX))
        elif kind == "prefecture":
            out.append((rules.bad_prefecture(col, conf), fixed.INVALID_PREFECTURE))
        elif kind == "name_only":
            out.append((rules.name_only(col, check[2], conf), fixed.NAME_ONLY))
        elif kind == "invoice_number":
            out.append((rules.bad_invoice_number(col), fixed.INVALID_INVOICE_NO))
        else:
            raise ValueError(kind)
    return out


def clean_rows(work: DataFrame, checks, conf: Conf) -> DataFrame:
    """Rows that fail no rule (same as a left-anti join with the errors on seq)."""
    cols = check_columns(checks, conf)
    if not cols:
        return work
    any_ng = cols[0][0]
    for ng, _ in cols[1:]:
        any_ng = any_ng | ng
    return work.filter(~any_ng)


def failing_rows(work: DataFrame, checks, conf: Conf) -> DataFrame:
    """One row per (work row, failing rule): work columns + ``_rule`` + error_reason."""
    cols = check_columns(checks, conf)
    hits = F.array(*[F.when(ng, F.struct(F.lit(i).alias("rule"), F.lit(reason).alias("reason")))
                     for i, (ng, reason) in enumerate(cols)])
    return (work.select("*", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("_hit"))
            .select(*work.columns, F.col("_hit.rule").alias("_rule"),
                    F.col("_hit.reason").alias("error_reason")))


def error_records(work: DataFrame, checks, conf: Conf, now: Column, max_existing_seq=0) -> DataFrame:
    """A12 + C7-C11: error rows numbered max existing + 1.. in (rule, work row) order;
    ``seq`` is dropped, ``insert_datetime`` stamped. ``max_existing_seq`` is a number or a
    Column (a scalar subquery over the existing table)."""
    failed = failing_rows(work, checks, conf)
    numbered = with_global_ordinal(failed, ["_rule", "seq"], "error_seq", start=max_existing_seq + 1)
    return numbered.drop("_rule", "seq").withColumn("insert_datetime", now)


def max_error_seq(errors: DataFrame | None):
    """Largest error_seq of an existing error table (0 when empty or absent), as a scalar
    subquery: it stays inside the plan."""
    if errors is None:
        return 0
    return errors.agg(F.coalesce(F.max("error_seq"), F.lit(0))).scalar()
