"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Inputs are derived by Spark from the driver's tables (``sources.fixtures``);
conf tables are the default contents (``sources.conf``). Every query runs
over whole tables.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..operators import manual_merge as mm
from ..operators import reports as rp
from ..operators.dedupe import ORD, dedupe
from ..operators.join import join_tables
from ..operators.slice import daily_slice
from ..operators.standardize import normalized_only
from ..operators.validate import failing_rows, max_error_seq
from ..sources.bucketed import scratch_path
from ..sources.tables import files_there
from ..sources import fixtures as fx
from ..sources.conf import Conf
from . import pipeline as pl
from .masters import Masters
from .specs import FEEDS as FEED_SPECS
from .specs import (COMPANY_VIEW_COLUMNS, FEED_ORDER, PERSON_FEEDS, company_view, company_view_parts,
                    with_constants)

FEEDS = FEED_ORDER


@lru_cache(maxsize=1)
def conf() -> Conf:
    return Conf.default()


def now():
    return fx.run_time_lit()


_KEPT: dict = {}


def _kept(spark, d, what, make, tables):
    """What ``make`` writes, once a session and data folder, as long as the files of its ``tables`` are there:
    a daily run finds its landed feeds and its masters like that."""
    key = (spark.sparkContext.applicationId, spark, d, what)
    if key not in _KEPT or not all(files_there(t) for t in tables(_KEPT[key])):
        _KEPT[key] = make()
    return _KEPT[key]


def _work(spark, d, feed):
    """A feed's work rows: the stand-in for the landed table."""
    return _kept(spark, d, f"feed {feed}", lambda: fx.work_feed(spark, d, feed), lambda df: [df])


def _std(spark, d, feed):
    return pl.standardized(feed, _work(spark, d, feed), conf())


def _batch(spark, d, feed):
    """The standardised rows of a feed, stored: an upsert reads its batch many times (as in ``pl.feed_step``)."""
    return pl.snapshot(_std(spark, d, feed))


def _seed_c(spark, d):
    return fx.seed_company_master(spark, d)


def _seed_p(spark, d):
    return fx.seed_person_master(spark, d)


def _tables(masters: Masters):
    return [masters.company.base, masters.person.base, masters.company.index.base, masters.person.index.base, masters.presidents.base]


def _masters(spark, d) -> Masters:
    """The seed masters as a kept state (bucketed, indexed)."""
    return _kept(spark, d, "masters", lambda: Masters.build(_seed_c(spark, d), _seed_p(spark, d), conf()), _tables)


# ---- A: sources -------------------------------------------------------------
def q_feed(feed):
    return lambda spark, d: fx.lake_feed(spark, d, feed)


def q_error_append_seq(spark, d):
    """CRM errors appended after the name-card errors of the same table
    (numbering continues from the existing maximum)."""
    first = pl.errors("name_card", _work(spark, d, "name_card"), conf(), now())
    return pl.errors("crm", _work(spark, d, "crm"), conf(), now(), max_error_seq(first))


# ---- B: slice, join, views ---------------------------------------------------
def q_daily_slice(spark, d):
    lake = fx.sales_lake_by_order_date(spark, d)
    mapping = [("customer_company_name", "customer_company_name"),
               ("customer_person_name", "customer_person_name"),
               ("phone_number1", "phone_number1"), ("phone_number2", "phone_number2"),
               ("email_address", "email_address"), ("address", "address"),
               (None, "concat_ws('/', phone_number1, phone_number2) AS phones"),
               (None, "length(address) AS address_length")]
    return daily_slice(lake, fx.SLICE_DAY, mapping, tie_break=["source_key"])


def q_work_normalized_join(spark, d):
    work = pl.clean("crm", _work(spark, d, "crm"), conf())
    norm = normalized_only(_std(spark, d, "crm"))
    return join_tables(work, "t1", norm, "t2", on=[("t1.seq", "t2.seq")], how="inner", columns=[
        ("t1.seq", None), ("t2.normalized_company_name", None), ("t1.postal_code", None),
        ("t1.prefecture", None), ("t2.normalized_full_address", "full_address"),
        ("t1.employees_volume", None), ("t2.normalized_company_phone_number", "main_phone_number"),
        ("t2.normalized_company_email", "main_email_address"), ("t2.normalized_personal_name", None),
        ("t2.normalized_job_post", None),
        (None, "upper(t2.normalized_personal_email) AS upper_email"),
        (None, "t1.annual_revenue / 1000 AS revenue_thousands")])


def q_company_view(feed):
    return lambda spark, d: company_view(feed, _std(spark, d, feed), conf(), now())


def q_person_view(feed):
    def run(spark, d):
        std = _batch(spark, d, feed)
        comp = pl.upsert_company(feed, std, _masters(spark, d).company, conf(), now(), index=False)
        from .specs import person_view
        return person_view(pl.with_company_code(std, comp.attached), now())
    return run


def q_prefecture_lookup(spark, d):
    std = _std(spark, d, "sales")
    pref = tx.Sql(tx.s_extract_prefecture(tx.ident("normalized_full_address")))
    return std.select("seq", pref.col().alias("prefecture_name"),
                      tx.prefecture_code(pref, conf()).alias("prefecture_code"))


# ---- C: validation -------------------------------------------------------------
def q_errors(feed):
    return lambda spark, d: pl.errors(feed, _work(spark, d, feed), conf(), now())


def q_clean(feed):
    return lambda spark, d: pl.clean(feed, _work(spark, d, feed), conf())


# ---- D: standardising ----------------------------------------------------------
def q_standardize(feed):
    return lambda spark, d: normalized_only(_std(spark, d, feed))


# ---- E: resolution and masters -------------------------------------------------
def q_dedupe_company(feed):
    def run(spark, d):
        var_view, constants = company_view_parts(feed, _batch(spark, d, feed), conf(), now())
        out = dedupe(var_view, fixed.COMPANY_COMBINATIONS).drop(ORD)
        return with_constants(out, constants, ("seq",) + COMPANY_VIEW_COLUMNS)
    return run


def _crm_company(spark, d):
    return pl.upsert_company("crm", _batch(spark, d, "crm"), _masters(spark, d).company, conf(), now(), index=False)


def _person_upsert(spark, d, feed):
    std = _batch(spark, d, feed)
    comp = pl.upsert_company(feed, std, _masters(spark, d).company, conf(), now(), index=False)
    return pl.upsert_person(std, comp.attached, _masters(spark, d).person, now(), index=False)


def q_dedupe_person(feed):
    def run(spark, d):
        return _person_upsert(spark, d, feed).deduped.drop(ORD)
    return run


def q_match_company(spark, d):
    return _crm_company(spark, d).updates.drop(ORD)


def q_match_person(spark, d):
    return _person_upsert(spark, d, "crm").updates.drop(ORD)


def q_insert_rows_company(spark, d):
    return _crm_company(spark, d).inserts.drop(ORD, "company_code")


def q_insert_rows_person(spark, d):
    return _person_upsert(spark, d, "crm").inserts.drop(ORD, "person_id")


def q_mint_company_codes(spark, d):
    return _crm_company(spark, d).inserts.select("seq", "company_code")


def q_attach_company_code(spark, d):
    return _crm_company(spark, d).attached


def q_merge_update_company(spark, d):
    return _crm_company(spark, d).updated


def q_upsert_company(feed):
    return lambda spark, d: pl.upsert_company(feed, _batch(spark, d, feed), _masters(spark, d).company,
                                              conf(), now(), index=False).master


def q_upsert_person(feed):
    return lambda spark, d: _person_upsert(spark, d, feed).master


def _fold(spark, d):
    std = {f: _std(spark, d, f) for f in FEEDS}
    return pl.fold(std, _masters(spark, d), conf(), now())


def q_fold_company(spark, d):
    return _fold(spark, d).company.rows()


def q_fold_person(spark, d):
    return _fold(spark, d).person.rows()


def q_manual_merge_check(spark, d):
    return mm.check_instructions(fx.merge_instructions(spark, d), _seed_c(spark, d))


def _manual_merge(spark, d):
    master = _masters(spark, d).company.base
    instr = mm.valid_instructions(fx.merge_instructions(spark, d), master)
    return mm.apply_merge(instr, master)


def q_manual_merge_apply(spark, d):
    return _manual_merge(spark, d)


def q_orphan_persons(spark, d):
    return mm.orphan_persons(_seed_p(spark, d), _manual_merge(spark, d))


# ---- F: reports ------------------------------------------------------------------
def _all_errors(spark, d):
    return {f: pl.errors(f, _work(spark, d, f), conf(), now()) for f in FEEDS}


def q_error_list(spark, d):
    return rp.error_list(_all_errors(spark, d))


def q_error_trend(spark, d):
    """F2 through the kept count table: the rows of a feed came in over the week up to the run day (their
    source number says on which day), each day's errors were counted that day, and the run day was
    run twice."""
    path = scratch_path(spark, "error-counts")
    day = F.date_sub(F.to_date(now()), F.pmod(F.col("seq"), F.lit(7)).cast("int"))
    counts = None
    for f in FEEDS:
        failed = failing_rows(_work(spark, d, f), FEED_SPECS[f].checks, conf())
        some = rp.daily_counts(failed, day, f)
        counts = some if counts is None else counts.unionByName(some)
    counts = pl.snapshot(counts)
    rp.replace_counts(counts, path)
    rp.replace_counts(counts.filter(F.col("error_date") == F.to_date(now())), path)
    return rp.error_trend(spark, path)


def _screen(spark, d) -> Masters:
    """The masters the screens show: those that the fold of all five feeds leaves, written once (a daily run
    writes them once a day)."""
    def make():
        place = scratch_path(spark, "screen")
        return _fold(spark, d).saved(f"{place}/company", f"{place}/person")[0]
    return _kept(spark, d, "screen", make, lambda m: [m.company.base, m.person.base])


def _screen_company(spark, d):
    return _screen(spark, d).company.base


def _screen_person(spark, d):
    return _screen(spark, d).person.base


def q_president_link(spark, d):
    """E11 after every feed with persons: the company master at the end of the fold."""
    return _screen_company(spark, d)


def q_candidates_name(spark, d):
    return rp.candidates_name(_screen_company(spark, d))


def q_candidates_address(spark, d):
    return rp.candidates_address(_screen_company(spark, d))


def q_candidates_domain(spark, d):
    return rp.candidates_domain(_screen_company(spark, d))


def q_company_list(spark, d):
    return rp.company_list(_screen_company(spark, d), prefecture_code="13")


def q_person_list(spark, d):
    return rp.person_list(_screen_person(spark, d), _screen_company(spark, d))


def registry() -> dict:
    q = {}
    for f in FEEDS:
        q[f"feed_{f}"] = q_feed(f)
    q["error_append_seq"] = q_error_append_seq
    q["daily_slice"] = q_daily_slice
    q["work_normalized_join"] = q_work_normalized_join
    for f in FEEDS:
        q[f"company_view_{f}"] = q_company_view(f)
    for f in PERSON_FEEDS:
        q[f"person_view_{f}"] = q_person_view(f)
    q["prefecture_lookup"] = q_prefecture_lookup
    for f in FEEDS:
        q[f"errors_{f}"] = q_errors(f)
    for f in FEEDS:
        q[f"clean_{f}"] = q_clean(f)
    for f in FEEDS:
        q[f"standardize_{f}"] = q_standardize(f)
    for f in FEEDS:
        q[f"dedupe_company_{f}"] = q_dedupe_company(f)
    for f in PERSON_FEEDS:
        q[f"dedupe_person_{f}"] = q_dedupe_person(f)
    q["match_company"] = q_match_company
    q["match_person"] = q_match_person
    q["insert_rows_company"] = q_insert_rows_company
    q["insert_rows_person"] = q_insert_rows_person
    q["mint_company_codes"] = q_mint_company_codes
    q["attach_company_code"] = q_attach_company_code
    q["merge_update_company"] = q_merge_update_company
    for f in FEEDS:
        q[f"upsert_company_{f}"] = q_upsert_company(f)
    for f in PERSON_FEEDS:
        q[f"upsert_person_{f}"] = q_upsert_person(f)
    q["president_link"] = q_president_link
    q["fold_company_master"] = q_fold_company
    q["fold_person_master"] = q_fold_person
    q["manual_merge_check"] = q_manual_merge_check
    q["manual_merge_apply"] = q_manual_merge_apply
    q["orphan_persons"] = q_orphan_persons
    q["error_list"] = q_error_list
    q["error_trend"] = q_error_trend
    q["candidates_name"] = q_candidates_name
    q["candidates_address"] = q_candidates_address
    q["candidates_domain"] = q_candidates_domain
    q["company_list"] = q_company_list
    q["person_list"] = q_person_list
    return q
