"""Composed plans: per-feed batch, company / person upsert, the five-feed fold.

The per-feed part (slice -> validate -> standardise) is one lazy plan with
no shuffle. Upserts shuffle the batch on the key pairs (E1, E3, E6); the masters and their
indexes are bucketed tables that are read where they lie (``masters``). Each feed leaves
stored change rows and index deltas, so the plan of feed n does not carry the plans of
feeds 1..n-1, and the masters are rewritten once, after the last feed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import changelog as cl
from ..operators import dedupe as dd
from ..operators import match as mt
from ..operators.keyindex import delta
from ..operators.skew import grown
from ..operators.standardize import standardize
from ..operators.validate import clean_rows, error_records
from ..sources.conf import Conf
from ..sources.tables import counted, stored
from .masters import KeptMaster, Masters, president_entry
from .specs import (COMPANY_VIEW_COLUMNS, FEEDS, FEED_ORDER, PERSON_VIEW_COLUMNS, company_update_columns,
                    company_view_parts, person_view_parts, with_constants)


def clean(feed: str, work: DataFrame, conf: Conf) -> DataFrame:
    return clean_rows(work, FEEDS[feed].checks, conf)


def errors(feed: str, work: DataFrame, conf: Conf, now: Column, max_existing_seq=0) -> DataFrame:
    return error_records(work, FEEDS[feed].checks, conf, now, max_existing_seq)


def standardized(feed: str, work: DataFrame, conf: Conf) -> DataFrame:
    """Clean rows of a feed, standardised (work and normalised columns on one row)."""
    return standardize(feed, clean(feed, work, conf), conf)


def snapshot(df: DataFrame) -> DataFrame:
    """Cut lineage: a parquet snapshot in the session's checkpoint folder.

    Used for results read several times (the de-duplicated batch, matches) and
    for master states between feeds: later plans start from a small leaf of
    known size, read only the columns they need, and a lost executor never
    forces a re-run of earlier steps. (``persist`` would keep the whole lineage
    in every later plan, and matching it against the cache on every step grows
    with the plan.)"""
    return stored(df, "snapshot")


def _logged(changes: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The change rows of one step, stored; and how many of them are inserts (counted while they are
    written)."""
    observed, obs = counted(changes, label, inserted=F.count_if(F.col(cl.INSERT)))
    kept = stored(observed, label)
    return kept, int(obs.get["inserted"])


def _before_and_after(kept: KeptMaster, log: DataFrame, columns) -> DataFrame:
    """(pk, _was_<column>, column) of every row a step touched: as it stood in ``kept`` before (null
    for a new row) and as the step's change rows leave it."""
    pk = kept.pk
    updates = log.filter(~F.col(cl.INSERT))
    was = kept.current(updates.select(pk), columns)
    was = was.select(pk, *[F.col(c).alias(f"_was_{c}") for c in columns], *columns)
    touched = cl.applied(was, cl.folded(updates, pk, columns, kept.flags), pk, kept.flags)
    fresh = log.filter(cl.INSERT).select(pk, *[F.lit(None).cast(kept.layout[c].dataType).alias(f"_was_{c}") for c in columns], *columns)
    return touched.unionByName(fresh)


def _pair_delta(touched: DataFrame, kept: KeptMaster, version: int) -> DataFrame:
    return delta(mt.pair_array(kept.combinations, "_was_"), mt.pair_array(kept.combinations), touched, kept.pk, version)


def _key_columns(combinations) -> list[str]:
    return sorted({c for pair in combinations for c in pair})


@dataclass
class CompanyUpsert:
    view: DataFrame        # B5 rows (seq + master columns)
    deduped: DataFrame     # E1 result with _ord
    matches: DataFrame     # E3 (seq, company_code)
    inserts: DataFrame     # E4 unmatched rows with minted codes (E5)
    updates: DataFrame     # E4 matched rows with company_code
    attached: DataFrame    # E6 (seq, company_code) for every source row
    changes: DataFrame     # change rows of the step (E7, E8 and the new rows)
    kept: KeptMaster       # state with the step's changes

    @property
    def updated(self) -> DataFrame:
        """The master before inserts are added."""
        return self.kept.rows(inserts=False)

    @property
    def master(self) -> DataFrame:
        """The next m_company state."""
        return self.kept.rows()


def company_batch(feed: str, std: DataFrame, conf: Conf, now: Column) -> tuple[DataFrame, DataFrame]:
    """(view, de-duplicated batch) of a feed's companies: B5 and E1, which need no master."""
    var_view, constants = company_view_parts(feed, std, conf, now)
    layout = ("seq",) + COMPANY_VIEW_COLUMNS
    # E1 carries only the varying columns (constants are equal in every row);
    # the de-duplicated batch feeds E3, E4, E5 and E6: materialise it once
    deduped = snapshot(with_constants(dd.dedupe(var_view, fixed.COMPANY_COMBINATIONS), constants, layout))
    return with_constants(var_view, constants, layout), deduped


def upsert_company(feed: str, std: DataFrame, kept: KeptMaster, conf: Conf, now: Column, version: int = 1,
                   index: bool = True, batch: tuple[DataFrame, DataFrame] | None = None) -> CompanyUpsert:
    """E1 -> E3 -> E4 -> E5 -> E6 -> change rows for E7/E8 and the inserts. With ``index`` the key
    index gets the step's changes (only a state that no further batch is matched against can do
    without). ``batch`` is the feed's ``company_batch`` where it has been made already."""
    combos = kept.combinations
    view, deduped = batch or company_batch(feed, std, conf, now)
    # (seq, code) pairs, read by E4, E5, E6 and E7: keep them
    matches = snapshot(mt.match_index(deduped, kept.index, combos))
    ins, upd = mt.split_insert_update(deduped, matches, "company_code")
    ins = mt.mint_codes(ins, kept.top, "company_code")
    key_cols = ["seq", "company_code"] + _key_columns(combos)
    coded = ins.select(*key_cols).unionByName(upd.select(*key_cols))
    attached = mt.attach_codes(view, coded, combos, "company_code")
    changes = cl.insert_rows(ins, kept.layout, version).unionByName(
        cl.update_rows(upd, "company_code", company_update_columns(feed), kept.layout, version, flags=kept.flags))
    log, inserted = _logged(changes, f"company-changes-{feed}")
    pairs = snapshot(_pair_delta(_before_and_after(kept, log, _key_columns(combos)), kept, version)) if index else None
    return CompanyUpsert(view, deduped, matches, ins, upd, attached, log, kept.changed(log, inserted, pairs))


@dataclass
class PersonUpsert:
    view: DataFrame
    deduped: DataFrame
    matches: DataFrame
    inserts: DataFrame
    updates: DataFrame
    changes: DataFrame
    kept: KeptMaster
    touched: DataFrame | None    # persons of the step before and after (keys, company, title)

    @property
    def master(self) -> DataFrame:
        return self.kept.rows()


def upsert_person(std: DataFrame, attached: DataFrame, kept: KeptMaster, now: Column, version: int = 1,
                  index: bool = True) -> PersonUpsert:
    """E1 -> E3 -> E4 -> E5 -> change rows for the inserts and E7 (fixed eight-column update list)."""
    combos = kept.combinations
    attached = snapshot(attached)        # the batch is read more than once
    var_view, constants = person_view_parts(with_company_code(std, attached), now)
    keys, _ = person_view_parts(std, now)
    view = with_constants(var_view, constants, ("seq",) + PERSON_VIEW_COLUMNS)
    deduped = snapshot(with_constants(dd.dedupe(var_view, combos, keys=keys), constants,
                                      ("seq",) + PERSON_VIEW_COLUMNS))
    matches = snapshot(mt.match_index(deduped, kept.index, combos))
    ins, upd = mt.split_insert_update(deduped, matches, "person_id")
    ins = mt.mint_codes(ins, kept.top, "person_id")
    changes = cl.insert_rows(ins, kept.layout, version).unionByName(
        cl.update_rows(upd, "person_id", fixed.PERSON_UPDATE_COLUMNS, kept.layout, version))
    log, inserted = _logged(changes, "person-changes")
    touched = pairs = None
    if index:
        touched = snapshot(_before_and_after(kept, log, [*_key_columns(combos), "company_code", "job_post"]))
        pairs = snapshot(_pair_delta(touched, kept, version))
    return PersonUpsert(view, deduped, matches, ins, upd, log, kept.changed(log, inserted, pairs), touched)


def with_company_code(std: DataFrame, attached: DataFrame) -> DataFrame:
    return std.join(grown(attached), "seq", "left")


def link_presidents(masters: Masters, new_companies: DataFrame, person: PersonUpsert, conf: Conf,
                    version: int) -> tuple[Masters, DataFrame]:
    """E11, incrementally: the index of presidents gets the step's persons, and only companies that won
    or lost a president in it (or are new) are looked up again; one that lost its last keeps what it
    has. A state whose links do not follow the index yet is linked as a whole, once. Returns the
    state with the persons and the index, and the change rows of the companies."""
    entry = lambda p: president_entry(F.col(f"{p}job_post"), F.col(f"{p}company_code"), conf)
    changed = snapshot(delta(entry("_was_"), entry(""), person.touched, "person_id", version))
    presidents = masters.presidents.extended(changed)
    wanted = None
    if masters.linked:
        wanted = changed.select("company_code").unionByName(new_companies).distinct()
    best = presidents.best(wanted, F.min).withColumnRenamed("person_id", "president_person_id")
    links = cl.update_rows(best, "company_code", ["president_person_id"], masters.company.layout, version,
                           order_col=None, on_multi="unique")
    return replace(masters, person=person.kept, presidents=presidents, linked=True), _logged(links, "president-links")[0]


@dataclass
class FeedResult:
    company: CompanyUpsert
    person: PersonUpsert | None
    masters: Masters             # state after company upsert (+ persons and president link)

    @property
    def m_company(self) -> DataFrame:
        return self.masters.company.rows()

    @property
    def m_person(self) -> DataFrame:
        return self.masters.person.rows()


def _new_companies(company: CompanyUpsert) -> DataFrame:
    return company.changes.filter(cl.INSERT).select("company_code")


def feed_step(feed: str, std: DataFrame, masters: Masters, conf: Conf, now: Column) -> FeedResult:
    """One feed against the masters: company upsert, then (if the feed carries
    persons) person upsert and the president link."""
    # the standardised batch is read by E1, E6 and the person view: text work once
    std = snapshot(std)
    version = 2 * masters.step + 1
    comp = upsert_company(feed, std, masters.company, conf, now, version)
    masters = replace(masters, step=masters.step + 1, company=comp.kept)
    if not FEEDS[feed].has_person:
        return FeedResult(comp, None, masters)
    pers = upsert_person(std, comp.attached, masters.person, now, version)
    masters, links = link_presidents(masters, _new_companies(comp), pers, conf, version + 1)
    return FeedResult(comp, pers, replace(masters, company=masters.company.changed(links, 0)))


def fold(std_by_feed: dict, masters: Masters, conf: Conf, now: Column, feeds=FEED_ORDER) -> Masters:
    """Apply the feeds in priority order (weakest first), so the
    strongest feed's non-empty values win. No master is rewritten on the way: every feed leaves
    change rows, and the next state is taken from them once (``rows`` or ``saved`` of the result).

    What does not depend on each other runs side by side: the feeds' batches need no master, and the
    persons of a feed wait for its companies and for the persons before them, not for the companies
    of the next feed. Change rows carry their version, so the order in which they are written does
    not matter."""
    feeds = [f for f in feeds if f in std_by_feed]
    spark = masters.company.base.sparkSession
    versions = {f: 2 * (masters.step + i) + 1 for i, f in enumerate(feeds)}

    def prepare(feed):
        std = snapshot(std_by_feed[feed])
        return std, company_batch(feed, std, conf, now)

    def persons(feed, std, comp, before):
        state, links = before.result() if before else (masters, [])
        pers = upsert_person(std, comp.attached, state.person, now, versions[feed])
        state, new = link_presidents(state, _new_companies(comp), pers, conf, versions[feed] + 1)
        return state, [*links, new]

    company, last = masters.company, None
    with ThreadPoolExecutor(max_workers=max(1, len(feeds))) as batches, ThreadPoolExecutor(max_workers=1) as behind:
        start = lambda pool, f, *a: pool.submit(inheritable_thread_target(spark)(f), *a)
        ready = {f: start(batches, prepare, f) for f in feeds}
        for feed in feeds:
            std, batch = ready[feed].result()
            comp = upsert_company(feed, std, company, conf, now, versions[feed], batch=batch)
            company = comp.kept
            if FEEDS[feed].has_person:
                last = start(behind, persons, feed, std, comp, last)
        state, links = last.result() if last else (masters, [])
    for new in links:
        company = company.changed(new, 0)
    return replace(state, company=company, step=masters.step + len(feeds))
