"""Kept masters: bucketed tables, key index, change log, incremental president link, single-key filter."""

import random
import re
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from partyfold.functions import fixed
from partyfold.operators import changelog as cl
from partyfold.operators import dedupe as dd
from partyfold.operators import manual_merge as mm
from partyfold.operators import master as ms
from partyfold.operators import match as mt
from partyfold.operators import reports as rp
from partyfold.operators.keyindex import KeptIndex, delta
from partyfold.plans import pipeline as pl
from partyfold.plans import queries as Q
from partyfold.plans.masters import KeptMaster, Masters
from partyfold.sources.bucketed import read_bucketed, write_bucketed


def fresh(label):
    return f"{tempfile.mkdtemp(prefix='kept-')}/{label}"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def moved_tables(df, column):
    """Bucketed scans of tables with ``column`` that have a shuffle between them and the first join or
    aggregate above them."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[ :+\-]*", x).group()) for x in lines]
    moved, seen = 0, 0
    for i, line in enumerate(lines):
        if "FileScan parquet" not in line or "Bucketed: true" not in line or f"{column}#" not in line.split("Batched")[0]:
            continue
        seen += 1
        at = depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < at:
                at = depth[j]
                if "Exchange" in lines[j]:
                    moved += 1
                if "Join" in lines[j] or "Exchange" in lines[j]:
                    break
    return seen, moved


# ---- bucketed tables and the index ---------------------------------------------------------
def test_bucketed_table_is_read_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        path = fresh("t")
        df = spark.range(500).selectExpr("lpad(id, 10, '0') code", "id % 7 v")
        write_bucketed(df, path, ["code"], 8)
        table = read_bucketed(spark, path, df.schema, ["code"], 8)
        assert rows(table) == rows(df) and rows(spark.read.parquet(path)) == rows(df)
        other = spark.range(50).selectExpr("lpad(id, 10, '0') code", "id w")
        joined = table.join(other, "code", "left")
        assert moved_tables(joined, "code") == (1, 0) and joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_index_deltas_equal_a_new_index(spark):
    """Random rows change their keys over versions; look-ups and entries follow, base and deltas alike."""
    rng = random.Random(4)
    combos = (("a", "b"), ("a", "c"), ("b", "c"))
    schema = "code string, a string, b string, c string"
    value = lambda: rng.choice(["", None, "x", "y", "z"])
    state = {f"{i:03d}": (value(), value(), value()) for i in range(40)}
    frame = lambda s: spark.createDataFrame([(k, *v) for k, v in sorted(s.items())], schema)
    index = KeptIndex.build(mt.key_pairs(frame(state), combos, "code"), mt.KEY, "code", fresh("i"), 8)
    for version in range(1, 4):
        new = dict(state)
        for k in rng.sample(sorted(state), 8):
            new[k] = (value(), value(), value())
        new.update({f"{100 * version + i}": (value(), value(), value()) for i in range(4)})
        touched = [(k, *(state.get(k) or (None,) * 3), *v) for k, v in new.items() if state.get(k) != v]
        changed = spark.createDataFrame(touched, "code string, _was_a string, _was_b string, _was_c string, a string, b string, c string")
        index = index.extended(delta(mt.pair_array(combos, "_was_"), mt.pair_array(combos), changed, "code", version))
        state = new
        want = mt.key_pairs(frame(state), combos, "code").distinct()
        assert rows(index.entries(8).select(*mt.KEY, "code")) == rows(want.select(*mt.KEY, "code"))
        probe = spark.createDataFrame([(i, value(), value(), value()) for i in range(30)], "seq bigint, a string, b string, c string")
        assert rows(mt.match_index(probe, index, combos), "seq", "code") == \
            rows(mt.match_master(probe, frame(state), combos, "code"), "seq", "code")
    saved = index.saved(fresh("i"), 8)
    assert not saved.deltas and rows(saved.entries()) == rows(index.entries())


# ---- change log -------------------------------------------------------------------------------
def test_log_applied_once_equals_updates_one_after_another(spark):
    rng = random.Random(9)
    schema = "code string, name string, phone string, volume bigint, flag boolean, other string"
    text = lambda: rng.choice([None, "", "p", "q"])
    row = lambda k: (k, text(), text(), rng.choice([None, 0, 5]), rng.choice([None, True, False]), text())
    target = spark.createDataFrame([row(f"c{i}") for i in range(30)], schema)
    log, plain = None, target
    for version in (1, 2, 3):
        ins = spark.createDataFrame([row(f"n{version}{i}") for i in range(4)], schema)
        known = [r.code for r in plain.select("code").collect()]
        upd = spark.createDataFrame([(*row(rng.choice(known)), i) for i in range(12)], schema + ", _ord bigint")
        cols = (["name", "phone", "volume"], ["name"], ["phone", "volume"])[version - 1]
        step = cl.insert_rows(ins, target.schema, version).unionByName(
            cl.update_rows(upd, "code", cols, target.schema, version, flags=["flag"]))
        log = step if log is None else log.unionByName(step)
        plain = ms.merge_update(plain, upd, "code", cols, or_columns=["flag"]).unionByName(ins)
        plain = spark.createDataFrame(plain.collect(), schema)
    updates = cl.folded(log.filter("not _insert"), "code", target.columns, ["flag"])
    everyone = target.unionByName(log.filter("_insert").select(*target.columns))
    assert rows(cl.applied(everyone, updates, "code", ["flag"])) == rows(plain)


# ---- the fold -----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def folded(spark):
    start = Masters.build(Q._seed_c(spark, SMALL), Q._seed_p(spark, SMALL), Q.conf(), 8)
    std = {f: Q._std(spark, SMALL, f) for f in Q.FEEDS}
    return start, pl.fold(std, start, Q.conf(), Q.now())


def test_indexes_after_five_feeds_equal_new_ones(spark, folded):
    _, after = folded
    for kept in (after.company, after.person):
        new = mt.key_pairs(kept.rows(), kept.combinations, kept.pk).distinct()
        assert rows(kept.index.entries(8).select(*mt.KEY, kept.pk)) == rows(new.select(*mt.KEY, kept.pk))
        assert kept.top == max(int(r[0]) for r in kept.rows().select(kept.pk).collect())
    held = ms.president_rows(after.person.rows(), Q.conf())
    assert rows(after.presidents.best(None, F.min), "company_code", "person_id") == rows(held, "company_code", "president_person_id")


def test_linked_state_is_linked_step_by_step(spark, folded):
    """From a linked state on, the link of changed companies alone equals the full link."""
    _, after = folded
    kept, counts = after.saved(fresh("company"), fresh("person"), fresh("index"))
    assert counts["company_rows"] == counts["company_inserted"] + counts["company_updated"] + counts["company_untouched"]
    assert counts["person_inserted"] > 0 and counts["person_untouched"] > 0
    again = replace(kept, linked=True)
    # new titles and companies for some of the standardised sales rows
    std = Q._std(spark, SMALL, "name_card").withColumn(
        "normalized_job_post", F.when(F.col("seq") % 3 == 0, "社長").when(F.col("seq") % 3 == 1, "課長").otherwise(F.col("normalized_job_post")))
    step = pl.feed_step("name_card", std, again, Q.conf(), Q.now())
    full = ms.president_link(step.company.master, step.m_person, Q.conf())
    assert rows(step.m_company) == rows(full)
    assert step.masters.company.log[-1].count() < full.count()


def test_masters_and_indexes_stay_where_they_are(spark, folded):
    start, after = folded
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        view = Q.company_view("crm", Q._std(spark, SMALL, "crm"), Q.conf(), Q.now())
        for index in (start.company.index, after.company.index):
            found = mt.match_index(view, index, fixed.COMPANY_COMBINATIONS)
            assert moved_tables(found, "key_a") == (1, 0)
            assert moved_tables(index.entries(8), "key_a")[1] == 0
        assert moved_tables(after.company.rows(), "company_code") == (1, 0)
        assert moved_tables(after.person.rows(), "person_id") == (1, 0)
        codes = view.selectExpr("lpad(seq, 10, '0') company_code").distinct()
        assert moved_tables(after.company.current(codes, ["company_name"]), "company_code") == (1, 0)
        instr = spark.createDataFrame([("0000000013", "0000000019")], mm.INSTRUCTION_SCHEMA)
        merged = mm.apply_merge(instr, start.company.base)
        seen, moved = moved_tables(merged, "company_code")
        assert seen == 3 and moved == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_state_is_kept_between_runs(spark, folded):
    _, after = folded
    company, person, index = fresh("c"), fresh("p"), fresh("i")
    saved, _ = after.saved(company, person, index)
    loaded = Masters.load(spark, company, person, index, (saved.company.layout, saved.person.layout), 8)
    assert rows(loaded.company.base) == rows(after.company.rows()) and loaded.company.top == after.company.top
    assert rows(loaded.person.index.entries()) == rows(after.person.index.entries())
    assert rows(loaded.presidents.entries()) == rows(after.presidents.entries()) and loaded.linked
    assert isinstance(loaded.person, KeptMaster) and not loaded.person.log


# ---- single-key filter ----------------------------------------------------------------------------
@pytest.mark.parametrize("spread", [3, 40, 400])
def test_single_key_filter_changes_nothing(spark, spread):
    rng = random.Random(spread)
    value = lambda c: rng.choice([None, "", *[f"{c}{rng.randrange(spread)}" for _ in range(6)]])
    data = [(i, value("n"), value("a"), value("p"), value("m"), rng.choice([None, "u", "v"])) for i in range(250)]
    df = spark.createDataFrame(data, "seq bigint, company_name string, full_address string, main_phone_number string, "
                                     "main_email_address string, url string")
    on = dd.dedupe(df, fixed.COMPANY_COMBINATIONS, single_keys=True)
    off = dd.dedupe(df, fixed.COMPANY_COMBINATIONS, single_keys=False)
    assert rows(on) == rows(off)
    columns = dd.key_columns(fixed.COMPANY_COMBINATIONS)
    count = {}
    for r in data:
        for c, v in zip(columns, r[1:5]):
            count[c, v] = count.get((c, v), 0) + 1
    enter = {r[0] for r in data if sum(bool(v) and count[c, v] > 1 for c, v in zip(columns, r[1:5])) > 1}
    assert {r.seq for r in dd.sharing_rows(df, columns).collect()} == enter
    assert dd.filter_pays(df, columns) == (spread == 400)


def test_growing_sides_are_never_broadcast(spark, conf):
    """Whatever the planner makes of their size (here all of them are tiny)."""
    d, now = SMALL, Q.now()
    masters = Q._masters(spark, d)
    std = pl.snapshot(Q._std(spark, d, "sales"))
    comp = pl.upsert_company("sales", std, masters.company, conf, now, index=False)
    person = pl.upsert_person(std, comp.attached, masters.person, now, index=False)
    shared = dd.sharing_rows(person.view, dd.key_columns(fixed.PERSON_COMBINATIONS))
    plans = {
        "attached": comp.attached, "companies": comp.master, "persons": person.master, "inserts": person.inserts,
        "matches": mt.match_index(person.deduped, masters.person.index, fixed.PERSON_COMBINATIONS),
        "current": person.kept.current(person.updates.select("person_id").distinct(), ["name"]), "shared": shared,
        "dedupe": dd.dedupe(person.view, fixed.PERSON_COMBINATIONS, single_keys=True),
        "names": rp.candidates_name(comp.master), "addresses": rp.candidates_address(comp.master),
        "domains": rp.candidates_domain(comp.master), "list": rp.person_list(person.master, comp.master),
        "orphans": mm.orphan_persons(person.master, comp.master)}
    for name, df in plans.items():
        df.collect()                       # the adaptive plan as it was run
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan, name
        # only the offsets of a global numbering, one row a partition, are broadcast
        assert not re.search(r"BroadcastHashJoin \[(?!_part_id)", plan), name


def test_upserts_read_a_standardised_batch_once_made(spark):
    """The text rules of a feed run once, not again in each step that reads the batch."""
    df = Q.registry()["person_view_sales"](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "normalized_personal_name" in plan and "regexp_replace" not in plan
