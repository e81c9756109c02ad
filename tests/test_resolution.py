"""E1-E8, E11, E13-E15 edge cases and properties."""

from pyspark.sql import functions as F

from partyfold.functions import fixed
from partyfold.operators import dedupe as dd
from partyfold.operators import manual_merge as mm
from partyfold.operators import master as ms
from partyfold.operators import match as mt
from partyfold.operators.ordinal import with_global_ordinal

SCHEMA = "seq bigint, company_name string, full_address string, main_phone_number string, main_email_address string"
COMBOS = fixed.COMPANY_COMBINATIONS


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_empty_beats_later_value(spark):
    df = spark.createDataFrame([(1, "A", "X", "", "m1"), (2, "A", "X", "0312345678", "m2")], SCHEMA)
    out = dd.dedupe(df, COMBOS, keep_order=False)
    assert rows(out, "seq", "main_phone_number") == [(1, "")]


def test_null_is_a_gap(spark):
    df = spark.createDataFrame([(1, "A", "X", None, "m1"), (2, "A", "X", "0312345678", "m2")], SCHEMA)
    out = dd.dedupe(df, COMBOS, keep_order=False)
    assert rows(out, "seq", "main_phone_number") == [(1, "0312345678")]


def test_passes_are_sequential(spark):
    # a~b by (name, address); b~c by (name, phone); a's phone differs from c's
    df = spark.createDataFrame([(1, "A", "X", "p1", ""), (2, "A", "X", "p2", ""), (3, "A", "Y", "p2", "")], SCHEMA)
    out = dd.dedupe(df, COMBOS, keep_order=False)
    assert rows(out, "seq", "full_address", "main_phone_number") == [(1, "X", "p1"), (3, "Y", "p2")]


def test_dedupe_is_idempotent(spark):
    from conftest import SMALL
    from partyfold.plans import queries as Q
    view = Q.company_view("sales", Q._std(spark, SMALL, "sales"), Q.conf(), Q.now())
    once = dd.dedupe(view, COMBOS, keep_order=False)
    twice = dd.dedupe(once, COMBOS, keep_order=False)
    assert twice.count() == once.count()


def test_match_last_combination_wins(spark):
    master = spark.createDataFrame(
        [("0000000001", "A", "X", "", ""), ("0000000002", "", "", "p", "m")],
        "company_code string, company_name string, full_address string, main_phone_number string, "
        "main_email_address string")
    batch = spark.createDataFrame([(7, "A", "X", "p", "m")], SCHEMA)
    got = mt.match_master(batch, master, COMBOS, "company_code").collect()
    assert [(r.seq, r.company_code) for r in got] == [(7, "0000000002")]


def test_codes_from_empty_and_from_max(spark):
    batch = spark.createDataFrame([(5, "a"), (3, "b")], "seq bigint, company_name string")
    batch = dd.with_initial_order(batch)
    empty = spark.createDataFrame([], "company_code string")
    got = mt.mint_codes(batch, empty, "company_code").select("seq", "company_code")
    assert rows(got, "seq", "company_code") == [(3, "0000000001"), (5, "0000000002")]
    top = spark.createDataFrame([("0000000009",), ("0000000002",)], "company_code string")
    got = mt.mint_codes(batch, top, "company_code").select("seq", "company_code")
    assert rows(got, "seq", "company_code") == [(3, "0000000010"), (5, "0000000011")]


def test_code_text_keeps_long_numbers(spark):
    df = spark.createDataFrame([(12345678901,), (7,)], "n bigint")
    assert [r[0] for r in df.select(mt.code_text(F.col("n"))).collect()] == ["12345678901", "0000000007"]


def test_attach_ignores_empty_keys(spark):
    source = spark.createDataFrame([(1, "A", "X", "", ""), (2, "B", "Y", "", "")], SCHEMA)
    coded = spark.createDataFrame([(9, "0000000005", "C", "Z", "", "")],
                                  "seq bigint, company_code string, company_name string, full_address string, "
                                  "main_phone_number string, main_email_address string")
    got = mt.attach_codes(source, coded, COMBOS, "company_code")
    assert rows(got, "seq", "company_code") == [(1, None), (2, None)]


def test_merge_update_rules(spark):
    target = spark.createDataFrame(
        [("c1", "t", "t", "t", True, 5), ("c2", "u", "u", "u", False, None)],
        "company_code string, a string, b string, c string, customer_flag boolean, employees_volume bigint")
    source = spark.createDataFrame(
        [("c1", "", None, "x", False, None, 1)],
        "company_code string, a string, b string, c string, customer_flag boolean, employees_volume bigint, "
        "_ord bigint")
    out = ms.merge_update(target, source, "company_code", ["a", "b", "c", "employees_volume"],
                          or_columns=["customer_flag"])
    got = {r.company_code: (r.a, r.b, r.c, r.customer_flag, r.employees_volume) for r in out.collect()}
    assert got == {"c1": ("t", "t", "x", True, 5), "c2": ("u", "u", "u", False, None)}


def test_merge_update_last_row_wins(spark):
    target = spark.createDataFrame([("c1", "t")], "company_code string, a string")
    source = spark.createDataFrame([("c1", "first", 1), ("c1", "last", 2)], "company_code string, a string, _ord bigint")
    assert ms.merge_update(target, source, "company_code", ["a"]).collect()[0].a == "last"


def test_president_smallest_person(spark, conf):
    company = spark.createDataFrame([("c1", None), ("c2", "p0")], "company_code string, president_person_id string")
    person = spark.createDataFrame([("p3", "c1", "代表取締役社長"), ("p2", "c1", "CEO"), ("p4", "c2", "課長")],
                                   "person_id string, company_code string, job_post string")
    got = {r.company_code: r.president_person_id for r in ms.president_link(company, person, conf).collect()}
    assert got == {"c1": "p2", "c2": "p0"}


def test_manual_merge(spark):
    master = spark.createDataFrame(
        [("a", "", 0, False, "x"), ("b", "B", 200, True, "y"), ("c", "C", 1, None, "z"), ("d", "D", 1, None, "w")],
        "company_code string, company_name string, employees_volume bigint, customer_flag boolean, fax_number string")
    from partyfold.sources.fixtures import _typed_master, COMPANY_TYPES
    master = _typed_master(master, fixed.M_COMPANY_COLUMNS, COMPANY_TYPES)
    instr = spark.createDataFrame([(" a ", "b"), ("c", "c"), ("d", "q")], mm.INSTRUCTION_SCHEMA)
    bad = rows(mm.check_instructions(instr, master), "field", "code", "problem")
    assert ("absorbed", "q", "unknown_code") in bad and ("survivor", "c", "self_merge") in bad
    out = mm.apply_merge(mm.valid_instructions(instr, master), master)
    got = {r.company_code: (r.company_name, r.employees_volume, r.customer_flag, r.fax_number) for r in out.collect()}
    assert got == {"a": ("B", 200, False, "x"), "c": ("C", 1, None, "z"), "d": ("D", 1, None, "w")}


def test_global_ordinal_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = with_global_ordinal(df, ["k"], "n", start=10, num_partitions=7)
    got = sorted((r.k, r.n) for r in out.collect())
    assert [n for _, n in got] == list(range(10, 5010))


def test_candidates_are_groups_not_pairs(spark):
    from partyfold.operators import reports as rp
    from partyfold.sources.fixtures import _typed_master, COMPANY_TYPES
    m = spark.createDataFrame(
        [("0000000001", "A", "info@big.example"), ("0000000002", "B", "sales@big.example"),
         ("0000000003", "C", "x@big.example"), ("0000000004", "D", "y@solo.example"), ("0000000005", "E", "")],
        "company_code string, company_name string, main_email_address string")
    m = _typed_master(m, fixed.M_COMPANY_COLUMNS, COMPANY_TYPES)
    got = rows(rp.candidates_domain(m), "company_code", "anchor_code", "group_size")
    assert got == [("0000000001", "0000000001", 3), ("0000000002", "0000000001", 3), ("0000000003", "0000000001", 3)]


def test_salted_join_equals_plain_join(spark):
    from partyfold.operators.skew import salted_join
    big = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), F.col("id"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    a = sorted(tuple(r) for r in salted_join(big, small, ["k"], salt_from=["id"]).select("id", "k", "v").collect())
    b = sorted(tuple(r) for r in big.join(small, "k").select("id", "k", "v").collect())
    assert a == b


def test_global_ordinal_with_adaptive_ranges(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("k"))
    got = sorted((r.k, r.n) for r in with_global_ordinal(df, ["k"], "n", start=1).collect())
    assert [n for _, n in got] == list(range(1, 3001))


def test_near_names(spark):
    from partyfold.operators import reports as rp
    names = ["あいうえお", "あいうえか", "あいうえ株式会社お", "あいうお", "あいうえおか", "あいいうえお", "いあうえお", "会社一二三1", "会社一二三2",
             "会社一二1三", "会社一二四1", "", None, "aabbb", "abbb", "aabbbb", "aabb"]
    m = spark.createDataFrame([(f"{i:03d}", n) for i, n in enumerate(names * 2)], "company_code string, company_name string")
    plain = {n: (n or "").replace("株式会社", "") for n in names}
    rest = lambda x: {x[:i] + x[i + 1:] for i in range(len(x))}
    digits = lambda x: [c for c in x if c.isdigit()]

    def near(a, b):
        one = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
        return min(len(a), len(b)) >= 5 and digits(a) == digits(b) and (one or b in rest(a) or a in rest(b))
    keys = {k for k in plain.values() if k}
    code = {k: min(f"{i:03d}" for i, n in enumerate(names * 2) if plain[n] == k) for k in keys}
    want = []
    for i, n in enumerate(names * 2):
        around = [k for k in keys if plain[n] and near(plain[n], k)]
        if around:
            want.append((f"{i:03d}", min(code[k] for k in [*around, plain[n]]), len(around) + 1))
    assert rows(rp.near_names(m), "company_code", "anchor_code", "group_size") == sorted(want) and len(want) > 10
