"""In-batch pairwise de-duplication with ordered survivorship.

For each key pair in turn, rows whose two keys are both non-empty and occur
more than once collapse into one row; every other column takes the first
non-null value in the current row order. Passes are sequential (an absorbed
value can no longer match), so this is not connected components.

Row order matters (survivorship, and later the order codes are minted in).
After a pass that merged, the order is: merged rows by (key a, key b), then
the rest in their previous order. That order is carried as one struct
``_ord = (t, a, b, s)``:

* a row never merged: ``(0, '', '', seq)``
* a row last merged by pass p: ``(-p, a, b, 0)``

Sorting by ``_ord`` reproduces the sequential order exactly (a later pass
sorts first; within a pass the merged keys are unique).

Each pass is one ``groupBy`` on ``(k1, k2, solo)``, where ``solo`` is null
for rows with both keys filled and the row's ``seq`` otherwise (so those rows
stay alone). The aggregates are partial (map-side), so a key pair held by a
third of all rows is combined before the shuffle and does not load one task.

Most rows of a feed of new parties can never merge: to do so, a row must share the values of
two key columns with other rows, and every value a merged row holds comes from a row that
merged. So each key value is counted once (as a hash, in narrow rows), and a row with fewer
than two shared values skips all passes. The counting pays only where it leaves many rows
out; estimates of the distinct values (one pass without a shuffle) decide that, and both ways
give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident
from ..sources.tables import stored
from .skew import grown

ORD = "_ord"
_N, _SOLO, _FIRST = "_grp_n", "_solo", "_ord_first"


def s_filled(*cols: str) -> str:
    """The columns are neither null nor empty, as SQL text (one expression instead of many calls)."""
    return " AND ".join(f"({ident(c)} IS NOT NULL AND {ident(c)} <> '')" for c in cols)


def with_initial_order(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.withColumn(ORD, F.expr(f"named_struct('t', 0, 'a', '', 'b', '', 's', CAST({ident(seq)} AS BIGINT))"))


def dedupe_pass(df: DataFrame, k1: str, k2: str, pass_no: int, seq: str = "seq", solid=()) -> DataFrame:
    """One pass. Columns in ``solid`` hold no null, so the first row's values stand for all of
    them: they share one buffer (and one copy of the order) with the first row's order."""
    solid = [c for c in solid if c not in (k1, k2, ORD)]
    carried = [c for c in df.columns if c not in (k1, k2, ORD, *solid)]
    a, b, o = ident(k1), ident(k2), ident(ORD)
    solo = F.expr(f"CASE WHEN {a} IS NOT NULL AND {a} <> '' AND {b} IS NOT NULL AND {b} <> '' "
                  f"THEN CAST(NULL AS BIGINT) ELSE CAST({ident(seq)} AS BIGINT) END AS {_SOLO}")
    # the order is unique, so comparing the structs never reaches the columns after it
    aggs = [F.expr(f"count(1) AS {_N}"), F.min(F.struct(ORD, *solid)).alias(_FIRST)]
    # First non-null in the current order ("" is a value, not a gap)
    aggs += [F.expr(f"min_by({ident(c)}, CASE WHEN {ident(c)} IS NOT NULL THEN {o} END) AS {ident(c)}")
             for c in carried]
    grouped = df.groupBy(F.col(k1), F.col(k2), solo).agg(*aggs)
    new_ord = F.expr(f"CASE WHEN {_N} > 1 THEN named_struct('t', {-pass_no}, 'a', {a}, 'b', {b}, "
                     f"'s', CAST(0 AS BIGINT)) ELSE {_FIRST}.{o} END AS {o}")
    return grouped.select(*[F.col(f"{_FIRST}.{ident(c)}").alias(c) if c in solid else F.col(ident(c))
                            for c in df.columns if c != ORD], new_ord)


def key_columns(combinations) -> list[str]:
    return list(dict.fromkeys(c for pair in combinations for c in pair))


def sharing_rows(df: DataFrame, columns, seq: str = "seq") -> DataFrame:
    """(seq) of the rows that share two or more filled values of ``columns`` with other rows.
    Values are compared by 64-bit hashes: a collision could only let one more row in."""
    hashes = ", ".join(f"CASE WHEN {s_filled(c)} THEN xxhash64({i}, {ident(c)}) END" for i, c in enumerate(columns))
    values = df.select(F.col(seq), F.expr(f"explode(array_compact(array({hashes})))").alias("_value"))
    shared = values.groupBy("_value").agg(F.count(F.lit(1)).alias(_N)).filter(F.col(_N) > 1).select("_value")
    # a value that very many rows hold is one row on the other side, which AQE's skew join splits
    return values.join(grown(shared), "_value").groupBy(seq).agg(F.count(F.lit(1)).alias(_N)).filter(F.col(_N) > 1).select(seq)


def filter_pays(df: DataFrame, columns) -> bool:
    """Whether half of the rows or fewer share two key values, by estimate: at most twice as many rows
    as there are values beyond the distinct ones share a column's values."""
    row = df.agg(F.expr("count(1) AS n"), *[F.expr(x) for i, c in enumerate(columns) for x in (
        f"count_if({s_filled(c)}) AS n{i}", f"approx_count_distinct(nullif({ident(c)}, ''), 0.03) AS d{i}")]).first()
    sharing = sorted((min(row[f"n{i}"], 2 * max(0, row[f"n{i}"] - row[f"d{i}"])) for i in range(len(columns))), reverse=True)
    return len(sharing) > 1 and 2 * sharing[1] <= row.n


def dedupe(df: DataFrame, combinations, seq: str = "seq", keep_order: bool = True, single_keys: bool | None = None,
           keys: DataFrame | None = None) -> DataFrame:
    """E1 over all key pairs in order. Input rows need a unique ``seq`` (their
    initial order); the output keeps ``_ord`` unless ``keep_order`` is False. ``single_keys`` says
    whether rows that cannot merge are taken out first (None: where that pays); ``keys`` may give the
    rows' seq and key columns from a cheaper plan."""
    solid = [f.name for f in df.schema.fields if not f.nullable and f.name != ORD]
    out = df if ORD in df.columns else with_initial_order(df, seq)
    columns = key_columns(combinations)
    keys = df if keys is None else keys
    alone = None
    if filter_pays(keys, columns) if single_keys is None else single_keys:
        sharing = grown(stored(sharing_rows(keys, columns, seq), "sharing"))
        out, alone = out.join(sharing, seq, "left_semi"), out.join(sharing, seq, "left_anti")
    for p, (k1, k2) in enumerate(combinations, start=1):
        out = dedupe_pass(out, k1, k2, p, seq, solid)
    if alone is not None:
        out = out.unionByName(alone)
    return out if keep_order else out.drop(ORD)


def order_columns() -> list[Column]:
    """Sort key of the de-duplicated order, field by field."""
    return [F.col(f"{ORD}.t"), F.col(f"{ORD}.a"), F.col(f"{ORD}.b"), F.col(f"{ORD}.s")]
