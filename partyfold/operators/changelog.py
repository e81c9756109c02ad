"""Keyed changes of a master, kept as a log and applied in one go.

A feed does not rewrite a master. It leaves change rows in the master's layout: inserts (whole
new rows) and updates (one row per key and version, null where the column is not its business).
The next state of a master is one aggregate over the updates, the last non-empty value of
every column by version, joined to the rows there were: exactly what applying the feeds'
merge-updates (E7, E8) one after another gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ident
from .dedupe import ORD
from .keyindex import VERSION
from .master import one_row_per_key
from .skew import grown

INSERT = "_insert"


def log_schema(layout: T.StructType) -> T.StructType:
    return T.StructType([*layout.fields, T.StructField(VERSION, T.IntegerType()), T.StructField(INSERT, T.BooleanType())])


def _in_layout(rows: DataFrame, layout: T.StructType, columns, version: int, insert: bool, flags=()) -> DataFrame:
    out = []
    for f in layout.fields:
        c = f"CAST({ident(f.name) if f.name in columns else 'NULL'} AS {f.dataType.simpleString()})"
        out.append(f"{f'coalesce({c}, false)' if f.name in flags else c} AS {ident(f.name)}")
    return rows.selectExpr(*out, f"{version} AS {VERSION}", f"{str(insert).lower()} AS {INSERT}")


def insert_rows(rows: DataFrame, layout: T.StructType, version: int) -> DataFrame:
    """New rows of a master (columns they lack are null)."""
    return _in_layout(rows, layout, set(rows.columns), version, True)


def update_rows(source: DataFrame, key: str, columns, layout: T.StructType, version: int, *, flags=(),
                order_col: str | None = ORD, on_multi: str = "last") -> DataFrame:
    """E7 / E8 as change rows: the source reduced to one row per key, only ``columns`` and
    ``flags`` filled. A flag of an update is never null (it will be OR-ed)."""
    cols = [c for c in dict.fromkeys([*columns, *flags]) if c != key]
    return _in_layout(one_row_per_key(source, key, cols, order_col, on_multi), layout, {key, *cols}, version, False, flags)


def folded(updates: DataFrame, key: str, columns, flags=()) -> DataFrame:
    """One row per key: flags OR-ed, of the other columns the last non-empty value by version."""
    aggs = []
    for c in columns:
        if c == key:
            continue
        if c in flags:
            aggs.append(f"max({ident(c)}) AS {ident(c)}")
            continue
        value = f"nullif({ident(c)}, '')" if isinstance(updates.schema[c].dataType, T.StringType) else ident(c)
        aggs.append(f"max_by({value}, CASE WHEN {value} IS NOT NULL THEN {VERSION} END) AS {ident(c)}")
    return updates.groupBy(key).agg(*[F.expr(a) for a in aggs])


def applied(rows: DataFrame, changes: DataFrame, key: str, flags=(), extra=()) -> DataFrame:
    """``rows`` with the folded ``changes`` of their keys (and ``extra`` SQL columns, which may use those of the
    changes as ``_new_<name>``); ``rows`` bucketed on the key stay where they are, and so does the result."""
    fresh = changes.columns
    new = changes.selectExpr(ident(key), *[f"{ident(c)} AS {ident('_new_' + c)}" for c in fresh if c != key])
    out = []
    for c in rows.columns:
        a, b = ident(c), ident("_new_" + c)
        if c == key or c not in fresh:
            out.append(a)
        elif c in flags:
            out.append(f"CASE WHEN {b} IS NOT NULL THEN {b} OR coalesce({a}, false) ELSE {a} END AS {a}")
        else:
            out.append(f"coalesce({b}, {a}) AS {a}")
    return rows.join(grown(new), key, "left").selectExpr(*out, *extra)
