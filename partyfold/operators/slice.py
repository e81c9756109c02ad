"""Daily slice of a lake table, mapping-driven projection, row numbering."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import with_global_ordinal


def day_filter(df: DataFrame, day: dt.date, ts_col: str = "update_datetime"):
    """``DATE(ts) = day`` written as a half-open range so it reaches the parquet scan."""
    ts_type = df.schema[ts_col].dataType
    start = F.lit(dt.datetime.combine(day, dt.time())).cast(ts_type)
    end = F.lit(dt.datetime.combine(day + dt.timedelta(days=1), dt.time())).cast(ts_type)
    return (F.col(ts_col) >= start) & (F.col(ts_col) < end)


def mapped(src, dst) -> Column:
    """One entry of a column map: a source column (name or Column) under its new name, or, where the
    source is None, ``dst`` as a SQL expression with its alias ("upper(city) AS city")."""
    if src is None:
        return F.expr(dst)
    column = src if isinstance(src, Column) else F.col(src)
    return column.alias(dst) if dst else column


def daily_slice(lake: DataFrame, day: dt.date, mapping, tie_break=(), ts_col: str = "update_datetime",
                seq_col: str = "seq", partition: str | None = None) -> DataFrame:
    """Rows updated on ``day``, projected by ``mapping`` [(src, dst)] (real renames and
    expressions, see ``mapped``), numbered 1.. in (update time, tie-break) order as ``seq``. With the
    lake's day column as ``partition`` only that day's files are read. Expressions are taken after the
    numbering, from the lake's columns."""
    wanted = day_filter(lake, day, ts_col)
    if partition is not None:
        wanted = (F.col(partition) == F.lit(day)) & wanted
    numbered = with_global_ordinal(lake.filter(wanted), [ts_col, *tie_break], seq_col)
    return numbered.select(seq_col, *[mapped(src, dst) for src, dst in mapping])
