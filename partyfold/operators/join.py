"""Mapping-driven two-table join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slice import mapped


def join_tables(left: DataFrame, left_alias: str, right: DataFrame, right_alias: str,
                on, how: str = "inner", columns=()) -> DataFrame:
    """``SELECT <columns> FROM left l <how> JOIN right r ON l.x = r.y AND ...``.

    ``on`` is a list of (left expr, right expr) pairs; ``columns`` a list of
    (qualified column, alias or None), or of (None, "expression AS alias")."""
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in on])
    joined = left.alias(left_alias).join(right.alias(right_alias), cond, how)
    return joined.select(*[mapped(c, alias or (c.split(".")[-1] if isinstance(c, str) else None)) for c, alias in columns])
