"""E7 keyed merge-update, E8 flag OR, E11 president link, E15 keyed delete.

Masters are immutable snapshots: every operator returns the next state as a
DataFrame (left join of the target with the per-key source row), which the
caller writes as a new snapshot or checkpoints.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..sources.conf import Conf
from .dedupe import ORD
from .skew import grown

_S = "_src_"
_HIT = "_src_hit"


def _string_columns(df: DataFrame) -> set:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def one_row_per_key(source: DataFrame, key: str, columns, order_col: str | None = ORD,
                    on_multi: str = "last") -> DataFrame:
    """Source rows reduced to one per key: the last in ``order_col`` order
    (``on_multi='last'``), or fail on duplicates (``'error'``, like a MERGE);
    ``'unique'`` trusts the caller."""
    cols = [c for c in dict.fromkeys(columns) if c != key]
    if on_multi == "unique":          # already one row per key by construction
        return source.select(key, *cols)
    if on_multi == "error":
        dup = source.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"several source rows for {key}={dup[0][0]}")
        return source.select(key, *cols)
    if order_col is None or order_col not in source.columns:
        raise ValueError("on_multi='last' needs an order column")
    # max_by per column keeps every value of the same (last) row; partial aggregate
    return source.groupBy(key).agg(*[F.max_by(F.col(c), F.col(order_col)).alias(c) for c in cols])


def merge_update(target: DataFrame, source: DataFrame, key: str, columns, *,
                 or_columns=(), order_col: str | None = ORD, on_multi: str = "last") -> DataFrame:
    """For target rows with a source row, ``col = COALESCE(NULLIF(S.col,''), T.col)``
    for text columns and ``COALESCE(S.col, T.col)`` otherwise, only for ``columns``.
    E8: ``or_columns`` become ``S OR T`` (a missing flag counts as false)."""
    cols = [c for c in dict.fromkeys(list(columns) + list(or_columns)) if c != key]
    src = one_row_per_key(source, key, cols, order_col, on_multi)
    src = src.select(F.col(key), F.lit(True).alias(_HIT), *[F.col(c).alias(_S + c) for c in cols])
    strings = _string_columns(target)
    joined = target.join(grown(src), key, "left")
    out = []
    for c in target.columns:
        if c in or_columns:
            val = F.when(F.col(_HIT), F.coalesce(F.col(_S + c), F.lit(False))
                         | F.coalesce(F.col(c), F.lit(False))).otherwise(F.col(c))
        elif c in cols:
            s = F.col(_S + c)
            val = F.coalesce(F.nullif(s, F.lit("")) if c in strings else s, F.col(c))
            val = val.cast(target.schema[c].dataType)
        else:
            val = F.col(c)
        out.append(val.alias(c))
    return joined.select(*out)


def is_president(job_post: Column, conf: Conf) -> Column:
    """The title contains a president keyword (no keywords: nobody's does)."""
    words = list(dict.fromkeys(conf.keywords_of(fixed.KEYWORD_PRESIDENT)))
    return reduce(lambda a, b: a | b, [job_post.contains(w) for w in words], F.lit(False))


def president_rows(m_person: DataFrame, conf: Conf) -> DataFrame:
    """E11 source: (company_code, president_person_id), smallest person per company."""
    held = F.coalesce(is_president(F.col("job_post"), conf), F.lit(False))
    return (m_person.filter(held & F.col("company_code").isNotNull())
            .groupBy("company_code").agg(F.min("person_id").alias("president_person_id")))


def president_link(m_company: DataFrame, m_person: DataFrame, conf: Conf) -> DataFrame:
    """Set m_company.president_person_id from the persons' titles."""
    return merge_update(m_company, president_rows(m_person, conf), "company_code",
                        ["president_person_id"], order_col=None, on_multi="unique")


def delete_keys(target: DataFrame, keys: DataFrame, key: str, key_col: str | None = None) -> DataFrame:
    """Keyed delete as a left-anti join (no driver-side key list)."""
    k = keys.select(F.col(key_col or key).alias(key)).filter(F.col(key).isNotNull())
    return target.join(grown(k), key, "left_anti")
