"""Match a batch against a master, split, mint codes, attach codes.

All key pairs go through one shuffle: each row is exploded once into
``(combination, key a, key b)`` for its filled pairs, the master side is
reduced to one code per such key by one partial aggregate, and one equi-join
meets the two. Rows whose two keys are not both filled give no pair: besides
being the rule, this keeps the one giant ``''`` key out of the shuffle. A pair
that a large share of the batch holds has a single row on the other side, so
AQE's skew join splits just that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import CODE_WIDTH
from ..functions.text import ident
from .dedupe import order_columns, s_filled
from .keyindex import KeptIndex
from .ordinal import with_global_ordinal
from .skew import grown

_RANK, _PK = "combo", "_cand_pk"
#: A key pair: the place of its combination and the two values.
KEY = (_RANK, "key_a", "key_b")


def pair_array(combinations, prefix: str = "") -> Column:
    """The filled key pairs of a row as an array of structs (columns named with ``prefix``)."""
    pairs = ", ".join(
        f"CASE WHEN {s_filled(prefix + k1, prefix + k2)} THEN named_struct('{KEY[0]}', {rank}, '{KEY[1]}', {ident(prefix + k1)}, "
        f"'{KEY[2]}', {ident(prefix + k2)}) END" for rank, (k1, k2) in enumerate(combinations))
    return F.expr(f"array_compact(array({pairs}))")


def key_pairs(df: DataFrame, combinations, value: str) -> DataFrame:
    """(combination, key a, key b, value): one row per filled key pair of each row."""
    return df.select(F.col(value), F.explode(pair_array(combinations)).alias("_pair")).select("_pair.*", value)


def match_master(batch: DataFrame, master: DataFrame, combinations, pk: str,
                 row_id: str = "seq") -> DataFrame:
    """(row_id, pk) of batch rows that equal a master row on some key pair.

    Later pairs overwrite earlier ones; within one pair the last master row
    (largest pk) wins. The master is first reduced to one pk per key pair
    (a partial aggregate, so hot pairs are combined map-side), so each batch
    row meets at most one candidate per pair: no fan-out."""
    keys = key_pairs(master, combinations, pk).groupBy(*KEY).agg(F.max(pk).alias(pk))
    return _best_match(key_pairs(batch, combinations, row_id), keys, pk, row_id)


def match_index(batch: DataFrame, index: KeptIndex, combinations, row_id: str = "seq") -> DataFrame:
    """E3 against a kept index instead of the master: the batch's key pairs go to the index's
    buckets, the index stays where it is."""
    pairs = key_pairs(batch, combinations, row_id)
    return _best_match(pairs, index.best(pairs.select(*KEY).distinct()), index.pk, row_id)


def _best_match(pairs: DataFrame, keys: DataFrame, pk: str, row_id: str) -> DataFrame:
    cands = pairs.join(grown(keys.withColumnRenamed(pk, _PK)), list(KEY))
    return cands.groupBy(row_id).agg(F.max_by(F.col(_PK), F.struct(F.col(_RANK), F.col(_PK))).alias(pk))


def split_insert_update(batch: DataFrame, matches: DataFrame, pk: str, row_id: str = "seq"):
    """(insert rows, update rows with pk). One join feeds both sides."""
    joined = batch.join(grown(matches), row_id, "left")
    return joined.filter(F.col(pk).isNull()).drop(pk), joined.filter(F.col(pk).isNotNull())


def next_code(master: DataFrame, pk: str) -> Column:
    """First free code: max existing code as a number + 1 (1 for an empty master),
    as a scalar subquery: it stays inside the plan, no separate driver job."""
    return master.agg(F.coalesce(F.max(F.col(pk).try_cast("bigint")), F.lit(0)) + 1).scalar()


def code_text(n: Column) -> Column:
    """Zero-pad to 10 digits; a longer number is kept whole (lpad would cut it)."""
    s = n.cast("string")
    return F.when(F.length(s) >= CODE_WIDTH, s).otherwise(F.lpad(s, CODE_WIDTH, "0"))


def mint_codes(inserts: DataFrame, master: DataFrame | int, pk: str, order=None) -> DataFrame:
    """E5: new codes max+1.. in the batch's de-duplicated order. ``master`` is the table, or its
    largest code as a number."""
    start = master + 1 if isinstance(master, int) else next_code(master, pk)
    numbered = with_global_ordinal(inserts, order or order_columns(), "_code_n", start=start)
    return numbered.withColumn(pk, code_text(F.col("_code_n"))).drop("_code_n")


def attach_codes(source: DataFrame, coded: DataFrame, combinations, pk: str,
                 row_id: str = "seq") -> DataFrame:
    """(row_id, pk) for every source row: the first key pair, in order,
    whose filled keys equal a coded row's (smallest code per pair); a row no
    pair reaches takes the code of the coded row with its own row_id."""
    keys = key_pairs(coded, combinations, pk).groupBy(*KEY).agg(F.min(pk).alias(_PK))
    cands = key_pairs(source, combinations, row_id).join(grown(keys), list(KEY)).select(row_id, _RANK, _PK)
    own = coded.select(row_id, F.lit(len(combinations)).alias(_RANK), F.col(pk).alias(_PK))
    best = cands.unionByName(own).groupBy(row_id).agg(F.min_by(F.col(_PK), F.col(_RANK)).alias(pk))
    return source.select(row_id).join(grown(best), row_id, "left")
