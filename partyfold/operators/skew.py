"""Hot-key handling for joins of rows with their per-key aggregate.

A key may hold a third of all rows. Joining those rows with the key's single
aggregate row would put them all into one task; salting splits every key
over ``salts`` sub-keys: the row side takes a salt from a hash of its own
columns, the (small, one-row-per-key) side is replicated once per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def grown(side: DataFrame) -> DataFrame:
    """``side`` of a join whose rows grow with the data: joined by a shuffle, never broadcast. The planner
    goes by the size of the files or of the shuffle's blocks, which compress well: a side below its
    threshold can take tens of times as much when the driver holds it as a hash table, and several
    such joins run at a time. A hot key is split by AQE as in every sort-merge join."""
    return side.hint("merge")


def salted_join(rows: DataFrame, per_key: DataFrame, keys, how: str = "inner", salts: int = 16,
                salt_from=None) -> DataFrame:
    """Join ``rows`` with ``per_key`` (one row per key) on ``keys``, split ``salts`` ways."""
    keys = list(keys)
    src = [F.col(c) for c in (salt_from or rows.columns)]
    salted = rows.withColumn(SALT, F.pmod(F.xxhash64(*src), F.lit(salts)))
    spread = per_key.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(grown(spread), keys + [SALT], how).drop(SALT)
