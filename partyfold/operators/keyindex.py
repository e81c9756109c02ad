"""A kept index of a master: which codes stand under which key.

The base is a table bucketed on the key, one row per (key, code), written in the form of the
deltas (version 0, alive) so that the two can be read as one. Every batch adds a delta
with just its changes: entries that came to life and entries that died, under a version
number that grows from batch to batch. A look-up takes the wanted keys to the buckets (the
base is never shuffled or sorted out anew), resolves each (key, code) to its latest version and
reduces every key to one code, so a key that very many rows hold costs no fan-out.

Two indexes are kept: the key pairs of E3, on (combination, key a, key b), and the presidents
of each company for E11, on the company code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.bucketed import read_bucketed, write_bucketed
from .skew import grown

VERSION, LIVE = "_version", "_live"


def index_schema(keys, pk: str, types: dict | None = None) -> T.StructType:
    types = types or {}
    return T.StructType([*[T.StructField(c, types.get(c, T.StringType())) for c in (*keys, pk)],
                         T.StructField(VERSION, T.IntegerType()), T.StructField(LIVE, T.BooleanType())])


def delta(before: Column, after: Column, rows: DataFrame, pk: str, version: int) -> DataFrame:
    """Entries of ``rows`` that changed: ``before`` and ``after`` are arrays of key structs (null
    or empty for none); one row per entry that died or came to life."""
    none = F.slice(after, F.lit(1), F.lit(0))
    old, new = F.coalesce(before, none), F.coalesce(after, none)
    changed = rows.select(F.col(pk), old.alias("_old"), new.alias("_new"))
    told = "transform(array_except({0}, {1}), k -> named_struct('key', k, 'live', {2}))"
    entry = f"explode(concat({told.format('_old', '_new', 'false')}, {told.format('_new', '_old', 'true')})) AS _entry"
    return (changed.selectExpr(pk, entry)
            .selectExpr("_entry.key.*", pk, f"{version} AS {VERSION}", f"_entry.live AS {LIVE}"))


def _as_base(rows: DataFrame) -> DataFrame:
    return rows.withColumns({VERSION: F.lit(0), LIVE: F.lit(True)})


@dataclass(frozen=True)
class KeptIndex:
    base: DataFrame                      # keys + pk + version + live, bucketed on the keys
    keys: tuple
    pk: str
    deltas: tuple = ()                   # the same columns, of the batches since

    @classmethod
    def build(cls, entries: DataFrame, keys, pk: str, path: str, buckets: int) -> "KeptIndex":
        """The index of (keys, pk) rows, written at ``path``."""
        rows = entries.select(*keys, pk).repartition(buckets, *keys).distinct()
        return cls(write_bucketed(_as_base(rows), path, keys, buckets, aligned=True), tuple(keys), pk)

    @classmethod
    def load(cls, spark, path: str, schema: T.StructType, keys, pk: str, buckets: int) -> "KeptIndex":
        return cls(read_bucketed(spark, path, schema, keys, buckets), tuple(keys), pk)

    def extended(self, changes: DataFrame) -> "KeptIndex":
        return replace(self, deltas=(*self.deltas, changes))

    def _resolved(self, frames) -> DataFrame:
        """Live (keys, pk) of the base and the deltas, the latest version of each deciding."""
        out = frames[0]
        for d in frames[1:]:
            out = out.unionByName(d)
        return (out.groupBy(*self.keys, self.pk).agg(F.max_by(LIVE, VERSION).alias(LIVE))
                .filter(LIVE).drop(LIVE))

    def entries(self, buckets: int | None = None) -> DataFrame:
        """All live entries. With ``buckets`` (those of the base) only the deltas move."""
        if not self.deltas:
            return self.base.select(*self.keys, self.pk)
        moved = [d.repartition(buckets, *self.keys) if buckets else d for d in self.deltas]
        return self._resolved([self.base, *moved])

    def best(self, wanted: DataFrame | None, pick: Callable[[str], Column] = F.max) -> DataFrame:
        """(keys, pk) of the ``wanted`` keys (distinct rows; None: of all) that have live entries:
        the code that ``pick`` takes."""
        frames = [self.base, *self.deltas]
        if wanted is not None:
            frames = [f.join(grown(wanted), list(self.keys), "left_semi") for f in frames]
        live = frames[0] if not self.deltas else self._resolved(frames)
        return live.groupBy(*self.keys).agg(pick(self.pk).alias(self.pk))

    def saved(self, path: str, buckets: int) -> "KeptIndex":
        """The index as one base again, at ``path``: buckets are read, changed and written in place
        of each other without moving the base."""
        rows = self.entries(buckets).select(*self.keys, self.pk)
        return replace(self, base=write_bucketed(_as_base(rows), path, self.keys, buckets, aligned=True), deltas=())
