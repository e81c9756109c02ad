"""The kept masters: rows bucketed by code, the indexes over them, and the changes since.

``Masters`` is the state a daily run starts from and leaves behind. Within a run the tables
written by the run before are only read: feeds append to change logs and index deltas, all of
the size of their batches. ``saved`` writes the next state once, without moving the old one.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..operators import changelog as cl
from ..operators.keyindex import KeptIndex, index_schema
from ..operators.master import is_president
from ..operators.match import KEY, key_pairs
from ..operators.skew import grown
from ..sources.bucketed import default_buckets, read_bucketed, scratch_path, write_bucketed
from ..sources.conf import Conf
from ..sources.tables import counted

PAIR_TYPES = {KEY[0]: T.IntegerType()}


@dataclass(frozen=True)
class KeptMaster:
    base: DataFrame                  # layout rows, bucketed by pk
    pk: str
    combinations: tuple
    flags: tuple
    index: KeptIndex                 # E3 key pairs
    top: int                         # largest code as a number
    buckets: int
    log: tuple = ()                  # change rows of the feeds since

    @property
    def layout(self) -> T.StructType:
        return self.base.schema

    @classmethod
    def build(cls, rows: DataFrame, pk: str, combinations, flags, path: str, index_path: str, buckets: int) -> "KeptMaster":
        """From any master table: bucketed by code and indexed."""
        base = write_bucketed(rows, path, [pk], buckets)
        index = KeptIndex.build(key_pairs(base, combinations, pk), KEY, pk, index_path, buckets)
        return cls(base, pk, combinations, flags, index, _top(base, pk), buckets)

    @classmethod
    def load(cls, spark: SparkSession, layout: T.StructType, pk: str, combinations, flags, path: str, index_path: str,
             buckets: int) -> "KeptMaster":
        base = read_bucketed(spark, path, layout, [pk], buckets)
        index = KeptIndex.load(spark, index_path, index_schema(KEY, pk, PAIR_TYPES), KEY, pk, buckets)
        return cls(base, pk, combinations, flags, index, _top(base, pk), buckets)

    def changed(self, changes: DataFrame, inserted: int, delta: DataFrame | None = None) -> "KeptMaster":
        return replace(self, log=(*self.log, changes), top=self.top + inserted,
                       index=self.index if delta is None else self.index.extended(delta))

    def _log(self, columns=None) -> DataFrame | None:
        if not self.log:
            return None
        out = reduce(DataFrame.unionByName, self.log)
        return out if columns is None else out.select(*columns, cl.VERSION, cl.INSERT)

    def current(self, codes: DataFrame, columns) -> DataFrame:
        """(pk, columns) of the rows with these ``codes`` (distinct pk rows) as they stand now. The
        base gives just these columns, and is not moved."""
        cols = [self.pk, *(c for c in columns if c != self.pk)]
        rows = self.base.select(*cols).join(grown(codes), self.pk, "left_semi")
        log = self._log(cols)
        if log is None:
            return rows
        log = log.join(grown(codes), self.pk, "left_semi")
        rows = rows.unionByName(log.filter(cl.INSERT).select(*cols))
        return cl.applied(rows, cl.folded(log.filter(~F.col(cl.INSERT)), self.pk, cols, self.flags), self.pk, self.flags)

    def rows(self, inserts: bool = True) -> DataFrame:
        """The next state: the base and the inserted rows, each with its updates."""
        log = self._log()
        if log is None:
            return self.base
        names = self.layout.fieldNames()
        updates = cl.folded(log.filter(~F.col(cl.INSERT)), self.pk, names, self.flags)
        old = cl.applied(self.base, updates, self.pk, self.flags)
        if not inserts:
            return old
        new = cl.applied(log.filter(cl.INSERT).select(*names), updates, self.pk, self.flags)
        return old.unionByName(new)

    def saved(self, path: str, index_path: str | None) -> tuple["KeptMaster", dict]:
        """Write the next state and its index (None: without it); returns it and the rows inserted, updated, untouched
        and in all, counted while they are written."""
        log = self._log()
        names = self.layout.fieldNames()
        tag = F.col("_tag")
        if log is None:
            rows = self.base.withColumn("_tag", F.lit("untouched"))
        else:
            updates = cl.folded(log.filter(~F.col(cl.INSERT)), self.pk, names, self.flags).withColumn("_touched", F.lit(True))
            mark = "CASE WHEN _new__touched THEN 'updated' ELSE 'untouched' END AS _tag"
            old = cl.applied(self.base, updates, self.pk, self.flags, extra=[mark])
            new = cl.applied(log.filter(cl.INSERT).select(*names), updates, self.pk, self.flags, extra=["'inserted' AS _tag"])
            rows = old.unionByName(new)
        observed, obs = counted(rows, f"save-{self.pk}", **{t: F.count_if(tag == t) for t in ("inserted", "updated", "untouched")})
        base = write_bucketed(observed.drop("_tag"), path, [self.pk], self.buckets, aligned=True)
        index = self.index.saved(index_path, self.buckets) if index_path else self.index
        return replace(self, base=base, index=index, log=()), {k: int(v) for k, v in obs.get.items()}


def _top(base: DataFrame, pk: str) -> int:
    """Largest code as a number, 0 for an empty master (E5)."""
    return int(base.agg(F.coalesce(F.max(F.col(pk).try_cast("bigint")), F.lit(0))).first()[0])


def president_entry(job_post: Column, company: Column, conf: Conf) -> Column:
    """A person's key in the index of presidents: an array of their company, empty for others."""
    held = F.coalesce(is_president(job_post, conf), F.lit(False)) & company.isNotNull()
    key = F.array(F.struct(company.alias("company_code")))
    return F.when(held, key).otherwise(F.slice(key, F.lit(1), F.lit(0)))


@dataclass(frozen=True)
class Masters:
    company: KeptMaster
    person: KeptMaster
    presidents: KeptIndex            # E11: (company_code) -> person_id of its presidents
    linked: bool = False             # president_person_id follows the index already
    step: int = 0                    # feeds applied since the state was built or loaded

    @classmethod
    def build(cls, m_company: DataFrame, m_person: DataFrame, conf: Conf, buckets: int | None = None, root: str | None = None) -> "Masters":
        """The state of two plain master tables, kept under ``root`` (else in the checkpoint folder)."""
        spark = m_company.sparkSession
        n = buckets or default_buckets(spark)
        root = root or scratch_path(spark, "masters")
        with ThreadPoolExecutor(max_workers=2) as pool:
            company = pool.submit(inheritable_thread_target(spark)(KeptMaster.build), m_company, "company_code",
                                  fixed.COMPANY_COMBINATIONS, fixed.COMPANY_FLAGS, f"{root}/company", f"{root}/company_pairs", n)
            person = pool.submit(inheritable_thread_target(spark)(KeptMaster.build), m_person, "person_id",
                                 fixed.PERSON_COMBINATIONS, (), f"{root}/person", f"{root}/person_pairs", n)
            company, person = company.result(), person.result()
        held = (person.base.select("person_id", F.explode(president_entry(F.col("job_post"), F.col("company_code"), conf)).alias("k"))
                .select("k.company_code", "person_id"))
        presidents = KeptIndex.build(held, ("company_code",), "person_id", f"{root}/presidents", n)
        return cls(company, person, presidents)

    @classmethod
    def load(cls, spark: SparkSession, m_company: str, m_person: str, index_root: str, layouts: tuple, buckets: int) -> "Masters":
        """The state that ``saved`` left."""
        company = KeptMaster.load(spark, layouts[0], "company_code", fixed.COMPANY_COMBINATIONS, fixed.COMPANY_FLAGS,
                                  m_company, f"{index_root}/company_pairs", buckets)
        person = KeptMaster.load(spark, layouts[1], "person_id", fixed.PERSON_COMBINATIONS, (), m_person,
                                 f"{index_root}/person_pairs", buckets)
        presidents = KeptIndex.load(spark, f"{index_root}/presidents", index_schema(("company_code",), "person_id"),
                                    ("company_code",), "person_id", buckets)
        return cls(company, person, presidents, linked=True)

    def saved(self, m_company: str, m_person: str, index_root: str | None = None) -> tuple["Masters", dict]:
        """Write the next state, with its indexes under ``index_root`` where one is given; returns it and its
        row counts (rows, inserted, updated, untouched of both masters)."""
        place = lambda name: f"{index_root}/{name}" if index_root else None
        company, of_company = self.company.saved(m_company, place("company_pairs"))
        person, of_person = self.person.saved(m_person, place("person_pairs"))
        presidents = self.presidents.saved(place("presidents"), self.company.buckets) if index_root else self.presidents
        counts = {**{f"company_{k}": v for k, v in of_company.items()}, **{f"person_{k}": v for k, v in of_person.items()}}
        return Masters(company, person, presidents, self.linked), counts
