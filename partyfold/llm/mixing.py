"""Mixing sources to target weights by capped water-filling.

Every source gets ``weight / sum of weights`` of the wanted total. A source whose share
exceeds ``max_epochs`` times its size is clamped there and what it cannot take goes to the
others in proportion to their weights, again and again until no share is above its cap.
A source then repeats each of its documents ``floor(target / size)`` times, and the
fraction that is left is one more copy of documents in a seeded order, up to the target.

Scale: the texts are read once (a count of words, JVM only). The seeded order is a hash;
the cut in it is found from sums per (source, leading bits of the hash), eight more bits at
a time and only within the bucket that holds the cut; the sums combine before the shuffle, and
only documents of the last such bucket are put in order. A source with a third of all rows is thus spread over all tasks.

Defined cases: null text has size 0 and is taken 0 times; null source is a source of its
own, last in order; rows with equal ids are separate rows; sources without words get target
0; an empty table gives an empty result. Needs the columns named in the call only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_global_ordinal
from .common import WORD_PATTERN, free_names, picked, small_side, stored

#: The cut of a source is found by so many more leading bits of the 60-bit order hash at each level.
BITS, LEVELS = 8, 3


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def order_hash(doc_id, seed: str):
    """60 bits of MD5 of id and seed: the same on every run and engine."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")),
                                             F.lit(seed))), 1, 15), 16, 10).cast("long")


def _bucket(level: int):
    return F.shiftright("_h", 60 - BITS * level)


def water_fill(sources: DataFrame, total: float) -> DataFrame:
    """Targets of ``sources`` (source, weight, cap): adds ``target``. Clamping only ever
    adds sources, so the loop ends; each round is one aggregate over one row per source."""
    clamped = F.lit(False)
    level = 0.0
    n = -1
    while True:
        free = F.when(~clamped, F.col("weight"))
        row = sources.agg(F.coalesce(F.sum(free), F.lit(0)).alias("w"),
                          F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)).alias("c"),
                          F.count(F.when(clamped, F.lit(1))).alias("n")).first()
        if row.n == n or not row.w:
            break
        n = row.n
        rest, weights = float(total - row.c), float(row.w)
        level = rest / weights
        clamped = clamped | (F.col("weight") * F.lit(rest) / F.lit(weights) > F.col("cap"))
    if n < 0:
        return sources.withColumn("target", F.lit(0.0))
    share = F.col("weight") * F.lit(rest) / F.lit(weights) if level else F.lit(0.0)
    return sources.withColumn("target", F.when(clamped, F.col("cap").cast("double")).otherwise(share))


def _mixed(docs: DataFrame, weights: Sequence[int], total_share: float, max_epochs: int, seed: str,
           whole_documents: bool, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The rows of ``mix`` with their order hash _h."""
    rows = picked(docs, doc_id=id_col, text=text_col, source=source_col)
    rows = stored(rows.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              order_hash(F.col("doc_id"), seed).alias("_h")), "mix-sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_ordinal(sums, [F.col("source").asc_nulls_last()], "_n", start=0)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stored(ranked.select("source", "source_size",
                                  F.element_at(cycle, (F.col("_n") % len(weights) + 1).cast("int")).alias("weight"),
                                  (F.col("source_size") * max_epochs).alias("cap")), "mix-sources")
    words = ranked.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(ranked, total_share * words)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (filled.withColumn("_whole", rate.cast("long"))
            .withColumn("_rest", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")))

    # where in the hash order each source's last, fractional copy ends: bits by bits, from sums
    # that combine before the shuffle
    plan = plan.select(F.col("source").alias("_src"), "source_size", "target", "_whole", "_rest",
                       F.lit(0).cast("long").alias("_cut"), F.lit(0).cast("long").alias("_before"))
    for level in range(1, LEVELS + 1):
        plan = stored(plan, "mix-plan")
        here = (rows.filter("size > 0").join(small_side(plan.select("_src", "_rest", "_cut", F.col("_before").alias("_base"))),
                                             F.col("source").eqNullSafe(F.col("_src")))
                .withColumn("_b", _bucket(level)).filter(F.shiftright("_b", BITS) == F.col("_cut")))
        sums = here.groupBy("_src", "_rest", "_base", "_b").agg(F.sum("size").alias("_s"))
        before = Window.partitionBy("_src").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_s").over(before), F.lit(0)))
        cuts = (sums.filter("_before < _rest and _rest <= _before + _s")
                .select(F.col("_src").alias("_at"), F.col("_b").alias("_cut"), "_before"))
        plan = (plan.drop("_cut", "_before").join(cuts, F.col("_src").eqNullSafe(F.col("_at")), "left").drop("_at")
                .withColumn("_cut", F.coalesce("_cut", F.lit(-1))).withColumn("_before", F.coalesce("_before", F.lit(0))))
    plan = stored(plan, "mix-plan")
    joined = (rows.join(small_side(plan), F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
              .withColumn("_b", _bucket(LEVELS)))
    at_cut = (F.col("_b") == F.col("_cut")) & (F.col("size") > 0)
    running = (Window.partitionBy("source").orderBy("_h", "doc_id", "size")
               .rowsBetween(Window.unboundedPreceding, -1))
    done = F.col("_before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    left = F.greatest(F.col("_rest") - done, F.lit(0))
    if whole_documents:
        part = F.when(left * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    else:
        part = F.least(left, F.col("size"))
    inside = joined.filter(at_cut).withColumn("part", part)
    outside = joined.filter(~at_cut).withColumn(
        "part", F.when(F.col("_b") < F.col("_cut"), F.col("size")).otherwise(F.lit(0)))
    return (outside.unionByName(inside)
            .select("_h", "doc_id", "source", "size", "source_size", "target",
                    F.col("_whole").alias("whole"), F.col("part").cast("long").alias("part"),
                    (F.col("_whole") * F.col("size") + F.col("part")).cast("long").alias("taken")))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5,
        max_epochs: int = 2, seed: str = "mix", whole_documents: bool = False,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole (full copies),
    part (words of one more copy), taken = whole * size + part.

    With ``whole_documents`` the document at a source's cut is taken in full or not at all,
    whichever is nearer to the target; else it gives just the words that are missing."""
    return _mixed(docs, weights, total_share, max_epochs, seed, whole_documents, id_col, text_col, source_col).drop("_h")


def repeated(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5,
             max_epochs: int = 2, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it, whole documents only (rows of one id and
    source alike); rows without words are taken 0 times. Each source's last copy ends at one place of the
    hash order, so rows are decided where they are, by a table with one row per source."""
    mixed = _mixed(docs, weights, total_share, max_epochs, seed, True, id_col, text_col, source_col)
    src, whole, last, count, copy = free_names(docs, "mix_source", "mix_whole", "mix_last", "mix_copies", "mix_copy")
    plan = mixed.groupBy(F.col("source").alias(src)).agg(
        F.max("whole").alias(whole), F.max(F.when(F.col("part") > 0, F.col("_h"))).alias(last))
    plan = stored(plan, "mix-copies")
    joined = docs.join(small_side(plan), docs[source_col].eqNullSafe(F.col(src)))
    one_more = order_hash(docs[id_col], seed) <= F.coalesce(F.col(last), F.lit(-1))
    copies = F.when(word_count(docs[text_col]) > 0, F.col(whole) + one_more.cast("long")).otherwise(F.lit(0))
    return (joined.select(*[docs[c] for c in docs.columns], copies.alias(count)).filter(F.col(count) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))))
            .select(*docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


#: The same rows for DuckDB: sources sorted by the level at which they clamp.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || 'mix'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER o, 0)::BIGINT AS caps_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weights_left
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (
  SELECT caps_before, weights_left, total FROM r
  WHERE NOT (weight::DOUBLE * (total - caps_before) / weights_left::DOUBLE > cap)
  ORDER BY caps_before LIMIT 1),
t AS (
  SELECT r.source, r.source_size,
         CASE WHEN r.weight::DOUBLE * (r.total - l.caps_before) / l.weights_left::DOUBLE > r.cap THEN r.cap::DOUBLE
              ELSE r.weight::DOUBLE * (r.total - l.caps_before) / l.weights_left::DOUBLE END AS target
  FROM r, lvl l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS done
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + least(greatest(round(target - whole * source_size)::BIGINT - done, 0), size))::BIGINT AS taken
FROM p
"""
