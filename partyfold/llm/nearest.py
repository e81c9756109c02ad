"""Approximate nearest neighbours by NN-descent.

Equal vectors are one node. Random-projection trees, fitted on a bounded sample, deal all
nodes into leaves (a leaf that is too full is dealt on by a hash), and the nearest in each
leaf start the graph. NN-descent then joins neighbours of neighbours: every node meets its
neighbours and those that have it as a neighbour, all of them meet each other, and whoever is
nearer than a node's present list enters it; rounds go on until few lists change. A query
walks the graph greedily: of the best nodes found so far those not yet opened are opened,
their neighbours scored, and the best kept, until no better node turns up. Its last list is
scored on the original vectors in double precision, nodes opened up into their rows.

Scale: a node meets at most ``degree`` neighbours and as many reverse ones, so tasks get
bounded groups and a node that very many point to is no hot key (its reverse list is cut
by a ranking that limits before the shuffle). Graph building uses normalised half-precision
copies of the vectors. The sample for the trees is bounded by ``SAMPLE_FLOATS``; everything
else covers all rows. Rounds are stored.

Defined cases: rows whose id or vector is null, whose vector is zero, holds a null or a
non-finite number, or differs in length from most, take no part; rows equal in id and
vector count once; rows with equal ids and different vectors are separate candidates,
and a query row skips all rows of its own id; fewer candidates than k are all returned; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, picked, small_side, stored, table

#: Floats of the sample that the trees are fitted on, and the most rows of a leaf.
SAMPLE_FLOATS, LEAF = 2_000_000, 200


def _arrays(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors as float64, None for the others."""
    out: list[np.ndarray | None] = []
    for x in column:
        v = None
        if x.is_valid and x.values is not None and x.values.null_count == 0 and len(x.values):
            v = x.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            if not (np.isfinite(v).all() and v.any()):
                v = None
        out.append(v)
    return out


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, node, dim, exact, half) of the usable rows: exact holds the doubles, half the
    normalised half-precision copy, node a hash of the vector."""
    def make():
        def run(column):
            arrays = _arrays(column)
            half = [None if v is None else (v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())).astype(np.float16).tobytes() for v in arrays]
            return [pa.array([None if v is None else xxhash.xxh3_64_intdigest(v.tobytes()) - (1 << 63) for v in arrays], pa.int64()),
                    pa.array([None if v is None else len(v) for v in arrays], pa.int32()),
                    pa.array([None if v is None else v.tobytes() for v in arrays], pa.binary()), pa.array(half, pa.binary())]
        return run
    made = arrow_rows(rows.filter("vec_id is not null"), ["vec_id"], ["embedding"], "node long, dim int, exact binary, half binary", make)
    return made.filter("node is not null")


def _halves(column, dim: int) -> np.ndarray:
    """A binary column of half-precision vectors as a float32 matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, dim).astype(np.float32)


def _best(edges: DataFrame, k: int, by: str = "u", other: str = "v") -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("s"), other)
    return edges.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def _trees(nodes: DataFrame, dim: int, count: int, n_trees: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per tree (directions, medians): level by level, a random direction and, for every branch,
    the median of the sample's projections."""
    most = max(1, SAMPLE_FLOATS // dim)
    share = min(1.0, most / max(1, count))
    draw = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = nodes.filter(draw < share).select("half").toArrow()["half"]  # about `most` rows
    x = _halves(sample.combine_chunks() if sample.num_chunks != 1 else sample.chunk(0), dim) if len(sample) else np.zeros((0, dim), np.float32)
    rng = np.random.default_rng(seed)
    levels = 0
    while count >> (levels + 1) >= LEAF // 2 and len(x) >> (levels + 1) >= 4:
        levels += 1
    out = []
    for _ in range(n_trees):
        directions = rng.standard_normal((levels, dim)).astype(np.float32)
        medians = np.zeros((levels, 1 << levels), np.float32)
        at = np.zeros(len(x), np.int64)
        for level in range(levels):
            p = x @ directions[level]
            order = np.lexsort((p, at))
            starts = np.searchsorted(at[order], np.arange((1 << level) + 1))
            for b in range(1 << level):
                part = p[order[starts[b]:starts[b + 1]]]
                medians[level, b] = part[len(part) // 2] if len(part) else 0
            at = at * 2 + (p >= medians[level, at])
        out.append((directions, medians))
    return out


def _first_graph(nodes: DataFrame, dim: int, count: int, degree: int, n_trees: int, seed: int) -> DataFrame:
    """(u, v, s) from the leaves of the trees."""
    sent = nodes.sparkSession.sparkContext.broadcast(_trees(nodes, dim, count, n_trees, seed))

    def make():
        trees = sent.value

        def run(half):
            x = _halves(half, dim)
            leaves = np.zeros((len(x), len(trees)), np.int64)
            for t, (directions, medians) in enumerate(trees):
                at = np.zeros(len(x), np.int64)
                for level in range(len(directions)):
                    at = at * 2 + (x @ directions[level] >= medians[level, at])
                leaves[:, t] = at * len(trees) + t
            return [pa.array(list(leaves), pa.list_(pa.int64()))]
        return run

    placed = stored(arrow_rows(nodes, ["node", "half"], ["half"], "leaves array<long>", make)
                    .select("node", "half", F.explode("leaves").alias("leaf")), "leaves")
    sizes = placed.groupBy("leaf").count().select(F.col("leaf").alias("_leaf"), F.ceil(F.col("count") / LEAF).alias("parts"))
    dealt = (placed.join(small_side(sizes), F.col("leaf") == F.col("_leaf"))
             .withColumn("part", F.pmod(F.xxhash64("node", "leaf"), F.col("parts"))))

    def near(t: pa.Table) -> pa.Table:
        ids, x = t["node"].to_numpy(), _halves(t["half"], dim)
        k = min(degree, len(ids) - 1)
        if k < 1:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "s": pa.array([], pa.float32())})
        s = x @ x.T
        np.fill_diagonal(s, -2)
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        return pa.table({"u": np.repeat(ids, k), "v": ids[top].ravel(), "s": np.take_along_axis(s, top, 1).ravel()})

    return dealt.groupBy("leaf", "part").applyInArrow(lambda t: near(t), "u long, v long, s float")


def _meetings(graph: DataFrame, nodes: DataFrame, dim: int, degree: int, per_member: int) -> DataFrame:
    """Candidates (u, v, s) from the meetings around each node, where s beats u's present list."""
    worst = graph.groupBy(F.col("u").alias("node")).agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("n"))
    worst = worst.select("node", F.when(F.col("n") < degree, F.lit(-2.0)).otherwise(F.col("worst")).cast("float").alias("worst"))
    guests = nodes.join(worst, "node", "left").select("node", "half", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
    reverse = _best(graph, degree, "v", "u").select(F.col("v").alias("u"), F.col("u").alias("v"), "new")
    invited = (graph.select("u", "v", "new").union(reverse).groupBy("u", "v").agg(F.max("new").alias("new")))
    invited = invited.join(guests, F.col("v") == F.col("node")).select("u", F.struct("v", "new", "worst", "half").alias("g"))
    groups = invited.groupBy("u").agg(F.collect_list("g").alias("g")).select("g")  # at most 2 * degree each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            for first in range(0, len(lists), 500):
                part = lists.slice(first, 500)
                sizes = np.diff(part.offsets.to_numpy())
                flat = part.flatten()
                v, new, worst = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                x = _halves(flat.field(3), dim)
                width = int(sizes.max())
                row = np.repeat(np.arange(len(sizes)), sizes)
                col = np.arange(len(v)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                vec = np.zeros((len(sizes), width, dim), np.float32)
                vec[row, col] = x
                ids, fresh, bar = (np.zeros((len(sizes), width), a.dtype) for a in (v, new, worst))
                ids[row, col], fresh[row, col], bar[row, col] = v, new, worst
                there = np.zeros((len(sizes), width), bool)
                there[row, col] = True
                s = vec @ vec.transpose(0, 2, 1)
                ok = there[:, :, None] & there[:, None, :] & (fresh[:, :, None] | fresh[:, None, :]) & ~np.eye(width, dtype=bool) & (s > bar[:, :, None])
                s = np.where(ok, s, -3)
                k = min(per_member, width)
                top = np.argpartition(-s, k - 1, axis=2)[:, :, :k]
                best = np.take_along_axis(s, top, 2)
                g, i, j = np.nonzero(best > -3)
                yield pa.RecordBatch.from_arrays([pa.array(ids[g, i]), pa.array(ids[g, top[g, i, j]]), pa.array(best[g, i, j].astype(np.float32))], names=["u", "v", "s"])

    return groups.mapInArrow(run, "u long, v long, s float")


def neighbour_graph(nodes: DataFrame, dim: int, count: int, degree: int, n_trees: int, rounds: int,
                    settled: float, per_member: int, seed: int) -> DataFrame:
    """(u, v, s, new): the ``degree`` nearest found of every node (node, half)."""
    start = _first_graph(nodes, dim, count, degree, n_trees, seed).groupBy("u", "v").agg(F.max("s").alias("s"))
    graph = stored(_best(start, degree).withColumn("new", F.lit(True)), "graph")
    for _ in range(rounds):
        found = _meetings(graph, nodes, dim, degree, per_member).withColumn("new", F.lit(True))
        both = graph.withColumn("new", F.lit(False)).unionByName(found).groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
        graph = stored(_best(both, degree), "graph")
        changed = graph.agg(F.coalesce(F.avg(F.col("new").cast("int")), F.lit(0.0))).first()[0]
        if changed < settled:
            break
    return graph


def _scored(pairs: DataFrame, queries: DataFrame, nodes: DataFrame, dim: int) -> DataFrame:
    """(q, v, s) of pairs (q, v) by the half-precision copies."""
    with_query = pairs.join(small_side(queries.select("q", F.col("half").alias("x"))), "q")
    with_both = with_query.join(nodes.select(F.col("node").alias("v"), "half"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = (_halves(b.column(2), dim) * _halves(b.column(3), dim)).sum(axis=1) if len(b) else np.zeros(0, np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s.astype(np.float32))], names=["q", "v", "s"])
    return with_both.select("q", "v", "x", "half").mapInArrow(run, "q long, v long, s float")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, dim: int, degree: int, beam: int, opened: int, steps: int) -> DataFrame:
    """(q, v, s): the ``beam`` best nodes found for each query (q, half; q is a node). The walk
    starts at the query's own node."""
    # the walk goes along edges both ways, against their direction as often as `degree` at most
    reverse = _best(graph, degree, "v", "u").select(F.col("v").alias("_u"), F.col("u").alias("v"))
    links = stored(graph.select(F.col("u").alias("_u"), "v").union(reverse).distinct(), "links")
    entry = graph.join(queries.select(F.col("q").alias("u")), "u").select(F.col("u").alias("q"), "v", "s", F.lit(False).alias("open"))
    pool = stored(_best(entry, beam, "q"), "pool")
    for _ in range(steps):
        w = Window.partitionBy("q").orderBy(F.desc("s"), "v")
        closed = pool.filter("not open").withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= opened)
        closed = closed.select("q", F.col("v").alias("_from"))
        if closed.isEmpty():
            break
        step = closed.join(links, F.col("_from") == F.col("_u")).select("q", "v").distinct()
        step = step.filter("q != v").join(pool.select("q", "v"), ["q", "v"], "left_anti")
        found = _scored(step, queries, nodes, dim).withColumn("open", F.lit(False))
        known = (pool.join(closed.withColumnRenamed("_from", "v").withColumn("_now", F.lit(True)), ["q", "v"], "left")
                 .select("q", "v", "s", (F.col("open") | F.coalesce("_now", F.lit(False))).alias("open")))
        pool = stored(_best(known.unionByName(found), beam, "q"), "pool")
    return pool.select("q", "v", "s")


def nearest(rows: DataFrame, is_query: Column, k: int = 5, degree: int = 24, n_trees: int = 4, rounds: int = 6,
            settled: float = 0.02, per_member: int = 6, beam: int = 150, opened: int = 40, steps: int = 6,
            seed: int = 8) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row of ``rows`` (vec_id,
    embedding) where ``is_query`` holds, by cosine, ties to the smaller id."""
    usable = stored(vectors(rows), "vectors")
    dims = usable.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = dims.dim if dims else 1
    usable = usable.filter(F.col("dim") == dim).drop("dim")
    # of equal vectors only the k + 1 rows of least id can be among the k nearest of any query
    w = Window.partitionBy("node").orderBy("vec_id")
    members = usable.select("vec_id", "node", "exact").groupBy("node", "vec_id").agg(F.first("exact").alias("exact"))
    members = members.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k + 1)
    members = stored(members.drop("_r"), "members")
    nodes = stored(usable.select("node", "half").groupBy("node").agg(F.first("half").alias("half")), "nodes")
    graph = neighbour_graph(nodes, dim, nodes.count(), degree, n_trees, rounds, settled, per_member, seed)

    asked = usable.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("q"), "exact").dropDuplicates(["query_id", "q"])
    asked = stored(asked, "queries")
    starts = asked.select("q").distinct().join(nodes, F.col("q") == F.col("node")).select("q", "half")
    found = search(stored(starts, "query-nodes"), nodes, graph, dim, degree, beam, opened, steps)
    short = _best(found, 3 * k, "q").select("q", "v").union(asked.select("q", F.col("q").alias("v")).distinct())
    pairs = (short.join(asked, "q").join(members.select(F.col("node").alias("v"), "vec_id", F.col("exact").alias("other")), "v")
             .filter("vec_id != query_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x), np.frombuffer(y)
                score.append(float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    scored = pairs.select("query_id", "vec_id", "exact", "other").mapInArrow(run, f"query_id {id_type}, vec_id {id_type}, score double")
    scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = picked(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding")
    return nearest(rows, F.col("vec_id") % 50 == 0)
