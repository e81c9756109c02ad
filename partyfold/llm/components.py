"""Connected components of links by alternating large and small stars.

Each step hangs the neighbours of a node on the smallest node among them, as one aggregate
(combined before the shuffle) and one join that AQE can split where a node has very many
links; a few rounds turn every component into a star around its smallest node. Rounds are
stored, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v): hang v (large: v > u only) on the least node around u."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = edges.join(least, F.col("u") == F.col("c"))
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.filter("c != m").select(F.col("c").alias("u"), F.col("m").alias("v"))
    return joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) that is not its component's least node,
    with that least node."""
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stored(_star(_star(both, True), False), "stars")
        new = _state(edges)
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
