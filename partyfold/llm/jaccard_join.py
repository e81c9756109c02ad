"""N-gram Jaccard join: size-aware, light sets by subsets, heavy sets by inverted lists.

A document's set holds the hashes of its distinct word n-grams; documents with equal sets are
one class (128 bits of the sorted set), and classes are the nodes. Two sets link
when intersection / union >= num / den, that is when they share at least
``tau = ceil(num * (|x| + |y|) / (num + den))`` n-grams.

Light sets (size <= boundary) list every subset they can keep after as many deletions as the
threshold allows; equal subsets of two sets are the overlap itself. Heavy sets, and light
ones within reach of a heavy partner, are found through inverted lists of their first
``|x| - ceil(num / den |x|) + 1`` n-grams in one global order (n-grams that blocks of texts
report as frequent come last, by the power of two of their count), where linked sets must meet. Bounds from sizes, places in
the order and the number of shared n-grams drop pairs that cannot link before any set is
fetched. The boundary is the size at which listing subsets, summed over the size histogram,
costs as much as posting and scanning lists.

No list is expanded into all pairs. Round one pairs each member of a list with one hub, the
member with the fewest rare n-grams in its prefix (the same for all lists of a family of
copies, and the one nearest to all of them); the pairs are verified on full sets and give
components. Round two takes the lists that still hold several components besides the hub's pairs
(so three classes or more) and pairs only members of different components, so what copies have in
common is compared once. Every pair that can link is in one component already, was judged with
its hub, or is verified, so no link is lost.

Scale: texts are hashed in tasks (three scans, the last one only for candidates); prefixes
are stored once, and what is shuffled is the prefix postings (n-gram, row and place; the
digests of classes only for lists of two rows or more), the pairs and the candidates' sets.
The postings are dealt out in ``PARTS`` turns by n-gram, so that disk holds one part of that shuffle.
Lists of frequent n-grams (a bounded table) get their hub by an aggregate that
combines before the shuffle and a broadcast of at most that table; their members that are copies
are listed once per task. Joins can be split by AQE. Nothing that grows with the corpus
reaches the driver.

Defined cases: null, empty and word-free texts have size 0 and link with nothing (their
component is their own id); fewer words than n are one n-gram; rows with equal ids are separate
rows; rows without an id take the least id of their component, or null; an empty table
gives an empty result. Hashes of n-grams have 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, free_names, mapped, picked, pieces, small_side, stored, stored_in_turn, table, utf8
from .components import components

#: Words whose hash a task remembers, n-grams in a block that counts them, how often a block
#: must hold one to report it, and how many reported ones are ordered last.
REMEMBERED, BLOCK, FREQUENT, LAST = 100_000, 2_000_000, 2, 200_000
#: What a set in a block takes besides its n-grams, in n-grams.
OBJECT = 32
#: Largest size whose subsets may be listed, and what scanning a posting costs against
#: writing one key.
MOST_LIGHT, SCAN_COST = 24, 4
#: Parts of the n-grams whose postings are shuffled one after another.
PARTS = 4

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sets of n-gram hashes (sorted, distinct, unsigned 64-bit)."""

    def __init__(self, n: int):
        self.n, self._hash = n, _WordHashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self._hash.__getitem__, words), np.uint64, len(words))
        if len(words) < self.n:
            return _mixed((h * np.resize(_ODD, len(h))).sum(keepdims=True) + np.uint64(len(h)))
        total = np.zeros(len(h) - self.n + 1, np.uint64)
        for i in range(self.n):
            total += h[i:i + len(total)] * _ODD[i % len(_ODD)] + np.uint64(i // len(_ODD))
        return np.unique(_mixed(total))


def class_of(grams: np.ndarray) -> bytes:
    """128 bits of a set."""
    return xxhash.xxh3_128_digest(grams.tobytes())


def _digests(rows: DataFrame, n: int) -> DataFrame:
    """For every row: doc_id, its class (node) and size n; for every n-gram frequent in a
    block: gram and its count n, without a node."""
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("node", T.BinaryType()),
                           T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        block, size, seen = [], 0, set()
        ids_type = None

        def frequent():
            grams, counts = np.unique(np.concatenate(block), return_counts=True)
            often = counts >= FREQUENT
            grams, counts = grams[often].view(np.int64), counts[often]
            return pa.RecordBatch.from_arrays([pa.nulls(len(grams), ids_type), pa.nulls(len(grams), pa.binary()),
                                               pa.array(grams), pa.array(counts)], names=schema.names)

        for b in pieces(batches):
            ids_type = b.column(0).type
            nodes, sizes = [], []
            for text in utf8(b.column(1)):
                grams = shingle(text)
                node = class_of(grams)
                nodes.append(node)
                sizes.append(len(grams))
                if len(grams) and node not in seen:
                    seen.add(node)
                    block.append(grams)
                    size += len(grams) + OBJECT
                    if size >= BLOCK:
                        yield frequent()
                        block, size, seen = [], 0, set()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.binary()), pa.nulls(len(nodes), pa.int64()),
                                              pa.array(sizes, pa.int64())], names=schema.names)
        if block:
            yield frequent()

    return mapped(rows.select("doc_id", "text"), run, schema)


def deletions(size: int, num: int, den: int) -> int:
    """How many of its n-grams a set can lack in a linked partner."""
    return size - -(-num * size // den)


def boundary(histogram: dict[int, int], num: int, den: int) -> int:
    """Largest size up to which listing subsets costs no more than posting and scanning."""
    best, subsets, lists = 0, 0, 0
    for s in range(1, MOST_LIGHT + 1):
        k = deletions(s, num, den)
        subsets += histogram.get(s, 0) * sum(math.comb(s, a) for a in range(k + 1))
        lists += histogram.get(s, 0) * (k + 1) * SCAN_COST
        if subsets <= lists:
            best = s
    return best


def _prefixes(rows: DataFrame, n: int, num: int, den: int, light: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Prefixes (row, node, n, grams, places, rare): n-grams with their place, and subsets with place =
    -their size. row is the number of the stored row; a class has one for each task that met it."""
    sent = rows.sparkSession.sparkContext.broadcast(frequent)
    reach = -(-num * (light + 1) // den)

    def make():
        shingle, (often, level) = Shingler(n), sent.value
        listed: set[bytes] = set()

        def keys(grams: np.ndarray):
            s = len(grams)
            places, out, n_rare = [], [], 0
            if s > light or s >= reach:
                at = np.searchsorted(often, grams)
                common = often[np.minimum(at, len(often) - 1)] == grams if len(often) else np.zeros(s, bool)
                first = deletions(s, num, den) + 1
                rare = grams[~common][:first]
                n_rare = len(rare)
                rest = np.nonzero(common)[0]
                rest = rest[np.lexsort((grams[rest], level[at[rest]]))][:first - n_rare] if len(rest) else rest
                ordered = np.concatenate([rare, grams[rest]])
                out.append(ordered)
                places.append(np.arange(len(ordered)))
            if s <= light:
                mixed = _mixed(grams)
                total = mixed.sum(keepdims=True)
                for a in range(deletions(s, num, den) + 1):
                    lost = np.array([mixed[list(c)].sum() for c in combinations(range(s), a)], np.uint64) if a else np.zeros(1, np.uint64)
                    out.append(_mixed(total - lost + np.uint64(s - a)))
                    places.append(np.full(len(lost), a - s))
            return np.concatenate(out).view(np.int64), np.concatenate(places), n_rare

        def run(text):
            nodes, sizes, grams_of, places_of, rare_of = [], [], [], [], []
            for t in utf8(text):
                grams = shingle(t)
                node = class_of(grams)
                new = len(grams) > 0 and node not in listed
                if new:
                    if len(listed) > REMEMBERED:
                        listed.clear()
                    listed.add(node)
                g, p, r = keys(grams) if new else (np.zeros(0, np.int64), np.zeros(0, np.int64), 0)
                for to, x in ((nodes, node), (sizes, len(grams)), (grams_of, g), (places_of, p), (rare_of, r)):
                    to.append(x)

            def lists(parts, kind):
                offsets = np.cumsum([0, *map(len, parts)])
                return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(kind)))
            return [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                    lists(grams_of, np.int64), lists(places_of, np.int32), pa.array(rare_of, pa.int32())]
        return run

    found = arrow_rows(rows, [], ["text"], "node binary, n int, grams array<long>, places array<int>, rare int", make)
    return stored(found.filter(F.size("grams") > 0).withColumn("row", F.monotonically_increasing_id()), "prefixes")


def _tau(na: Column, nb: Column, num: int, den: int) -> Column:
    return F.ceil(num * (na + nb) / float(num + den)).cast("int")


def _meetings(rows: DataFrame, num: int, den: int, a: str, b: str) -> DataFrame:
    """(a, b, proved) of joined postings that may link by size and by their places in the order:
    the bound is exact at the first n-gram two sets share. A shared subset proves the link."""
    na, nb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "place") for x in (a, b))
    tau = _tau(na, nb, num, den)
    near = F.when(pa_ < 0, -pa_ >= tau).otherwise(F.least(na - pa_, nb - pb) >= tau)
    fits = F.least(na, nb) * den >= F.greatest(na, nb) * num
    left, right = F.col(f"{a}.node"), F.col(f"{b}.node")
    met = rows.filter(fits & near).select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"), (pa_ < 0).alias("proved"))
    return met.groupBy("a", "b").agg(F.max("proved").alias("proved"))


def _plausible(pairs: DataFrame, prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose prefixes share enough: sets with an overlap of tau or more share at least
    c of their first |x| - tau + c and |y| - tau + c n-grams, here for the largest c that both
    prefixes allow. Prefixes are a small part of the sets, which only these pairs fetch."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    own = (prefixes.join(small_side(wanted), "node", "left_semi").groupBy("node")
           .agg(F.first("n").alias("n"), F.first("grams").alias("grams")))
    both = (pairs.join(own.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("x")), "a")
            .join(own.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("y")), "b"))
    na, nb = F.col("na"), F.col("nb")
    tau = _tau(na, nb, num, den)
    spare = lambda n: tau - F.ceil(num * n / float(den)).cast("int") + 1
    c = F.greatest(F.least(spare(na), spare(nb)), F.lit(1))
    shared = F.size(F.array_intersect(F.slice("x", F.lit(1), F.greatest(na - tau + c, F.lit(0))),
                                      F.slice("y", F.lit(1), F.greatest(nb - tau + c, F.lit(0)))))
    return both.filter(F.col("proved") | (shared >= c)).select("a", "b")


def _classes(prefixes: DataFrame, light: int) -> DataFrame:
    """(row, node, n, central) of one row of each class. central counts the rare n-grams of a heavy set's prefix."""
    own = prefixes.groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("rare").alias("rare"))
    return own.select("row", "node", "n", F.when(F.col("n") > light, F.col("rare")).otherwise(F.lit(0)).alias("central"))


def _with_hub(prefixes: DataFrame, light: int, own: DataFrame | None = None, part: int | None = None) -> DataFrame:
    """Postings (gram, node, n, place, central, often, more) of lists with two classes or more, with the hub
    of their list; more is false where two are all. own are the ``_classes``; a part has the n-grams of one
    remainder by ``PARTS``.

    Most n-grams stand in one prefix only. To find those, the numbers of rows are dealt out, which
    take a few bytes however many partitions there are; the digests and counts of classes
    follow for the lists of two rows or more, from one row of each class."""
    own = _classes(prefixes, light) if own is None else own
    entries = (prefixes.select("row", "node", "n", "rare", F.explode(F.arrays_zip("grams", "places")).alias("g"))
               .select(F.col("g.grams").alias("gram"), "row", "node", "n", "rare", F.col("g.places").alias("place")))
    if part is not None:
        entries = entries.filter(F.pmod("gram", F.lit(PARTS)) == part)
    w = Window.partitionBy("gram")
    met = (entries.filter("place < rare").select("gram", "row", "place")
           .withColumns({"least": F.min("row").over(w), "most": F.max("row").over(w)})
           .filter("least != most").select("gram", "row", "place"))
    member = F.struct("central", "n", "node", "place")
    # dealt out before the window, which would make its struct first and send both
    rare = (met.join(own, "row").select("gram", "node", "n", "place", "central", F.lit(False).alias("often")).repartition("gram")
            .withColumns({"hub": F.min(member).over(w), "least": F.min("node").over(w), "most": F.max("node").over(w),
                          "more": F.count(F.lit(1)).over(w) > 2})
            .filter("least != most").drop("least", "most"))
    often = (entries.filter("place >= rare")
             .select("gram", "node", "n", "place", F.when(F.col("n") > light, F.col("rare")).otherwise(F.lit(0)).alias("central"),
                     F.lit(True).alias("often")))
    hubs = (often.groupBy(F.col("gram").alias("_gram"))
            .agg(F.min(member).alias("hub"), F.min("node").alias("least"), F.max("node").alias("most"))
            .filter("least != most").select("_gram", "hub"))
    # at most LAST rows: the table of frequent n-grams is that long
    often = often.join(F.broadcast(hubs), F.col("gram") == F.col("_gram")).drop("_gram").withColumn("more", F.lit(True))
    return rare.unionByName(often).select("gram", "node", "n", "place", "central", "often", "more", "hub")


def _still_mixed(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings (gram, node, n, place, root, hub_root) of the lists that hold several components besides
    their hub, without the hub: round one has judged its pairs, by the same sizes and places."""
    members = (lists.filter("more and place >= 0")
               .select("gram", "node", "n", "place", "often", (F.col("node") == F.col("hub.node")).alias("is_hub"))
               .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    root, other = F.when(F.col("is_hub"), F.col("root")), F.when(~F.col("is_hub"), F.col("root"))
    found = {"hub_root": F.max(root), "least": F.min(other), "most": F.max(other)}
    w = Window.partitionBy("gram")
    rare = members.filter("not often").withColumns({k: c.over(w) for k, c in found.items()}).filter("least != most")
    often = members.filter("often")
    hubs = often.groupBy(F.col("gram").alias("_gram")).agg(*[c.alias(k) for k, c in found.items()]).filter("least != most")
    # at most LAST rows, as above
    often = often.join(F.broadcast(hubs), F.col("gram") == F.col("_gram"))
    wanted = ["gram", "node", "n", "place", "root", "hub_root"]
    return rare.filter("not is_hub").select(*wanted).union(often.filter("not is_hub").select(*wanted))


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that link, by their full sets."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(wanted.join(classes, "node").select("node", "least_id"), "candidates")
    ids = wanted.select(F.col("least_id").alias("_id")).distinct()
    ids = small_side(ids)
    texts = rows.join(ids, rows["doc_id"].eqNullSafe(F.col("_id")), "left_semi")

    def make():
        shingle = Shingler(n)

        def run(text):
            sets = [shingle(t) for t in utf8(text)]
            return [pa.array([class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        return run

    sets = arrow_rows(texts, [], ["text"], "node binary, grams binary", make)
    sets = sets.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared * den >= num * (len(x) + len(y) - shared))
            kept = b.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return mapped(both.select("a", "b", "x", "y"), check, "a binary, b binary")


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links), n_links (verified links of
    its class), class_id (equal sets) and group_id (the component's first class) of every row."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    digests = stored(_digests(rows, n), "jaccard-digests")
    own = digests.filter("node is not null").select("doc_id", "n", "node")
    sized = own.filter("n > 0")
    histogram = {r.n: r["count"] for r in sized.filter(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()}
    light = boundary(histogram, num, den)
    last = (digests.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "gram").limit(LAST).toArrow())
    grams, counts = last["gram"].to_numpy().view(np.uint64), last["n"].to_numpy()
    by_gram = np.argsort(grams)
    frequent = grams[by_gram], np.log2(np.maximum(counts, 1)).astype(np.int8)[by_gram]
    classes = sized.groupBy("node").agg(F.min("doc_id").alias("least_id"))

    prefixes = _prefixes(rows, n, num, den, light, frequent)
    numbered = stored(_classes(prefixes, light), "classes")
    lists = stored_in_turn([_with_hub(prefixes, light, numbered, part) for part in range(PARTS)], "lists")

    with_hubs = lists.filter("node != hub.node").select(F.struct("n", "place", "node").alias("x"), "hub")
    stars = stored(_meetings(with_hubs, num, den, "x", "hub"), "stars")
    plausible = stored(_plausible(stars, prefixes, num, den), "pairs-1")
    links = stored(_verified(plausible, rows, classes, n, num, den), "links-1")
    roots = components(links)

    mixed = stored(_still_mixed(lists, roots), "mixed-lists")
    x, y = mixed.filter("not root <=> hub_root").alias("x"), mixed.alias("y")
    # two rows of different components that both differ from the hub's meet from both sides: once is enough
    both = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root"))
                  & ((F.col("y.root") == F.col("y.hub_root")) | (F.col("x.node") < F.col("y.node"))))
    crossing = _meetings(both, num, den, "x", "y").join(stars.select("a", "b"), ["a", "b"], "left_anti")
    crossing = stored(_plausible(crossing, prefixes, num, den), "pairs-2")
    more = stored(_verified(crossing, rows, classes, n, num, den), "links-2")
    if not more.isEmpty():
        links = links.union(more)
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    degrees = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    placed = (classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = (roots.select("node", "root").union(roots.select(F.col("root").alias("node"), "root").distinct())
              .join(least, "root").join(degrees, "node", "left").select("node", "root", "component_id", "n_links"))
    # classes without links keep their least id; linked ones take that of their component
    final = (classes.join(linked, "node", "left")
             .select("node", F.coalesce("root", "node").alias("group_id"), F.coalesce("component_id", "least_id").alias("component_id"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return (own.join(final, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.col("node").alias("class_id"), "group_id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the row of its least id. Rows without words
    stay. Of rows that share an id (or have none) one of each component's stays, so equal rows become one."""
    joined = stored(join(docs, n, num, den, id_col, text_col), "components")
    odd_id, lost_id, class_id, own_id, node, empty = free_names(
        docs, "jj_odd", "jj_lost", "jj_class", "jj_id", "jj_node", "jj_empty")
    odd = joined.groupBy("doc_id").count().filter("doc_id is null or count > 1").select(F.col("doc_id").alias(odd_id))
    odd = stored(odd, "odd-ids")
    lost = joined.filter("n_shingles > 0 and doc_id != component_id").select(F.col("doc_id").alias(lost_id)).distinct()
    lost = stored(lost.join(odd, F.col(lost_id) == F.col(odd_id), "left_anti"), "lost-ids")
    some_odd = not odd.isEmpty()
    plain = docs.join(small_side(odd), docs[id_col].eqNullSafe(F.col(odd_id)), "left_anti") if some_odd else docs
    kept = plain.join(small_side(lost), plain[id_col] == F.col(lost_id), "left_anti")
    if not some_odd:
        return kept
    chosen = (joined.filter("n_shingles > 0 and doc_id <=> component_id").groupBy("group_id", "doc_id")
              .agg(F.min("class_id").alias(class_id)).select(F.col("doc_id").alias(own_id), class_id))

    def make():
        shingle = Shingler(n)

        def run(text):
            sets = [shingle(t) for t in utf8(text)]
            return [pa.array([class_of(s) for s in sets], pa.binary()), pa.array([len(s) == 0 for s in sets], pa.bool_())]
        return run
    extra = docs.join(small_side(odd), docs[id_col].eqNullSafe(F.col(odd_id)), "left_semi")
    keyed = arrow_rows(extra, docs.columns, [text_col], f"{node} binary, {empty} boolean", make)
    same = keyed[id_col].eqNullSafe(F.col(own_id)) & (F.col(node) == F.col(class_id))
    first = keyed.filter(~F.col(empty)).join(chosen, same, "left_semi").dropDuplicates([id_col, node])
    return kept.unionByName(keyed.filter(empty).select(*docs.columns)).unionByName(first.select(*docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


#: For DuckDB: all pairs that share an n-gram, then the least id reachable.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] FOR i IN range(1, len(ws) - 2)] END) AS sh FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles, md5(array_to_string(list_sort(sh), chr(10))) AS class FROM s),
c AS (SELECT class, any_value(n_shingles) AS n, min(doc_id) AS id FROM n WHERE n_shingles > 0 GROUP BY class),
t AS (SELECT c.id, c.n, unnest(s.sh) AS g FROM c JOIN s ON s.doc_id = c.id),
p AS (SELECT a.id AS x, b.id AS y FROM t a JOIN t b ON a.g = b.g AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT id, id AS reached FROM c UNION SELECT r.id, e.y FROM r JOIN e ON e.x = r.reached),
m AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id)
SELECT n.doc_id, n.n_shingles, coalesce(m.component_id, n.doc_id) AS component_id
FROM n LEFT JOIN c ON n.class = c.class AND n.n_shingles > 0 LEFT JOIN m ON m.id = c.id
"""
