"""Quality classifier by co-training of a text view and a metadata view.

The text view is a naive Bayes classifier of hashed words, word shapes and repetitions of the
word before, read over the whole text; its score is the mean log-odds per word. The metadata
view is a naive Bayes classifier of source, language, size and layout (characters, lines, line
length, bytes per character). Both start from the labelled rows. In each round each view
labels the unlabelled documents it is most sure of, out of all of them, for the other view to learn from; sure means
a calibrated probability of at least ``sure`` (Platt scaling on labelled rows kept out of
training), so a view without information hands nothing on. At the end a logistic
combination of the two calibrated views, fitted on the same kept-out rows, scores every
document of the table.

Fitting uses at most about ``per_class`` labelled rows of each class, drawn evenly by a hash of
the id; all other steps cover all rows. A round is one scan: every task scores its documents and
keeps the ``per_round`` surest of each view and class that the other view has not learned yet,
and the surest of these are taken. Counts are summed by Spark, and what reaches the driver is one
number per bucket and class, the scores of the kept-out rows and the keys of the chosen ones.

Defined cases: null and empty texts have text score 0 (no evidence); null metadata is a value
of its own; several labels of one id count by majority, a tie as good; when one class has no
labelled row there is nothing to learn: scores are null and every row is kept; rows with
equal ids are separate rows, but rows equal in all columns are chosen once; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, picked, pieces, small_side, stored, table

BUCKETS = 1 << 16
VIEWS = ("text", "meta")
FEATURES = "buckets array<int>, counts array<int>, meta array<int>"
#: Words whose weight a task remembers.
REMEMBERED = 500_000

_RUNS = re.compile(r"([a-zß-öø-ÿ]+)|([A-ZÀ-ÖØ-Þ]+)|([0-9]+)")


def bucket(kind: str, value: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}\0{value}".encode("utf-8", "surrogatepass")) % BUCKETS


def shape(word: str) -> str:
    """A word with its letter and digit runs reduced to one sign each."""
    return _RUNS.sub(lambda m: "x" if m[1] else "X" if m[2] else "9", word)[:8]


AGAIN, ANEW = bucket("repeat", "again"), bucket("repeat", "anew")


def text_buckets(text: str | None) -> tuple[list[int], list[int]]:
    """Buckets of a text's features and their counts."""
    words = text.split() if text else []
    counts: dict[int, int] = {}
    last = None
    for w in words:
        for b in (bucket("word", w.lower()), bucket("shape", shape(w)), AGAIN if w == last else ANEW):
            counts[b] = counts.get(b, 0) + 1
        last = w
    return list(counts), list(counts.values())


def meta_buckets(source, lang, n_chars, text: str | None) -> list[int]:
    size = lambda n: "null" if n is None else str(int(math.log2(n + 1) * 2)) if n >= 0 else "negative"
    text = text or ""
    lines = text.count("\n") + 1
    return [bucket("source", str(source)), bucket("lang", str(lang)), bucket("chars", size(n_chars)),
            bucket("lines", size(lines)), bucket("line length", size(len(text) // lines)),
            bucket("bytes", str(round(10 * len(text.encode("utf-8", "surrogatepass")) / max(1, len(text)))))]


class _Weights(dict):
    """Log-odds of a word: its own and its shape's."""

    def __init__(self, odds: np.ndarray):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        w = self[word] = float(self.odds[bucket("word", word.lower())] + self.odds[bucket("shape", shape(word))])
        return w


class Views:
    """Scores of both views for one task."""

    def __init__(self, text_odds: np.ndarray, meta_odds: np.ndarray):
        self.meta, self._weights = meta_odds, _Weights(text_odds)
        self._again, self._anew = float(text_odds[AGAIN]), float(text_odds[ANEW])

    def text_score(self, text: str | None) -> float:
        words = text.split() if text else []
        if not words:
            return 0.0
        again = sum(map(str.__eq__, words, words[1:]))
        total = sum(map(self._weights.__getitem__, words)) + again * self._again + (len(words) - again) * self._anew
        return total / len(words)

    def meta_score(self, *values) -> float:
        return float(self.meta[meta_buckets(*values)].sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (last: intercept) by Newton's method, with a small ridge on the slopes."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _sample(rows: DataFrame, labels: DataFrame, per_class: int, seed: int) -> DataFrame:
    """(y, kept_out, buckets, counts, meta) of the labelled sample."""
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    by_class = {r.y: r["count"] for r in labels.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, F.lit(min(1.0, per_class / max(1, by_class.get(1, 0))))).otherwise(
        F.lit(min(1.0, per_class / max(1, by_class.get(0, 0)))))
    known = labels.filter(draw < share).select(F.col("doc_id").alias("_id"), "y")  # about per_class rows each
    drawn = rows.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    drawn = drawn.withColumn("kept_out", F.pmod(F.xxhash64("doc_id", F.lit(seed + 2)), F.lit(4)) == 0)
    return stored(_features(drawn, ["y", "kept_out"]), "co-training")


def _odds(learned: DataFrame, pairs) -> np.ndarray:
    """Log-odds of every bucket from rows with a label."""
    sums = (learned.select("label", F.explode(pairs).alias("f"))
            .groupBy("label", F.col("f.b").alias("b")).agg(F.sum("f.c").cast("long").alias("n")).toArrow())
    counts = np.ones((2, BUCKETS))
    counts[sums["label"].to_numpy(), sums["b"].to_numpy()] += sums["n"].to_numpy()
    p = counts / counts.sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def _scores(sample: DataFrame, text_odds: np.ndarray, meta_odds: np.ndarray):
    """y and both scores of the sample (bounded) as numpy arrays."""
    sent = sample.sparkSession.sparkContext.broadcast((text_odds, meta_odds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text, of_meta = sent.value
        for b in batches:
            text, meta = [], []
            for x, c, m in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                text.append(float(of_text[x] @ np.array(c)) / (sum(c) / 3) if x else 0.0)
                meta.append(float(of_meta[m].sum()))
            yield pa.RecordBatch.from_arrays([b.column(3), pa.array(text, pa.float64()), pa.array(meta, pa.float64())], names=["y", "text", "meta"])
    t = sample.select("buckets", "counts", "meta", "y").mapInArrow(run, "y int, text double, meta double").toArrow()
    return [t[c].to_numpy() for c in ("y", "text", "meta")]


def surest(free: DataFrame, odds: dict[str, np.ndarray], platt: dict[str, np.ndarray], learned: dict[str, set[int]],
           per_round: int, sure: float) -> DataFrame:
    """(teacher, label, key, buckets, counts, meta): for each view and class the ``per_round`` rows of
    ``free`` that the view is surest of and the other view has not ``learned`` (keys)."""
    spark = free.sparkSession
    sent = spark.sparkContext.broadcast((odds, platt, learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, fits, known = sent.value
        views = Views(of["text"], of["meta"])
        best: dict[tuple[str, int], dict] = {(v, label): {} for v in VIEWS for label in (0, 1)}
        for b in pieces(batches):
            rows = list(zip(*(b.column(i).to_pylist() for i in range(5)), strict=True))
            scores = {"text": [views.text_score(r[1]) for r in rows], "meta": [views.meta_score(*r[2:], r[1]) for r in rows]}
            for view, other in (VIEWS, VIEWS[::-1]):
                p = probability(fits[view], np.array(scores[view], float)[:, None])
                for label, confidence in ((1, p), (0, 1 - p)):
                    top = best[view, label]
                    for i in np.flatnonzero(confidence >= sure).tolist():
                        if rows[i][0] not in known[other]:
                            top[rows[i][0]] = (-float(confidence[i]), rows[i][0])
                    if len(top) > per_round:
                        best[view, label] = {t[1]: t for t in heapq.nsmallest(per_round, top.values())}
        for (view, label), top in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([view] * len(top), pa.string()), pa.array([label] * len(top), pa.int32()), pa.array([-less for less, _ in top.values()], pa.float64()),
                 pa.array([key for _, key in top.values()], pa.int64())], names=["teacher", "label", "confidence", "key"])

    found = stored(free.select("key", "text", "source", "lang", "n_chars").mapInArrow(
        run, "teacher string, label int, confidence double, key long"), "co-training-surest")
    chosen = []
    for view in VIEWS:
        for label in (0, 1):
            one = found.filter((F.col("teacher") == view) & (F.col("label") == label)).groupBy("key").agg(F.max("confidence").alias("confidence"))
            chosen += [(view, label, r.key) for r in one.orderBy(F.desc("confidence"), "key").limit(per_round).collect()]
    taken = F.broadcast(spark.createDataFrame(chosen, "teacher string, label int, key long"))  # at most 4 x per_round
    # features of the chosen alone, from one more scan for their rows
    rows = free.join(taken.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    return stored(_features(rows, ["key"]).join(taken, "key"), "co-training-chosen")


def _features(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the features of both views."""
    ints = pa.list_(pa.int32())

    def make():
        def run(text, source, lang, n_chars):
            texts = text.to_pylist()
            counted = [text_buckets(t) for t in texts]
            meta = [meta_buckets(*v) for v in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist(), texts, strict=True)]
            return [pa.array([b for b, _ in counted], ints), pa.array([c for _, c in counted], ints), pa.array(meta, ints)]
        return run
    return arrow_rows(rows, keep, ["text", "source", "lang", "n_chars"], FEATURES, make)


def learn(rows: DataFrame, labels: DataFrame, per_class: int, rounds: int, per_round: int, sure: float, seed: int):
    """Text and metadata log-odds, their calibrations and the combination; None without two classes."""
    sample = _sample(rows, labels, per_class, seed)
    first = {(r.y, r.kept_out): r["count"] for r in sample.groupBy("y", "kept_out").count().collect()}
    if min(first.get((y, k), 0) for y in (0, 1) for k in (False, True)) == 0:
        return None
    free = rows.join(small_side(labels.select(F.col("doc_id").alias("_id"))), F.col("doc_id") == F.col("_id"), "left_anti").withColumn(
        "key", F.xxhash64("doc_id", "text", "source", "lang", "n_chars"))
    known = sample.filter("not kept_out").select(F.col("y").alias("label"), "buckets", "counts", "meta")
    learned = {view: known for view in VIEWS}
    keys: dict[str, set[int]] = {view: set() for view in VIEWS}
    pairs = {"text": F.transform(F.arrays_zip("buckets", "counts"), lambda z: F.struct(z["buckets"].alias("b"), z["counts"].alias("c"))),
             "meta": F.transform("meta", lambda b: F.struct(b.alias("b"), F.lit(1).alias("c")))}
    for turn in range(rounds + 1):
        odds = {view: _odds(learned[view], pairs[view]) for view in VIEWS}
        y, *both = _scores(sample.filter("kept_out"), odds["text"], odds["meta"])
        truth, scores = y.astype(float), dict(zip(VIEWS, both, strict=True))
        platt = {view: fit_logistic(s[:, None], truth) for view, s in scores.items()}
        if turn == rounds:
            break
        more = surest(free, odds, platt, keys, per_round, sure)
        for view, other in (VIEWS, VIEWS[::-1]):
            learned[other] = learned[other].unionByName(more.filter(F.col("teacher") == view).select(known.columns))
        for r in more.select("teacher", "key").collect():  # at most 4 x per_round
            keys[VIEWS[r.teacher == VIEWS[0]]].add(r.key)
    logits = np.column_stack([scores[v] * platt[v][0] + platt[v][1] for v in VIEWS])
    return odds["text"], odds["meta"], platt["text"], platt["meta"], fit_logistic(logits, truth)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 3000, rounds: int = 3,
             per_round: int = 300, sure: float = 0.97, threshold: float = 0.5, seed: int = 1, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars",
             label_col: str = "quality") -> DataFrame:
    """doc_id, text_score, meta_score (calibrated probabilities of good quality), score (their
    combination) and kept of every row of ``docs``; ``labels`` has the ids and 0/1 labels."""
    rows = picked(docs, doc_id=id_col, text=text_col, source=source_col, lang=lang_col, n_chars=chars_col)
    known = (picked(labels, doc_id=id_col, y=label_col).filter("doc_id is not null and y in (0, 1)")
             .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    model = learn(rows, known, per_class, rounds, per_round, sure, seed)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        views = Views(*sent.value[:2]) if sent.value else None

        def run(text, source, lang, n_chars):
            texts = text.to_pylist()
            if views is None:
                nothing = pa.nulls(len(texts), pa.float64())
                return [nothing, nothing, nothing, pa.array([True] * len(texts), pa.bool_())]
            of_text, of_meta, combined = sent.value[2:]
            a = np.array([views.text_score(t) for t in texts])
            b = np.array([views.meta_score(*v) for v in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist(), texts, strict=True)])
            score = probability(combined, np.column_stack([a * of_text[0] + of_text[1], b * of_meta[0] + of_meta[1]]))
            return [pa.array(probability(of_text, a[:, None])), pa.array(probability(of_meta, b[:, None])), pa.array(score), pa.array(score >= threshold)]
        return run
    return arrow_rows(rows, ["doc_id"], ["text", "source", "lang", "n_chars"], "text_score double, meta_score double, score double, kept boolean", make)


def query(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
