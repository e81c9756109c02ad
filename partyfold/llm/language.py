"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams of one to three characters of the lower-cased text, with a line end before and
after it, fall into ``buckets`` by a fixed hash. Training counts them by language over at most
``sample`` rows of each language (a seeded hash of the id picks them, evenly over the
table), and what reaches the driver is one number per language and bucket. The
log-probability matrix is broadcast, and tasks score whole texts in numpy: gather the rows
of the matrix for all n-grams of a batch and add them up per text.

Defined cases: null text, text without any letter, and every text when no language was
learned get ``und`` with score 0; texts are read whole; a null id is neither held out nor
learned from; rows with equal ids are separate rows; an empty table gives an empty result;
equal scores go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, mapped, picked, pieces, table

ORDERS = (1, 2, 3)
UNDETERMINED = "und"
#: Characters that are scored at once, divided by the number of languages.
BLOCK = 4_000_000

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(f"\n{text.lower()}\n".encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashed(codes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    n = len(codes) - order + 1
    h = np.full(n, order * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
    for i in range(order):
        h = (h ^ codes[i:i + n]) * _FACTORS[i]
        h ^= h >> np.uint32(15)
    return h & np.uint32(buckets - 1)


def _blocks(texts: Iterator[tuple[int, np.ndarray]], size: int):
    """Groups of (row, codes, first, last): the n-grams that start in [first, last) of codes."""
    group, total = [], 0
    for row, codes in texts:
        for first in range(0, len(codes), size):
            last = min(len(codes), first + size)
            group.append((row, codes[first:last + ORDERS[-1] - 1], last - first))
            total += last - first
            if total >= size:
                yield group
                group, total = [], 0
    if group:
        yield group


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Scorer:
    def __init__(self, langs: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.langs, self.matrix, self.prior = langs, matrix, prior

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        totals = np.tile(self.prior, (len(texts), 1))
        rows = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        buckets = len(self.matrix)
        for group in _blocks(((i, _codes(texts[i])) for i in rows), max(1, BLOCK // max(1, len(self.langs)))):
            codes = np.concatenate([c for _, c, _ in group])
            starts = np.cumsum([0, *(len(c) for _, c, _ in group)])[:-1]
            lengths = np.array([len(c) for _, c, _ in group])
            wanted = np.array([w for _, _, w in group])
            owner = np.array([r for r, _, _ in group])
            for order in ORDERS:
                some = np.minimum(wanted, lengths - order + 1)
                ok = some > 0
                if not ok.any():
                    continue
                bounds = np.stack([starts[ok], starts[ok] + some[ok]], 1).ravel()
                hashed = _hashed(codes, order, buckets)
                picks = self.matrix[hashed]
                if bounds[-1] >= len(hashed):
                    bounds = bounds[:-1]
                np.add.at(totals, owner[ok], np.add.reduceat(picks, bounds, axis=0)[::2])
        lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for i in rows:
            t = totals[i]
            best = int(t.argmax())
            lang[i] = self.langs[best]
            score[i] = float(1 / np.exp(np.minimum(t - t[best], 0)).sum())
        return lang, score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(rows: DataFrame, sample: int, buckets: int, max_languages: int, smoothing: float, seed: int):
    """Languages, log-probability matrix (bucket by language) and log prior, from
    ``rows`` (doc_id, text, lang)."""
    known = rows.filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    langs = sorted(r.lang for r in sizes)
    if not langs:
        return [], np.zeros((buckets, 0)), np.zeros(0)
    share = {r.lang: min(1.0, sample / r["count"]) for r in sizes}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    picked_rows = known.filter(F.col("lang").isin(langs)).filter(draw < shares[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(langs), buckets), np.int64)
        for b in pieces(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = _codes(text)
                at = sums[langs.index(lang)]
                for order in ORDERS:
                    if len(codes) >= order:
                        at += np.bincount(_hashed(codes, order, buckets), minlength=buckets)
        of, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(sums[of, bucket])], names=["lang", "bucket", "n"])

    sums = (mapped(picked_rows, count, "lang int, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())  # at most languages x buckets
    counts = np.zeros((buckets, len(langs)))
    counts[sums["bucket"].to_numpy(), sums["lang"].to_numpy()] = sums["n"].to_numpy()
    matrix = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * buckets)
    of = {r.lang: r["count"] for r in sizes}
    prior = np.log(np.array([of[x] for x in langs], float) / sum(of.values()))
    return langs, np.ascontiguousarray(matrix), prior


def identify(docs: DataFrame, keep: list[str] | None = None, training: Column | None = None, sample: int = 4000,
             buckets: int = 1 << 15, max_languages: int = 64, smoothing: float = 0.5, seed: int = 9,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``keep`` columns of ``docs`` (its id alone by default) with ``lang_pred`` and ``score``.
    Learns from the rows where ``training`` (a condition on doc_id) holds, at most about
    ``sample`` rows a language."""
    rows = picked(docs, doc_id=id_col, text=text_col, lang=lang_col)
    model = train(rows.filter(training) if training is not None else rows, sample, buckets, max_languages, smoothing, seed)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(*sent.value)

        def run(text):
            lang, score = scorer.score(text.to_pylist())
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return run
    return arrow_rows(docs, keep or [id_col], [text_col], "lang_pred string, score double", make)


def recognised(docs: DataFrame, min_score: float = 0.5, sample: int = 4000, buckets: int = 1 << 15, max_languages: int = 64,
               smoothing: float = 0.5, seed: int = 9, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is determined with a score of at least ``min_score``;
    a null language is filled in. Learns from the rows that have one."""
    rows = picked(docs, doc_id=id_col, text=text_col, lang=lang_col).filter("doc_id is not null")
    model = train(rows, sample, buckets, max_languages, smoothing, seed)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for b in pieces(batches):
            lang, score = scorer.score(b.column(names.index(text_col)).to_pylist())
            given = b.column(names.index(lang_col)).to_pylist()
            filled = pa.array([g if g is not None else x for g, x in zip(given, lang, strict=True)], pa.string())
            columns = [filled if c == lang_col else b.column(i) for i, c in enumerate(names)]
            keep = [x != UNDETERMINED and s >= min_score for x, s in zip(lang, score, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return mapped(docs, run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = picked(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    learn = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()
    return identify(docs, training=learn).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
