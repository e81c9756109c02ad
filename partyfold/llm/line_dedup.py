"""Substring dedup by hashed lines and their pieces.

Units are the lines of a text and, so that a passage put into the middle of a line is found
too, the pieces that a long line falls into. A line is cut where a sentence starts (after a word
that ends with . ! or ?, and at a capitalised word) and, inside sentences of more than ``LONGEST``
words, at the words whose hash is the least among their ``REACH`` neighbours on either side. Both
kinds of cut depend on the words around them alone, so a repeated passage falls into the same
pieces wherever it stands, but for a few words at its ends; pieces do not overlap. Neighbouring
pieces of a text that all repeat are one span, which goes if it has ``min_words`` words or more.
Where a line has few blanks (Chinese, Thai, encoded data) its characters are the words, and a
minimum of one word stands for ``CHARS_A_WORD`` characters. Units are normalised (lower case, single
spaces) and hashed to 96 bits.

Digests are grouped over the corpus. The occurrence in the document of least id is kept, and
in it the first; every other occurrence is cut out, with its span in the original
text (code points, end exclusive) kept in the result. Lines of fewer than ``min_line_words``
words, and shorter spans inside lines than ``min_words``, are never cut. Every word that goes stands in an earlier
occurrence, so of a text that repeats itself one period stays.

Scale: one scan makes the units; the least id of a digest is an aggregate of two numbers that
combines before the shuffle, and the join that tells each occurrence its digest's
keeper has one row per repeated digest on one side, so AQE can split a digest that a third
of all documents hold. Spans come back to texts by a shuffled join on id, at any size.

Defined cases: null text stays null, without spans; empty texts stay empty; texts are read
whole; rows with equal ids but different texts are one document to the order (neither is cut for
the other's sake), and equal rows get equal results; rows without an id come last and
are not cut for each other's sake; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, arrow_rows, picked, stored, table

ODD_BLANK = re.compile("[\t\r\v\f]|  |^ | $").search
WORD = re.compile("[^\x20\t-\r]+")
#: Words of a sentence that is not cut, and neighbours on either side that a cut inside one is chosen from.
LONGEST, REACH = 20, 5
#: Words whose hash a task remembers.
REMEMBERED = 500_000
# Scripts written without blanks (Thai to Tibetan, Burmese, Khmer, kana and Han), their
# ends of sentences, the mean length of a word from which a line counts as one of few blanks, and the
# characters that stand for a word in these scripts and in others.
UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
FULL_STOPS = "\u3002\uff01\uff1f\uff0e.!?"
MEAN_CHARS = 20
CHARS_A_WORD = (2, 6)

_FACTOR, _MOST = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << 64) - 1)


def _words(line: str) -> tuple[list[str], list[int], list[int]]:
    """Words of a line, where they start and where they end."""
    if ODD_BLANK(line):
        found = [(m[0], m.start(), m.end()) for m in WORD.finditer(line)]
        return [w for w, _, _ in found], [s for _, s, _ in found], [e for _, _, e in found]
    words = line.split(" ")
    ends = [n + i for i, n in enumerate(accumulate(map(len, words)))]
    return words, [e - len(w) for e, w in zip(ends, words, strict=True)], ends


def _dense(line: str, words: list[str]) -> int:
    """Characters that stand for a word in a line with few blanks; 0: its words are words."""
    chars = sum(map(len, words))
    if not line.isascii() and 2 * len(UNSPACED.findall(line)) > chars:
        return CHARS_A_WORD[0]
    return CHARS_A_WORD[1] if chars > MEAN_CHARS * len(words) else 0


class _Hashes(dict):
    """Hash of a word in lower case."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return h


_hashes = _Hashes()


def sentences_of(words: list[str], dense: int) -> list[int]:
    """Where the sentences of a line start, and its end."""
    n = len(words)
    if dense:
        return [0, *(i for i in range(1, n) if words[i - 1] in FULL_STOPS and words[i] not in FULL_STOPS), n]
    return [0, *(i for i in range(1, n) if words[i - 1][-1] in ".!?" or (words[i][0].isupper() and not words[i][1:2].isupper())), n]


def least_words(lines: list[list[str]], reach: int) -> list[np.ndarray]:
    """For each line the words (never the first) whose hash, taken with the word before, is the first
    least of ``reach`` neighbours on either side, all lines at once."""
    sizes = np.array([len(words) for words in lines])
    ends = np.cumsum(sizes)
    firsts = ends - sizes
    h = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(lines)), np.uint64, ends[-1])
    h = h * _FACTOR + np.roll(h, 1)
    h = (h ^ (h >> np.uint64(29))) * _FACTOR
    h[firsts] = _MOST
    # lines stand apart by as many greatest values as a neighbourhood has
    at = np.arange(len(h)) + np.repeat(reach * np.arange(len(lines)), sizes)
    apart = np.full(at[-1] + 2 * reach + 1, _MOST)
    apart[at + reach] = h
    around = np.lib.stride_tricks.sliding_window_view(apart, 2 * reach + 1)[at]
    chosen = np.flatnonzero((around.argmin(axis=1) == reach) & (h != _MOST))
    bounds = np.searchsorted(chosen, ends)
    return [chosen[a:b] - first for a, b, first in zip([0, *bounds], bounds, firsts)]


def units(text: str, min_line_words: int) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, words, normalised text) of every unit, in order: each line that has words and is long
    enough to go by itself, and the pieces of lines that fall into more than one. Words are counted as
    the minimums count them; for a line they have the sign minus."""
    at, lines = 0, []
    long: dict[int, list[int]] = {}
    for line in text.split("\n"):
        if line.strip(BLANKS):
            words, starts, ends = _words(line)
            dense = _dense(line, words)
            if dense:
                starts = [i for s, e in zip(starts, ends, strict=True) for i in range(s, e)]
                ends = [i + 1 for i in starts]
                words = [line[i] for i in starts]
            cuts = sentences_of(words, dense)
            if len(words) > LONGEST and any(b - a > LONGEST * (dense or 1) for a, b in pairwise(cuts)):
                long.setdefault(dense, []).append(len(lines))
            lines.append([at, words, starts, ends, dense, cuts])
        at += len(line) + 1
    for dense, which in long.items():
        scale = dense or 1
        for i, chosen in zip(which, least_words([lines[i][1] for i in which], REACH * scale), strict=True):
            cuts = lines[i][5]
            more = [chosen[np.searchsorted(chosen, a + 1):np.searchsorted(chosen, b)].tolist() if b - a > LONGEST * scale else []
                    for a, b in pairwise(cuts)]
            lines[i][5] = [x for a, own in zip(cuts, [*more, []]) for x in (a, *own)]
    for at, words, starts, ends, dense, cuts in lines:
        n, scale, blank = len(words), dense or 1, "" if dense else " "
        if n >= min_line_words * scale or len(cuts) == 2:
            yield at + starts[0], at + ends[-1], -(n // scale), blank.join(words).lower()
        if len(cuts) > 2:
            for a, b in pairwise(cuts):
                yield at + starts[a], at + ends[b - 1], (b - a) // scale, blank.join(words[a:b]).lower()


def spans_to_cut(found: list[tuple[int, int, int]], text: str, min_words: int, min_line_words: int) -> list[tuple[int, int]]:
    """Repeated units (start, end, words) as the spans that go: whole lines of ``min_line_words`` words, and
    neighbouring units, across blanks and line breaks, of ``min_words`` words together."""
    runs: list[list[int]] = []
    covered = -1
    for start, end, words in sorted(found, key=lambda u: (u[0], -u[1])):
        if end <= covered:
            continue                      # a piece of a line that goes as a whole
        covered = end
        whole = words < 0 and -words >= min_line_words
        if runs and not text[runs[-1][1]:start].strip(BLANKS + "\n"):
            runs[-1][1], runs[-1][2] = end, runs[-1][2] + abs(words)
            runs[-1][3].append((start, end, whole))
        else:
            runs.append([start, end, abs(words), [(start, end, whole)]])
    out = []
    for start, end, words, parts in runs:
        if words >= min_words:
            out.append((start, end))
        else:
            out += [(s, e) for s, e, whole in parts if whole]
    return out


def _texts_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) & 0xFFFFFFFF


def packed(start: int, end: int, words: int) -> int:
    return start << 35 | (end - start) << 9 | (256 if words < 0 else 0) | min(abs(words), 255)


def unpacked(span: int) -> tuple[int, int, int]:
    start, words = span >> 35, span & 255
    return start, start + (span >> 9 & 0x3FFFFFF), -words if span & 256 else words


def text_units(rows: DataFrame, min_line_words: int) -> DataFrame:
    """(doc_id, h1, h2, again, span): units of all texts. h2 holds the last 32 bits of the
    digest above 32 bits of the text's own hash; span holds the start (28 bits), the length in characters
    (26) and the words (8 and a sign; more count as the most); again marks occurrences after the first
    in one text. Units are read twice, by the digests' groups and by the join, and making them costs far more
    than storing them: they are stored, as arrays of a text (its hash stands there once)."""
    def make():
        def run(text):
            key_of, h1_of, d_of, again_of, span_of = [], [], [], [], []
            for t in text.to_pylist():
                h1, tail, again, span, seen = [], [], [], [], set()
                key_of.append(_texts_key(t) if t else 0)
                for start, end, words, unit in units(t, min_line_words) if t else ():
                    d = xxhash.xxh3_128_intdigest(unit.encode()) >> 32
                    h1.append((d >> 32) - (1 << 63))
                    tail.append((d & 0xFFFFFFFF) - (1 << 31))
                    again.append(d in seen)
                    span.append(packed(start, end, words))
                    seen.add(d)
                for to, x in ((h1_of, h1), (d_of, tail), (again_of, again), (span_of, span)):
                    to.append(x)
            longs = pa.list_(pa.int64())
            return [pa.array(key_of, pa.int64()), pa.array(h1_of, longs), pa.array(d_of, pa.list_(pa.int32())), pa.array(again_of, pa.list_(pa.bool_())), pa.array(span_of, longs)]
        return run

    found = stored(arrow_rows(rows, ["doc_id"], ["text"], "key long, h1 array<long>, d array<int>, again array<boolean>, span array<long>", make),
                   "units", compression="zstd")
    return (found.select("doc_id", "key", F.explode(F.arrays_zip("h1", "d", "again", "span")).alias("u"))
            .select("doc_id", F.col("u.h1").alias("h1"), F.shiftleft(F.col("u.d").cast("long"), 32).bitwiseOR(F.col("key")).alias("h2"),
                    F.col("u.again").alias("again"), F.col("u.span").alias("span")))


def repeated_spans(rows: DataFrame, min_line_words: int) -> DataFrame:
    """(doc_id, key, spans): the repeated units of each text (key: 32 bits of its hash)."""
    found = text_units(rows, min_line_words)
    digest = F.shiftright("h2", 32)
    keepers = (found.groupBy("h1", digest.alias("d")).agg(F.min("doc_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select(F.col("h1").alias("k1"), F.col("d").alias("k2"), "keeper"))
    hits = (found.withColumn("d", digest)
            .join(keepers, (F.col("h1") == F.col("k1")) & (F.col("d") == F.col("k2")))
            .filter("again or (keeper is not null and not (doc_id <=> keeper))"))
    return (hits.groupBy("doc_id", F.col("h2").bitwiseAND(0xFFFFFFFF).alias("key"))
            .agg(F.collect_set("span").alias("spans")))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; a line goes whole when no word of it is left."""
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    out.append(text[at:])
    if not spans:
        return text
    kept = []
    # numbers of the lines with a cut, in what is left: line breaks inside a span went with it
    cut_lines = set(accumulate(part.count("\n") for part in out[:-1]))
    for i, line in enumerate("".join(out).split("\n")):
        if i not in cut_lines or line.strip(BLANKS):
            kept.append(line)
    return "\n".join(kept)


def dedup(docs: DataFrame, min_words: int = 10, min_line_words: int = 5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_removed (spans), removed_chars, removed (spans as start:end, comma-joined),
    text (what is left) of every row."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    spans = stored(repeated_spans(rows, min_line_words), "repeats")
    # texts are what is large here: merge, whatever the planner makes of the size of the spans
    spans = spans.select(F.col("doc_id").alias("_id"), "key", "spans").hint("merge")
    keyed = arrow_rows(rows, ["doc_id", "text"], ["text"], "text_key long", lambda: lambda text: [
        pa.array([_texts_key(t) if t else 0 for t in text.to_pylist()], pa.int64())])
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("key")), "left")

    def make():
        def run(text, spans):
            n, chars, told, kept = [], [], [], []
            for t, s in zip(text.to_pylist(), spans.to_pylist(), strict=True):
                cut = spans_to_cut([unpacked(x) for x in s], t, min_words, min_line_words) if t and s else []
                n.append(len(cut))
                chars.append(sum(e - b for b, e in cut))
                told.append(",".join(f"{b}:{e}" for b, e in cut))
                kept.append(without(t, cut) if cut else t)
            return [pa.array(n, pa.int64()), pa.array(chars, pa.int64()), pa.array(told, pa.string()), pa.array(kept, pa.string())]
        return run
    made = arrow_rows(joined, ["doc_id"], ["text", "spans"], "n_removed long, removed_chars long, removed string, kept string", make)
    return made.withColumnRenamed("kept", "text")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
