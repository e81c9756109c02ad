"""Periodic runs of words by online dyadic square catching.

A run is a stretch of words with smallest period q that no neighbouring word extends; a square
is one of length 2q. ``SquareCatchers`` reads a stream of words, any number at a time. Whenever
a block of L = 1, 2, 4, ... words is complete (it starts at a multiple of L) a catcher stands on
it, which watches the words appended at distances q of 2L-1 to 4L-2: the left half of every
square of such a period holds a whole block of L words. Each appended word completes one suffix
of every length L, which is compared with the two catchers of that length that are within reach
(by 64-bit fingerprints, made for length 2L from those of length L). Where one is equal, the
words before and behind are compared to find how far the equality of words q apart reaches; q
equal words or more are a square. Squares of one period that overlap are one stretch; a
stretch that touches the end of the stream stays open and grows with the next words. A period
that is a multiple of a smaller one has the very same stretch, so the smallest period of each
stretch makes the run. Every reported run is compared once more word by word.

Scale: one scan of the texts, no shuffle. The documents of a batch follow one another in one
stream, each closed by a word that occurs nowhere else, so a few numpy calls serve hundreds of
documents; a long document reaches the stream in pieces of ``PIECE`` words. Memory is the words of
one batch (cut by bytes) and a few numbers for each, also for a text of one repeated word: a catcher
inside a known run whose period divides q is passed over, as it would find that run again. Time is
proportional to words times the levels up to the longest period asked for.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts have no words, no runs and
collapse to the empty text; repeated rows (also of one id) are judged each by itself; an empty
table gives an empty result; other columns of the input (under any name) are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, free_names, picked, table, utf8

#: Words that go to the stream at a time.
PIECE = 1 << 16
#: Words before and behind caught blocks that are compared for all blocks at once.
NEAR = 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


class _Numbers(dict):
    """Words numbered from 0 as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class _Level:
    """The catchers on blocks of ``size`` words: fingerprints of the last suffixes (starting at
    ``first``) and of the last complete blocks (from block number ``block`` on)."""

    def __init__(self, size: int):
        self.size, self.first, self.block = size, 0, 0
        self.last = np.empty(0, np.uint64)
        self.blocks = np.empty(0, np.uint64)

    def append(self, new: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Take the fingerprints of the suffixes that start at ``start`` and after; returns the
        caught pairs (block start, period)."""
        size = self.size
        begins = np.arange(start, start + len(new))
        whole = -(-start // size) * size
        self.blocks = np.concatenate([self.blocks, new[whole - start::size]])
        number = begins // size
        caught_at, caught_q = [], []
        for back in (2, np.where(begins % size == size - 1, 1, 3)):
            block = number - back
            reach = np.flatnonzero(block >= self.block)
            hit = reach[self.blocks[block[reach] - self.block] == new[reach]]
            at = block[hit] * size
            caught_at.append(at)
            caught_q.append(begins[hit] - at)
        self.last = np.concatenate([self.last, new])
        drop = max(0, len(self.last) - size)
        self.last, self.first = self.last[drop:], self.first + drop
        old = max(0, len(self.blocks) - 5)
        self.blocks, self.block = self.blocks[old:], self.block + old
        return np.concatenate(caught_at), np.concatenate(caught_q)


class SquareCatchers:
    """Squares, and the runs they merge into, of the words appended so far (whole numbers from 0).
    Periods above ``longest`` are not looked for."""

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.words = np.empty(1024, np.int64)
        self.n = 0
        self.levels: list[_Level] = []
        #: (start, q) of a stretch -> its end: those whose equal words reach the end, those that hold a square
        self.open: dict[tuple[int, int], int] = {}
        self.found: dict[tuple[int, int], int] = {}
        self._recent: list[tuple[np.ndarray, ...]] = []
        self._cover: tuple | None = None

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            grown = np.empty(max(self.n, 2 * len(self.words)), np.int64)
            grown[:old] = self.words[:old]
            self.words = grown
        self.words[old:self.n] = words
        self._advance()
        level, begun, start = 0, 0, old
        prints = _mixed(words.astype(np.uint64) * _A + _B)       # suffixes of one word
        while True:
            size = 1 << level
            if len(self.levels) == level:
                if self.n < size or (self.longest is not None and 2 * size - 1 > self.longest):
                    break
                self.levels.append(_Level(size))
            if level:
                # those that the new words complete, each from its two halves
                start = max(0, old - size + 1)
                left = halves[start - begun:self.n - size + 1 - begun]
                right = halves[start + size // 2 - begun:self.n - size // 2 + 1 - begun]
                prints = _mixed(left * _A + right)
            here = self.levels[level]
            begun, halves = here.first, np.concatenate([here.last, prints])
            at, q = here.append(prints, start)
            if len(at):
                self._extend(at, q, size)
            level += 1

    def _equal(self, i: int, j: int, step: int, limit: int) -> int:
        """How many words from i and from j on (backwards for step -1) are equal, ``limit`` at most."""
        done, piece = 0, 64
        while done < limit:
            m = min(piece, limit - done)
            if step > 0:
                a, b = self.words[i + done:i + done + m], self.words[j + done:j + done + m]
            else:
                a, b = self.words[i - done - m + 1:i - done + 1][::-1], self.words[j - done - m + 1:j - done + 1][::-1]
            differ = a != b
            first = int(differ.argmax())
            if differ[first]:
                return done + first
            done, piece = done + m, piece * 4
        return done

    def _keep(self, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> None:
        """Stretches whose words from ``start`` to ``end`` equal those q further on."""
        at_end = end + q == self.n
        self.open.update(zip(zip(start[at_end].tolist(), q[at_end].tolist()), end[at_end].tolist()))
        square = end - start >= q
        if square.any():
            start, q, end = start[square], q[square], (end + q)[square]
            self.found.update(zip(zip(start.tolist(), q.tolist()), end.tolist()))
            self._recent.append((start, end, q))
            self._cover = None

    def _advance(self) -> None:
        """Stretches that touched the end grow into the new words."""
        before, self.open = self.open, {}
        self._recent, self._cover = [], None
        if before:
            start, q, end = (np.array(x, np.int64) for x in zip(*((s, q, e) for (s, q), e in before.items())))
            more = [self._equal(e, e + p, 1, self.n - e - p) for e, p in zip(end.tolist(), q.tolist())]
            self._keep(start, end + np.array(more, np.int64), q)

    def _covered(self, at: np.ndarray, q: np.ndarray, size: int) -> np.ndarray:
        """Whether the caught pair lies in a known run whose period divides q. The pair ends among the
        words of this call, so runs that reach into them are all that matter."""
        if not self._recent:
            return np.zeros(len(at), bool)
        if self._cover is None:
            starts, ends, periods = (np.concatenate(x) for x in zip(*self._recent))
            order = np.lexsort((periods, starts))
            starts, ends, periods = starts[order], ends[order], periods[order]
            # of the runs that start no later, the one that ends last
            number = np.arange(len(starts))
            furthest = np.maximum.accumulate(ends * len(starts) + (len(starts) - 1 - number))
            self._cover = starts, ends, periods, len(starts) - 1 - furthest % len(starts)
        starts, ends, periods, which = self._cover
        i = np.searchsorted(starts, at, "right") - 1
        run = which[np.maximum(i, 0)]
        return (i >= 0) & (ends[run] >= at + q + size) & (q % periods[run] == 0)

    def _extend(self, at: np.ndarray, q: np.ndarray, size: int) -> None:
        """From caught blocks to stretches: blocks side by side of one period are one, and the words before
        and behind are compared."""
        order = np.lexsort((at, q))
        at, q = at[order], q[order]
        head = np.flatnonzero(np.concatenate([[True], (np.diff(at) != size) | (np.diff(q) != 0)]))
        tail = np.concatenate([head[1:], [len(at)]]) - 1
        start, end, q = at[head], at[tail] + size, q[head]
        new = ~(self._covered(start, q, size) & self._covered(end - size, q, size))
        start, end, q = start[new], end[new], q[new]
        w, n = self.words, self.n
        # nearly all end within a few words: all at once, the others one by one
        left = right = np.arange(len(q))
        for _ in range(NEAR):
            left = left[start[left] > 0]
            left = left[w[start[left] - 1] == w[start[left] - 1 + q[left]]]
            start[left] -= 1
            right = right[end[right] + q[right] < n]
            right = right[w[end[right]] == w[end[right] + q[right]]]
            end[right] += 1
            if not (len(left) or len(right)):
                break
        for i in left.tolist():
            s, p = int(start[i]), int(q[i])
            start[i] = s - self._equal(s - 1, s - 1 + p, -1, s)
        for i in right.tolist():
            e, p = int(end[i]), int(q[i])
            end[i] = e + self._equal(e, e + p, 1, n - e - p)
        self._keep(start, end, q)

    def runs(self, times: int = 2, least: int = 2) -> list[tuple[int, int, int]]:
        """(start, length, period) of runs of ``least`` words and ``times`` periods or more, by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for (start, q), end in self.found.items():
            smallest[start, end] = min(q, smallest.get((start, end), q))
        w = self.words
        return sorted((s, e - s, q) for (s, e), q in smallest.items()
                      if e - s >= max(least, times * q) and np.array_equal(w[s:e - q], w[s + q:e]))


def runs_of(documents: list[np.ndarray], times: int, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each document (arrays of whole numbers from 0), all in one stream."""
    lengths = [len(d) for d in documents]
    stream = SquareCatchers(max(lengths, default=0) // times)
    ends, at = [], 0
    parts: list[np.ndarray] = []
    pending = 0

    def flush():
        nonlocal parts, pending
        if parts:
            stream.append(np.concatenate(parts))
        parts, pending = [], 0
    for i, words in enumerate(documents):
        at += len(words) + 1
        ends.append(at)
        for piece in [*(words[k:k + PIECE] for k in range(0, len(words), PIECE)), np.array([-1 - i], np.int64)]:
            parts.append(piece)
            pending += len(piece)
            if pending >= PIECE:
                flush()
    flush()
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    found = stream.runs(times, least)
    which = np.searchsorted(np.array(ends, np.int64), [s for s, _, _ in found], "right") if found else []
    for i, (s, length, q) in zip(which, found):
        out[i].append((s - (ends[i] - lengths[i] - 1), length, q))
    return out


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", times: int = 4, least: int = 6) -> DataFrame:
    """``keep`` of every row with n_words, runs (start, length, period: word numbers from 0, by start, then
    period; runs of ``least`` words and ``times`` periods or more) and collapsed: the words joined by one
    space, without those that a run holds after its first period."""
    def make():
        def run(texts):
            word_lists = [t.split() if t else [] for t in utf8(texts)]
            numbers = _Numbers()
            documents = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in word_lists]
            found = runs_of(documents, times, least)
            collapsed = []
            for words, runs in zip(word_lists, found):
                if runs:
                    stay = np.ones(len(words), bool)
                    for s, length, q in runs:
                        stay[s + q:s + length] = False
                    words = [words[i] for i in np.flatnonzero(stay)]
                collapsed.append(b" ".join(words).decode())
            spans = pa.array([[{"start": s, "length": m, "period": q} for s, m, q in runs] for runs in found],
                             pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
            return [pa.array([len(w) for w in word_lists], pa.int64()), spans, pa.array(collapsed, pa.string())]
        return run
    return arrow_rows(docs, keep, [text], "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string", make)


def longest_power(runs: Column) -> Column:
    """The run of greatest length / period (exact); ties: smallest start, then period; null without runs."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def planted(text: Column, doc_id: Column) -> Column:
    """The text whose runs the query finds: for ids whose crc32 h is divisible by 10, each word i >= a becomes
    word a + (i - a) % p, where g = floor(h / 10), a = g % n and p = 1 + floor((n - a) / (3 + g % 8))."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]")) > 0), repeated).otherwise(text)


def query(spark, sf_dir: str) -> DataFrame:
    docs = picked(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    docs = docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = find_runs(docs, ["doc_id"], "text")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    best = F.col("best")
    return (found.withColumn("best", longest_power(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                    best["period"].alias("period"), F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))
