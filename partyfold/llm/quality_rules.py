"""Quality rules by distribution divergence.

Every text gets the base counts (words, symbols, repeated lines, repeated three-word
windows) and two histograms: its character classes and its use of the common words of a
language. Each is compared with the language references by Jensen-Shannon distance (base 2,
0 to 1); the language whose two distances have the smallest sum is the text's own. A text
is kept if the base rules pass and neither distance exceeds its limit. Short texts spread
wider by chance alone: a histogram of N draws over K bins is expected to diverge by about
(K - 1) / (8 N ln 2) from its own source, so that much is added to the squared limit, and
below ``min_words`` words (or ``min_letters`` letters) the method gives no verdict of its own.

References cover the whole corpus: for each ``lang`` value the sums of the histograms of all
its texts. Common words are the ``common`` most frequent ones. A word whose share in a language
is at least ``min_share`` has that share in at least one block of texts too, so blocks
report just such words, and a second pass counts them exactly. What reaches the driver is
at most ``max_languages`` languages and a fixed number of bins each.

Defined cases: null and empty texts have no words, fail the base rules and are not kept;
texts are read whole; rows with equal ids are separate rows; rows without ``lang`` take no
part in references; without any reference the method rejects nothing; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, arrow_rows, picked, stored, table, utf8

SYMBOLS = "#*$%&|<>"

#: Character classes of UTF-8 bytes: a lead byte stands for its character, and the bytes
#: that follow it count for nothing.
CLASSES = ("lower", "upper", "digit", "blank", "line end", "sentence mark", "symbol", "other mark", "beyond ASCII")


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 0xC0:
        return 8
    if b >= 0x80:
        return len(CLASSES)
    if c == "\n":
        return 4
    if c in " \t\r\v\f":
        return 3
    if c.isalpha():
        return 0 if c.islower() else 1
    return 2 if c.isdigit() else 5 if c in ".,;:!?'\"" else 6 if c in SYMBOLS else 7


_CLASS_TABLE = np.array([_class_of(b) for b in range(256)], np.uint8)


def class_histogram(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS_TABLE[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[:len(CLASSES)]


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words."""
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        until = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    return chars, symbols, len(lines) - len(set(lines)), repeated


def _common_candidates(docs: DataFrame, min_share: float, block_words: int) -> DataFrame:
    """(lang, word): words with a share of ``min_share`` in some block of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        total: Counter = Counter()

        def frequent(lang):
            least = min_share * total.pop(lang)
            return [(lang, w.decode()) for w, n in counts.pop(lang).items() if n >= least]

        for b in batches:
            rows = []
            for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                words = text.lower().split()
                counts[lang].update(words)
                total[lang] += len(words)
                if total[lang] >= block_words:
                    rows += frequent(lang)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], names=["lang", "word"])
        rows = [r for lang in list(total) if total[lang] for r in frequent(lang)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], names=["lang", "word"])

    known = docs.filter("lang is not null and text is not null").select("lang", "text")
    return known.mapInArrow(run, "lang string, word string").distinct()


def references(docs: DataFrame, common: int, min_share: float, max_languages: int,
               block_words: int = 500_000) -> dict[str, tuple[list[int], dict[bytes, int], int]]:
    """For each language: character class counts, counts of its common words, all words."""
    docs = docs.filter("lang is not null and text is not null")
    langs = [r.lang for r in docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()]
    if not langs:
        return {}
    asked = docs.filter(F.col("lang").isin(langs))
    found: dict[str, set[bytes]] = defaultdict(set)
    for r in _common_candidates(asked, min_share, block_words).collect():  # at most 1 / min_share a block and language, nearly the same in each
        found[r.lang].add(r.word.encode())
    wanted = {k: sorted(v) for k, v in found.items()}
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {k: {w: i for i, w in enumerate(v)} for k, v in sent.value.items()}
        words_of = {k: np.zeros(len(v) + 1, np.int64) for k, v in sent.value.items()}
        classes_of = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                if lang not in index:
                    continue
                words = text.lower().split()
                at = index[lang]
                words_of[lang][-1] += len(words)
                hits = [at[w] for w in words if w in at]
                if hits:
                    words_of[lang][:-1] += np.bincount(hits, minlength=len(at))
                classes_of[lang] += class_histogram(text)
        rows = [(k, f"w{i}", int(n)) for k, v in words_of.items() for i, n in enumerate(v) if n]
        rows += [(k, f"c{i}", int(n)) for k, v in classes_of.items() for i, n in enumerate(v) if n]
        if rows:
            a, c, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(c, pa.string()), pa.array(n, pa.int64())], names=["lang", "bin", "n"])

    sums = asked.select("lang", "text").mapInArrow(run, "lang string, bin string, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    got: dict[str, dict[str, int]] = defaultdict(dict)
    for r in sums.collect():  # one row per language and bin
        got[r.lang][r.bin] = r.n
    out = {}
    for lang, bins in got.items():
        words = wanted.get(lang, [])
        counted = sorted(((bins.get(f"w{i}", 0), w) for i, w in enumerate(words)), key=lambda x: (-x[0], x[1]))
        out[lang] = ([bins.get(f"c{i}", 0) for i in range(len(CLASSES))],
                     {w: n for n, w in counted[:common]}, bins.get(f"w{len(words)}", 0))
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of rows of ``p`` and one distribution ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


class _Judge:
    """Distances of texts to the references."""

    def __init__(self, refs: dict):
        self.langs = sorted(refs)
        vocabulary = sorted({w for _, words, _ in refs.values() for w in words})
        at = {w: i for i, w in enumerate(vocabulary)}
        self.refs = []
        for lang in self.langs:
            classes, words, total = refs[lang]
            of = np.zeros(len(words) + 1)
            of[:-1] = list(words.values())
            of[-1] = total - of[:-1].sum()
            self.refs.append((np.array(classes) / max(1, sum(classes)), np.array([at[w] for w in words], np.int64), of / max(1, total)))
        self.at, self.size = at, len(vocabulary)

    def word_histogram(self, words: list[bytes]) -> np.ndarray:
        at = self.at
        hits = [at[w] for w in words if w in at]
        return np.bincount(hits, minlength=self.size) if hits else np.zeros(self.size, np.int64)

    def distances(self, classes: np.ndarray, words: np.ndarray, n_words: np.ndarray):
        """Nearest language (index), distance of classes, distance of words, bins of words."""
        p = classes / np.maximum(1, classes.sum(axis=1, keepdims=True))
        n = np.maximum(1, n_words)[:, None]
        by_lang = []
        for ref_classes, own, ref_words in self.refs:
            mine = words[:, own]
            q = np.concatenate([mine, n_words[:, None] - mine.sum(axis=1, keepdims=True)], axis=1) / n
            by_lang.append((js_distance(p, ref_classes), js_distance(q, ref_words)))
        both = np.array(by_lang)
        best = both.sum(axis=1).argmin(axis=0)
        row = np.arange(len(best))
        return best, both[best, 0, row], both[best, 1, row], np.array([len(r[2]) for r in self.refs])[best]


def judge(docs: DataFrame, common: int = 50, min_share: float = 0.002, max_languages: int = 200,
          max_class_distance: float = 0.28, max_word_distance: float = 0.38, min_words: int = 50,
          min_letters: int = 200, max_repeat_percent: int = 50, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    nearest language, class_distance and word_distance of every document."""
    rows = picked(docs, doc_id=id_col, text=text_col, lang=lang_col)
    refs = references(rows, common, min_share, max_languages)
    sent = docs.sparkSession.sparkContext.broadcast(refs)

    def make():
        judged = _Judge(sent.value)

        def run(text):
            n, counts, classes, used = [], [], [], []
            for t, raw in zip(text.to_pylist(), utf8(text), strict=True):
                words = raw.split() if raw else []
                n.append(len(words))
                counts.append(base_counts(t, words) if t else (0, 0, 0, 0))
                classes.append(class_histogram(raw or b""))
                used.append(judged.word_histogram(raw.lower().split() if raw else []))
            n_words, base = np.array(n, np.int64), np.array(counts, np.int64).reshape(-1, 4)
            failed = (n_words < 50) | (100 * base[:, 3] > max_repeat_percent * n_words)
            lang, near_class, near_word, odd = [None] * len(n), np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), bool)
            if judged.refs and len(n):
                classes = np.array(classes)
                best, near_class, near_word, bins = judged.distances(classes, np.array(used).reshape(len(n), -1), n_words)
                lang = [judged.langs[i] for i in best]
                draws = np.maximum(1, classes.sum(axis=1))
                slack = 1 / (8 * np.log(2))
                odd = (near_class ** 2 > max_class_distance ** 2 + (len(CLASSES) - 1) * slack / draws) | \
                      (near_word ** 2 > max_word_distance ** 2 + (bins - 1) * slack / np.maximum(1, n_words))
                odd &= (n_words >= min_words) & (base[:, 0] >= min_letters)
            return [pa.array(n_words), *[pa.array(base[:, i]) for i in range(4)], pa.array(failed), pa.array(~failed & ~odd),
                    pa.array(lang, pa.string()), pa.array(near_class, pa.float64()), pa.array(near_word, pa.float64())]
        return run

    return arrow_rows(rows, ["doc_id"], ["text"], "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                      "n_repeat_words long, base_failed boolean, kept boolean, nearest string, "
                      "class_distance double, word_distance double", make)


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
