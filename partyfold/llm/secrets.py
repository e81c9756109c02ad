"""Secret scans with a randomness test battery.

Three patterns give the base spans. Beyond them, every run of 20 or more characters of
``[A-Za-z0-9+/_=-]``, or every such piece that base spans leave of one, is a candidate: the smallest alphabet that holds its characters
is taken as its encoding, and three tests ask whether it can be uniform over that alphabet:
chi-squared of the symbol counts, Wald-Wolfowitz runs about the middle of the alphabet, and
lag-one serial correlation. A candidate that none of them rejects looks random. How
unlikely ordinary text is to look like it is measured by the likelihood ratio R of the
uniform source against a model of text (letters by their usual frequency, characters of one
class in a row). Under that model R is 1 on average, so 1 / R bounds the p-value for any
length. False discoveries are then held to ``fdr`` by Benjamini-Hochberg over all
candidates of the corpus, in a family for each range of lengths, so that the many short
runs of ordinary text do not raise the bar for long ones nor the reverse.

The corpus-wide step is one aggregate of counts by family and rounded log p (rounded
towards 1, which keeps the control valid), a few hundred rows. Texts are read once by the
query; only spans are kept.

Defined cases: null and empty texts have no spans; texts are read whole; rows with equal ids
are separate rows; an empty table gives an empty result; spans are code points, end
exclusive, and never come from anything but the text column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, mapped, picked, pieces, stored, table

KINDS = ("assign", "access", "hex", "random")

# The patterns of the base spans and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SIGNS = "+/_=-"

# Usual frequency of the letters a to z in English text, per mille.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)

#: Least lengths of the families.
FAMILIES = (20, 24, 28, 32, 40, 48, 64, 96)
#: Log p in steps of 1 / STEPS, at most DEEPEST steps.
STEPS, DEEPEST = 2, 400

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = tuple((name, {c: i for i, c in enumerate(letters)}) for name, letters in (
    ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER),
    ("base32", _UPPER + "234567"), ("lower36", _DIGITS + _LOWER), ("upper36", _DIGITS + _UPPER),
    ("letters", _UPPER + _LOWER), ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("any", _UPPER + _LOWER + _DIGITS + "+/-_=")))

_STAY, _MOVE = math.log(0.95), math.log(0.05 / 3)
_TEXT_MODEL = {c: (k, math.log(p)) for k, pairs in enumerate((
    [(c, n / sum(LETTERS)) for c, n in zip(_LOWER, LETTERS, strict=True)],
    [(c, n / sum(LETTERS)) for c, n in zip(_UPPER, LETTERS, strict=True)],
    [(c, 0.1) for c in _DIGITS], [(c, 0.2) for c in "+/-_="])) for c, p in pairs}


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(codes: list[int], k: int) -> tuple[float, float, float]:
    """p-values of chi-squared uniformity (upper tail), runs and serial correlation."""
    n = len(codes)
    counts = [0] * k
    for c in codes:
        counts[c] += 1
    chi2 = sum(c * c for c in counts) * k / n - n
    z = (chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    uniform = math.erfc(z / math.sqrt(2)) / 2
    high = [2 * c >= k for c in codes]
    a = sum(high)
    b = n - a
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
        mean = 1 + 2 * a * b / n
        spread = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        in_runs = two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        in_runs = 2.0 ** (1 - n)
    mid = sum(codes) / n
    var = sum((c - mid) ** 2 for c in codes)
    lag = sum((x - mid) * (y - mid) for x, y in zip(codes, codes[1:], strict=False))
    serial = two_sided((lag / var + 1 / n) * math.sqrt(n)) if var else 0.0
    return uniform, in_runs, serial


def against_text(token: str, k: int) -> float:
    """Natural log of the likelihood ratio of a uniform source over text."""
    log, last = -math.log(4), -1
    for c in token:
        kind, p = _TEXT_MODEL[c]
        log += p + (0.0 if last < 0 else _STAY if kind == last else _MOVE)
        last = kind
    return -len(token) * math.log(k) - log


def examine(token: str, alpha: float) -> tuple[bool, int]:
    """Does the token look random, and the steps of -log p against text."""
    body = token.rstrip("=") or token
    seen = set(body)
    if seen <= set(_DIGITS):
        return False, 0
    codes = next(codes for _, codes in ENCODINGS if seen <= codes.keys())
    tests = battery([codes[c] for c in body], len(codes))
    steps = min(DEEPEST, max(0, int(against_text(body, len(codes)) * STEPS)))
    return min(tests) * len(tests) >= alpha, steps


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, in order."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def outside(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bool, bool]]:
    """What is left of a run without the base spans, and whether one was cut off before and after it."""
    at = start
    for s, e in merged((s, e) for s, _, e in base if s < end and start < e):
        if s > at:
            yield at, s, at > start, True
        at = e
    if at < end:
        yield at, end, at > start, False


def candidates(text: str, base: list[tuple[int, int, int]], alpha: float) -> Iterator[tuple[int, int, int, int, bool]]:
    """(start, end, family, steps, random) of runs, and of what base spans leave of them. The
    sign that parts a piece from its base span is not of the piece."""
    for m in CANDIDATE.finditer(text):
        for a, b, before, after in outside(*m.span(), base):
            inner = a + (before and text[a] in SIGNS), b - (after and text[b - 1] in SIGNS)
            if inner[1] - inner[0] >= FAMILIES[0]:
                a, b = inner
            elif b - a < FAMILIES[0]:
                continue
            random, steps = examine(text[a:b], alpha)
            yield a, b, sum(b - a >= x for x in FAMILIES) - 1, steps, random


def scan(docs: DataFrame, keep: list[str], text_col: str, alpha: float) -> DataFrame:
    """``keep`` columns, ``base`` spans and tested ``runs`` of every text."""
    def make():
        base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("family", pa.int32()), ("steps", pa.int32()), ("random", pa.bool_())]))

        def run(text):
            base, runs = [], []
            for t in text.to_pylist():
                spans = base_spans(t) if t else []
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                runs.append([{"start": s, "end": e, "family": f, "steps": p, "random": r} for s, e, f, p, r in candidates(t, spans, alpha)] if t else [])
            return [pa.array(base, base_type), pa.array(runs, run_type)]
        return run
    return arrow_rows(docs, keep, [text_col], "base array<struct<start: int, kind: int, end: int>>, "
                      "runs array<struct<start: int, end: int, family: int, steps: int, random: boolean>>", make)


def thresholds(scanned: DataFrame, fdr: float) -> list[int]:
    """For each family the least steps that Benjamini-Hochberg accepts (DEEPEST + 1: none).
    A run that the battery rejects counts as tested with p = 1."""
    tested = scanned.select(F.explode("runs").alias("r")).select(
        F.col("r.family").alias("family"), F.when(F.col("r.random"), F.col("r.steps")).otherwise(F.lit(0)).alias("steps"))
    rows = tested.groupBy("family", "steps").count().collect()  # at most families x steps
    out = []
    for family in range(len(FAMILIES)):
        counts = {r.steps: r["count"] for r in rows if r.family == family}
        tests, above, least = sum(counts.values()), 0, DEEPEST + 1
        for steps in sorted(counts, reverse=True):
            above += counts[steps]
            if math.exp(-steps / STEPS) * tests <= fdr * above:
                least = steps
        out.append(least)
    return out


def accepted(limits: list[int]) -> Column:
    """The runs that count as secrets, as (start, kind, end)."""
    limit = F.array(*[F.lit(x) for x in limits])
    found = F.filter("runs", lambda r: r["random"] & (r["steps"] >= F.element_at(limit, r["family"] + 1)))
    return F.transform(found, lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), r["end"].alias("end")))


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.001, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, base (spans), found (spans that the battery adds); spans are (start, kind, end)."""
    scanned = stored(scan(picked(docs, doc_id=id_col, text=text_col), ["doc_id"], "text", alpha), "secrets")
    return scanned.select("doc_id", "base", accepted(thresholds(scanned, fdr)).alias("found"))


def redacted(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.001, text_col: str = "text",
             mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; all rows and columns stay."""
    limits = thresholds(scan(docs, [], text_col, alpha), fdr)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in pieces(batches):
            texts = []
            for t in b.column(at).to_pylist():
                if t:
                    base = base_spans(t)
                    spans = base + [(s, 3, e) for s, e, f, steps, random in candidates(t, base, alpha) if random and steps >= limits[f]]
                    for s, e in reversed(merged((s, e) for s, _, e in spans)):
                        t = t[:s] + mark + t[e:]
                texts.append(t)
            columns = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return mapped(docs, run, T.StructType(docs.schema.fields))


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping spans as one, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.array_sort(F.concat("base", "found"))).alias("spans"), F.size("found").cast("long").alias("n_random"))
