"""Periodic runs, whitening and URL filters: brute-force comparisons and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from partyfold.llm import periodic_runs, url_filter, whitening
from partyfold.llm.common import slices

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs --------------------------------------------------------------------
def plain_runs(w, times=2, least=2):
    """Every maximal stretch of every period, the smallest period of each."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def some_words(rng):
    w = [rng.randrange(rng.choice([1, 2, 2, 3, 5, 40])) for _ in range(rng.randint(0, 90))]
    for _ in range(rng.randint(0, 3) if w else 0):
        a = rng.randrange(len(w))
        p = rng.randint(1, max(1, (len(w) - a) // 3))
        for i in range(a, rng.randint(a, len(w))):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_catchers_find_the_runs_however_words_arrive(step):
    rng = random.Random(step)
    for _ in range(150):
        w = some_words(rng)
        stream = periodic_runs.SquareCatchers()
        for i in range(0, len(w), step):
            stream.append(np.array(w[i:i + step], np.int64))
        assert stream.runs() == plain_runs(w)
        assert stream.runs(4, 6) == plain_runs(w, 4, 6)


def test_documents_in_one_stream_stay_apart(monkeypatch):
    rng = random.Random(2)
    docs = [some_words(rng) for _ in range(120)]
    docs[5:5] = [[1] * 40, [1] * 40, []]
    for piece in (1 << 16, 9):
        monkeypatch.setattr(periodic_runs, "PIECE", piece)
        assert periodic_runs.runs_of([np.array(d, np.int64) for d in docs], 4, 6) == [plain_runs(d, 4, 6) for d in docs]


def test_one_repeated_word_takes_little():
    stream = periodic_runs.SquareCatchers(50_000)
    for _ in range(4):
        stream.append(np.zeros(50_000, np.int64))
    assert stream.runs() == [(0, 200_000, 1)] and len(stream.found) < 10


def plain_row(doc_id, text):
    w = WORDS.findall(text or "")
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 4, 6)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in dropped).encode()).hexdigest(), n)


def test_runs_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in periodic_runs.query(spark, SMALL).collect()]
    short = {i for i, t in docs if len(WORDS.findall(t or "")) < 1500}
    assert len(got) == len(docs) and any(r[1] for r in got)
    assert sorted(r for r in got if r[0] in short) == sorted(plain_row(i, t) for i, t in docs if i in short)


def test_runs_edge_cases(spark, tmp_path):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a " * 30_000), (5, "a b\tc\n" * 5), (5, "a b\tc\n" * 5), (None, "x x x x x x"),
            (None, None), (7, "été été été été été été \U0001F600"), (8, "a a a a a b b b b b")]
    rows += [(i, t) for i, t in zip(ids, ["", None, "one", " a b c d e f g h i j k l m n ", "x y " * 20, "z"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", *[F.lit("x").alias(c) for c in ("runs", "collapsed", "n_words", "best", "start", "words")])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic_runs.query(spark, str(tmp_path)).collect()]
    small = [(i, t) for i, t in rows if i != 4]
    assert sorted(map(str, (r for r in got if r[0] != 4))) == sorted(map(str, (plain_row(i, t) for i, t in small)))
    assert [r[1:6] for r in got if r[0] == 4] == [(1, 0, 30_000, 1, 30_000_000)]
    five = periodic_runs.find_runs(df, ["doc_id"], "text").filter("doc_id = 5").collect()
    assert [(r.collapsed, [tuple(x) for x in r.runs]) for r in five] == [("a b c", [(0, 15, 3)])] * 2
    assert periodic_runs.find_runs(df.limit(0), ["doc_id"]).count() == 0


def test_slices_cut_batches_by_bytes():
    import pyarrow as pa
    texts = ["a" * 10, None, "b" * 500, "", "c" * 30, "d" * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    cut = list(slices(batch, 50))
    assert [x for b in cut for x in b.column(1).to_pylist()] == texts and [b.num_rows for b in cut] == [2, 3, 1]
    assert list(slices(batch.slice(0, 0), 50))[0].num_rows == 0


# ---- whitening ------------------------------------------------------------------------
def plain_whitening(vectors, k):
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [sum(int(v) ** 2 for v in row) for row in n * x - s], c @ u / np.sqrt(e), e / np.square(c).sum() * n


@pytest.mark.parametrize("scale", ["flat", "falling"])
def test_whitening_equals_full_eigenvectors(spark, scale):
    rng = np.random.default_rng(1)
    raw = rng.standard_normal((700, 40)) * (0.9 ** np.arange(40) * 9 if scale == "falling" else 1) + 3
    raw = raw.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<float>").repartition(5)
    rows, found, error = whitening.whiten(df, components=8)
    n, deviation, want, share = plain_whitening(raw, 8)
    got = sorted(rows.collect())
    y = np.array([r.whitened for r in got])
    assert found.n == n and [r.deviation for r in got] == deviation and error < 1e-9 and found.passes > 5
    assert np.abs(y * np.sign((y * want).sum(axis=0)) - want).max() < 1e-8
    assert np.abs(found.values / found.trace / share - 1).max() < 1e-10


def test_whitening_query(spark):
    raw = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    n, deviation, want, share = plain_whitening([v for _, v in raw], 32)
    got = whitening.query(spark, SMALL).orderBy("vec_id", "component").collect()
    assert len(got) == 32 * n and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    order = np.argsort([i for i, _ in raw])
    y = np.array([r.whitened for r in got]).reshape(n, 32)
    want = want[order]
    assert np.abs(y * np.sign((y * want).sum(axis=0)) - want).max() < 1e-8 and got[0].identity_error < 1e-9
    assert [r.deviation for r in got[::32]] == [deviation[i] for i in order]
    assert np.allclose([r.explained for r in got[:32]], share, rtol=1e-10) and [r.component for r in got[:32]] == list(range(1, 33))


def test_whitening_edge_cases(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (2, [0.25, -1.0, 0.0]), (None, [3.0, 2.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0, 0.0]),
            (6, [inf, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, [1.0, 2.0]), (None, None)]
    schema = "vec_id long, embedding array<float>, x string, whitened string, part string"
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.query(spark, str(tmp_path)).collect()
    n, deviation, want, share = plain_whitening([v for _, v in rows[:4]], 2)
    # the third dimension never varies: two components
    assert len(got) == 8 and {r.n for r in got} == {4} and sorted(r.deviation for r in got) == sorted(deviation * 2)
    assert np.allclose(sorted(abs(r.whitened) for r in got), sorted(np.abs(want).ravel())) and all(abs(r.identity_error) < 1e-9 for r in got)
    equal = spark.createDataFrame([(i, [1.0, 2.0], "", "", "") for i in range(3)], schema)
    assert [len(r.whitened) for r in whitening.whiten(equal)[0].collect()] == [0, 0, 0]
    assert whitening.whiten(df.limit(0))[0].count() == 0 and whitening.whiten(df.filter("vec_id = 3"))[0].count() == 0
    huge = spark.createDataFrame([(1, [3e38, 1.0], "", "", ""), (2, [-3e38, 1.0], "", "", ""), (3, [0.0, 2.0], "", "", "")], schema)
    out = whitening.whiten(huge)[0].collect()
    assert len(out) == 3 and all(np.isfinite(r.whitened).all() for r in out)
    big = np.array([[1 << 62, 0], [0, 0]])
    assert whitening.deviations(big, 2, big.sum(axis=0), 1 << 62) == [None, None]
    assert whitening.deviations(np.array([[3, 1], [1, 1]]), 2, np.array([4, 2]), 3) == [4, 4]


# ---- URL filters -----------------------------------------------------------------------
URLS = [
    ("https://WWW.Example.com/en/1?b=2&utm_source=x&a=1#f", "www.example.com", "/en/1", "www.example.com/en/", "allow", "example.com/en/1?a=1&b=2"),
    ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block", "m.example.com/en"),
    ("http://example.com/en", "example.com", "/en", "com/", "allow", "example.com/en"),
    ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow", "notexample.com/en/1"),
    ("https://a.net/es/x", "a.net", "/es/x", "net/es/", "block", "a.net/es/x"), ("https://net/fr/", "net", "/fr/", "net/fr/", "block", "net/fr"),
    ("https://a.com", "a.com", "", None, "allow", "a.com"), ("https://a.com?q#x", "a.com", "", None, "allow", "a.com?q"),
    ("https://a.net/en/x/", "a.net", "/en/x/", None, "block", "a.net/en/x"), ("ftp://u:p@a.net:443/en/x?", "u:p@a.net:443", "/en/x", None, "block", "a.net/en/x"),
    ("https://É.org:8080/é", "É.org:8080", "/é", None, "allow", "É.org:8080/é"), ("https:///x", "", "/x", None, "allow", None), ("://b.org.", "b.org.", "", None, "allow", "b.org"),
    ("no scheme", "", "", None, "allow", None), ("", "", "", None, "allow", None), (None, "", "", None, "allow", None),
    ("https://a.org\n/x\n", "a.org\n", "/x\n", None, "allow", "a.org\n/x\n"), ("x://y://z.org/1://2", "y:", "//z.org/1://2", None, "allow", "y//z.org/1://2"),
]
LISTED = ["http://www.a.net/en/x//?ref=1", "https://m.example.com/en", None, "", "nothing", "http://q.org/1"]


@pytest.mark.parametrize("shuffled", [False, True])
def test_urls(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(url_filter, "HIT_BYTES", -1)
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] * 2 + [(None, "https://a.net/en/x")], "page_id long, url string")
    pages = pages.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "key", "possible", "_at", "_w0", "_hit", "listed")])
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    got = url_filter.judge(pages, listed).collect()
    want = [(i, h, p, r, v, k in ("a.net/en/x", "m.example.com/en")) for i, (_, h, p, r, v, k) in enumerate(URLS)] * 2
    want.append((None, "a.net", "/en/x", None, "block", True))
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in got))) == sorted(map(str, want))
    assert all(r.possible for r in got if r.listed)
    keys = pages.filter("page_id is not null").select("page_id", url_filter.canonical(F.col("url")).alias("k")).collect()
    assert {r.page_id: r.k for r in keys} == {i: u[5] for i, u in enumerate(URLS)}
    nothing = listed.limit(0)
    assert not any(r.possible or r.listed for r in url_filter.judge(pages, nothing).collect())
    assert url_filter.judge(pages.limit(0), listed).count() == 0


def test_filter_misses_nothing_and_lets_little_through(spark):
    keys = spark.range(4000).selectExpr("concat('k', id) key")
    blocks = 4000 * 16 // 512
    probes = spark.range(20_000).selectExpr("concat('k', id) key", "id < 4000 inside")
    got = url_filter.with_possible(probes, "key", url_filter.bloom_blocks(keys, "key", blocks), blocks)
    n = {r.inside: (r.n, r.hits) for r in got.groupBy("inside").agg(F.count("*").alias("n"), F.count_if("possible").alias("hits")).collect()}
    assert n[True] == (4000, 4000) and n[False][1] < 200
    # a filter cut to one block lets more through; the exact join still decides
    pages = spark.createDataFrame([(i, f"http://h.org/{i}") for i in range(500)], "page_id long, url string")
    few = url_filter.judge(pages, pages.filter("page_id < 400"), max_blocks=1).collect()
    assert sorted(r.page_id for r in few if r.listed) == list(range(400)) and any(r.possible and not r.listed for r in few)
