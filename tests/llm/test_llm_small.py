"""Edge cases and brute-force comparisons of the operators on small inputs."""

import hashlib
import math
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partyfold.llm import (bpe, common, components, cotraining, html_text, jaccard_join, language, line_dedup, mixing,
                           nearest, quality_rules, secrets)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 30_000 + "end"

#: (doc_id, text, lang, source, n_chars): nulls, empties, blanks, ties, repeats, one very long text.
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\v\f\r ", None, None, 7), (4, "one", "en", "b", 3),
    (5, "two words", "fr", "b", 9), (5, "two words", "fr", "b", 9), (5, "other words entirely here", "fr", None, 9),
    (None, "no id at all in this row here", "en", "a", 4), (None, None, None, None, None),
    (6, "The cat sat on the mat. " * 20, "en", "a", 1), (7, "The cat sat on the mat. " * 20, "en", "b", 1),
    (8, LONG, "en", None, len(LONG)), (9, "été à l'école \U0001F600 naïve x", "fr", "a", 1), (10, "12 34 !!", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as operators name their own.
CLASHES = ("size", "target", "part", "whole", "taken", "node", "gram", "n", "h1", "h2", "key", "spans", "span", "score", "kept",
           "base", "runs", "ids", "y", "row", "label", "_h", "_src", "mix_source", "jj_odd", "text_key", "lang_pred")


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def small(spark):
    from conftest import SMALL
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def empty_like(df):
    return df.limit(0)


# ---- quality rules ------------------------------------------------------------------
def plain_counts(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3000 else None
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), None if covered is None else len(covered))


def test_quality_base_counts(edge, small):
    for df in (edge, small.limit(40)):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                     for r in quality_rules.judge(df).collect())
        want = []
        for doc_id, text in texts:
            n, chars, symbols, dups, repeated = plain_counts(text)
            repeated = n - 1 if repeated is None else repeated        # LONG: all words but the last
            want.append((str(doc_id), n, chars, symbols, dups, repeated, n < 50 or 100 * repeated > 50 * n))
        assert got == sorted(want)


def test_quality_verdict(small, spark):
    from conftest import SMALL
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality_rules.judge(small).join(labels, "doc_id").filter("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert quality_rules.judge(empty_like(small)).count() == 0
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.0, 1.0])
    assert quality_rules.js_distance(p, q)[0] == 1 and quality_rules.js_distance(p, p[0])[0] == 0


def test_common_words_are_exact(spark):
    random.seed(1)
    texts = [" ".join(random.choices(["the", "of", "and", *map(str, range(300))], [30, 20, 10] + [1] * 300, k=200)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(5)
    from collections import Counter
    truth = Counter(w for t in texts for w in t.split())
    classes, words, total = quality_rules.references(df, 3, 0.01, 10, block_words=500)["en"]
    assert {w.decode(): n for w, n in words.items()} == dict(truth.most_common(3)) and total == sum(truth.values())
    assert sum(classes) == sum(map(len, texts))


# ---- mixing -------------------------------------------------------------------------
def plain_fill(sizes, weights, total):
    clamped = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        rest = total - sum(2 * sizes[s] for s in clamped)
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {**{s: 2 * sizes[s] for s in clamped}, **share}
        clamped |= over


def test_mix(edge, small):
    for df in (edge, small):
        got = mixing.mix(df).collect()
        sizes = {}
        for r in df.collect():
            sizes[r.source] = sizes.get(r.source, 0) + len(WORDS.findall(r.text or ""))
        order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
        want = plain_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
        taken = {}
        for r in got:
            assert r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
            assert math.isclose(r.target, want[r.source])
            taken[r.source] = taken.get(r.source, 0) + r.taken
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    assert mixing.mix(empty_like(edge)).count() == 0


def test_repeated_follows_the_plan(edge, small):
    mixed = {r.doc_id: r for r in mixing.mix(small, whole_documents=True).collect()}
    copies = {r.doc_id: r["count"] for r in mixing.repeated(small).groupBy("doc_id").count().collect()}
    for k, r in mixed.items():
        assert copies.get(k, 0) == (r.whole + (r.part > 0) if r["size"] else 0)
    out = mixing.repeated(edge)
    assert out.columns == edge.columns and out.filter("text is null").count() == 0
    assert mixing.repeated(empty_like(edge)).count() == 0


# ---- secrets ------------------------------------------------------------------------
def plain_base(text):
    found = []
    for kind, pattern, flags, least in (
            (0, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, None),
            (1, r"AKIA[A-Z0-9]+", 0, 16), (2, r"[0-9a-f]+", 0, 32)):
        for m in re.finditer(pattern, text, flags):
            if (len(m[2]) >= 8) if least is None else (len(m[0]) >= least):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


SECRET_TEXTS = [
    'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" | x', "PassWord:short", "api_key='A1b2C3d4E5'", "apikey=token=abcdefgh12",
    "token=token= abcdefghij", "AKIAABCDEFGHIJKL AKIASHORT AKIAAKIAAKIAAKIA1", "é" * 5 + "secret : zzzzzzzz.", "deadbeef" * 4, "deadbeef" * 3 + "x",
    "paſſword=abcdefgh1", "see q8Zt+1LkXw/0vBnR7yHc2MfJ5sDgA9eU and zu geeinvererberlichlich", None, ""]


def test_secret_base_spans(spark, small):
    df = spark.createDataFrame(list(enumerate(SECRET_TEXTS)), "doc_id long, text string")
    for rows in (df, small):
        texts = {r.doc_id: r.text or "" for r in rows.collect()}
        for r in secrets.find_secrets(rows).collect():
            assert [tuple(s) for s in r.base] == plain_base(texts[r.doc_id])


def test_secret_query_columns(small, spark):
    from conftest import SMALL
    texts = {r.doc_id: r.text for r in small.collect()}
    for r in secrets.query(spark, SMALL).collect():
        base = plain_base(texts[r.doc_id])
        told = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]


def test_battery_finds_random_tokens_only(spark, edge):
    random.seed(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    tokens = ["".join(random.choices(letters, k=random.choice((32, 40, 64)))) for _ in range(60)]
    words = ["erschlichereinbelichheitungver", "leauxleelleouoneaumentation", "internationalisationsworkshops", "aaaaaaaaaaaaaaaaaaaaaaaa",
             "abcdefghijklmnopqrstuvwxyz", "01234567890123456789012345"] * 10
    df = spark.createDataFrame([(i, f"key {t} end", t in tokens) for i, t in enumerate(tokens + words)], "doc_id long, text string, planted boolean")
    found = {r.doc_id for r in secrets.find_secrets(df).filter(F.size("found") > 0).collect()}
    planted = {r.doc_id for r in df.filter("planted").collect()}
    assert len(found & planted) >= 57 and not found - planted
    hidden = secrets.redacted(df).filter("planted").collect()
    assert sum(r.text == "key [secret] end" for r in hidden) >= 57
    assert secrets.redacted(edge).columns == edge.columns and secrets.redacted(edge).count() == len(EDGE)
    assert secrets.find_secrets(empty_like(edge)).count() == 0


def test_battery_tests_what_base_spans_leave_of_a_run(spark):
    rng = random.Random(11)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, hidden = [], {}
    for i in range(30):
        key, tail, whole = "AKIA" + pick(b64[:26], 16), pick(b64, 48), pick("0123456789abcdef", 32)
        text = f"see {key}/{tail} end" if i % 3 == 0 else f"see {whole}_{tail} end" if i % 3 == 1 else f"see {tail}/{key} end"
        rows.append((i, text))
        hidden[i] = tail
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [rows[r.doc_id][1][s.start:s.end] for s in r.found] for r in secrets.find_secrets(df).collect()}
    assert sum(found[i] == [t] for i, t in hidden.items()) >= 27
    left = {r.doc_id: r.text for r in secrets.redacted(df).collect()}
    assert sum(hidden[i] not in left[i] for i in hidden) >= 27
    assert list(secrets.candidates("AKIA" + "A" * 16 + "/short", secrets.base_spans("AKIA" + "A" * 16 + "/short"), 0.001)) == []


def test_battery_p_values():
    random.seed(2)
    passed = sum(min(secrets.battery([random.randrange(16) for _ in range(40)], 16)) * 3 >= 0.01 for _ in range(400))
    assert passed >= 388
    assert min(secrets.battery([3] * 40, 16)) < 1e-6 and min(secrets.battery(list(range(16)) * 3, 16)) < 1e-3


# ---- html ---------------------------------------------------------------------------
PAGES = [
    ("<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A &amp; B</h1>"
     "<p>Some   text\n of&nbsp;the <b>story</b>.<br>Goes on.<p>Second part, long enough to matter here.</article>"
     "<div class='comments'><p>A reader says very much about this, longer than the text itself is, much longer.</p></div>"
     "<footer>c</footer></body></html>", "A & B\nSome text of the story. Goes on.\nSecond part, long enough to matter here."),
    ("<body><div id='cookie-notice'>We use cookies on this site, accept them all please.</div><div id=content><h2>Title</h2>"
     "<p>The body text of the page goes here, with words.</p><form><label>Name</label><input></form><script>var a='<p>no</p>'</script>"
     "<ul><li>one</li><li>two</li></ul></div><aside>Other</aside>", "Title\nThe body text of the page goes here, with words.\none\ntwo"),
    (None, ""), ("", ""), ("<article></article>", ""), ("just text", "just text"), ("<![odd[ x", None), ("<p", None),
]


def test_html_cases(spark):
    df = spark.createDataFrame([(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df.select("page_id", "url", "html")).collect()}
    for i, (_, want) in enumerate(PAGES):
        if want is not None:
            assert got[i].text == want
        assert got[i].n_chars == len(got[i].text)


def test_html_pages_equal_their_articles(spark):
    import html as H
    from conftest import SMALL
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.query(spark, SMALL).collect():
        article = raw[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(H.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article))
        assert r.text == "\n".join(b for b in blocks if b)


# ---- byte-level BPE -----------------------------------------------------------------
def test_bpe_equals_tiktoken(small, edge):
    import tiktoken
    path, pattern = bpe.vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    random.seed(6)
    codec = bpe.Codec(bpe.model_bytes(bpe.read_ranks(path)), pattern)
    letters = " \t\n\r\v\f\x1c\x85\xa0 'sStvelm019ßÄé½²中の한\U0001F600_$!"
    texts = ["".join(random.choices(letters, k=random.randint(0, 20))) for _ in range(3000)]
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        assert list(memoryview(ids).cast("I")) == enc.encode_ordinary(t) and codec.decode(ids) == t.encode()
    for df in (small, edge):
        for r in bpe.encoded_and_checked(df.select("doc_id", "text"), path, pattern, keep=("doc_id", "text")).collect():
            assert list(memoryview(bytes(r.ids)).cast("I")) == enc.encode_ordinary(r.text or "") and r.round_trip
    assert bpe.round_trip(empty_like(edge), path, pattern).count() == 0


def test_pieces_return_freed_memory():
    """What a stage freed is not kept by the worker's C library while the next one runs."""
    held = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024
    many = [bytes(2000) for _ in range(100_000)]
    last = bytes(2000)                                    # above the others in the heap, so it cannot shrink
    del many
    before = held()
    batch = pa.RecordBatch.from_arrays([pa.array(["a", None])], names=["text"])
    assert [b.num_rows for b in common.pieces(iter([batch]))] == [2] and last
    assert held() < before - 100


def test_batches_to_python_are_cut_by_bytes(spark):
    """Many long rows reach Python in batches of a few MB, also where a stage maps whole rows."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    rows = spark.range(0, 8000, 1, 1).select("id", F.expr("repeat(cast(id % 10 as string), 2000)").alias("text"))
    got = common.mapped(rows, sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 8000 and max(r.size for r in got) < common.BATCH_BYTES + 10_000
    spark.conf.set(common.BATCH_LIMIT, "1000000")                     # a session's own limit stays
    try:
        got = common.mapped(rows, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 8000 and max(r.size for r in got) < 1_010_000
    finally:
        spark.conf.unset(common.BATCH_LIMIT)


def test_stored_leaves_no_shuffle_files(spark):
    """The write's shuffle files go with its end, and the frame can be read again."""
    shuffled = lambda: {p.name for p in pathlib.Path(local).rglob("shuffle_*.data")}
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    local = pathlib.Path(local).parent
    before = spark.conf.get(common.DROP_SHUFFLES)
    df = spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.collect_list("id").alias("ids"))
    old = shuffled()
    out = common.stored(df, "test-shuffles")
    for _ in range(50):                                               # Spark drops them in the background
        if not shuffled() - old:
            break
        time.sleep(0.2)
    assert not shuffled() - old
    assert out.count() == df.count() == 5000 and spark.conf.get(common.DROP_SHUFFLES) == before


def test_bpe_remembers_few_and_encodes_alike(monkeypatch):
    path, pattern = bpe.vocabulary()
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(20)] + [None, ""]
    codec = lambda: bpe.Codec(bpe.model_bytes(bpe.read_ranks(path)), pattern)
    expected = codec().encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "GROUP", 100)
    assert codec().encode(texts) == expected


def test_bpe_pattern_is_the_public_one():
    assert bpe.vocabulary()[1] == bpe.PATTERN_OF_QUICK


# ---- n-gram Jaccard join ------------------------------------------------------------
def plain_components(rows, n, num, den):
    sets = []
    for _, text in rows:
        w = [bytes(x) for x in (text or "").encode().lower().split()]
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                at[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return sorted((str(k), len(s), str(least.get(root(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(seed, families, per_family, words):
    random.seed(seed)
    out, k = [], 0
    for _ in range(families):
        base = [f"w{random.randrange(10 ** 6)}" for _ in range(random.choice(words))]
        for _ in range(per_family):
            copy = list(base)
            for _ in range(random.randrange(0, max(1, len(base) // 12) + 1)):
                kind, i = random.random(), random.randrange(len(copy))
                if kind < 0.5:
                    copy[i] = f"m{random.randrange(10 ** 6)}"
                elif kind < 0.8 and len(copy) > 1:
                    del copy[i]
                else:
                    copy.insert(i, "ins")
            out.append((k, " ".join(copy)))
            k += 1
    random.shuffle(out)
    return [(i, t) for i, (_, t) in enumerate(out)]


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100), (2, 60, 100)])
def test_jaccard_equals_brute_force(spark, monkeypatch, n, num, den):
    rows = near_copies(n, 12, 14, (3, 6, 9, 11, 14, 18, 30, 80, 200)) + [(k, t) for k, t, *_ in EDGE if t != LONG]
    monkeypatch.setattr(jaccard_join, "BLOCK", 2000)          # many blocks: frequent n-grams go last
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(df, n, num, den).collect())
    assert got == plain_components(rows, n, num, den)


def test_jaccard_lists_name_a_class_once(spark):
    rows = [(k, t) for _ in range(4) for k, t in near_copies(6, 6, 4, (9, 40, 90))]        # exact copies in every task
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(4)
    light, none = 10, (np.zeros(0, np.uint64), np.zeros(0, np.int8))
    prefixes = jaccard_join._prefixes(df, 5, 80, 100, light, none)
    lists = jaccard_join._with_hub(prefixes, light)
    assert prefixes.count() > prefixes.select("node").distinct().count()
    assert lists.count() == lists.select("gram", "node", "place").distinct().count() > 0
    assert lists.groupBy("gram").agg(F.countDistinct("node").alias("c"), F.countDistinct("hub").alias("h")).filter("c < 2 or h != 1").count() == 0
    plain = {}
    for r in prefixes.collect():
        for g in r.grams:
            plain.setdefault(g, set()).add(bytes(r.node))
    assert {(r.gram, bytes(r.node)) for r in lists.collect()} == {(g, x) for g, nodes in plain.items() if len(nodes) > 1 for x in nodes}


@pytest.fixture(scope="module")
def postings(spark):
    """Prefixes of families of near copies that share some words, with most n-grams called frequent."""
    rows = [(k, f"{t} these words stand in all of them {'at the end' if k % 2 else 'too'}")
            for _ in range(3) for k, t in near_copies(6, 8, 5, (9, 40, 90))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(4)
    grams = np.unique(np.concatenate([jaccard_join.Shingler(5)(t.encode()) for _, t in rows]))
    often = grams[grams % np.uint64(10) < 9]
    return jaccard_join._prefixes(df, 5, 80, 100, 10, (often, np.ones(len(often), np.int8)))


def test_jaccard_lists_come_in_parts(spark, postings, monkeypatch):
    """The parts are the whole, none holds most of it, and the join writes them one after another."""
    def rows(df):
        return sorted((r.gram, bytes(r.node), r.n, r.place, r.central, r.often, r.more, bytes(r.hub.node)) for r in df.collect())
    whole, own = rows(jaccard_join._with_hub(postings, 10)), jaccard_join._classes(postings, 10)
    parts = [rows(jaccard_join._with_hub(postings, 10, own, p)) for p in range(jaccard_join.PARTS)]
    assert sorted(x for p in parts for x in p) == whole and {x[5] for x in whole} == {True, False}
    assert max(len({x[0] for x in p}) for p in parts) < 0.5 * len({x[0] for x in whole})
    labels, write = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, label, **o: labels.append(label) or write(df, label, **o))
    jaccard_join.join(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string"))
    assert labels == ["lists"] * jaccard_join.PARTS


def test_jaccard_second_round_leaves_pairs_of_hubs(spark, postings):
    """Only lists whose members besides the hub are of several components go on, without the hub."""
    lists = jaccard_join._with_hub(postings, 10)
    nodes = sorted({bytes(r.node) for r in lists.select("node").distinct().collect()})
    random.seed(4)
    root = {x: random.choice(nodes[:3]) if random.random() < 0.6 else x for x in nodes}
    root |= {x: x for x in nodes[:3]}
    roots = spark.createDataFrame([(x, y) for x, y in root.items() if x != y], "node binary, root binary")
    members = {}
    for r in lists.filter("place >= 0").collect():
        members.setdefault((r.gram, bytes(r.hub.node)), set()).add((bytes(r.node), r.n, r.place))
    want = {(g, x, n, p, root[x], root[hub]) for (g, hub), of in members.items()
            if len({root[x] for x, *_ in of if x != hub}) > 1 for x, n, p in of if x != hub}
    got = {(r.gram, bytes(r.node), r.n, r.place, bytes(r.root), bytes(r.hub_root))
           for r in jaccard_join._still_mixed(lists, roots).collect()}
    assert got == want and 0 < len({x[0] for x in got}) < len(members)
    assert any(len(of) == 2 for of in members.values()) and lists.filter("often").count() > 0


def test_boundary_follows_cost():
    assert jaccard_join.boundary({}, 85, 100) == jaccard_join.MOST_LIGHT
    many = {s: 1000 for s in range(1, 25)}
    b = jaccard_join.boundary(many, 85, 100)
    assert 6 <= b < jaccard_join.MOST_LIGHT
    assert jaccard_join.deletions(6, 85, 100) == 0 and jaccard_join.deletions(7, 85, 100) == 1


def test_jaccard_keeps_one_of_each(spark, edge):
    rows = near_copies(3, 8, 6, (40, 90)) + [(800, "a b c d e f"), (800, "a b c d e f"), (None, "a b c d e f"), (None, "alone is this row"), (900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard_join.one_of_each(df).collect()
    groups = {c for _, size, c in plain_components(rows, 5, 80, 100) if size}
    assert len([r for r in kept if (r.text or "").split()]) == len(groups)
    assert sum(not (r.text or "") for r in kept) == 2
    out = jaccard_join.one_of_each(edge)
    assert out.columns == edge.columns and jaccard_join.one_of_each(empty_like(edge)).count() == 0


def test_components(spark):
    random.seed(8)
    links = [(f"{a:03}", f"{b:03}") for a, b in ((random.randrange(120), random.randrange(120)) for _ in range(90))] + [("200", f"{i}") for i in range(201, 240)]
    links += [(f"{i}", f"{i + 1}") for i in range(300, 340)]
    at = {}

    def root(x):
        while at.get(x, x) != x:
            x = at[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    nodes = {x for e in links for x in e}
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {x: root(x) for x in nodes if root(x) != x}
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


# ---- nearest neighbours -------------------------------------------------------------
def test_nearest_recall_ties_and_bad_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 16))
    x[100:200] = x[0]                                          # a large group of equal vectors
    x[300] = 2 * x[301]
    rows = [(i, v.astype(np.float32).tolist(), "x", 0) for i, v in enumerate(x)]
    rows += [(1000, None, "x", 0), (1050, [0.0] * 16, "x", 0), (1100, [float("nan")] * 16, "x", 0), (1150, [1.0, None] + [0.0] * 14, "x", 0),
             (1200, [1.0], "x", 0), (None, [1.0] * 16, "x", 0), (1250, [], "x", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string, score int")
    got = nearest.nearest(df, F.col("vec_id") % 50 == 0).collect()
    x = x.astype(np.float32).astype(float)
    norm = np.linalg.norm(x, axis=1)
    hits = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by) == list(range(0, 600, 50))
    for q, found in by.items():
        s = x @ x[q] / norm / norm[q]
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - score) < 1e-12 for _, v, score in found)
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-round(s[i], 12), i))[:5]
        hits += len(set(order) & {v for _, v, _ in found})
    assert hits >= 0.9 * 5 * len(by)
    assert [v for _, v, _ in sorted(by[150])] == [0, 100, 101, 102, 103]


def test_nearest_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest.nearest(few, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 2), (0, 2, 1)]
    assert nearest.nearest(few.limit(0), F.lit(True)).count() == 0
    assert nearest.nearest(few.limit(1), F.lit(True)).count() == 0


# ---- language -----------------------------------------------------------------------
def test_language(small, spark):
    from conftest import SMALL
    truth = {r.doc_id: r for r in small.collect()}
    rows = language.query(spark, SMALL).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(edge):
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(edge.select("doc_id", "text", "lang")).collect()]
    assert len(got) == len(EDGE)
    assert all(p == "und" and s == 0 for k, p, s in got if k in (1, 2, 3, 10))
    assert all(p in ("en", "fr") for k, p, s in got if k in (4, 6, 8, 9))
    out = language.recognised(edge)
    assert out.columns == edge.columns and {r.doc_id for r in out.collect()}.isdisjoint({1, 2, 3, 10})
    assert language.identify(empty_like(edge).select("doc_id", "text", "lang")).count() == 0
    unknown = language.identify(edge.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))).collect()
    assert all(r.lang_pred == "und" for r in unknown)


def test_language_scores_do_not_depend_on_blocks(monkeypatch):
    texts = ["Ein kurzer Text.", "a" * 50, "x y z " * 40, None, "été"]
    rng = np.random.default_rng(1)
    scorer = language.Scorer(["a", "b", "c"], rng.standard_normal((1 << 10, 3)), np.zeros(3))
    whole = scorer.score(texts)
    monkeypatch.setattr(language, "BLOCK", 21)
    parts = scorer.score(texts)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])
    codes = language._codes(texts[0])
    total = sum(scorer.matrix[language._hashed(codes, n, 1 << 10)].sum(axis=0) for n in language.ORDERS)
    p = np.exp(total - total.max())
    assert math.isclose(whole[1][0], p.max() / p.sum())


# ---- substring dedup ----------------------------------------------------------------
def test_line_dedup_cuts_repeats_only(spark):
    passage = "This long passage has a start. It goes on for a while with many words in it. Short one. And it ends after some more words here."
    rows = [(1, f"Alpha beta gamma {passage} delta epsilon zeta.\nA line that only this document has inside of it."),
            (2, f"{passage}\nSomething else altogether stands in this second text."), (3, f"before it {passage} after it\n{passage}"),
            (4, "A clean text. It shares nothing with others, short or long."), (4, "Another clean text of the same id, it stays as it is."),
            (None, f"no id {passage}"), (5, None), (6, ""), (7, "a line of five words\nx\na line of five words"), (8, "x\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = {(r.doc_id, r.n_removed > 0): r for r in line_dedup.dedup(df).collect()}
    text = {(k, i): t for i, (k, t) in enumerate(rows)}
    assert (1, False) in got and got[(1, False)].text == rows[0][1]
    for k in (2, 3, None):
        r = got[(k, True)]
        original = next(t for kk, t in rows if kk == k)
        cut = "".join(original[int(a):int(b)] for a, b in (s.split(":") for s in r.removed.split(",")))
        assert cut.replace(" ", "") == passage.replace(" ", "") * (2 if k == 3 else 1)
        assert len(cut) == r.removed_chars and "passage" not in r.text
    assert got[(2, True)].text == "Something else altogether stands in this second text."
    assert got[(7, True)].text == "a line of five words\nx" and (4, True) not in got and (8, True) not in got
    assert got[(5, False)].text is None and got[(6, False)].text == ""
    assert len(text) == len(rows)


def plain_cuts(words):
    """Starts of sentences, and in long ones the words whose pair hash is the first least of five on either side."""
    import xxhash
    factor, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    h = [xxhash.xxh3_64_intdigest(w.lower().encode()) for w in words]
    pair = []
    for i in range(len(words)):
        x = (h[i] * factor + h[i - 1]) & mask
        pair.append(((x ^ (x >> 29)) * factor) & mask if i else mask)
    starts = [i for i in range(1, len(words)) if words[i - 1][-1] in ".!?" or (words[i][0].isupper() and not words[i][1:2].isupper())]
    bounds = [0, *starts, len(words)]
    cuts = set(bounds)
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a + 1, b if b - a > 20 else a):
            near = [pair[j] if 0 <= j < len(words) else mask for j in range(i - 5, i + 6)]
            if near.index(min(near)) == 5:
                cuts.add(i)
    return sorted(cuts)


def plain_units(text):
    """(start, end, words, whole line, text) of lines and their pieces, for texts written with blanks."""
    at = 0
    for line in text.split("\n"):
        found = [(m[0], at + m.start(), at + m.end()) for m in WORDS.finditer(line)]
        if found:
            cuts = plain_cuts([w for w, _, _ in found])
            spans = [(0, len(found), True)] if len(found) >= 5 or len(cuts) == 2 else []
            for a, b, whole in spans + ([(a, b, False) for a, b in zip(cuts, cuts[1:])] if len(cuts) > 2 else []):
                yield found[a][1], found[b - 1][2], b - a, whole, " ".join(w for w, _, _ in found[a:b]).lower()
        at += len(line) + 1


def test_line_dedup_equals_brute_force(small):
    """Keepers, runs of repeated pieces and spans, all restated plainly: a word goes if its piece or line
    repeats, in stretches of ten words or in a repeated line of five."""
    rows = [(r.doc_id, r.text) for r in small.collect()
            if all(sum(map(len, x.split())) <= 20 * len(x.split()) for x in (r.text or "").split("\n"))]
    keeper = {}
    for k, t in sorted(rows):
        for start, _, _, _, unit in plain_units(t or ""):
            keeper.setdefault(unit, (k, start))
    want = {}
    for k, t in rows:
        gone = [u for u in plain_units(t or "") if keeper[u[4]] != (k, u[0])]
        starts = {m.start(): n for n, m in enumerate(WORDS.finditer(t or ""))}
        ends = [m.end() for m in WORDS.finditer(t or "")]
        marked = sorted({i for s, e, *_ in gone for i in range(starts[s], ends.index(e) + 1)})
        whole = {i for s, e, n, line, _ in gone if line and n >= 5 for i in range(starts[s], ends.index(e) + 1)}
        stretches = []
        for i in marked:
            if stretches and stretches[-1][-1] == i - 1:
                stretches[-1].append(i)
            else:
                stretches.append([i])
        cut = sorted({i for x in stretches for i in x if len(x) >= 10 or i in whole})
        want[k] = set(cut)
    got = {}
    for r in line_dedup.dedup(small).collect():
        spans = [tuple(map(int, x.split(":"))) for x in r.removed.split(",") if x]
        got[r.doc_id] = {n for n, m in enumerate(WORDS.finditer(next((t for k, t in rows if k == r.doc_id), None) or ""))
                         if any(s <= m.start() < e for s, e in spans)}
    assert all(got[k] == want[k] for k, _ in rows) and sum(map(bool, want.values())) > 10


def test_line_dedup_finds_repeats_inside_sentences(spark):
    words = [f"word{i * 7919 % 1000}" for i in range(60)]
    run = " ".join(words)
    han = "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(80))
    rows = [(1, f"An old text has {run} and one end"), (2, f"quite another start, then {run} but not that other end"),
            (3, f"first half on\nits own line {' '.join(words[:30])}\n{' '.join(words[30:])} last"),
            (4, f"\u7532\u4e59{han}\u3002"), (5, f"\u4e19{han}\u4e01\u620a"), (6, "\u4f60\u597d"), (7, "\u4f60\u597d"),
            (8, "it has " + " ".join(words[5:14]) + " only")]
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == got[4].n_removed == got[6].n_removed == got[7].n_removed == got[8].n_removed == 0
    for k, ends in ((2, 2), (3, 4)):                  # what stays: less than a piece at each end of a run
        left = got[k].text.split()
        assert sum(w in words for w in left) <= ends * line_dedup.LONGEST // 2
        assert [w for w in left if w not in words] == [w for w in rows[k - 1][1].split() if w not in words]
    assert len(got[5].text) < 50 and got[5].text[0] == "\u4e19" and got[5].text.endswith("\u4e01\u620a")


def test_line_dedup_makes_units_once(small):
    """The groups of the digests and the join that finds their places read stored units."""
    plan = line_dedup.repeated_spans(small.select("doc_id", "text"), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "MapInArrow" not in plan


def test_line_dedup_without_counts_lines():
    text = "one two\nthree four\nfive six\nseven"
    assert line_dedup.without(text, [(8, 27)]) == "one two\nseven"
    assert line_dedup.without(text, [(4, 13), (28, 33)]) == "one  four\nfive six"


def test_line_dedup_edges(edge):
    out = line_dedup.dedup(edge).collect()
    assert len(out) == len(EDGE)
    assert line_dedup.dedup(empty_like(edge)).count() == 0


# ---- co-training --------------------------------------------------------------------
def test_cotraining(spark, edge):
    from conftest import SMALL
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    got = {r.doc_id: r for r in cotraining.classify(docs, half).collect()}
    rest = labels.join(half, "doc_id", "left_anti").collect()
    assert len(got) == docs.count()
    assert np.mean([got[r.doc_id].kept == (r.quality == 1) for r in rest]) >= 0.97
    assert np.mean([got[r.doc_id].kept for r in rest if r.quality == 1]) >= 0.98
    none = cotraining.classify(edge, half.filter("quality = 1"))
    assert none.filter("not kept or score is not null").count() == 0 and none.count() == len(EDGE)
    some = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, 0), (7, 0), (8, 1), (9, 1), (10, 0), (2, 0)], "doc_id long, quality int")
    assert cotraining.classify(edge, some).count() == len(EDGE)
    assert cotraining.classify(empty_like(edge), some).count() == 0


def test_cotraining_hands_on_from_all_documents(spark):
    odds = np.zeros(cotraining.BUCKETS)
    for word, w in (("good", 3.0), ("bad", -3.0)):
        odds[cotraining.bucket("word", word)] = w
    rows = [(i, " ".join(["good" if i % 2 else "bad"] * (1 + i % 7)), "a", "en", i) for i in range(4000)]
    free = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(7)
    free = free.withColumn("key", F.col("doc_id")).unionByName(free.withColumn("key", F.col("doc_id")).limit(50))
    fits = {"text": np.array([4.0, 0.0]), "meta": np.array([0.0, 0.0])}
    keys = {"text": set(), "meta": set()}
    for _ in range(4):  # every round finds as many new ones, beyond any window
        got = cotraining.surest(free, {"text": odds, "meta": odds * 0}, fits, keys, 400, 0.97).collect()
        assert {r.teacher for r in got} == {"text"} and all(r.key % 2 == r.label for r in got)
        assert [sum(r.label == y for r in got) for y in (0, 1)] == [400, 400]
        new = {r.key for r in got}
        assert len(new) == 800 and not new & keys["meta"]
        keys["meta"] |= new
