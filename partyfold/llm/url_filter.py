"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A URL's host and path are judged by rules first (the longest rule that fits wins). For what no
rule fits, the list decides: a URL is blocked when its canonical form is listed. The list's
canonical URLs go into a blocked Bloom filter (each sets ``WORDS`` bits, one in every 64-bit word
of a single block), which all pages are held against where they are; only possible hits
take part in the join with the list itself, which removes the false positives.

Canonical form: no scheme, user or fragment; the host in lower case (A-Z) without a leading
``www.``, a last dot and the default ports 80 and 443; the path without slashes at its end; the
parameters of the query sorted, without empty ones and those that only track (``TRACKING``).

Scale: everything is JVM expressions, joins and aggregates. The filter is built by one aggregate
(``bit_or`` per block, combined before the shuffle) and broadcast: it has at most ``max_blocks``
rows of nine longs whatever the list's length (12 MB at the default). A list too long for that
lets more pages through to the exact join and changes no result. Before that join the possible
hits are reduced to distinct canonical URLs, so a URL that very many pages share is one row;
the true hits come back to the pages by a broadcast below a counted size, else by a salted join
of the possible hits alone. Pages are scanned twice, by their URL column only.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is not
listed (verdict allow); so is one with an empty host; repeated rows are judged alike; an empty
list blocks nothing; an empty table gives an empty result; other columns of the input (under
any name) are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .common import picked, stored, table

#: 64-bit words of a block of the filter.
WORDS = 8
#: Broadcast of true hits: bytes of their URLs up to which it is used.
HIT_BYTES = 16_000_000
#: Parameters that only track where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|\z)"
#: (verdict, host, path): a rule holds for its host and all subdomains, where the path begins like the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The canonical form (above), null where the URL has no host."""
    host = F.regexp_replace(host_of(url), r"(?s)^.*@", "")
    host = F.regexp_replace(host, r":(80|443)?\z", "")
    host = F.regexp_replace(F.regexp_replace(host, r"\.\z", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                       .otherwise(F.lit(""))))


def rule_text(host: str, path: str) -> str:
    return host + path


def by_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, ties to the smaller text; null where none does.
    The rules are a parameter of the job: a short list that becomes part of the expression."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (-len(rule_text(*r[1:])), rule_text(*r[1:])), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(rule_text(h, p))).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _bits(key: Column) -> list[Column]:
    """One bit for each word of a block."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _w0.._w7): the filled blocks of the filter of ``keys``."""
    return (keys.select(_block(F.col(key), blocks).alias("_block"), *[b.alias(f"_w{i}") for i, b in enumerate(_bits(F.col(key)))])
            .groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)]))


def with_possible(rows: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """``rows`` and ``possible``: whether the filter lets the key through (false for a null key)."""
    found = rows.withColumn("_at", _block(F.col(key), blocks)).join(
        F.broadcast(filter_blocks.withColumnRenamed("_block", "_at")), "_at", "left")
    hit = F.col(key).isNotNull()
    for i, b in enumerate(_bits(F.col(key))):
        hit = hit & (F.coalesce(F.col(f"_w{i}"), F.lit(0)).bitwiseAND(b) != 0)
    return found.select(*rows.columns, hit.alias("possible"))


def listed_keys(listed: DataFrame, url: str = "url") -> DataFrame:
    """The distinct canonical URLs of a list, stored."""
    return stored(listed.select(canonical(F.col(url)).alias("key")).filter("key is not null").distinct(), "url-list")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, bits_per_url: int = 16,
          max_blocks: int = 1 << 17, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, possible (the filter let it through),
    listed (its canonical URL is on the list, whether a rule decides or not)."""
    keys = listed_keys(listed, listed_col)
    count = keys.count()
    blocks = min(max_blocks, max(1, -(-count * bits_per_url // (64 * WORDS))))
    rows = picked(pages, page_id=id_col, url=url_col).select("page_id", "url", canonical(F.col("url")).alias("key"))
    probed = with_possible(rows, "key", stored(bloom_blocks(keys, "key", blocks), "url-bloom"), blocks)
    # the exact join: distinct possible hits against the list
    hits = stored(probed.filter("possible").select("key").distinct().join(keys, "key", "left_semi"), "url-hits")
    total = hits.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))).first()[0]
    hits = hits.withColumn("_hit", F.lit(True))
    if total <= HIT_BYTES:
        key = F.when(F.col("possible"), F.col("key"))
        judged = probed.withColumn("key", key).join(F.broadcast(hits), "key", "left")
    else:
        inside = salted_join(probed.filter("possible"), hits, ["key"], "left", salt_from=["page_id"])
        judged = inside.unionByName(probed.filter(~F.col("possible")), allowMissingColumns=True)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    on_list = F.coalesce(F.col("_hit"), F.lit(False))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    return (judged.select("page_id", host.alias("host"), path.alias("path"), "possible", on_list.alias("listed"))
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "possible", "listed"))


def query(spark, sf_dir: str) -> DataFrame:
    """All pages. The list is a stand-in in the form such lists have (raw URLs): those of the pages that share
    their number with a document labelled toxic."""
    pages = table(spark, sf_dir, "pages")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.select("page_id", "url").join(toxic, "page_id", "left_semi")
    return judge(pages, listed).drop("possible")


#: The same rows for DuckDB, by plain membership in the list.
SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS rest
  FROM pages),
h AS (
  SELECT page_id, rest, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
c AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':(80|443)?\z', ''), '\.\z', ''), '^www\.', '') AS plain,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|\z)'))) AS params
  FROM h),
k AS (
  SELECT page_id, host, path, CASE WHEN plain <> '' THEN plain || regexp_replace(path, '/+\z', '')
         || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key
  FROM c),
r AS (
  SELECT k.*, key IS NOT NULL AND key IN (SELECT key FROM k WHERE key IS NOT NULL AND page_id IN
                                          (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS listed,
         CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM k)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
