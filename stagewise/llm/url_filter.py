"""URL filter (operator 1), DataFrame functions only.

Two parts give a verdict. Rules (host and path prefix, longest wins) decide
first. Other urls are looked up among listed canonical urls: a blocked Bloom
filter (one 256-bit block per key, eight bits set in it) passes possible hits
to an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: A page on a host with one of these name parts puts its canonical url on the list.
LISTED_HOSTS = r"(^|[.-])(spam|pills|bets|ads)([.-]|$)"

#: A doorway page, with at most this many links in its html, does so too, whatever its host.
DOORWAY_LINKS = 4

#: Query parameters that don't change a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

WORDS = 4  # 64-bit words of a block
BITS_A_KEY = 16


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling of the urls of a page: host without ``www.``/``m.`` and default port, path without
    ``index.html`` and trailing slash, other query parameters sorted, no scheme and fragment.

    Null for a null url and one without ``://``.
    """
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)?$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/index\.html?$", "/"), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))
    rest = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, whole)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits; nulls if none does."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("long"))


def _masks(key: Column) -> list[Column]:
    """One 64-bit mask per word of the block, two bits each, from a second hash of the key."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")

    def bit(k: int) -> Column:
        return F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(keys: DataFrame, column: str, n_blocks: int) -> DataFrame:
    """The filter as rows ``block``, ``w0`` .. ``w3``: the masks of a block's keys, combined before the shuffle."""
    key = F.col(column)
    masked = keys.where(key.isNotNull()).select(
        _block(key, n_blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(key))]
    )
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def bloom_hit(key: Column, n_blocks: int) -> tuple[Column, Column]:
    """The block of a key, and whether the words of that block (``w0`` ..) let it pass."""
    passed = F.lit(True)
    for i, m in enumerate(_masks(key)):
        passed = passed & (F.col(f"w{i}").bitwiseAND(m) == m)
    return _block(key, n_blocks), passed


def listed_among(rows: DataFrame, column: str, listed: DataFrame, bits_a_key: int = BITS_A_KEY) -> DataFrame:
    """``rows`` with boolean ``listed``: whether ``column`` is a value of the distinct one-column table ``listed``.

    The filter has ``bits_a_key`` bits for each listed key, far less than the
    keys; Spark broadcasts it when its measured size allows and else joins by
    block. Only rows it passes meet the exact join. Null keys aren't listed.
    """
    (name,) = listed.columns
    n_blocks = max(1, math.ceil(listed.count() * bits_a_key / (64 * WORDS)))
    blocks = bloom_blocks(listed, name, n_blocks).withColumnRenamed("block", "_filter_block")
    key = F.col(column)
    at, passed = bloom_hit(key, n_blocks)
    probed = rows.withColumn("_block", at).join(blocks, F.col("_block") == F.col("_filter_block"), "left")
    probed = probed.withColumn("_possible", F.coalesce(passed & key.isNotNull(), F.lit(False)))
    exact = listed.select(F.col(name).alias("_listed_key"))
    # Rows that the filter rejects get a null key, which no join row meets and no shuffle needs.
    probed = probed.withColumn("_probe", F.when(F.col("_possible"), key))
    sure = probed.where("_possible").join(exact, F.col("_probe") == F.col("_listed_key"), "left")
    out = sure.withColumn("listed", F.col("_listed_key").isNotNull()).unionByName(
        probed.where("NOT _possible").withColumn("_listed_key", F.lit(None).cast("string")).withColumn("listed", F.lit(False))
    )
    return out.drop("_block", "_filter_block", "_possible", "_probe", "_listed_key", *[f"w{i}" for i in range(WORDS)])


def is_doorway(html: Column, links: int = DOORWAY_LINKS) -> Column:
    """Whether a page has at most so many links; one without html (null) is none."""
    return F.coalesce(F.regexp_count(html, F.lit(r"(?i)<a\s")) <= links, F.lit(False))


def listed_urls(pages: DataFrame, hosts: str = LISTED_HOSTS, links: int = DOORWAY_LINKS) -> DataFrame:
    """Distinct canonical urls of all pages on a listed host and of all doorway pages.

    A doorway is known by its ``html``, so the other spellings of its url
    (``www.``, ``m.``, trailing slash, tracking) are caught by the lookup alone.
    A table without that column is judged by hosts.
    """
    url, listed = F.col("url"), url_host(F.col("url")).rlike(hosts)
    if "html" in pages.columns:
        listed = listed | is_doorway(F.col("html"), links)
    return pages.where(listed).select(canonical(url).alias("url")).distinct()


def judged_urls(
    pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, unlisted: str = "allow"
) -> DataFrame:
    """``row`` (the input), ``host``, ``path``, ``canonical``, ``rule``, ``verdict`` and ``listed`` of every page.

    Null urls and urls without ``://`` have empty host and path, fit no rule
    and aren't listed. Repeated rows and urls are judged alike, each on its
    own. Empty tables give empty results; an empty list blocks nothing.
    """
    url = F.col("row.url")
    rows = packed(pages).withColumn("host", url_host(url)).withColumn("path", url_path(url))
    rows = rows.withColumn("canonical", canonical(url)).withColumn("_rule", longest_rule(F.col("host"), F.col("path")))
    out = listed_among(rows, "canonical", listed)
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit(unlisted))
    return out.select(
        "row",
        "host",
        "path",
        "canonical",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), other).alias("verdict"),
        "listed",
    )


def url_filter_query(pages: DataFrame) -> DataFrame:
    listed = stored(listed_urls(pages), "listed-urls")
    return judged_urls(pages.select("page_id", "url"), listed).select(
        F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "canonical", "listed"
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u, url, coalesce(len(regexp_extract_all(html, '(?i)<a\s')) <= 4, false) AS doorway,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
      regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '^(www|m)\.', '')
      || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
      || CASE WHEN rest <> '' THEN '?' || rest ELSE '' END END AS canonical
  FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1, 's'), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&'), '') AS rest FROM p)
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|[.-])(spam|pills|bets|ads)([.-]|$)') OR doorway
), rules AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) r(verdict, host, path)
), fits AS (
  SELECT c.page_id, c.u, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS best
  FROM c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
  GROUP BY 1, 2
)
SELECT c.page_id, c.host, c.path, f.best.rule AS rule,
  coalesce(f.best.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  c.canonical, l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN fits f ON c.page_id = f.page_id AND c.u = f.u LEFT JOIN listed l ON c.canonical = l.canonical
"""


