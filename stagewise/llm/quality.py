"""Quality rules with host-level verdicts (operator 3).

Per document: counts over its whole text and four rules on them. Per host:
failures of every rule, aggregated before any shuffle of rows; the failure
rate of a host is shrunk towards a beta prior fitted to all hosts by moments
(few documents: near the corpus rate; many: near the host's own rate). A host
fails when a shrunk rate is over its limit, and its verdict is joined back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, packed, ship, stored

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("short", "repeated", "symbols", "dup_lines")


@dataclass(frozen=True)
class HostLimits:
    """A host fails when its shrunk failure rate of a rule is over ``rates[rule]``.

    ``min_strength``/``max_strength`` bound alpha + beta of the fitted prior.
    """

    rates: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, 0.6))
    min_strength: float = 2.0
    max_strength: float = 1e6


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; null and empty texts: all 0."""
    if not text:
        return (0,) * len(COUNTS)
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def repeat_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    base = len(known)
    pairs = ids[:-2] * base + ids[1:-1]
    if base > 2_000_000:  # three ids would not fit one 64-bit key
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs * base + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


_COUNTED = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


@F.arrow_udf(_COUNTED)
def _counts(texts: pa.Array) -> pa.Array:
    found = [text_counts(x.as_py()) for x in texts]
    cols = list(zip(*found, strict=True)) or [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(COUNTS))


def with_counts(docs: DataFrame) -> DataFrame:
    """``row`` (the input's columns) and COUNTS of ``row.text``; Python gets the text alone, Spark keeps the row."""
    ship(docs.sparkSession)
    rows = packed(docs)
    return rows.select("row", _counts("row.text").alias("_counts")).select("row", "_counts.*")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failures() -> dict[str, Column]:
    """Whether a document fails each rule."""
    return {
        "short": F.col("n_words") < 50,
        "repeated": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def host_verdicts(counted: DataFrame, host: str, limits: HostLimits) -> DataFrame:
    """``host``, ``n_docs``, ``rate_<rule>`` (shrunk) and ``host_failed`` of every host.

    The prior of a rule has the corpus failure rate m as mean; its strength
    follows from the variance of the hosts' rates beyond binomial noise. The
    fit is one row of sums over hosts, the only thing the driver reads.
    """
    fails = rule_failures()
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in fails.items()]
    )
    sums = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.count(F.lit(1)).alias("h"),
        *[F.sum(f"f_{r}").alias(f"f_{r}") for r in RULES],
        *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"s_{r}") for r in RULES],
    ).first()
    out = hosts
    failed = F.lit(False)
    for r in RULES:
        alpha, beta = beta_prior(sums["n"] or 0, sums["h"], sums[f"f_{r}"] or 0, sums[f"s_{r}"] or 0.0, limits)
        rate = (F.col(f"f_{r}") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
        out = out.withColumn(f"rate_{r}", rate)
        failed = failed | (F.col(f"rate_{r}") > F.lit(limits.rates[r]))
    return out.withColumn("host_failed", failed).drop(*[f"f_{r}" for r in RULES])


def beta_prior(n: int, hosts: int, failures: int, square: float, limits: HostLimits) -> tuple[float, float]:
    """Alpha and beta by moments: ``square`` is the sum over hosts of failures**2 / documents."""
    if not n:
        return 1.0, 1.0
    mean = min(max(failures / n, 0.5 / n), 1 - 0.5 / n) if n > 1 else 0.5
    noise = mean * (1 - mean) * hosts / n
    between = square / n - (failures / n) ** 2 - noise
    strength = mean * (1 - mean) / between - 1 if between > 0 else limits.max_strength
    strength = min(max(strength, limits.min_strength), limits.max_strength)
    return mean * strength, (1 - mean) * strength


def judged(docs: DataFrame, host: str = "source", limits: HostLimits | None = None, carry: bool = False) -> DataFrame:
    """Documents with COUNTS, ``base_failed``, ``host_failed``, the host's shrunk ``rate_<rule>`` and ``kept``.

    ``carry`` keeps the whole input row in ``row``; else only ``doc_id`` and
    the host are carried (no text is written or shuffled). Null host: one host
    of its own. Null and empty texts have no words and fail. Equal rows are
    judged alike, each on its own. An empty table gives an empty result.
    """
    limits = limits or HostLimits()
    counted = with_counts(docs if carry else docs.select("doc_id", F.col(host), "text"))
    wanted = [F.col("row")] if carry else [F.col("row.doc_id").alias("doc_id")]
    counted = stored(counted.select(*wanted, F.col(f"row.{host}").alias("_host"), *COUNTS), "quality")
    # Stored, so that Spark knows its size: a small one is broadcast and no text is shuffled.
    hosts = stored(host_verdicts(counted, "_host", limits).drop("n_docs"), "host-verdicts")
    out = counted.join(hosts, counted["_host"].eqNullSafe(hosts["host"]), "left").drop("host")
    out = out.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def quality_query(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_failed", *[F.round(f"rate_{r}", 6).alias(f"rate_{r}") for r in RULES],
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules and their host's verdict keep, with the input's columns."""
    return judged(docs, carry=True).where("kept").select("row.*")


#: The same rows in SQL; the host part repeats the prior's moments.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), tri AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
    unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS s
  FROM w WHERE len(ws) > 3
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM tri) WHERE c > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id
), f AS (
  SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2,
    10 * n_symbols > n_words AS r3, 10 * n_dup_lines > 3 * n_lines AS r4 FROM c
), h AS (
  SELECT source, r, count(*) AS n, sum(bad) AS f FROM (
    SELECT source, unnest(['a', 'b', 'c', 'd']) AS r, unnest([r1::INT, r2::INT, r3::INT, r4::INT]) AS bad FROM f)
  GROUP BY source, r
), m AS (
  SELECT r, sum(f) / sum(n) AS raw, least(greatest(sum(f) / sum(n), 0.5 / sum(n)), 1 - 0.5 / sum(n)) AS mean,
    sum(f * f / n) / sum(n) AS square, count(*) / sum(n) AS hosts FROM h GROUP BY r
), k AS (
  SELECT r, mean, least(greatest(CASE WHEN square - raw * raw - mean * (1 - mean) * hosts > 0
    THEN mean * (1 - mean) / (square - raw * raw - mean * (1 - mean) * hosts) - 1 ELSE 1e6 END, 2.0), 1e6) AS strength FROM m
), bad AS (
  SELECT source, bool_or(rate > 0.6) AS host_failed,
    max(CASE r WHEN 'a' THEN rate END) AS ra, max(CASE r WHEN 'b' THEN rate END) AS rb,
    max(CASE r WHEN 'c' THEN rate END) AS rc, max(CASE r WHEN 'd' THEN rate END) AS rd
  FROM (SELECT source, h.r, (f + mean * strength) / (n + strength) AS rate FROM h JOIN k ON h.r = k.r) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
  NOT (r1 OR r2) AND NOT host_failed AS kept, host_failed, round(ra, 6) AS rate_short,
  round(rb, 6) AS rate_repeated, round(rc, 6) AS rate_symbols, round(rd, 6) AS rate_dup_lines
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""
