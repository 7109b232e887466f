"""Source divergence audit by a minimal-perfect-hash recount (operator 13).

How far the word use of a source is from that of the other sources of its
language, and by which terms. First pass: in how many documents of a language
each term is, exactly; rare ones go. The kept terms of a language are dealt to
shards by hash and every shard gets a minimal perfect hash that stores its
keys. Second pass: with the shards broadcast (a round of bounded size at a
time), tasks count every occurrence in dense slots of its group (language,
source); a term whose stored key differs is none of the kept ones. All that
follows works on slots: shares, divergences between groups in blocks of
sources, and the terms a source has more than its language. Integers only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .perfect_hash import PerfectHash, ShardedHash, build
from .runs import whole_runs

#: A term in UTF-8: letters A-Z, a-z and all characters beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^A-Za-z\x80-\xff]")
#: Shares are 1 + floor(UNIT * (count + 1) / (all counts + terms)): three digits to the base 1000.
UNIT, BASE, DIGITS = 1_000_000_000, 1000, 3


@dataclass(frozen=True)
class Settings:
    """``in_documents``: documents a kept term is in at least. ``ranks``: terms returned for a group.
    ``shard``: terms of a shard, about. ``round_bytes``: bound of what is broadcast at once.
    ``held_terms``, ``held_tokens``: what a task holds before it passes counts on.
    ``block``: sources compared in one unit of work; languages with more are split, not cut.
    ``text_bytes``: a longer text is cut at the next character that is in no term."""

    in_documents: int = 3
    ranks: int = 200
    shard: int = 4096
    round_bytes: int = 64_000_000
    held_terms: int = 300_000
    held_tokens: int = 500_000
    block: int = 64
    text_bytes: int = 1 << 20


def terms_of(raw: bytes | None, s: Settings) -> Iterator[list[bytes]]:
    """The terms of a whole text, A-Z in lower case, in lists of bounded size."""
    at, raw = 0, raw or b""
    while at < len(raw):
        end = len(raw)
        if end - at > s.text_bytes:
            cut = _NO_TERM.search(raw, at + s.text_bytes)
            end = cut.end() if cut else end
        yield TERM.findall(raw[at:end].lower())
        at = end


def cleaned(docs: DataFrame) -> DataFrame:
    """lang, source (null: empty) and text (UTF-8) of every row."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*said, F.col("text").cast("binary").alias("text"))


def kept_terms(rows: DataFrame, s: Settings) -> DataFrame:
    """(lang, term) of the terms in at least ``in_documents`` rows of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        n = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                cols = [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "term", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                own: set[bytes] = set()
                for terms in terms_of(text.as_py(), s):
                    own.update(terms)
                counts = held[lang]
                n -= len(counts)
                counts.update(own)
                n += len(counts)
                if n > s.held_terms:
                    yield from passed_on()
                    n = 0
        yield from passed_on()

    found = rows.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= s.in_documents).drop("n")


def hashed_shards(kept: DataFrame, s: Settings) -> DataFrame:
    """lang, shard, shards (of the language), size, seed, shifts and keys (by slot) of every shard."""
    sizes = kept.groupBy(F.col("lang").alias("_lang")).agg(F.ceil(F.count(F.lit(1)) / s.shard).cast("int").alias("shards"))
    dealt = kept.join(sizes, F.col("lang") == F.col("_lang"))
    dealt = dealt.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "shards", "term")
    order = ("lang", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_runs(batches, order):
            first = table.take(pa.array(starts[:-1]))
            made = [build(table.column("term").slice(a, z - a).to_pylist()) for a, z in zip(starts, starts[1:], strict=False)]
            cols = {
                "lang": first.column("lang").combine_chunks(),
                "shard": first.column("shard").combine_chunks(),
                "shards": first.column("shards").combine_chunks(),
                "size": pa.array([len(m.keys) for m in made], pa.int32()),
                "seed": pa.array([m.seed for m in made], pa.int32()),
                "shifts": pa.array([m.shifts.tolist() for m in made], pa.list_(pa.int64())),
                "keys": pa.array([m.keys.to_pylist() for m in made], pa.list_(pa.binary())),
            }
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    work = dealt.repartition(*order).sortWithinPartitions(*order)
    schema = "lang string, shard int, shards int, size int, seed int, shifts array<long>, keys array<binary>"
    return work.mapInArrow(run, schema)


Hashes = dict[str, ShardedHash]


def rounds(shards: DataFrame, s: Settings) -> Iterator[Hashes]:
    """Perfect hashes of every language that has some in the round; a round is ``round_bytes`` at most, about."""
    size = 8 * F.size("shifts") + F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a + F.length(k) + 8)
    total = shards.agg(F.sum(size)).first()[0] or 0
    n = -(-total * 5 // (s.round_bytes * 4))  # a fifth of room, as shards are dealt by hash
    for k in range(n):
        found: dict[str, tuple[int, dict[int, PerfectHash]]] = {}
        for r in shards.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(n)) == k).toLocalIterator():
            keys = pa.array(r["keys"], pa.large_binary())
            made = PerfectHash(r["seed"], np.array(r["shifts"], np.int64), keys)
            found.setdefault(r["lang"], (r["shards"], {}))[1][r["shard"]] = made
        yield {lang: ShardedHash.of(*x) for lang, x in found.items()}


_COUNTS = "lang string, source string, shard int, slots array<int>, counts array<long>"


def _count_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()))
    cols = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["lang", "source", "shard", "slots", "counts"]
    )


def recounted(rows: DataFrame, hashes: Hashes, s: Settings) -> DataFrame:
    """Counts of every group's slots of a round's shards, as far as one task adds them up: a row for each shard.

    A task's rows are sorted by group, so it holds the slots of one language at a time.
    """
    shared = rows.sparkSession.sparkContext.broadcast(hashes)  # at most ``round_bytes``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        group, slots_of = None, None
        dense, touched = np.zeros(0, np.int64), []
        held, tokens = Counter(), 0
        ready: list[tuple] = []

        def added() -> None:
            """The held terms into the group's slots."""
            nonlocal tokens
            at = slots_of.places(list(held))
            n = np.fromiter(held.values(), np.int64, len(held))
            hit = at >= 0
            dense[at[hit]] += n[hit]  # every term is held once
            touched.append(at[hit])
            held.clear()
            tokens = 0

        def passed_on() -> None:
            at = np.unique(np.concatenate(touched))
            n = dense[at]
            dense[at] = 0
            touched.clear()
            shard = np.searchsorted(slots_of.first, at, "right") - 1  # the last of those that begin there is not empty
            for k in np.unique(shard).tolist():
                own = slice(*np.searchsorted(shard, (k, k + 1)))
                ready.append((*group, k, (at[own] - slots_of.first[k]).astype(np.int32), n[own]))

        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text"), strict=True):
                if group != (lang, source):
                    if slots_of is not None:
                        added()
                        passed_on()
                    if group is None or group[0] != lang:
                        slots_of = known.get(lang)
                        dense = np.zeros(0 if slots_of is None else len(slots_of.keys), np.int64)
                    group = (lang, source)
                if slots_of is None:
                    continue
                for terms in terms_of(text.as_py(), s):
                    held.update(terms)
                    tokens += len(terms)
                    if tokens > s.held_tokens:
                        added()
                if len(ready) >= 64:
                    yield _count_batch(ready)
                    ready = []
        if slots_of is not None:
            added()
            passed_on()
        if ready:
            yield _count_batch(ready)

    return rows.sortWithinPartitions("lang", "source").mapInArrow(run, _COUNTS)


def _count_row(key: tuple[str, str, int], dense: np.ndarray) -> tuple:
    at = np.flatnonzero(dense)
    return (*key, at.astype(np.int32), dense[at])


def merged(counts: DataFrame, by_source: bool) -> DataFrame:
    """One row for each (lang, source, shard), or (lang, shard) with an empty source: rows are added up as they come."""
    if not by_source:
        counts = counts.withColumn("source", F.lit(""))
    order = ("lang", "shard", "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0, np.int64)
        for b in batches:
            slots, n = b.column("slots"), b.column("counts")
            for k, own in enumerate(zip(*(b.column(c).to_pylist() for c in ("lang", "source", "shard")), strict=True)):
                if own != key:
                    if key is not None:
                        yield _count_batch([_count_row(key, total)])
                    key, total = own, np.zeros(0, np.int64)
                at = slots[k].values.to_numpy()
                if len(at) and at[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(int(at[-1]) + 1 - len(total), np.int64)])
                total[at] += n[k].values.to_numpy()
        if key is not None:
            yield _count_batch([_count_row(key, total)])

    work = counts.select("lang", "source", "shard", "slots", "counts").repartition(*order[: 2 + by_source])
    return work.sortWithinPartitions(*order).mapInArrow(run, _COUNTS)


def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * (counts + 1) / whole), exact up to 9 * 10**15: long division to the base 1000."""
    out, rest = np.zeros(np.broadcast(counts, whole).shape, np.int64), counts + 1
    for _ in range(DIGITS):
        digit, rest = np.divmod(rest * BASE, whole)
        out = out * BASE + digit
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _dense(table: pa.Table, k: int, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    slots, counts = table.column("slots")[k], table.column("counts")[k]
    if slots.is_valid:
        out[slots.values.to_numpy()] = counts.values.to_numpy()
    return out


def pair_values(groups: DataFrame, shards: DataFrame, counts: DataFrame, s: Settings) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language that has kept terms.

    A language's sources are dealt to blocks, and each pair of blocks and shard
    is a unit: its rows are at most the sources of two blocks.
    """
    blocks = groups.groupBy(F.col("lang").alias("_lang")).agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"))
    rows = groups.where("terms > 0").join(blocks, F.col("lang") == F.col("_lang")).drop("_lang")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    parts = shards.select(F.col("lang").alias("_lang"), "shard", "size")
    rows = rows.join(parts, F.col("lang") == F.col("_lang")).drop("_lang")  # every source meets every shard, seen there or not
    own = counts.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("shard").alias("_shard"), "slots", "counts")
    same = (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source")) & (F.col("shard") == F.col("_shard"))
    rows = rows.join(own, same, "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "lang", "shard", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).alias("second"), "source", "size", (F.col("total") + F.col("terms")).alias("whole"), "slots", "counts",
    )
    order = ("lang", "shard", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_runs(batches, order):
            for a, z in zip(starts.tolist(), starts[1:].tolist(), strict=False):
                one = table.slice(a, z - a)
                size, whole = one.column("size")[0].as_py(), one.column("whole").to_numpy()
                p = shares(np.stack([_dense(one, k, size) for k in range(z - a)]), whole[:, None])
                cross = one.column("i")[0].as_py() != one.column("j")[0].as_py()
                second = one.column("second").to_numpy()
                source, ids = one.column("source").combine_chunks(), np.arange(z - a)
                x, y, value = [], [], []
                for k in range(z - a):
                    others = ids[second != second[k]] if cross else ids[ids != k]
                    x.append(np.full(len(others), k))
                    y.append(others)
                    value.append(divergence(p[k], p[others]).sum(1))
                x, y, value = (np.concatenate(v) for v in (x, y, value))
                lang = pa.array([one.column("lang")[0].as_py()] * len(x), pa.string())
                cols = [lang, source.take(pa.array(x)), source.take(pa.array(y)), pa.array(value, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "item", "value"])

    work = rows.repartition(*order).sortWithinPartitions(*order)
    parts = work.mapInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(groups: DataFrame, shards: DataFrame, counts: DataFrame, s: Settings) -> DataFrame:
    """(lang, source, item, value) of at least the first ``ranks`` terms that a group has more than its language."""
    of_lang = stored(merged(counts, by_source=False), "audit-languages")
    whole = groups.groupBy(F.col("lang").alias("_l")).agg(F.sum("total").alias("lang_total"))
    of_lang = of_lang.select(F.col("lang").alias("_lang"), F.col("shard").alias("_shard"), F.col("counts").alias("lang_counts"))
    sums = groups.join(whole, F.col("lang") == F.col("_l")).select(
        F.col("lang").alias("_l"), F.col("source").alias("_s"),
        (F.col("total") + F.col("terms")).alias("whole"), (F.col("lang_total") + F.col("terms")).alias("lang_whole"),
    )
    rows = counts.join(sums, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s"))).drop("_l", "_s")
    rows = rows.join(of_lang, (F.col("lang") == F.col("_lang")) & (F.col("shard") == F.col("_shard"))).drop("_lang", "_shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, slots, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for k in range(b.num_rows):
                own, n, all_ = (b.column(c)[k].values.to_numpy() for c in ("slots", "counts", "lang_counts"))
                p, q = shares(n, b.column("whole")[k].as_py()), shares(all_[own], b.column("lang_whole")[k].as_py())
                own, f = own[p > q], divergence(p, q)[p > q]
                if len(f) > s.ranks:  # ties of the last rank stay
                    first = f >= np.partition(f, -s.ranks)[-s.ranks]
                    own, f = own[first], f[first]
                for c, v in zip((at, slots, values), (np.full(len(f), k), own, f), strict=True):
                    c.append(v)
            at, slots, values = (np.concatenate(c) for c in (at, slots, values))
            cols = [b.column(c).take(pa.array(at)) for c in ("lang", "source", "shard")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(slots), pa.array(values)], names=["lang", "source", "shard", "slot", "value"])

    found = rows.mapInArrow(run, "lang string, source string, shard int, slot int, value long")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    found = found.withColumn("_rank", F.rank().over(by_value)).where(F.col("_rank") <= s.ranks).drop("_rank")
    terms = shards.select(F.col("lang").alias("_lang"), F.col("shard").alias("_shard"), F.posexplode("keys").alias("_slot", "term"))
    same = (F.col("lang") == F.col("_lang")) & (F.col("shard") == F.col("_shard")) & (F.col("slot") == F.col("_slot"))
    return found.join(terms, same).select("lang", "source", F.col("term").cast("string").alias("item"), "value")


def audited(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: see the contract of ``op13``.

    Null text, lang and source count as empty ones; repeated rows are documents
    of their own. Every group that occurs gets its pairs, with value 0 if the
    language keeps no term; a language with one source has none. Ties go to the
    item that is smaller in UTF-8. An empty table gives no rows. Texts of any
    length are read whole, in pieces.
    """
    s = settings or Settings()
    ship(docs.sparkSession)
    rows = cleaned(docs)
    shards = stored(hashed_shards(kept_terms(rows, s), s), "audit-shards")
    counts = None
    for hashes in rounds(shards, s):
        part = stored(recounted(rows, hashes, s), "audit-recount")
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = docs.sparkSession.createDataFrame([], _COUNTS)
    counts = stored(merged(counts, by_source=True), "audit-counts")
    groups = stored(_group_sums(rows, shards, counts), "audit-groups")
    bare = groups.where("terms = 0").select("lang", "source")
    others = bare.select(F.col("lang").alias("_lang"), F.col("source").alias("item"))
    zero = bare.join(others, (F.col("lang") == F.col("_lang")) & (F.col("source") != F.col("item")))
    pairs = pair_values(groups, shards, counts, s).unionByName(
        zero.select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    )
    terms = term_values(groups, shards, counts, s)
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= s.ranks))


def _group_sums(rows: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, total (occurrences of kept terms) and terms (kept ones of the language) of every group."""
    n: Column = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = counts.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum(n).alias("total"))
    terms = shards.groupBy(F.col("lang").alias("_lang")).agg(F.sum("size").cast("long").alias("terms"))
    groups = rows.select("lang", "source").distinct()
    groups = groups.join(totals, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
    groups = groups.join(terms, F.col("lang") == F.col("_lang"), "left")
    zero = F.lit(0).cast("long")
    return groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"))


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit_query(docs: DataFrame) -> DataFrame:
    return audited(docs.select("text", "lang", "source"))


#: The same rows in SQL.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), lc AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL
), g AS (
  SELECT x.lang, x.source, coalesce(y.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) x
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) y ON x.lang = y.lang AND x.source = y.source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + CAST((1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + v.v) AS BIGINT) AS p
  FROM g JOIN v ON g.lang = v.lang JOIN kept ON g.lang = kept.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT lc.lang, lc.term, 1 + CAST((1000000000::HUGEINT * (lc.n + 1)) // (t.total + v.v) AS BIGINT) AS q
  FROM lc JOIN v ON lc.lang = v.lang JOIN (SELECT lang, sum(n) AS total FROM lc GROUP BY lang) t ON t.lang = lc.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), terms AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pairs.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM terms
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
