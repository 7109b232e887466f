"""Near-duplicates by SimHash with Pigeonring filtering (operator 11).

A text's fingerprint has a bit for each place of 64-bit hashes that is set in
over half of the hashes of its word shingles. Two fingerprints link at
``distance`` or fewer differing bits.

The fingerprint is a ring of segments. Pigeonring principle: if two differ in
at most ``distance`` bits, then at some segment a chain starts whose first k
segments differ in at most k * distance / segments bits, for every k. The first
``chain`` segments make the join key: a fingerprint has one key for each start
and each set of bits there in which a partner may differ within the budgets;
the key holds the chain's other bits, and the two partners stand on its two
sides, having each other's values in that set. So all pairs of a viable chain
meet, and no others. Pairs of a bucket must then keep the budgets of the longer
chains, one segment after the other, before the full Hamming check. A bucket
that is too large is split into blocks and every pair of blocks is a unit of
work; a unit returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import components
from .runs import joined_rows, whole_runs

BITS = 64
#: Bits of a key below the number of its pattern.
KEY = 52
#: Shingles hashed, and pairs checked, at a time: bounds a task's memory, however long a text is.
CHUNK = 1 << 16
#: White space to blanks, A-Z to a-z.
_FOLD = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Settings:
    """``chain``: segments in a join key (None: as many as the number of fingerprints calls for; the rows are the same).
    ``task_keys``: keys that one task makes, about.
    ``block``: fingerprints of a bucket compared in one unit of work; larger buckets are split, not cut.
    ``small``: units of at most so many rows are compared together."""

    words: int = 4
    seed: int = 42
    distance: int = 4
    segments: int = 5
    chain: int | None = None
    task_keys: int = 1_000_000
    block: int = 1024
    small: int = 32


@dataclass(frozen=True)
class Ring:
    """Segments as (first bit, width), and ``budgets[k]``: differing bits that a chain of k segments may have."""

    segments: tuple[tuple[int, int], ...]
    budgets: tuple[int, ...]

    @staticmethod
    def of(s: Settings) -> Ring:
        cuts = [BITS * k // s.segments for k in range(s.segments + 1)]
        parts = tuple((a, b - a) for a, b in zip(cuts, cuts[1:], strict=False))
        return Ring(parts, tuple(k * s.distance // s.segments for k in range(s.segments + 1)))

    def width(self, start: int, length: int) -> int:
        return sum(self.segments[(start + k) % len(self.segments)][1] for k in range(length))

    def mask(self, start: int, length: int) -> int:
        """The bits of a chain."""
        out = 0
        for k in range(length):
            low, width = self.segments[(start + k) % len(self.segments)]
            out |= ((1 << width) - 1) << low
        return out

    def patterns(self, start: int, length: int) -> list[int]:
        """The sets of differing bits that a viable chain may have, its first bit being bit 0; the empty set first."""
        found, low = [0], 0
        for k in range(length):
            width = self.width((start + k) % len(self.segments), 1)
            more = []
            for p in found:
                for n in range(1, self.budgets[k + 1] - p.bit_count() + 1):
                    more += [p | sum(1 << low + b for b in bits) for bits in combinations(range(width), n)]
            found += more
            low += width
        return found


def folded(raw: bytes) -> bytes:
    """The words, A-Z in lower case, with one blank between each two."""
    x = np.frombuffer(raw.translate(_FOLD), np.uint8)
    word = x != 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    return x[keep].tobytes().rstrip(b" ")


def fingerprint(raw: bytes | None, s: Settings) -> int:
    """The SimHash of a text in UTF-8, as a signed 64-bit number; 0 for one without words."""
    text = folded(raw or b"")
    if not text:
        return 0
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - s.words)
    starts = np.concatenate([[0], gaps + 1])[:n]
    ends = np.concatenate([gaps, [len(text)]])[-n:]
    ones, hash64 = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        places = zip(starts[k : k + CHUNK].tolist(), ends[k : k + CHUNK].tolist(), strict=True)
        h = np.array([hash64(text[a:b], s.seed) for a, b in places], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id and fp (long) of every row; null text: 0."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), s) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def chain_length(n: int, s: Settings) -> int:
    """The shortest chain of whose keys chance gives less than one for each of n fingerprints (three at most)."""
    ring = Ring.of(s)
    return next((k for k in (1, 2) if n < 1 << ring.width(0, k)), min(3, s.segments))


def chain_keys(fps: DataFrame, s: Settings, length: int) -> DataFrame:
    """(key, right, fp): a row for each fingerprint, start of a chain and pattern of differing bits there.

    ``key >> KEY`` is start * patterns + pattern; partners differ in exactly the
    pattern's bits of the chain and have different ``right`` if there are any.
    """
    ship(fps.sparkSession)
    ring = Ring.of(s)
    patterns = [ring.patterns(k, length) for k in range(s.segments)]
    most = max(map(len, patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            for start, masks in enumerate(patterns):
                low, full = ring.segments[start][0], (1 << ring.width(start, length)) - 1
                x = fp.view(np.uint64)
                x = (x >> np.uint64(low) | x << np.uint64(BITS - low) if low else x) & np.uint64(full)
                step = max(1, (1 << 20) // max(len(x), 1))
                for k in range(0, len(masks), step):
                    w = np.array(masks[k : k + step], np.uint64)[:, None]
                    value, other = x & w, ~x & w
                    tag = np.arange(k, k + len(w), dtype=np.uint64)[:, None] + np.uint64(start * most)
                    key = tag << np.uint64(KEY) | x & ~w | np.minimum(value, other)
                    cols = key.view(np.int64).ravel(), (value > other).ravel(), np.tile(fp, len(w))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "right", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, right boolean, fp long")


def units(keys: DataFrame, s: Settings, most: int) -> DataFrame:
    """(key, i, j, second, right, fp): members of buckets with a possible pair, dealt to the pairs (i, j) of blocks."""
    rights = F.sum(F.col("right").cast("long"))
    sizes = keys.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("n"), rights.alias("r"))
    empty = F.pmod(F.shiftright("_key", KEY), F.lit(most)) == 0
    sizes = sizes.where((F.col("n") > 1) & (empty | ((F.col("r") > 0) & (F.col("r") < F.col("n")))))
    met = keys.join(sizes, F.col("key") == F.col("_key"))
    met = met.withColumn("blocks", F.ceil(F.col("n") / s.block).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).alias("second"), "right", "fp",
    )


def _viable(x: np.ndarray, start: np.ndarray, masks: np.ndarray, budgets: tuple[int, ...], first: int) -> np.ndarray:
    """Places of the differences x whose chains from ``start`` keep the budgets of ``first`` and more segments."""
    at = np.arange(len(x))
    for k in range(first, len(budgets)):
        at = at[np.bitwise_count(x[at] & masks[start[at], k]) <= budgets[k]]
    return at


def _unit_links(table: pa.Table, starts: np.ndarray, s: Settings, length: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of the linked pairs, each pair only in the unit of its first viable start."""
    ring = Ring.of(s)
    masks = np.array([[ring.mask(k, n) for n in range(s.segments + 1)] for k in range(s.segments)], np.uint64)
    fp = table.column("fp").to_numpy().view(np.uint64)
    tag = table.column("key").to_numpy() >> KEY
    right, second = (table.column(c).to_numpy() for c in ("right", "second"))
    cross = table.column("i").to_numpy() != table.column("j").to_numpy()
    begin, plain = tag // most, tag % most == 0
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def check(a: np.ndarray, b: np.ndarray) -> None:
        met = (plain[a] | (right[a] != right[b])) & (~cross[a] | (second[a] != second[b]))
        a, b = a[met], b[met]
        x = fp[a] ^ fp[b]
        at = _viable(x, begin[a], masks, ring.budgets, length + 1)
        a, b, x = a[at], b[at], x[at]
        at = np.flatnonzero((np.bitwise_count(x) <= s.distance) & (x != 0))
        a, b, x = a[at], b[at], x[at]
        sooner = np.zeros(len(a), bool)
        for k in range(s.segments - 1):
            later = np.flatnonzero(begin[a] > k)
            sooner[later[_viable(x[later], np.full(len(later), k), masks, ring.budgets, 1)]] = True
        if not sooner.all():
            found.append((a[~sooner], b[~sooner]))

    size = np.diff(starts)
    end = np.repeat(np.where(size <= s.small, starts[1:], 0), size)  # none of a large unit
    for step in range(1, s.small):
        a = np.flatnonzero(np.arange(step, len(end) + step) < end)
        if not len(a):
            break
        check(a, a + step)
    for low, high in zip(starts[:-1][size > s.small], starts[1:][size > s.small], strict=True):
        rows = np.arange(low, high)
        for k in range(1, len(rows), per := max(1, CHUNK * 4 // len(rows))):
            b = np.arange(k, min(k + per, len(rows)))  # each with all rows before it
            check(np.concatenate([rows[:x] for x in b]), np.repeat(rows[b], b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b


def links(fps: DataFrame, s: Settings) -> DataFrame:
    """(a, b): a spanning forest of the linked pairs of each unit; their union connects just what links connect."""
    n = fps.count()
    length = s.chain or chain_length(n, s)
    ring = Ring.of(s)
    most = max(len(ring.patterns(k, length)) for k in range(s.segments))
    fps = fps.repartition(max(1, -(-n * most * s.segments // s.task_keys)), "fp")  # few bytes, many keys
    order = ("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_runs(batches, order):
            a, b = _unit_links(table, starts, s, length, most)
            root = joined_rows(table.num_rows, a, b)
            who = np.flatnonzero(root != np.arange(len(root)))
            if len(who):
                fp = table.column("fp").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(fp[who]), pa.array(fp[root[who]])], names=["a", "b"])

    keys = stored(chain_keys(fps, s, length), "simhash-keys")
    work = units(keys, s, most).repartition(*order).sortWithinPartitions(*order)
    return stored(work.mapInArrow(run, "a long, b long"), "simhash-links")


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id that links reach) of every row.

    Null and empty texts, and those without words, have fingerprint 0, linked
    like any other. Repeated rows are copies of each other. A null doc_id
    counts only where a component has no other. An empty table: no rows. Other
    columns are not read. Texts of any length are hashed whole, in pieces.
    """
    s = settings or Settings()
    seen = stored(fingerprints(docs.select("doc_id", "text"), s), "simhash-fingerprints")
    classes = stored(seen.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(links(classes, s)).withColumnRenamed("node", "_fp")
    joined = classes.join(roots, F.col("fp") == F.col("_fp")).drop("_fp")
    least = joined.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    moved = joined.join(least, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), F.col("component_id").alias("_id"))
    of = classes.join(stored(moved, "simhash-components"), F.col("fp") == F.col("_fp"), "left")
    of = of.select(F.col("fp").alias("_class"), F.coalesce("_id", "least").alias("component_id"))
    return seen.join(of, F.col("fp") == F.col("_class")).select("doc_id", "fp", "component_id")


def simhash_query(docs: DataFrame) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
