"""Fuzzy line deduplication by MinHash (operator 5).

A line is the set of its overlapping 12-byte shingles. One pass over the texts
makes the signature of every line: each shingle hash falls into one of BINS
bins and the smallest of a bin is kept. The bins lie on a 4 x 4 grid whose
rows, columns and diagonals, four bins each, are the bands. Lines that share a
band meet the exact Jaccard similarity, which decides:
first each line and the first of its bucket, in large buckets some more lines
there, then all pairs of a bucket that these links don't join. Bitmaps of the shingles refuse most pairs that
cannot be similar enough. A large bucket is split into blocks and every pair
of blocks is a unit of work, so no pair is left out. Union-find joins the links
to components and the first occurrence of each component stays.

All steps are DataFrame functions; ``line_bins`` and ``shingle_set`` in numpy
are for comparisons by brute force.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import merged, packed, stored
from .components import components
from .url_filter import BITS_A_KEY, WORDS, bloom_blocks, bloom_hit

BINS = 16
#: Rows, columns and (wrapped) diagonals of the grid of bins: two bands share one bin at most.
BANDS = (
    *[[4 * r + c for c in range(4)] for r in range(4)],
    *[[4 * r + c for r in range(4)] for c in range(4)],
    *[[4 * r + (r + c) % 4 for r in range(4)] for c in range(4)],
)
BLANK = " \t\r\x0b\x0c"
#: The primes of XXH64.
PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
#: Shingles of a row of ``signatures`` and of ``known_lines``.
AT_ONCE = 4
#: Words of a line's bitmap.
MAP = 32
#: Above the hashes of a bin that are put first (see ``signatures``).
ANOTHER = (1 << 60) - (1 << 63)
#: Bytes that ``line_bins`` hashes together.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``hubs``: lines of a bucket of more than ``small`` lines whose pairs are verified first, like those of its first line, as their links make others needless.
    ``block``, ``block_bytes``: lines of a block and their bytes, about; larger buckets are split, not cut.
    ``filter_blocks``: a filter of up to this many 40-byte blocks is broadcast; with more the lines are joined without it."""

    shingle: int = 12
    percent: int = 80
    hubs: int = 4
    small: int = 32
    block: int = 1024
    block_bytes: int = 2_000_000
    filter_blocks: int = 1_000_000


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """XXH64 (seed 42, as ``xxhash64`` of Spark) of each ``width`` bytes, at most 31, in a row of ``data`` (of all its bytes, if fewer)."""
    width = min(width, len(data))
    return _hashed(np.lib.stride_tricks.sliding_window_view(data, width))


def _hashed(rows: np.ndarray) -> np.ndarray:
    """XXH64 of each row of a matrix of bytes, of at most 31 columns."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in PRIMES)
    n, width = rows.shape

    def turned(h: np.ndarray, k: int) -> np.ndarray:
        return (h << np.uint64(k)) | (h >> np.uint64(64 - k))

    def number(start: int, size: int) -> np.ndarray:
        return sum(rows[:, start + k].astype(np.uint64) << np.uint64(8 * k) for k in range(size))

    h, at = np.full(n, (42 + PRIMES[4] + width) % (1 << 64), np.uint64), 0
    while at + 8 <= width:
        h = turned(h ^ (turned(number(at, 8) * p2, 31) * p1), 27) * p1 + p4
        at += 8
    if at + 4 <= width:
        h = turned(h ^ (number(at, 4) * p1), 23) * p2 + p3
        at += 4
    for k in range(at, width):
        h = turned(h ^ (number(k, 1) * p5), 11) * p1
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def line_bins(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The signature of each line (data[offsets[k]:offsets[k + 1]], not empty): smallest hash of each bin, 0 for none.

    ``signatures`` in numpy, for comparisons by brute force; no query runs it.
    """
    n = len(offsets) - 1
    out = np.full(n * BINS, 1 << 31, np.int64)

    def add(line: np.ndarray, h: np.ndarray) -> None:
        at = line * BINS + (h >> np.uint64(60)).astype(np.int64)
        np.minimum.at(out, at, ((h >> np.uint64(29)) & np.uint64(0x7FFFFFFE)).astype(np.int64) + 1)

    for low in range(int(offsets[0]), int(offsets[-1]), CHUNK):
        high = min(low + CHUNK, int(offsets[-1]))
        a, b = np.searchsorted(offsets, [low, high - 1], "right") - 1
        own = np.minimum(offsets[a + 1 : b + 2], high) - np.maximum(offsets[a : b + 1], low)
        line = np.repeat(np.arange(a, b + 1), own)
        some = data[low : high + width - 1]
        if len(some) >= width:
            h = window_hashes(some, width)
            line = line[: len(h)]
            whole = offsets[line + 1] - np.arange(low, low + len(line)) >= width
            add(line[whole], h[: len(line)][whole])
    lengths = np.diff(offsets)
    for size in range(1, width):
        short = np.flatnonzero(lengths == size)
        for k in range(0, len(short), CHUNK):
            some = short[k : k + CHUNK]
            add(some, _hashed(data[offsets[some][:, None] + np.arange(size)]))
    out[out == 1 << 31] = 0
    return out.reshape(n, BINS)


def shingle_set(line: bytes, width: int) -> np.ndarray:
    """The distinct shingle hashes of a line, sorted."""
    h = np.sort(window_hashes(np.frombuffer(line, np.uint8), width))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, line (binary, without outer blanks), h1, h2 of every line with a word.

    The two hashes stand for the line; (doc_id, text_hash) for its document.
    """
    line = F.trim(F.col("line"), F.lit(BLANK))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.withColumn("line", line).where("line != ''")
    return rows.select(
        "doc_id", "text_hash", "pos",
        F.col("line").cast("binary").alias("line"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def shingle_hash(line: Column, at: Column, s: Settings) -> Column:
    """The 64-bit hash of the shingle at a place (from 1) of a line."""
    return F.xxhash64(line.substr(at, F.lit(s.shingle)))


def last_shingle(line: Column, s: Settings) -> Column:
    """Place (from 1) of a line's last shingle; one of fewer bytes is a shingle of its own."""
    return F.greatest(F.length(line) - (s.shingle - 1), F.lit(1))


def signatures(lines: DataFrame, s: Settings) -> DataFrame:
    """h1, h2, n (occurrences), size in bytes, signature and an id of every distinct line.

    The highest four bits of a hash are its bin. With a bin's number put over them they are least for the bin's own hashes,
    so the smallest of all is the bin's smallest, unless it has none: then these bits show another bin. That
    spares sixteen conditions a hash. A row holds AT_ONCE shingles; the last row of a line repeats its last one.
    """
    line, last = F.col("line"), F.col("last")
    rows = lines.select("h1", "h2", "line", last_shingle(line, s).alias("last"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), last, F.lit(AT_ONCE))).alias("at"))
    places = [F.col("at"), *[F.least(F.col("at") + k, last) for k in range(1, AT_ONCE)]]
    rows = rows.select(
        "h1", "h2", F.length(line).alias("size"), (F.col("at") == 1).cast("long").alias("new"),
        *[shingle_hash(line, at, s).alias(f"s{k}") for k, at in enumerate(places)],
    )
    hashes = [F.col(f"s{k}") for k in range(AT_ONCE)]
    least = [F.min(F.least(*[x.bitwiseXOR(F.lit(_put_first(k))) for x in hashes])).alias(f"m{k}") for k in range(BINS)]
    out = rows.groupBy("h1", "h2").agg(F.sum("new").alias("n"), F.min("size").alias("size"), *least)
    value = [(F.shiftright(f"m{k}", 29).bitwiseAND(0x7FFFFFFE) + 1).cast("int") for k in range(BINS)]
    sig = [F.when(F.col(f"m{k}") < F.lit(ANOTHER), x).otherwise(F.lit(0)) for k, x in enumerate(value)]
    return out.select("h1", "h2", "n", "size", F.array(*sig).alias("sig")).withColumn("id", F.monotonically_increasing_id())


def _put_first(k: int) -> int:
    """A long that makes the hashes of bin ``k`` the least longs, in their order."""
    return (k << 60) - (1 << 63) if k < BINS // 2 else (k - BINS // 2) << 60


def _banded(found: DataFrame) -> DataFrame:
    """id, size and bucket of every band of a line that isn't empty; a bucket's lowest four bits are the band's number.

    The bands are rows of a literal and one expression makes the key: the code of twelve is longer than Java compiles.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(b).alias(f"b{j}") for j, b in enumerate(band)]) for k, band in enumerate(BANDS)]))
    bins = [F.get("sig", F.col(f"_band.b{j}")) for j in range(len(BANDS[0]))]
    key = F.xxhash64("_band.k", *bins).bitwiseAND(-16).bitwiseOR(F.col("_band.k"))
    met = found.select("id", "size", "sig", each.alias("_band")).where(F.greatest(*bins) != 0)
    return met.select("id", "size", key.alias("bucket"))


def bucket_members(found: DataFrame, s: Settings) -> DataFrame:
    """(bucket, band, blocks, lines, low, id, size) of the lines that share a band with another line; blocks, lines and smallest id of the bucket.

    A line is in a bucket once, as the key names the band. The count of the buckets and the join with it use all columns of one shuffle, so Spark makes the bands and deals them
    once; most buckets hold one line, so the shared ones are hashed and the lines are not sorted.
    """
    met = _banded(found).repartition("bucket")
    blocks = F.greatest(F.ceil(F.col("_n") / s.block), F.ceil(F.col("_bytes") / s.block_bytes)).cast("int")
    of = [F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_bytes"), F.min("id").alias("low")]
    shared = met.groupBy("bucket").agg(*of).where("_n > 1")
    shared = shared.select(F.col("bucket").alias("_bucket"), blocks.alias("blocks"), F.col("_n").alias("lines"), "low").hint("shuffle_hash")
    both = met.join(shared, F.col("bucket") == F.col("_bucket"))
    return both.select("bucket", F.col("bucket").bitwiseAND(15).cast("int").alias("band"), "blocks", "lines", "low", "id", "size")


def occurrences(lines: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """Lines whose (h1, h2) is in ``wanted`` (h1, h2, id, fuzzy), with the id, and the line itself where ``fuzzy``."""
    blocks_needed = max(1, -(-wanted.count() * BITS_A_KEY // (64 * WORDS)))
    if blocks_needed <= s.filter_blocks:  # else too large to broadcast, and the lines are joined unfiltered
        blocks = bloom_blocks(wanted, "h1", blocks_needed)
        at, passes = bloom_hit(F.col("h1"), blocks_needed)
        lines = lines.join(F.broadcast(blocks), at == F.col("block")).where(passes)
    keys = wanted.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "id", "fuzzy")
    met = lines.join(merged(keys), (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    return met.select("doc_id", "text_hash", "pos", "id", F.when(F.col("fuzzy"), F.col("line")).alias("line"))


def _hashes(line: Column, s: Settings) -> Column:
    """The distinct shingle hashes of a line."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last_shingle(line, s)), lambda at: shingle_hash(line, at, s)))


def known_lines(texts: DataFrame, s: Settings) -> DataFrame:
    """id, n (distinct shingles), a bitmap in MAP words, a bit for each shingle, and n less its bits, of the lines ``texts`` (id, line).

    A row holds AT_ONCE shingles; the last row of a line repeats its last one.
    """
    rows = texts.select("id", _hashes(F.col("line"), s).alias("all")).select("id", "all", F.size("all").alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(AT_ONCE))).alias("at"))
    some = range(AT_ONCE)
    rows = rows.select("id", "n", *[F.get("all", F.least(F.col("at") + k, F.col("n") - 1)).alias(f"h{k}") for k in some])
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"h{k}").bitwiseAND(63).cast("int")).alias(f"bit{k}") for k in some]
    rows = rows.select("id", "n", *bits, *[F.shiftright(f"h{k}", 6).bitwiseAND(MAP - 1).alias(f"word{k}") for k in some])

    def word(k: int) -> Column:
        # "if" is shorter code than CASE WHEN
        own = [F.call_function("if", F.col(f"word{j}") == k, F.col(f"bit{j}"), F.lit(0).cast("long")) for j in some]
        return F.bit_or(reduce(Column.bitwiseOR, own)).alias(f"w{k}")

    out = rows.groupBy("id").agg(F.max("n").alias("n"), *[word(k) for k in range(MAP)])
    return out.withColumn("more", F.col("n") - sum(F.bit_count(f"w{k}") for k in range(MAP)))


def near(s: Settings) -> Column:
    """Whether the bitmaps of known lines ``x`` and ``y`` allow the similarity.

    A bit of one map alone stands for a shingle of that line alone, so no pair that is similar enough is refused.
    """
    both = sum(F.bit_count(F.col(f"x.w{k}").bitwiseAND(F.col(f"y.w{k}"))) for k in range(MAP))
    common = F.least("x.more", "y.more") + both
    return s.percent * (F.col("x.n") + F.col("y.n")) <= (100 + s.percent) * common


def verified(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard similarity is at least the threshold; ``pairs``: a, b and shingles of each."""
    for side in ("a", "b"):
        own = texts.select(F.col("id").alias("_id"), F.col("line").alias(f"line_{side}"))
        pairs = pairs.join(own, F.col(side) == F.col("_id")).drop("_id")
    # named, so that small pairs with much work are not joined to few tasks
    pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    union = F.size(F.array_distinct(F.concat(_hashes(F.col("line_a"), s), _hashes(F.col("line_b"), s))))
    # n_a + n_b - union are common; each number is named once, so none is computed twice
    return pairs.where(100 * (F.col("n_a") + F.col("n_b")) >= (100 + s.percent) * union).select("a", "b")


def units(members: DataFrame) -> DataFrame:
    """(bucket, i, j, right, id, root): lines of every bucket, dealt to the pairs (i, j) of its blocks."""
    mine = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    met = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("mine", "other"), F.greatest("mine", "other")
    return met.select("bucket", i.alias("i"), j.alias("j"), (F.col("mine") == j).alias("right"), "id", "root")


def links(members: DataFrame, known: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Verified links (a, b) that join the members of each bucket; ``texts``: id, line.

    Lines meet the first of each bucket of theirs and, in large ones, some hubs; then come all pairs of each bucket that these links don't join.
    """
    # columns of a file may be null to Spark; without that the code of a pair is shorter
    known = known.select("id", *[F.coalesce(c, F.lit(0).cast(kind)).alias(c) for c, kind in known.dtypes if c != "id"])
    ends = [F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")]
    sizes = [F.when(F.col("x.id") < F.col("y.id"), F.col(f"{p}.n")).otherwise(F.col(f"{q}.n")) for p, q in ("xy", "yx")]
    pair = [*ends, sizes[0].alias("n_a"), sizes[1].alias("n_b")]
    large = members.where(F.col("lines") > s.small).select("bucket", F.col("id").alias("_a"))
    drawn = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("_a", "bucket"), "_a"))
    hubs = large.withColumn("_rank", drawn).where(F.col("_rank") <= s.hubs).select(F.col("bucket").alias("_bucket"), F.col("_a").alias("_b"))
    met = large.join(hubs, (F.col("bucket") == F.col("_bucket")) & (F.col("_a") != F.col("_b")))
    met = met.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"))
    met = met.unionByName(members.where("id > low").select(F.col("low").alias("_a"), F.col("id").alias("_b"))).distinct()
    met = met.join(known.alias("x"), F.col("_a") == F.col("x.id")).join(known.alias("y"), F.col("_b") == F.col("y.id"))
    good = stored(verified(met.where(near(s)).select(*pair), texts, s), "line-links")
    roots = components(good).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    met = members.join(roots, F.col("id") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "id"))
    met = units(met).withColumnRenamed("id", "_id").join(known, F.col("_id") == F.col("id")).drop("_id")
    unit = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    within = (F.col("x.i") == F.col("x.j")) & (F.col("x.id") < F.col("y.id"))
    across = (F.col("x.i") < F.col("x.j")) & ~F.col("x.right") & F.col("y.right")
    met = met.alias("x").join(met.alias("y"), unit & (within | across) & (F.col("x.root") != F.col("y.root")) & near(s))
    pairs = stored(met.select(*pair).distinct(), "line-pairs")
    return good.unionByName(stored(verified(pairs, texts, s), "line-links"))


def removals(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, text_hash, removed): sorted places of the lines of each document that go.

    Of each component the first occurrence by (doc_id, text hash, place) stays.
    """
    s = settings or Settings()
    lines = lines_of(docs)
    found = stored(signatures(lines, s), "line-signatures", "zstd")
    members = stored(bucket_members(found, s), "line-buckets")
    ids = members.select(F.col("id").alias("_id")).distinct()
    wanted = found.join(ids, F.col("id") == F.col("_id"), "left").select(
        "h1", "h2", "id", "n", F.col("_id").isNotNull().alias("fuzzy")
    )
    wanted = stored(wanted.where("fuzzy OR n > 1").drop("n"), "line-wanted")
    seen = stored(occurrences(lines, wanted, s), "line-occurrences", "zstd")
    texts = stored(seen.where("line IS NOT NULL").groupBy("id").agg(F.first("line").alias("line")), "line-texts", "zstd")
    known = stored(known_lines(texts, s), "line-maps", "zstd")
    roots = components(links(members, known, texts, s)).withColumnRenamed("node", "_id")
    of = seen.drop("line").join(roots, F.col("id") == F.col("_id"), "left")
    of = of.withColumn("root", F.coalesce("root", "id")).drop("_id", "id")
    place = F.struct("doc_id", "text_hash", "pos")
    first = of.groupBy(F.col("root").alias("_root")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    gone = of.join(first.where("n > 1"), F.col("root") == F.col("_root")).where(~place.eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def _with_removals(docs: DataFrame, s: Settings | None) -> DataFrame:
    """``docs`` as ``row`` with ``_removed`` (empty if nothing goes)."""
    gone = stored(removals(docs.select("doc_id", "text"), s), "line-removals")
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("removed").alias("_removed"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("row.text") == F.col("_hash"))
    out = packed(docs).join(gone, same, "left").drop("_doc", "_hash")
    return out.withColumn("_removed", F.coalesce("_removed", F.expr("cast(array() as array<int>)")))


def line_query(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed and the places of the removed lines (from 0) of every document.

    Null text: no lines; blank lines are never removed. Rows with equal doc_id
    and text are one document and lose the same lines. An empty table: no rows.
    """
    out = _with_removals(docs.select("doc_id", "text"), settings)
    return out.select(
        "row.doc_id",
        F.coalesce(F.size(F.split("row.text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.size("_removed").cast("long").alias("n_removed"),
        F.col("_removed").alias("removed"),
    )


def dedup_lines(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents without the lines that go, in the input's columns (n_chars anew); one that loses every word goes."""
    lines = F.split("row.text", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_removed"))
    less = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    touched = F.size("_removed") > 0
    out = _with_removals(docs, settings).withColumn("_text", F.when(touched, less).otherwise(F.col("row.text")))
    out = out.where(~touched | (F.trim(F.col("_text"), F.lit(BLANK + "\n")) != ""))
    new = {"text": F.col("_text"), "n_chars": F.when(touched, F.length("_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
