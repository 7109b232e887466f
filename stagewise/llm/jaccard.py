"""N-gram Jaccard join by an LSH forest of MinHash labels (operator 9).

A text is the set of its five-word shingles. Texts with equal sets form one
class. Each class has a MinHash label in every tree; the trees are prefix
tries of these labels, and classes meet at the node where both are cut. A
prefix may be as short as the length at which the chance that a pair at the
threshold meets in some tree reaches the target recall if all trees are cut
there (six of eight parts). Only nodes that many classes match are worth a
longer one: in these a class starts from its whole label and shortens it, in
its smallest nodes first, until its own target recall is reached again; a node
that one class needs shorter is shorter for all of its classes. So lengths
differ by node, and the chance of a pair doesn't fall under the target.

Pairs cut at the same node are verified by their exact sets. A node that still
is large is split into blocks and every pair of blocks is a unit of work, so no
pair is left out and none is emitted: a unit returns link counts and a spanning
forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, merged, packed, released, ship, stored
from .components import components


@dataclass(frozen=True)
class Settings:
    """``block``: classes of a trie node compared in one unit of work; larger nodes get longer prefixes, then are split."""

    words: int = 5
    threshold: float = 0.8
    trees: int = 24
    label: int = 8
    recall: float = 0.999
    block: int = 1024
    seed: int = 7

    def depth(self) -> int:
        """The longest prefix at which a pair at the threshold meets in some tree with the target recall."""
        for depth in range(self.label, 1, -1):
            if 1 - (1 - self.threshold**depth) ** self.trees >= self.recall:
                return depth
        return 1

    def lengths(self) -> list[int]:
        """Prefix lengths of a class's large nodes, the largest first: whole labels while its recall allows, then shorter.

        With all other trees at ``depth()``. A class that shortens its nodes one
        after the other, the smallest first, ends with these.
        """
        miss = [0.0] + [math.log(1 - self.threshold**d) for d in range(1, self.label + 1)]
        short = self.depth()
        slack = math.log(1 - self.recall) - self.trees * miss[short]
        out = []
        for _ in range(self.trees):
            fits = [d for d in range(self.label, short, -1) if miss[d] - miss[short] <= slack]
            out.append(fits[0] if fits else short)
            slack -= miss[out[-1]] - miss[short]
        return out


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingle_set(text: str | None, known: Words, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle; no word: none."""
    found = WORD.findall(text or "")
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, found), np.uint64, n)
    if n < words:
        ids = np.concatenate([ids, np.zeros(words - n, np.uint64)])
    count = len(ids) - words + 1
    h = np.zeros(count, np.uint64)
    for k in range(words):
        h = h * _MIX + ids[k : k + count]
    return np.unique(_mixed(h))


def _minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One minimum for each hash function a * x + b on 32 bits."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(x), 1024):
        low = np.minimum(low, (a[:, None] * x[None, k : k + 1024] + b[:, None]).min(1))
    return low


def _functions(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    size = s.trees * s.label
    a = rng.integers(0, 1 << 32, size, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, size, dtype=np.uint64).astype(np.uint32)


def prefix_keys(minima: np.ndarray, s: Settings, depth: int) -> np.ndarray:
    """One 64-bit key per tree for the first ``depth`` parts of its label."""
    parts = minima.reshape(s.trees, s.label)[:, :depth].astype(np.uint64)
    key = np.arange(1, s.trees + 1, dtype=np.uint64)
    for k in range(depth):
        key = _mixed(key * _MIX + parts[:, k])
    return key.view(np.int64)


def label_tails(minima: np.ndarray, s: Settings, depth: int) -> bytes:
    """The parts of every label after its first ``depth``, a byte each (unlike parts with equal bytes only meet more often)."""
    return _mixed(minima.reshape(s.trees, s.label)[:, depth:].astype(np.uint64)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, text_hash, digest (of the shingle set), the trees' shortest prefix keys and the rest of their labels.

    Texts without words: null digest.
    """
    ship(docs.sparkSession)
    depth = s.depth()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (a, b) = Words(), _functions(s)
        for batch in batches:
            digests, keys, tails = [], [], []
            for text in batch.column("text"):
                sh = shingle_set(text.as_py(), known, s.words)
                if not len(sh):
                    digests.append(None)
                    keys.append(None)
                    tails.append(None)
                    continue
                digests.append(blake2b(sh.tobytes(), digest_size=16).digest())
                minima = _minhash(sh, a, b)
                keys.append(prefix_keys(minima, s, depth))
                tails.append(label_tails(minima, s, depth))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(tails, pa.binary()),
                ],
                names=["doc_id", "text_hash", "digest", "keys", "tails"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, text_hash long, digest binary, keys array<long>, tails binary")


def cut(classes: DataFrame, s: Settings) -> DataFrame:
    """``classes`` (cid, keys, tails, more) with the keys of the nodes at which each class is cut, without ``tails``.

    A node of the shortest prefix with more than ``block`` classes is large.
    Each class asks for the lengths of :meth:`Settings.lengths` in its large
    nodes, by falling size; a node is as short as one of its classes asks.
    Both classes of a pair see the same answers above the node where their
    labels part, so they meet in a tree exactly if their cut is not below it.
    A class has at most ``trees`` large nodes; nothing else is grouped by it.
    """
    short, out = s.depth(), classes.drop("tails")
    met = classes.select("cid", "tails", F.posexplode("keys").alias("tree", "node"))
    large = met.groupBy(F.col("node").alias("_node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > s.block)
    large = stored(large, "large-nodes")
    if s.label == short or large.isEmpty():
        return out
    lengths = s.lengths()
    rank = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("n"), "tree"))
    rows = met.join(large, F.col("node") == F.col("_node")).withColumn("asked", F.element_at(F.lit(lengths), rank))
    more = s.label - short

    def key(depth: int) -> Column:
        """The node of this depth on the way of a label."""
        rest = F.substring("tails", F.col("tree") * more + 1, F.lit(depth - short))
        return F.xxhash64("node", F.lit(depth), rest) if depth > short else F.col("node")

    keys = [key(d) for d in range(short, s.label + 1)]
    rows = stored(rows.select("cid", "tree", "asked", *[k.alias(f"k{d}") for d, k in enumerate(keys, short)]), "matched")
    cuts = rows.withColumn("at", F.col(f"k{s.label}"))
    for d in range(s.label - 1, short - 1, -1):  # the shortest that anyone asks for comes last and stays
        wanted = rows.where(F.col("asked") == d).select(F.col(f"k{d}").alias(f"_k{d}")).distinct()
        cuts = cuts.join(merged(wanted), F.col(f"k{d}") == F.col(f"_k{d}"), "left")
        cuts = cuts.withColumn("at", F.coalesce(f"_k{d}", "at"))
    mine = cuts.groupBy(F.col("cid").alias("_cid")).agg(F.map_from_entries(F.collect_list(F.struct("tree", "at"))).alias("at"))
    out = out.join(merged(mine), F.col("cid") == F.col("_cid"), "left")
    new = F.transform("keys", lambda x, t: F.coalesce(F.try_element_at("at", t), x))
    return stored(out.withColumn("keys", new).drop("_cid", "at"), "cut-classes")


def units(classes: DataFrame, s: Settings) -> DataFrame:
    """(unit, node, i, j, side, cid, keys): classes of every trie node with two or more, dealt to block pairs."""
    met = classes.select("cid", F.posexplode("keys").alias("tree", "node"))
    sizes = met.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("node", "_node")
    met = met.join(merged(sizes), F.col("node") == F.col("_node")).select(
        "cid", "tree", "node", F.ceil(F.col("n") / s.block).cast("int").alias("blocks")
    )
    mine = F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")).cast("int")
    met = met.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    met = met.select(
        "cid",
        "tree",
        "mine",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        F.col("node"),
    )
    return met.join(merged(classes.select(F.col("cid").alias("_cid"), "keys")), F.col("cid") == F.col("_cid")).select(
        F.xxhash64("node", "i", "j").alias("unit"), "node", "i", "j", (F.col("mine") == F.col("j")).alias("right"),
        "tree", "cid", "keys",
    )


def _unit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one unit after the other; rows come sorted by (unit, node, i, j)."""
    open_: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        cols = [b.column(c).to_numpy() for c in ("unit", "node", "i", "j")]
        if not b.num_rows:
            continue
        edge = np.zeros(b.num_rows, bool)
        for c in cols:
            edge[1:] |= np.diff(c) != 0
        cuts = [0, *np.flatnonzero(edge).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in cols)
            if open_ and key != last:
                yield pa.Table.from_batches(open_)
                open_ = []
            open_.append(b.slice(a, z - a))
            last = key
    if open_:
        yield pa.Table.from_batches(open_)


def _assigned(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class ids, and for the pairs (left, right) of a unit whether they first meet in this unit's tree.

    Equal blocks: a pair counts once, above the diagonal.
    """
    cid = table.column("cid").to_numpy()
    keep = np.unique(cid, return_index=True)[1]
    cid = cid[keep]
    keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(table.num_rows, -1)[keep]
    right = table.column("right").to_numpy()[keep]
    tree = table.column("tree")[0].as_py()
    same_block = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    pairs = np.triu(np.ones((len(cid), len(cid)), bool), 1) if same_block else ~right[:, None] & right[None, :]
    for t in range(tree):
        pairs &= keys[:, t][:, None] != keys[:, t][None, :]
    return keep, cid, pairs


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a unit with a pair that first meets there."""
    for table in _unit_runs(batches):
        keep, _, pairs = _assigned(table)
        used = keep[pairs.any(1) | pairs.any(0)]
        if len(used):
            yield from table.take(pa.array(used)).combine_chunks().to_batches()


def _common(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs: one by one if few, else by products of 0/1 matrices."""
    out = np.zeros(pairs.shape, np.int64)
    left, right = np.nonzero(pairs)
    if len(left) < 8 * len(sets):
        for a, b in zip(left, right, strict=True):
            out[a, b] = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return out
    sizes = [len(x) for x in sets]
    at = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    for start in range(0, int(at[-1]) + 1, 4096):
        a, b = np.searchsorted(at, (start, start + 4096))
        has = np.zeros((len(sets), 4096), np.float32)
        has[row[a:b], at[a:b] - start] = 1
        out += (has @ has.T).astype(np.int64)
    return out


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """(member, root) of a spanning forest of a symmetric 0/1 matrix."""
    n = len(links)
    left, out = np.ones(n, bool), []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(links[front].any(0) & left)
            left[front] = False
            out += [(int(k), root) for k in front]
    return out


def _linked(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Per unit: (cid, links, root) of the classes with a verified link in it."""
    known = Words()
    for table in _unit_runs(batches):
        keep, cid, pairs = _assigned(table)
        texts = table.column("text").take(pa.array(keep))
        sets = [shingle_set(x.as_py(), known, s.words) for x in texts]
        common = _common(sets, pairs)
        size = np.array([len(x) for x in sets])
        union = size[:, None] + size[None, :] - common
        links = pairs & (common >= s.threshold * union - 1e-9)
        if not links.any():
            continue
        links |= links.T
        degree = links.sum(1)
        root = {m: r for m, r in _forest(links)}
        who = np.flatnonzero(degree)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cid[who], pa.int64()),
                pa.array(degree[who], pa.int64()),
                pa.array([cid[root.get(int(k), int(k))] for k in who], pa.int64()),
            ],
            names=["cid", "links", "root"],
        )


_UNIT = "unit long, node long, i int, j int, right boolean, tree int, cid long, keys array<long>"


def joined(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per document: doc_id, text_hash, text_class, n_copies, n_links, class_id, class_size.

    ``text_class``: smallest doc_id with the same shingle set; ``n_copies``: its
    documents. ``n_links``: other text classes with Jaccard at the threshold or
    more. ``class_id``: smallest doc_id of the connected texts, ``class_size``
    its documents. A text without words (null, empty) is alone: classes null.
    Repeated rows are copies of each other. An empty table gives no rows.
    """
    s = settings or Settings()
    sk = stored(sketches(docs, s), "sketches")
    classes = (
        sk.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("text_class"),
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("keys").alias("keys"),
            F.first("tails").alias("tails"),
        )
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = cut(stored(classes, "classes"), s)
    work = units(classes, s).repartition("unit").sortWithinPartitions("unit", "node", "i", "j")
    work = stored(work.mapInArrow(released(_needed), _UNIT), "units")
    reps = classes.select(F.col("cid").alias("_cid"), "rep.doc_id", "rep.text_hash")
    wanted = work.select("cid").distinct().join(merged(reps), F.col("cid") == F.col("_cid")).drop("_cid")
    source = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_hash"), "text")
    texts = wanted.join(
        merged(source), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    ).select(F.col("cid").alias("_cid"), "text")
    checked = work.join(merged(texts), F.col("cid") == F.col("_cid")).drop("_cid")
    checked = checked.repartition("unit").sortWithinPartitions("unit", "node", "i", "j")
    links = stored(checked.mapInArrow(released(lambda b: _linked(b, s)), "cid long, links long, root long"), "links")
    degrees = links.groupBy(F.col("cid").alias("_cid")).agg(F.sum("links").alias("n_links"))
    roots = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    full = classes.select("digest", "cid", "text_class", "n_copies")
    full = full.join(merged(degrees), F.col("cid") == F.col("_cid"), "left").drop("_cid")
    full = full.join(merged(roots.withColumnRenamed("node", "_cid")), F.col("cid") == F.col("_cid"), "left").drop("_cid")
    full = full.withColumn("root", F.coalesce("root", "cid")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    groups = full.groupBy(F.col("root").alias("_root")).agg(
        F.min("text_class").alias("class_id"), F.sum("n_copies").alias("class_size")
    )
    full = full.join(merged(groups), F.col("root") == F.col("_root")).select(
        F.col("digest").alias("_digest"), "text_class", "n_copies", "n_links", "class_id", "class_size"
    )
    out = sk.select("doc_id", "text_hash", "digest").join(merged(full), F.col("digest") == F.col("_digest"), "left")
    return out.select(
        "doc_id",
        "text_hash",
        "text_class",
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "class_id",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def jaccard_query(docs: DataFrame) -> DataFrame:
    return joined(docs.select("doc_id", "text")).drop("text_hash")


def keep_one(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The input without the near-duplicates of a kept document: the one with the smallest doc_id stays.

    Of rows with equal doc_id the smallest text hash stays, of equal rows one.
    Texts without words stay, and so do copies of which none has a doc_id.
    """
    found = stored(joined(docs.select("doc_id", "text"), settings), "near-duplicates")
    several = found.where("class_size > 1 AND class_id IS NOT NULL")
    mine = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    # One row per class, and how often exactly this (doc_id, text) occurs.
    stays = several.where(mine).groupBy("class_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    stays = stays.groupBy("class_id").agg(F.min(F.struct("text_hash", "n")).alias("first"))
    stays = stays.select(F.col("class_id").alias("_class"), F.col("first.text_hash").alias("_first"), F.col("first.n").alias("n"))
    gone = several.join(stays, F.col("class_id") == F.col("_class")).where(~mine | (F.col("text_hash") != F.col("_first")))
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("row.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("row.text") == F.col("_hash"))
    left = packed(docs).join(gone, same, "left_anti")
    repeated = stays.where("n > 1").select(F.col("_class").alias("_doc"), F.col("_first").alias("_hash"))
    repeated = stored(repeated, "repeated-rows")
    if repeated.isEmpty():
        return left.select("row.*")
    once = left.join(repeated, same, "left_semi").select("row.*").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").select("row.*").unionByName(once)
