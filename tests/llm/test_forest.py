"""The n-gram Jaccard join with prefixes of different lengths: large nodes of a family of near copies."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stagewise.llm import jaccard
from stagewise.llm.common import stored

BLOCK = 16


@pytest.fixture(scope="module")
def rows():
    """Families of 150, 40 and 2 texts that differ from their first in a few words, and 60 texts alone."""
    draw = random.Random(11)

    def words(n):
        return [f"w{draw.randrange(5000)}" for _ in range(n)]

    texts = []
    for size in (150, 40, 2):
        first = words(220)
        for k in range(size):
            t = list(first)
            for _ in range(k % 5):  # up to four words: Jaccard from 1 to below 0.8
                t[draw.randrange(len(t))] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(t))
    texts += [" ".join(words(100)) for _ in range(60)] + ["", "one two"]
    return list(enumerate(texts))


def shingles(text: str) -> frozenset:
    w = text.split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows) -> tuple[dict[int, int], dict[int, int]]:
    """Links of every document's text to other texts, and its class."""
    sets = {i: shingles(t) for i, t in rows}
    texts = sorted({s for s in sets.values() if s}, key=lambda s: min(i for i in sets if sets[i] == s))
    near = {a: [b for b in texts if a is not b and 10 * len(a & b) >= 8 * len(a | b)] for a in texts}
    group, seen = {}, set()
    for a in texts:
        todo, found = [a], []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                found.append(x)
                todo += near[x]
        low = min((i for i in sets if sets[i] in set(found)), default=None)
        group.update(dict.fromkeys(found, low))
    return {i: len(near[s]) if s else 0 for i, s in sets.items()}, {i: group.get(s) for i, s in sets.items()}


def test_links_and_classes_with_large_nodes(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links, classes = brute(rows)
    for block in (BLOCK, 1024):
        s = jaccard.Settings(block=block)
        got = {r.doc_id: r for r in jaccard.joined(docs, s).collect()}
        # no link is made up, and at most the target recall's share is missed (some pairs are at 0.8 exactly)
        assert all(r.n_links <= links[i] for i, r in got.items())
        assert sum(r.n_links for r in got.values()) >= s.recall * sum(links.values())
        assert {i: r.class_id for i, r in got.items()} == classes
    assert max(links.values()) > 3 * BLOCK  # nodes larger than a block are compared whole


def test_prefixes_of_different_lengths(spark, rows):
    s = jaccard.Settings(block=BLOCK)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.sketches(docs, s).where("digest IS NOT NULL").dropDuplicates(["digest"])
    before = stored(found.withColumn("cid", F.col("doc_id")), "test-classes")
    after = jaccard.cut(before, s)
    assert sorted(after.columns) == sorted(set(before.columns) - {"tails"})
    short = {r.cid: r["keys"] for r in before.collect()}
    keys = {r.cid: r["keys"] for r in after.collect()}
    assert keys.keys() == short.keys()
    longer = {c: [t for t in range(s.trees) if keys[c][t] != short[c][t]] for c in keys}
    # the large family has longer prefixes in some trees, texts alone have none
    assert any(longer.values()) and not any(longer[c] for c in keys if c >= 192)
    # classes that meet at a cut node share the shortest prefix; those that share a node are cut at the same length
    for t in range(s.trees):
        nodes: dict[int, set] = {}
        for c in keys:
            nodes.setdefault(keys[c][t], set()).add((short[c][t], t in longer[c]))
        assert all(len(x) == 1 for x in nodes.values())
    # whatever the lengths, no class falls under the target
    for c in keys:
        worst = sum(math.log(1 - s.threshold ** (s.label if t in longer[c] else s.depth())) for t in range(s.trees))
        assert 1 - math.exp(worst) >= s.recall


def test_lengths_reach_the_target_recall():
    for s in (jaccard.Settings(), jaccard.Settings(recall=0.99), jaccard.Settings(threshold=0.9), jaccard.Settings(trees=40, label=10)):
        lengths = s.lengths()
        assert lengths == sorted(lengths, reverse=True) and lengths[0] <= s.label and lengths[-1] >= s.depth()
        miss = math.prod(1 - s.threshold**d for d in lengths)
        assert 1 - miss >= s.recall - 1e-12
    assert len(set(jaccard.Settings().lengths())) > 1


def test_nothing_of_the_size_of_the_tries_is_broadcast(spark, rows):
    """The keys of the classes are arrays and are exploded: Spark takes both for a small part of their size."""
    s = jaccard.Settings(block=BLOCK)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = jaccard.sketches(docs, s).where("digest IS NOT NULL").withColumn("cid", F.monotonically_increasing_id())
    classes = stored(classes.select("cid", "keys", "tails"), "test-classes")
    for df in (jaccard.units(classes.drop("tails"), s), jaccard.joined(docs, s)):
        df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
