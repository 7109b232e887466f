"""Queries over the whole sf0.001 tables against brute force, and SQL oracles where there are any."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np

from stagewise.llm import line_dedup
from stagewise.llm.common import WORD
from stagewise.llm.registry import ORACLE_SQL, QUERIES
from tests.oracle_check import compare


def groups(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def similar_pairs(sets: list[frozenset]) -> list[tuple[int, int]]:
    return [
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if 10 * len(x := sets[a] & sets[b]) >= 8 * (len(sets[a]) + len(sets[b]) - len(x))
    ]


def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()}


def test_sql_oracles(spark, sf_small):
    got = compare(spark, sf_small, names=list(ORACLE_SQL), verbose=False)
    assert all(v["ok"] for v in got.values()), got


def test_jaccard_classes(spark, sf_small):
    docs = texts(spark, sf_small)
    words = {i: WORD.findall(t) for i, t in docs.items()}
    sets = [frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)]) for w in words.values()]
    ids = list(docs)
    root = groups(len(ids), similar_pairs(sets))
    got = {r.doc_id: r.class_id for r in QUERIES["op9_jaccard_forest"](spark, sf_small).collect()}
    assert got == {i: ids[root[k]] for k, i in enumerate(ids)}


def test_removed_lines(spark, sf_small):
    seen = defaultdict(list)
    for i, t in texts(spark, sf_small).items():
        for k, line in enumerate(t.split("\n")):
            if line.strip(line_dedup.BLANK):
                seen[line.strip(line_dedup.BLANK).encode()].append((i, k))
    lines = sorted(seen, key=lambda x: min(seen[x]))
    sets = [frozenset(x[k : k + 12] for k in range(max(1, len(x) - 11))) for x in lines]
    members = defaultdict(list)
    for k, r in enumerate(groups(len(lines), similar_pairs(sets))):
        members[r] += seen[lines[k]]
    want = {o for m in members.values() for o in sorted(m)[1:]}
    got = {(r.doc_id, k) for r in QUERIES["op5_line_minhash"](spark, sf_small).collect() for k in r.removed}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_recall_of_neighbours(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    norm = np.linalg.norm(x, axis=1)
    got = defaultdict(set)
    for r in QUERIES["op2_collision_ann"](spark, sf_small).collect():
        got[r.query_id].add(r.vec_id)
    found = []
    for k in np.flatnonzero(ids % 50 == 0):
        score = x @ x[k] / (norm * norm[k])
        score[k] = -2
        found += [i in got[ids[k]] for i in ids[np.lexsort((ids, -score))[:5]]]
    assert len(found) == 5 * len(got) and np.mean(found) >= 0.9


def test_pipeline_keeps_columns_and_packs_the_rest(spark, sf_small):
    import corpus_pipeline

    docs = first = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, docs, sf_small), name)
        assert kept.columns == first.columns and 0 < kept.count() <= docs.count()
        docs = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_no_pair_of_a_hot_line_bucket_is_left_out(spark):
    draw = random.Random(3)
    words = [bytes(draw.choices(range(97, 123), k=12)) for _ in range(20)]
    lines = []
    for _ in range(80):  # lines of a template, each with a copy near the threshold
        line = bytearray(b"".join(words))
        for k in draw.sample(range(20), 2):
            line[12 * k : 12 * k + 12] = bytes(draw.choices(range(97, 123), k=12))
        near = bytearray(line)
        near[60] = near[150] = 35
        lines += [bytes(line), bytes(near)]
    draw.shuffle(lines)
    bins = line_dedup.line_bins(np.frombuffer(b"".join(lines), np.uint8), np.arange(0, 240 * 160 + 1, 240), 12)
    sets = [frozenset(x[k : k + 12] for k in range(229)) for x in lines]
    met = [
        (a, b)
        for a, b in similar_pairs(sets)
        if (same := bins[a] == bins[b]).sum() >= 9 and any(same[x].all() and bins[a][x].any() for x in line_dedup.BANDS)
    ]
    root = groups(len(lines), met)
    want = {k for k in range(len(lines)) if root[k] != k}
    df = spark.createDataFrame([(k, x.decode()) for k, x in enumerate(lines)], "doc_id long, text string")
    for settings in ({"hubs": 1, "small": 2}, {"hubs": 1, "small": 8, "block": 16}):
        rows = line_dedup.line_query(df, line_dedup.Settings(**settings)).collect()
        assert {r.doc_id for r in rows if r.n_removed} == want, (settings, len(want))
