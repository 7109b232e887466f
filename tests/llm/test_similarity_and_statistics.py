"""Operators 11 to 13 against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stagewise.llm import audit, simhash, whitening
from stagewise.llm.common import WORD
from stagewise.llm.perfect_hash import ShardedHash, build, key_hashes
from stagewise.llm.runs import joined_rows
from tests.llm.test_brute_force import groups, texts

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# --- op11 ------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """{place: first place of its component} by comparing all pairs."""
    x = np.array(fps, np.uint64)
    return groups(len(x), [(int(a), b) for b in range(len(x)) for a in np.flatnonzero(np.bitwise_count(x[:b] ^ x[b]) <= 4)])


def check_simhash(spark, docs, want_texts, settings=None):
    ids = sorted(want_texts)
    fps = [plain_fingerprint(want_texts[i]) for i in ids]
    root = plain_components(fps)
    want = {i: (f, ids[root[k]]) for k, (i, f) in enumerate(zip(ids, fps, strict=True))}
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs, settings).collect()}
    assert got == want
    return want


@pytest.mark.parametrize("settings", [{}, {"chain": 1, "block": 16}, {"chain": 3}, {"segments": 3, "chain": 1}, {"chain": 2, "small": 2, "block": 4}])
def test_components_of_fingerprints(spark, sf_small, settings):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check_simhash(spark, docs, texts(spark, sf_small), simhash.Settings(**settings))


def test_family_of_near_copies(spark):
    draw = random.Random(5)
    base = [f"w{k}" for k in range(400)]
    rows = {}
    for i in range(300):
        words = list(base)
        for k in draw.sample(range(400), draw.choice([0, 1, 2, 4, 30])):
            words[k] = f"x{draw.random()}"
        rows[i] = " ".join(words)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for settings in ({}, {"block": 16, "chain": 2}, {"chain": 1, "small": 4}):
        want = check_simhash(spark, df, rows, simhash.Settings(**settings))
    assert 1 < len({c for _, c in want.values()}) < 300


def test_every_pair_within_reach_meets(spark):
    draw = random.Random(9)
    fps = set()
    for _ in range(150):
        x = draw.getrandbits(64)
        fps.add(x)
        for _ in range(draw.randint(1, 6)):  # chains of neighbours
            x ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 6)))
            fps.add(x)
    fps = sorted(fps)
    root = plain_components(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for chain in (1, 2, 3):
        links = [(fps[signed.index(r.a)], fps[signed.index(r.b)]) for r in simhash.links(df, simhash.Settings(chain=chain)).collect()]
        assert groups(len(fps), [(fps.index(a), fps.index(b)) for a, b in links]) == root


def test_fingerprints_of_odd_texts(spark):
    long = " ".join(f"w{k % 977}" for k in range(120_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Ä b"), (5, "ä B"), (6, "Ä b"), (7, long), (8, long.replace(" ", " \n\t")), (9, "a b c d"), (9, "A  B C d"), (None, "a b c d"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("mine")).withColumn("root", F.lit(0))
    got = simhash.simhash_query(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows_ = [(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()]
    assert len(rows_) == len(rows) and {(r[0], r[2]) for r in rows_ if r[1] == "0" * 16} == {(1, 1), (2, 1), (3, 1)}
    assert {r[1] for r in rows_ if r[0] in (7, 8)} == {f"{plain_fingerprint(long):016x}"}
    assert [r for r in rows_ if r[0] == 9] == [(9, f"{plain_fingerprint('a b c d'):016x}", 9)] * 2
    assert {r[2] for r in rows_ if r[0] is None} == {9, None}
    assert len({r[1] for r in rows_ if r[0] in (4, 5, 6)}) == 3
    assert simhash.simhash_query(df.limit(0)).count() == 0


def test_joined_rows():
    assert joined_rows(7, np.array([6, 1, 5]), np.array([5, 2, 2])).tolist() == [0, 1, 1, 3, 4, 1, 1]
    assert joined_rows(2, np.zeros(0, int), np.zeros(0, int)).tolist() == [0, 1]


# --- op12 ------------------------------------------------------------------------------------------------------------


def test_whitening_equals_a_dense_solver(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = table.collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    want = ((n * x - sums) / n) @ vectors / np.sqrt(values)
    got = whitening.whitening_query(table).toPandas()
    assert len(got) == 32 * n and set(got.n) == {n} and got.identity_error.max() < 1e-10
    place = {r.vec_id: k for k, r in enumerate(rows)}
    at, c = got.vec_id.map(place).to_numpy(), got.component.to_numpy() - 1
    ratio = got.whitened.to_numpy() * np.sign(want[0, c] * got[got.vec_id == rows[0].vec_id].set_index("component").whitened[c + 1].to_numpy())
    assert np.abs(ratio - want[at, c]).max() < 1e-8
    assert np.abs(got.explained.to_numpy() / (values / values.sum())[c] - 1).max() < 1e-9
    assert (got.deviation.to_numpy() == ((n * x - sums) ** 2).sum(1)[at]).all()


@pytest.mark.parametrize("d,rank,spread", [(1, 1, 0), (2, 2, 0), (7, 7, 6), (24, 24, 9), (24, 5, 2), (31, 31, 0)])
def test_eigenpairs(d, rank, spread):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, rank)) * 10.0 ** -np.linspace(0, spread / 2, rank)
    v = a @ a.T
    values, vectors = whitening.eigenpairs(v, whitening.Settings())
    assert len(values) == rank and (np.diff(values) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-12
    assert np.abs(vectors * values @ vectors.T - v).max() < 1e-13 * np.trace(v)


def test_vectors_that_take_no_part(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.5]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0]),
            (8, [float("inf"), 0.0]), (None, [0.0, 0.0]), (9, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("mine")).withColumn("n", F.lit(1))
    got = whitening.whitening_query(df).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 0, 1, 1, 2, 2, 2, 2] and {r.n for r in got} == {4}
    x = np.array([[64, 32], [16, -64], [16, -64], [0, 0]])
    assert {r.deviation for r in got if r.vec_id == 1} == {int(((4 * x[0] - x.sum(0)) ** 2).sum())}
    assert max(r.identity_error for r in got) < 1e-12
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whitening_query(one).count() == 0  # no spread, no component
    assert whitening.whitening_query(one.limit(0)).count() == 0


def test_deviation_of_far_vectors(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 0.0]), (3, [0.0, 1.0]), (4, [0.0, 3.0])]
    got = whitening.whitening_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = {1: None, 2: None, 3: (4 * 64 - 256) ** 2, 4: (4 * 192 - 256) ** 2}  # the first two don't fit a long
    assert {r.vec_id: r.deviation for r in got} == {k: v for k, v in want.items()}


# --- op13 ------------------------------------------------------------------------------------------------------------


def plain_audit(rows):
    words = [(r[1] or "", r[2] or "", audit.TERM.findall((r[0] or "").encode().lower())) for r in rows]
    found = defaultdict(Counter)
    for lang, _, w in words:
        found[lang].update(set(w))
    kept = {lang: {t for t, n in c.items() if n >= 3} for lang, c in found.items()}
    counts, langs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        w = [t for t in w if t in kept[lang]]
        counts[lang, source].update(w)
        langs[lang].update(w)

    def share(c, t, v):
        return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v)

    out = []
    for lang, source in counts:
        c, v = counts[lang, source], len(kept[lang])
        parts = {"pair": [], "term": []}
        for other in {s for x, s in counts if x == lang} - {source}:
            ps = [(share(c, t, v), share(counts[lang, other], t, v)) for t in kept[lang]]
            parts["pair"].append((-sum((p - q) ** 2 // q for p, q in ps), other.encode()))
        for t in c:
            p, q = share(c, t, v), share(langs[lang], t, v)
            if p > q:
                parts["term"].append((-((p - q) ** 2 // q), t))
        for part, items in parts.items():
            for rank, (value, item) in enumerate(sorted(items), 1):
                if part == "pair" or rank <= 200:
                    out.append((lang, source, part, item.decode(), -value, rank))
    return sorted(out)


def audit_rows():
    draw = random.Random(2)
    vocabulary = [f"{a}{b}" for a in "aäbcdÉfxyz" for b in ["lo", "Mi", "né", "日本", "ta"]]
    rows = []
    for k in range(120):
        text = "".join(draw.choice(vocabulary) + draw.choice([" ", ", ", "1", "\n", "\x7f", "{"]) for _ in range(draw.randint(0, 60)))
        rows.append((text, draw.choice(["en", "en", "de", None, ""]), draw.choice(["s1", "s2", "s3", None, "é", "z9"])))
    return rows + [(None, "en", "empty"), ("", "de", "s1"), ("lonely words", "xx", "a"), ("others", "xx", "b"), ("alone", "yy", "a")] + rows[:3]


@pytest.mark.parametrize(
    "settings", [{}, {"shard": 4, "block": 1, "round_bytes": 300}, {"held_terms": 5, "held_tokens": 7, "text_bytes": 10, "ranks": 200}]
)
def test_audit_equals_brute_force(spark, settings):
    rows = audit_rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    df = df.withColumn("value", F.lit("mine")).withColumn("shard", F.lit(0)).withColumn("doc_id", F.lit(None).cast("long"))
    got = sorted(tuple(r) for r in audit.audited(df, audit.Settings(**settings)).collect())
    assert got == plain_audit(rows)
    assert ("xx", "a", "pair", "b", 0, 1) in got and not any(r[0] == "yy" for r in got)


def test_audit_ties_at_the_last_rank(spark):
    words = [f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    rows = [(" ".join(words), "en", "s1")] * 3 + [("aa " * 50, "en", "s2")] * 3
    got = audit.audited(spark.createDataFrame(rows, "text string, lang string, source string"), audit.Settings(shard=32)).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows)
    assert max(r["rank"] for r in got if r.part == "term") == 200


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert audit.audited(none).count() == 0
    assert audit.audited(spark.createDataFrame([(None, None, None)] * 4, none.schema)).count() == 0


@pytest.mark.parametrize("raw", ["", "abc" * 50, "ab cd" * 40, "1" * 100, "é" * 33 + " x"])
def test_terms_of_long_texts(raw):
    s = audit.Settings(text_bytes=8)
    assert [t for some in audit.terms_of(raw.encode(), s) for t in some] == audit.TERM.findall(raw.encode())


def test_shares_are_exact():
    draw = random.Random(1)
    for _ in range(300):
        whole = draw.choice([1, 7, 10**9, 10**12, 9 * 10**15])
        n = draw.randrange(whole)
        assert int(audit.shares(np.array([n]), whole)[0]) == 1 + 10**9 * (n + 1) // whole


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 17, 500])
def test_perfect_hash(n):
    words = [f"wörd{k}".encode() for k in range(n)]
    made = build(words)
    whole = ShardedHash.of(1, {0: made})
    assert sorted(whole.places(words)) == list(range(n))
    assert (whole.places([f"x{k}".encode() for k in range(200)]) == -1).all()


def test_sharded_hash():
    words = [f"wörd{k}".encode() for k in range(300)]
    shard = np.mod(key_hashes(words).view(np.int64), 7)
    made = {k: build([w for w, x in zip(words, shard, strict=True) if x == k]) for k in (0, 3, 6)}
    some = ShardedHash.of(7, made)
    at = some.places(words)
    assert ((at >= 0) == np.isin(shard, [0, 3, 6])).all() and sorted(at[at >= 0]) == list(range(len(some.keys)))
    assert (np.searchsorted(some.first, at[at >= 0], "right") - 1 == shard[at >= 0]).all()


def test_perfect_hash_needs_distinct_words():
    with pytest.raises(ValueError):
        build([b"a", b"a"])
