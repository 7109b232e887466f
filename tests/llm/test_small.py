"""Operators on hand-built rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagewise.llm import ann, bpe, chat, jaccard, language, line_dedup, packing, quality, sharding, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k}" for k in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, LONG, "en", "a", None),
        (2, LONG, "en", "a", None),
        (2, LONG, "en", "a", None),
        (3, None, None, None, None),
        (4, "", "xx", "", 0),
        (None, LONG + " tail", "de", "b.org", 5),
        (5, "one\n\none\n\u00e9 x " + "y" * 20_000, "fr", "b.org", 5),
        (6, LONG + "\n" + LONG.replace("word7 ", "worm7 "), "en", "a", 7),
    ]
    df = spark.createDataFrame(rows, DOCS)
    # names that operators add themselves
    return df.withColumn("kept", F.lit("mine")).withColumn("shard", F.lit("own")).withColumn("n_words", F.lit(None).cast("int"))


def test_counts_and_verdicts(docs):
    rows = {(r.doc_id, r.n_words, r.n_dup_lines): r for r in quality.quality_query(docs).collect()}
    assert (3, 0, 0) in rows and (4, 0, 0) in rows and (5, 5, 1) in rows
    assert rows[(1, 60, 0)].kept and not rows[(3, 0, 0)].kept
    assert quality.quality_query(docs.limit(0)).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.kept for r in kept.collect()} == {"mine"}


@pytest.mark.parametrize("text,words", [("a b c a b c", 6), ("a b c d", 0), ("a a a a", 4), ("x a b c y a b c", 6), ("", 0)])
def test_repeat_words(text, words):
    assert quality.repeat_words(text.split()) == words


def test_host_rates_shrink_to_the_corpus(spark):
    rows = [(k, "short" if k < 40 else LONG, f"bad{k % 2}" if k < 40 else f"good{k % 20}") for k in range(400)]
    rows.append((999, "short", "once"))
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    failed = {r._host for r in got.where("host_failed").collect()}
    assert {"bad0", "bad1"} <= failed and not any(h.startswith("good") for h in failed)


def test_hilbert_curve_visits_neighbours():
    side = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    order = side[np.argsort(sharding.hilbert_index(side, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()
    assert sorted(sharding.hilbert_index(side, 3)) == list(range(512))


def test_shards_of_small_tables(docs):
    got = sharding.sharding_query(docs).collect()
    assert len(got) == docs.count() and {r.slot for r in got} == {0}
    assert len({r.shard for r in got}) == len(got)  # fewer rows than shards
    none = next(r for r in got if r.doc_id == 3)
    assert (none["size"], none.text_crc32, none.law) == (16, 0, "rows")
    few = sharding.hilbert_shards(docs, n_shards=3).collect()
    sizes = sorted(sum(r.shard == s for r in few) for s in range(3))
    assert sizes == [2, 3, 3]
    assert sharding.sharding_query(docs.limit(0)).count() == 0


def test_cells_are_cumulative_shares_of_whole_values(spark):
    """Brute force: the middle of a value's rows; values that share a long beginning, nulls, a hot value, ties."""
    values = [None] * 7 + ["same beginning " + x for x in "abcdefgh" for _ in range(3)] + ["hot"] * 40 + ["", "z", "\u00e9t\u00e9", "\U0001f600"]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    order = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
    want = {v: int((order.index(v) + order.count(v) / 2) * 32 / len(order)) for v in values}
    got = {r.v: r.cell for r in df.withColumn("cell", sharding.cell(df, "v", len(values))).collect()}
    assert got == want and len({got[v] for v in values if v and v.startswith("same")}) > 1
    nulls = df.where("v IS NULL")
    assert {r.cell for r in nulls.withColumn("cell", sharding.cell(nulls, "v", 7)).collect()} == {16}


def test_every_dimension_prunes_shards(spark, tmp_path):
    """Few values span the curve as well: a shard holds few languages, and its folder tells which."""
    rng = random.Random(5)
    rows = [(k, "x" * rng.randrange(5_000), rng.choice(["de", "en", "en", "fr", "it"]), f"source of documents {rng.randrange(30)}")
            for k in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("shard", F.lit("own"))
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    found = back.groupBy("shard").agg(
        F.count_distinct("lang").alias("langs"), F.count_distinct("source").alias("sources"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("slot").alias("slots"), F.max("slot").alias("last"),
    ).collect()
    assert len(found) == 40 and all((r.n, r.slots, r["last"]) == (100, 100, 99) for r in found)
    assert sum(r.langs for r in found) / 40 < 2.5 and sum(r.sources for r in found) / 40 < 16
    own = ["doc_id", "text", "lang", "source"]
    assert sorted(map(tuple, back.select(own).collect())) == sorted(map(tuple, df.select(own).collect()))


def test_url_rules_and_list(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/en/1x?q#f"), (2, "https://example.org/es/"), (3, "https://notexample.org/es/"),
        (4, "https://x.com/de/1"), (5, "https://com/fr/"), (6, None), (7, "no scheme"), (8, "https://spam.net/a/?b=1&utm_x=2"),
        (9, "http://www.spam.net/a?b=1#z"), (10, "https://fine.net/a"), (10, "https://fine.net/a"), (11, "x://org"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("mine"))
    got = {r.page_id: r for r in url_filter.url_filter_query(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule) == ("a.example.org", "/en/1x", "example.org/en/1")
    assert (got[2].verdict, got[3].rule, got[4].verdict, got[5].rule) == ("block", "org/", "block", "com/fr/")
    assert (got[6].host, got[7].path, got[6].verdict, got[6].rule) == ("", "", "allow", None)
    assert got[8].canonical == got[9].canonical == "spam.net/a?b=1" and got[8].verdict == got[9].verdict == "block"
    assert got[10].verdict == "allow" and (got[11].path, got[11].rule) == ("", None)
    assert url_filter.url_filter_query(pages).count() == len(rows)
    assert url_filter.url_filter_query(pages.limit(0)).count() == 0


def test_other_spellings_of_doorways_are_found_by_the_lookup(spark):
    """Pages that neither their host nor their html lists: without the lookup they would pass."""
    text = "<a href='x'>x</a><A\nhref='y'>y</A>" * 3
    rows = [
        (1, "https://shop.net/a/", "<body><abbr>one</abbr><a href='x'>x</a></body>"), (2, "http://www.shop.net/a?utm_source=f#top", text),
        (3, "https://m.shop.net:443/a/index.html", text), (4, "https://shop.net/b", text), (5, "https://blog.shop.net/a", text),
        (6, "https://other.net/x", None), (7, "https://www.other.net/x", text), (8, None, "<a "), (9, "no scheme", ""),
        (10, "https://empty.net/", ""), (11, "https://empty.net", text), (1, "https://shop.net/a/", "<body><abbr>one</abbr><a href='x'>x</a></body>"),
        (12, "https://shop.net/pre", text * 3_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("listed", F.lit("mine"))
    got = {r.page_id: (r.listed, r.verdict) for r in url_filter.url_filter_query(pages).collect()}
    assert {k for k, (listed, _) in got.items() if listed} == {1, 2, 3, 10, 11}
    assert {k for k, (_, verdict) in got.items() if verdict == "block"} == {1, 2, 3, 10, 11}
    assert url_filter.url_filter_query(pages).count() == len(rows)
    assert url_filter.url_filter_query(pages.limit(0)).count() == 0


def test_filter_has_no_false_verdicts(spark):
    listed = spark.range(0, 4000, 2).select(F.concat(F.lit("k"), "id").alias("k"))
    rows = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    got = url_filter.listed_among(rows, "k", listed, bits_a_key=4)  # a filter with many false positives
    assert got.where("listed != (id % 2 = 0)").count() == 0 and got.count() == 4000


def brute_bpe(word: bytes, ranks: dict) -> list[bytes]:
    parts = [bytes([c]) for c in word]
    while True:
        met = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not met:
            return parts
        k = min(met)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_automaton_equals_merging():
    rng = random.Random(0)
    for _ in range(300):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randint(1, 9)):
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        ids = {t: k for k, t in enumerate(tokens)}
        auto = bpe.MergeAutomaton({t: ids[t] for t in tokens[:3]}, merges, ids)
        ranks = {m: k for k, m in enumerate(merges)}
        for _ in range(20):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
            got = auto.encode(word)
            assert [tokens[k] for k in got] == brute_bpe(word, ranks)
            assert auto.decode(got) == word


def test_bpe_equals_the_library(docs, spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    texts = [LONG, "", "a  b\n\n c\t", "<|endoftext|>x<|endoftext|>", "it's \u0558'se \U0001f600\u200d \u3000", "z" * 3000, " " * 50 + "q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encoded(df).collect():
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        back = tok.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == sha256(back.encode()).hexdigest()
    assert bpe.bpe_query(docs).count() == docs.count() and bpe.bpe_query(docs.limit(0)).count() == 0


def test_packing_covers_every_token_once(docs, spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary_path("word_bpe_49k.json"))
    many = docs.select("doc_id", "text").unionByName(
        spark.range(100, 400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int") * 7).alias("text"))
    ).unionByName(spark.createDataFrame([(900, "pre\u00b9 <|endoftext|> \u00c9" * 9)], "doc_id long, text string"))
    rows = packing.packed_pieces(packing.pieces(many, with_ids=True)).collect()
    texts: dict = {}
    for r in many.collect():
        texts.setdefault(r.doc_id, r.text or "")
    seqs: dict = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length
        want = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert r.doc_tokens == len(want) and want[r.start : r.start + r.length] == ids.tolist()
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in seqs.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= 4096
    assert sum(r.length for r in rows) > 0.97 * 4096 * (len(seqs) - 1)
    assert packing.packing_query(docs.limit(0)).count() == 0


def test_best_fill_is_optimal():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        cap = rng.randint(0, 60)
        sums = {0}
        for size, c in counts.items():
            sums = {x + size * k for x in sums for k in range(c + 1)}
        used = packing.best_fill(counts, cap)
        assert sum(s * c for s, c in used.items()) == max(x for x in sums if x <= cap)
        assert all(c <= counts[s] for s, c in used.items())


def test_reply_tree_paths(spark):
    nodes = spark.createDataFrame(
        [(1, 1, None, "user", "q <|im_end|> \\ <\\|", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 3.0),
         (1, 4, 3, "us er\n", "c", None), (2, 7, 99, "user", "lost parent", 0.5), (None, 1, None, "user", None, 0.0)],
        "tree long, node long, parent long, role string, text string, score double",
    ).withColumn("text", F.coalesce("text", F.lit("")))
    got = {(r.tree, r.leaf): r for r in chat.conversations_of(nodes).withColumn("turns", chat.turns_of(F.col("formatted"))).collect()}
    assert set(got) == {(1, 2), (1, 4), (2, 7), (None, 1)}
    assert [(t.role, t.text) for t in got[(1, 4)].turns] == [("user", "q <|im_end|> \\ <\\|"), ("assistant", "b"), ("us er\n", "c")]
    assert got[(1, 4)].branch == 1 and got[(1, 2)].branch == 2  # 1.0 against 0.5
    assert {r.leaf for r in chat.conversations_of(nodes, top=1).where("tree = 1").collect()} == {4}
    loss = chat.conversations_of(nodes).select("leaf", chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("x"))
    assert {r.leaf: r.x for r in loss.collect()}[4] == "b"
    loop = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 1)], "tree long, node long, parent long")
    with pytest.raises(ValueError):
        chat.paths(loop)


def test_chat_of_nulls_ties_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, None, None, None), (None, 1, "user", "x")]
    got = {r.conv_id: r for r in chat.chat_query(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {1, None, -1} and got[1].n_turns == 3
    assert got[1].turns_sha256 == sha256(b"\n\nassistant\na\nassistant\nb\n").hexdigest()
    assert got[1].loss_sha256 == sha256(b"ab").hexdigest() and got[1].loss_chars == 2
    said = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].loss_sha256 == sha256(said.encode()).hexdigest() and got[-1].n_turns == 2
    assert chat.chat_query(spark.createDataFrame([], schema)).count() == 1


def test_neighbours_with_ties_and_bad_vectors(spark):
    rows = [(k, [1.0, 0.0]) for k in range(0, 120)] + [(200, [0.0, 1.0]), (201, [0.0, 0.0]), (202, None), (203, [float("nan"), 1.0]),
            (204, [None, 1.0]), (None, [1.0, 0.0]), (205, [1.0]), (250, [2.0, 0.1]), (250, [2.0, 0.1])]
    got = ann.ann_query(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by[0] == [1, 2, 3, 4, 5] and by[50] == [0, 1, 2, 3, 4] and by[200] == [250, 0, 1, 2, 3]
    assert by[250] == [0, 1, 2, 3, 4] and set(by) == {0, 50, 100, 200, 250}
    few = spark.createDataFrame([(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in ann.ann_query(few).collect()] == [(1, -1.0)]
    assert ann.ann_query(few.limit(0)).count() == 0


def test_near_duplicates_of_small_rows(docs):
    got = {r.doc_id: r for r in jaccard.jaccard_query(docs).collect()}
    assert got[1].class_id == 1 and got[2].class_id == 1 and got[1].n_copies == 3
    assert got[None].class_id == 1 and got[1].n_links == 2 and got[1].class_size == 5
    assert got[3].class_id is None and got[4].class_id is None
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert jaccard.jaccard_query(docs.limit(0)).count() == 0


def test_lines(docs, spark):
    got = {r.doc_id: r for r in line_dedup.line_query(docs).collect()}
    assert got[3].n_lines == 0 and got[5].removed == [2] and got[2].n_removed == 1
    assert got[6].removed == [0, 1] or got[1].n_removed == 1  # the fuzzy copy goes with its component
    less = line_dedup.dedup_lines(docs)
    assert less.columns == docs.columns
    texts = {r.doc_id: r.text for r in less.collect()}
    assert texts[5].startswith("one\n\n\u00e9") and texts[3] is None and texts[4] == ""
    assert sum(LONG in (t or "") for t in texts.values()) == 1
    assert line_dedup.line_query(docs.limit(0)).count() == 0


def test_line_bins_do_not_depend_on_chunks(monkeypatch):
    draw = np.random.default_rng(5)
    lines = [draw.integers(0, 256, n).astype(np.uint8).tobytes() for n in [1, 5, 11, 12, 13, 50, 300] * 20]
    data = np.frombuffer(b"".join(lines), np.uint8)
    offsets = np.cumsum([0, *map(len, lines)])
    whole = line_dedup.line_bins(data, offsets, 12)
    alone = [line_dedup.line_bins(np.frombuffer(x, np.uint8), np.array([0, len(x)]), 12)[0] for x in lines]
    assert (whole == np.array(alone)).all() and (line_dedup.line_bins(data, offsets[3:], 12) == whole[3:]).all()
    for chunk in (7, 64):
        monkeypatch.setattr(line_dedup, "CHUNK", chunk)
        assert (line_dedup.line_bins(data, offsets, 12) == whole).all()
    for x in lines:
        assert len(line_dedup.shingle_set(x, 12)) == len({x[i : i + 12] for i in range(max(1, len(x) - 11))})


def test_languages_of_small_rows(docs, spark):
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    assert (got[3].language, got[3].kept, got[4].language) == ("und", False, "und")
    assert language.keep_identified(docs).columns == docs.columns
    assert language.language_query(docs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "https://a.de/", '<html lang="de-AT"><b>der Hund</b></html>')], "page_id long, url string, html string")
    (p,) = language.page_evidence(pages).collect()
    assert (p.lang, p.source, p.text.split()) == ("de-AT", "a.de", ["der", "Hund"])


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from stagewise import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "local-cluster[2,1,1024]"}.get(key, default)

    class Fake:
        conf, sparkContext = Conf(), None

    with pytest.raises(ValueError):
        session.scratch_dir(Fake())


def test_bands_of_lines_are_dealt_once(spark):
    from stagewise.llm.common import stored

    sigs = [[(7 * k + b) % 5 if k % 3 else 0 for b in range(line_dedup.BINS)] for k in range(60)]
    found = stored(spark.createDataFrame([(k, 40 + k, x) for k, x in enumerate(sigs)], "id long, size long, sig array<int>"), "found")
    members = line_dedup.bucket_members(found, line_dedup.Settings(block=4))
    rows = members.collect()
    want = {}
    for k, x in enumerate(sigs):
        for t, band in enumerate(line_dedup.BANDS):
            if any(x[b] for b in band):
                want.setdefault((t, *[x[b] for b in band]), []).append(k)
    want = {(key[0], k, max(-(-len(ks) // 4), 1)) for key, ks in want.items() if len(ks) > 1 for k in ks}
    assert {(r.band, r.id, r.blocks) for r in rows} == want and len(rows) == len(want)
    assert all(r.size == 40 + r.id for r in rows)
    assert "ReusedExchange" in members._jdf.queryExecution().executedPlan().toString()
