"""Language identification by Bayesian evidence fusion (operator 6).

Log evidence of a language for a document = text likelihood (byte trigrams,
naive Bayes) + declared markup language (how often it is declared for texts of
that language, over all documents) + prior of the host, smoothed towards its
address suffix, and that towards the whole corpus. A background class "und"
takes texts that no model explains. The text model is fitted on a bounded
sample of documents with a declared language; every count behind the declared
evidence and the priors covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, ship, stored
from .url_filter import url_host

BITS = 15
SPACE = 32
UNKNOWN = "und"
#: Bytes of a text worked on at a time: bounds a task's memory, however long a text is.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``sample``: documents the text model is fitted on, about (a bound, whatever the input).
    ``text_weight``: trigrams overlap, so a text counts as this share of its trigrams.
    ``strength``: documents that the next higher level of the prior counts for.
    ``unknown_prior``: share of texts in none of the languages."""

    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    sample: int = 20_000
    text_weight: float = 0.2
    strength: float = 20.0
    unknown_prior: float = 0.01
    min_confidence: float = 0.5


#: Bytes of letters (ASCII ones and all of other scripts) stay, others become a blank.
_LETTERS = np.array([b if b >= 128 or 97 <= b <= 122 else SPACE for b in range(256)], np.uint32)


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams with two letters or more of the lower-cased text, in pieces of CHUNK bytes."""
    raw = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "replace") + b" ", np.uint8)
    for k in range(0, len(raw) - 2, CHUNK):
        x = _LETTERS[raw[k : k + CHUNK + 2]]
        blank = (x == SPACE).astype(np.int8)
        code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
        code = code[blank[:-2] + blank[1:-1] + blank[2:] < 2]
        yield ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def _declared(value: Column, languages: tuple[str, ...]) -> Column:
    """Primary part of a language tag if known, "other" if not, null if there is none."""
    tag = F.lower(F.regexp_extract(F.trim(value), r"^[A-Za-z]+", 0))
    return F.when(tag == "", None).when(tag.isin(*languages), tag).otherwise(F.when(tag.isNotNull(), "other"))


def suffix(host: Column) -> Column:
    """Last label of a host name; empty without a dot."""
    return F.when(F.instr(host, ".") > 0, F.lower(F.substring_index(host, ".", -1))).otherwise(F.lit(""))


def fit_text_model(docs: DataFrame, text: str, declared: str, settings: Settings) -> np.ndarray:
    """Log probabilities, one row per bucket, one column per language and one for "und" (uniform)."""
    langs = settings.languages
    known = docs.select(F.col(text).alias("t"), _declared(F.col(declared), langs).alias("l")).where(
        F.col("l").isin(*langs) & F.col("t").isNotNull()
    )
    every = max(1, -(-known.count() // settings.sample))
    sample = known.where(F.pmod(F.xxhash64("t", F.lit("sample")), F.lit(every)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), 1 << BITS), np.int64)
        for b in batches:
            for t, lang in zip(b.column("t"), b.column("l").to_pylist(), strict=True):
                for grams in trigrams(t.as_py()):
                    total[langs.index(lang)] += np.bincount(grams, minlength=1 << BITS)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[at, bucket])],
            names=["at", "bucket", "n"],
        )

    counts = np.full((1 << BITS, len(langs)), 0.5)
    rows = sample.mapInArrow(count, "at long, bucket long, n long").groupBy("at", "bucket").agg(F.sum("n").alias("n"))
    for r in rows.toLocalIterator():  # at most languages x buckets rows
        counts[r["bucket"], r["at"]] += r["n"]
    model = np.log(counts / counts.sum(0))
    return np.concatenate([model, np.full((1 << BITS, 1), -BITS * np.log(2))], 1)


def text_evidence(text: Column, model: Broadcast[np.ndarray], settings: Settings) -> Column:
    """A struct of n_grams and t_<language> for each language and "und": log likelihoods, the best one 0."""
    names = [f"t_{x}" for x in (*settings.languages, UNKNOWN)]
    weight = settings.text_weight
    fields = [T.StructField("n_grams", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in names]

    @F.arrow_udf(T.StructType(fields))
    def run(texts: pa.Array) -> pa.Array:
        table = model.value
        n, out = [], []
        for t in texts:
            grams, score = 0, np.zeros(len(names))
            for g in trigrams(t.as_py()):
                grams += len(g)
                score += table[g].sum(0, dtype=np.float64) * weight
            n.append(grams)
            out.append(np.round(score - score.max(), 6))
        got = np.array(out).reshape(-1, len(names))
        columns = [pa.array(n, pa.int64()), *(pa.array(got[:, k]) for k in range(len(names)))]
        return pa.StructArray.from_arrays(columns, names=["n_grams", *names])

    return run(text)


def _argmax(scores: Column, names: tuple[str, ...]) -> Column:
    """Name of the largest of an array of scores, ties to the first."""
    place = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in names]), place)


def identified(
    docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source",
    settings: Settings | None = None, carry: bool = False,
) -> DataFrame:
    """doc_id, text_language, declared, language, confidence, kept; ``carry`` adds the input as ``row``.

    A text without letters (null and empty ones too) is "und" and not kept. A
    null or empty declaration is no evidence; a null host is one host of its own.
    Equal rows are judged alike. An empty table gives an empty result.
    """
    s = settings or Settings()
    langs = s.languages
    ship(docs.sparkSession)
    model = fit_text_model(docs, text, declared, s)
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))  # languages x buckets numbers
    scored = packed(docs).select(
        *([F.col("row")] if carry else []),
        F.col("row.doc_id").alias("doc_id"),
        _declared(F.col(f"row.{declared}"), langs).alias("declared"),
        F.lower(F.col(f"row.{host}")).alias("host"),
        text_evidence(F.col(f"row.{text}"), shared, s).alias("_scores"),
    ).select("*", "_scores.*").drop("_scores")  # Python gets the text alone, Spark keeps the row
    scored = scored.withColumn("text_language", _argmax(F.array(*[F.col(f"t_{x}") for x in langs]), langs))
    scored = stored(scored.withColumn("text_language", F.when(F.col("n_grams") > 0, F.col("text_language"))), "language")

    is_lang = {x: F.coalesce(F.col("text_language") == x, F.lit(False)).cast("long") for x in langs}
    hosts = scored.groupBy("host").agg(*[F.sum(c).alias(f"h_{x}") for x, c in is_lang.items()])
    hosts = hosts.withColumn("suffix", suffix(F.coalesce("host", F.lit(""))))
    suffixes = hosts.groupBy(F.col("suffix").alias("_suffix")).agg(*[F.sum(f"h_{x}").alias(f"s_{x}") for x in langs])
    whole = suffixes.agg(*[F.sum(f"s_{x}").alias(x) for x in langs]).first()
    all_ = sum(whole[x] or 0 for x in langs)
    corpus = {x: ((whole[x] or 0) + 1) / (all_ + len(langs)) for x in langs}
    priors = hosts.join(suffixes, F.col("suffix") == F.col("_suffix")).withColumnRenamed("host", "_host").drop("_suffix")
    priors = stored(priors, "host-priors")  # of known size: a small one is broadcast and no text is shuffled

    pairs = scored.where("text_language IS NOT NULL AND declared IS NOT NULL").groupBy("declared", "text_language").count()
    told = {(r["declared"], r["text_language"]): r["count"] for r in pairs.collect()}  # (languages + 1) x languages
    said = (*langs, "other")

    def declared_evidence(x: str) -> Column:
        total = sum(told.get((d, x), 0) for d in said) + len(said)
        known = F.array(*[F.lit(float(np.log((told.get((d, x), 0) + 1) / total))) for d in said])
        place = F.array_position(F.array(*[F.lit(d) for d in said]), F.col("declared")).cast("int")
        return F.coalesce(F.get(known, place - 1), F.lit(0.0))

    out = scored.join(priors, scored["host"].eqNullSafe(priors["_host"]), "left").drop("_host")
    own = {x: F.coalesce(F.col("text_language") == x, F.lit(False)).cast("long") for x in langs}
    in_suffix = sum((F.col(f"s_{x}") - own[x] for x in langs), F.lit(0))
    in_host = sum((F.col(f"h_{x}") - own[x] for x in langs), F.lit(0))
    post = []
    for x in langs:  # counts without the document itself
        at_suffix = (F.col(f"s_{x}") - own[x] + s.strength * corpus[x]) / (F.col("_suffix") + s.strength)
        at_host = (F.col(f"h_{x}") - own[x] + s.strength * at_suffix) / (F.col("_host") + s.strength)
        post.append(F.col(f"t_{x}") + declared_evidence(x) + F.log(at_host * (1 - s.unknown_prior)))
    post.append(F.col(f"t_{UNKNOWN}") + F.lit(float(np.log(s.unknown_prior / (len(langs) + 1)))))
    out = out.withColumn("_suffix", in_suffix).withColumn("_host", in_host).withColumn("_post", F.array(*post))
    top = F.array_max("_post")
    confidence = 1 / F.aggregate("_post", F.lit(0.0), lambda a, p: a + F.exp(p - top))
    has = F.col("n_grams") > 0
    out = out.withColumn("language", F.when(has, _argmax(F.col("_post"), (*langs, UNKNOWN))).otherwise(UNKNOWN))
    out = out.withColumn("confidence", F.when(has, F.round(confidence, 6)).otherwise(0.0))
    kept = (F.col("language") != UNKNOWN) & (F.col("confidence") >= s.min_confidence)
    return out.withColumn("kept", kept).select(
        *(["row"] if carry else []), "doc_id", "text_language", "declared", "language", "confidence", "kept"
    )


def language_query(docs: DataFrame) -> DataFrame:
    return identified(docs.select("doc_id", "text", "lang", "source"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents in one of the languages, with the input's columns."""
    return identified(docs, carry=True).where("kept").select("row.*")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Raw pages as documents for ``identified``: visible text, ``<html lang>`` and host."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").alias("doc_id"),
        bare.alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1).alias("lang"),
        url_host(F.col("url")).alias("source"),
    )
