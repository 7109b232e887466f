"""Registered queries of the operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from . import (
    ann, audit, bpe, chat, jaccard, language, line_dedup, packing, quality, sharding, simhash, url_filter, whitening,
)
from .common import table


def _over(name, fn):
    return lambda spark, sf_dir: fn(table(spark, sf_dir, name))


QUERIES = {
    "op1_url_filter": _over("pages", url_filter.url_filter_query),
    "op2_collision_ann": _over("embeddings", ann.ann_query),
    "op3_host_quality": _over("documents", quality.quality_query),
    "op4_hilbert_sharding": _over("documents", sharding.sharding_query),
    "op5_line_minhash": _over("documents", line_dedup.line_query),
    "op6_language_fusion": _over("documents", language.language_query),
    "op7_bpe_automaton": _over("documents", bpe.bpe_query),
    "op8_chat_trees": _over("conversations", chat.chat_query),
    "op9_jaccard_forest": _over("documents", jaccard.jaccard_query),
    "op10_packing": _over("documents", packing.packing_query),
    "op11_simhash_pigeonring": _over("documents", simhash.simhash_query),
    "op12_embedding_whitening": _over("embeddings", whitening.whitening_query),
    "op13_source_divergence": _over("documents", audit.audit_query),
}

ORACLE_SQL = {
    "op1_url_filter": url_filter.ORACLE,
    "op3_host_quality": quality.ORACLE,
    "op8_chat_trees": chat.ORACLE,
    "op13_source_divergence": audit.ORACLE,
}
