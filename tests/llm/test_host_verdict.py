"""Host verdicts: a host of mostly bad documents fails, its good documents with it; small hosts are shrunk."""

from __future__ import annotations

import pytest

from stagewise.llm import quality

GOOD = " ".join(f"word{k}" for k in range(60))
BAD = "too short"
#: host -> (good, bad) documents
HOSTS = {"fine": (95, 5), "mixed": (50, 50), "spam": (10, 190), "small": (1, 2), "good": (120, 3), "better": (80, 2), None: (30, 2)}


@pytest.fixture(scope="module")
def judged(spark):
    texts = [(h, t) for h, (good, bad) in HOSTS.items() for t in [GOOD] * good + [BAD] * bad]
    docs = spark.createDataFrame([(k, h, t) for k, (h, t) in enumerate(texts)], "doc_id long, source string, text string")
    return quality.judged(docs).collect(), docs


def by_hand(rule: int) -> dict:
    """Shrunk failure rates of the rule ``short`` (0) or of one that nothing fails (1)."""
    fails = {h: (bad if rule == 0 else 0, good + bad) for h, (good, bad) in HOSTS.items()}
    n = sum(x for _, x in fails.values())
    raw = sum(f for f, _ in fails.values()) / n
    mean = min(max(raw, 0.5 / n), 1 - 0.5 / n)
    between = sum(f * f / x for f, x in fails.values()) / n - raw**2 - mean * (1 - mean) * len(fails) / n
    strength = min(max(mean * (1 - mean) / between - 1, 2.0), 1e6) if between > 0 else 1e6
    return {h: (f + mean * strength) / (x + strength) for h, (f, x) in fails.items()}


def test_rates_are_shrunk_to_the_prior(judged):
    rows, _ = judged
    short, none = by_hand(0), by_hand(1)
    for r in rows:
        assert r.rate_short == pytest.approx(short[r._host], rel=1e-12)
        assert r.rate_symbols == pytest.approx(none[r._host], rel=1e-9)
    # 2 of 3 documents fail, but three documents are too few to say that of the host
    assert 2 / 3 > 0.6 > short["small"]


def test_a_bad_host_takes_its_good_documents_with_it(judged):
    rows, _ = judged
    assert {r._host for r in rows if r.host_failed} == {"spam"}
    good = {h: [r for r in rows if r._host == h and not r.base_failed] for h in HOSTS}
    assert len(good["spam"]) == 10 and not any(r.kept for r in good["spam"])
    for h in HOSTS.keys() - {"spam"}:
        assert len(good[h]) == HOSTS[h][0] and all(r.kept for r in good[h])


def test_the_stage_drops_them(judged):
    _, docs = judged
    left = quality.keep_good(docs).collect()
    assert len(left) == 95 + 50 + 1 + 120 + 80 + 30 and {r.source for r in left} == HOSTS.keys() - {"spam"}


def test_other_limits_decide(judged):
    _, docs = judged
    limits = quality.HostLimits(rates=dict.fromkeys(quality.RULES, 0.4))
    rows = quality.judged(docs, limits=limits).collect()
    assert {r._host for r in rows if r.host_failed} >= {"mixed", "spam"}
