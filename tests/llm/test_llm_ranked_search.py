"""Ranked search against scoring of every document."""

import math
import re

import numpy as np
import pytest
from llm_cases import TEXTS, empty, messy

from tallyworks.llm import ranked_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, top=20):
    held = [(i, t) for i, text in docs if (t := terms(text))]
    n, total = len(held), sum(len(t) for _, t in held)
    out = []
    for item, text in items:
        best = []
        for doc_id, own in held:
            m = 100 - 25 + (25 * len(own) * n) // total
            score = 0
            for term in terms(text):
                df = sum(term in t for _, t in held)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                tf = own.count(term)
                score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score:
                best.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(best, key=lambda b: b[:3])[:top], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score int, rank int, part int, doc_id int") if not rows else spark.createDataFrame(
        [(i, t, 1, 1, 1, 1) for i, t in rows], "item_id long, text string, score int, rank int, part int, doc_id int"
    )


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    rng = np.random.default_rng(7)
    words = np.array([f"w{k}" for k in range(300)])
    texts = [" ".join(words[rng.zipf(1.2, rng.integers(1, 60)) % 300]) for _ in range(150)]
    texts += texts[:40] + ["w1 w2", "W1-W2", "", None, "...", "w7 " * 3_000 + "é w1"]
    docs = [*enumerate(texts), (None, "w3 w4 w5"), (None, "w3 w4 w5"), (3, "w9 w9 é")]
    items = [(i, " ".join(words[rng.zipf(1.3, 12) % 300])) for i in range(25)]
    return docs, [*items, (90, None), (91, "nothing here"), (92, "W1, w1; É é"), (None, "w3"), (5, "w11 w12"), (5, "w11 w12")]


@pytest.mark.parametrize("limits", [{}, {"SEGMENT": 40, "SEGMENT_DOCS": 7, "SLICE": 50}])
def test_against_every_document(spark, monkeypatch, limits):
    docs, items = corpus()
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    want = brute(docs, sorted(set(items), key=str), 5)
    for block in (4 << 20, 300):
        assert got(search.ranked_search(messy(spark, docs).repartition(3), items_of(spark, items), 5, block=block)) == want


def test_odd_rows(spark):
    items = [(1, "one two"), (2, "word1 tail7 é"), (3, "")]
    assert got(search.ranked_search(messy(spark), items_of(spark, items))) == brute(TEXTS, items)
    assert search.ranked_search(empty(spark), items_of(spark, items)).count() == 0
    assert search.ranked_search(messy(spark), items_of(spark, [])).count() == 0


def test_frequent_terms_open_no_accumulators():
    """Documents that hold the frequent term only get none once the rare ones fill the best."""
    texts = [["rare", "often"]] * 30 + [["often", f"x{k}"] for k in range(2_000)]
    vocabulary = {b"rare": 0, b"often": 1}
    hits = [vocabulary[w.encode()] for t in texts for w in t if w.encode() in vocabulary]
    part = search.Segment(list(range(len(texts))), [2] * len(texts), hits, [sum(w in ("rare", "often") for w in t) for t in texts], 2)
    weights = np.array([search.weight(2030, 30), search.weight(2030, 2030)])
    run = search.Search([[(0, 1), (1, 1)]], np.maximum(weights, 1), 2030, 4060, 20)
    run.add(part)
    assert run.opened == 30 and len(run.best[0][0]) == 20
