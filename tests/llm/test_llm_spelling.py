"""Spelling variants against all pairs of words."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import TEXTS, empty, messy

from tallyworks.llm import spelling


def words_of(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(counts):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus():
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdeéß"))
    base = ["".join(rng.choice(letters, rng.integers(7, 13))) for _ in range(60)] + ["aaaaaaaa", "abababab", "ababababa", "ÀÿÀÿÀÿÀÿ"]
    words = []
    for w in base:
        words += [w] * int(rng.choice([2, 5, 30, 300]))
        for _ in range(12):
            k, c = int(rng.integers(len(w))), str(rng.choice(letters))
            edit = [w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]][int(rng.integers(3))]
            words += [edit] * int(rng.choice([2, 3, 25]))
    # a crowd that shares its start
    words += [f"zzqqxx{a}{b}{c}" for a, b, c in itertools.product("abcdef", repeat=3) for _ in range(2)]
    words += ["a" * k for k in range(7, 40) for _ in range(2)] + ["ab" * k + c for k in range(5, 12) for c in ("", "a", "b", "x") for _ in range(2)]
    words += ["chainaaaa"] * 500 + ["chainaaab"] * 40 + ["chainaabb"] * 3
    rng.shuffle(words)
    return [(i, " ".join(words[k : k + 40]).upper() if i % 3 else " ".join(words[k : k + 40])) for i, k in enumerate(range(0, len(words), 40))]


@pytest.mark.parametrize("crowded", [512, 3])
def test_against_all_pairs(spark, crowded):
    docs = corpus()
    want = brute(words_of(docs))
    assert sum(f is not None for _, f, *_ in want) > 50 and any(f and f != r for _, f, r, *_ in want)
    assert got(spelling.spelling_variants(messy(spark, docs), crowded=crowded)) == want


def test_small_limits(spark, monkeypatch):
    docs = corpus()[:40]
    monkeypatch.setattr(spelling, "HELD", 20)
    monkeypatch.setattr(spelling, "PIECE", 30)
    assert got(spelling.spelling_variants(messy(spark, docs))) == brute(words_of(docs))


def test_odd_rows(spark):
    rows = [*TEXTS, *[(None, "sevenseven")] * 3, (50, "x" * 30_000), (51, "x" * 30_000), (52, "x" * 29_999)]
    assert got(spelling.spelling_variants(messy(spark, rows))) == brute(words_of(rows))
    assert spelling.spelling_variants(empty(spark)).count() == 0


def test_long_open_parts_are_matched_by_halves(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SHORT", 4)
    docs = corpus()
    assert got(spelling.spelling_variants(messy(spark, docs), crowded=2)) == brute(words_of(docs))


def test_pivots_share_no_letter_and_weigh_least():
    rng = np.random.default_rng(0)
    for _ in range(300):
        places = sorted(rng.choice(12, rng.integers(3, 7), replace=False).tolist())
        weights = rng.integers(1, 9, len(places)).tolist()
        chosen = spelling.pivots_of(places, weights)
        cost = dict(zip(places, weights))
        best = min(cost[a] + cost[b] for a, b in itertools.combinations(places, 2) if b - a >= 2)
        assert len(chosen) == 2 and chosen[1] - chosen[0] >= 2 and sum(cost[p] for p in chosen) == best
