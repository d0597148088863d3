"""MinHash near-duplicates: components against all pairs of full sets."""

import random

import numpy as np
import pytest
from llm_helpers import edge_docs, edge_rows, no_docs, prose

from tollstream.llm import minhash


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < words:
        return frozenset([b" ".join(w)])
    return frozenset(b" ".join(w[i:i + words]) for i in range(len(w) - words + 1))


def plain(rows, words, percent):
    """[(doc_id, n, component)] by comparing every pair of distinct sets."""
    sets = [shingles(t, words) for _, t in rows]
    classes = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    root = list(range(len(classes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(classes):
        for j in range(i):
            b = classes[j]
            if 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    at = {s: find(k) for k, s in enumerate(classes)}
    first = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            first[at[s]] = min(i, first.get(at[s], i))
    return [(i, len(s), first.get(at[s]) if s else i) for (i, _), s in zip(rows, sets)]


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def check(spark, rows, words=5, percent=85):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in minhash.near_duplicates(df, words, percent).collect()]
    assert by_id(got) == by_id(plain(rows, words, percent))
    return got


def edited(text, rate, rnd):
    return " ".join("x%d" % rnd.randrange(10**6) if rnd.random() < rate else w for w in text.split())


def corpus(seed, groups=25, shared=12):
    """Copies, near copies around the threshold, and texts that share a long passage."""
    rnd, rows = random.Random(seed), []
    passage = prose(seed + 5000, 60)
    for g in range(groups):
        base = prose(seed * 100 + g, rnd.randrange(30, 150))
        rows += [base, base.upper()]
        rows += [edited(base, rnd.choice([0.005, 0.01, 0.02, 0.03]), rnd) for _ in range(6)]
    rows += [prose(seed * 77 + 9000 + k, 40) + " " + passage for k in range(shared)]
    rnd.shuffle(rows)
    return [(1000 + k if k % 2 else k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 85), (3, 80)])
def test_equals_all_pairs(spark, seed, percent):
    got = check(spark, corpus(seed), percent=percent)
    assert len({c for _, _, c in got}) < len(got)


def test_blocks_lose_nothing(spark, monkeypatch):
    """Lists and groups of many blocks give the same components."""
    monkeypatch.setattr(minhash, "LIST_ROWS", 3)
    monkeypatch.setattr(minhash, "SET_ROWS", 400)
    check(spark, corpus(4, groups=8))


def test_chain_reaches_further_than_a_link(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[4 * k:4 * k + 100])) for k in range(8)]
    got = check(spark, rows)
    assert {c for _, _, c in got} == {0}


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = [tuple(r) for r in minhash.near_duplicates(edge_docs(spark), 5, 85).collect()]
    assert by_id(got) == by_id(plain(rows, 5, 85))
    assert minhash.near_duplicates(no_docs(spark)).collect() == []


def test_words_are_split_and_lowered_as_ascii(spark):
    tail = " ".join(f"k{j}" for j in range(30))
    rows = [(1, "Alpha\x0bbeta\x0cgamma " + tail), (2, "alpha beta gamma " + tail), (3, "É " + tail), (4, "é " + tail),
            (5, "alpha beta gamma " + tail), (6, "alpha\x1cbeta gamma " + tail)]
    check(spark, rows)


def test_large_ids_stay_exact(spark):
    rows = [((1 << 60) + 1, prose(1, 50)), ((1 << 60) + 3, prose(2, 50)), (None, prose(3, 50)), ((1 << 60) + 5, prose(2, 50))]
    check(spark, rows)


def test_one_repeated_text_is_a_third(spark):
    rows = [(k, prose(1, 60) if k % 3 == 0 else prose(k, 30)) for k in range(300)]
    check(spark, rows)


def test_threshold_of_matches():
    t = minhash.least_matches(64, 85)
    rng = np.random.default_rng(1)
    assert (rng.binomial(64, 0.85, 200_000) >= t).all() and t > 25


def test_matches_counts_all_coordinates():
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 3, (50, 64)).astype(np.int32)
    for t in (1, 16, 22, 30, 64):
        others, count = minhash.matches(sig, 0, np.arange(1, 50), t)
        full = (sig[1:] == sig[0]).sum(axis=1)
        assert others.tolist() == (1 + np.flatnonzero(full >= t)).tolist()
        assert count.tolist() == full[full >= t].tolist()
