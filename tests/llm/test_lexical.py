"""Ranked lexical search: against scoring every document, odd rows, the tree."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import edge_docs, edge_rows, no_docs, prose

from tollstream.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        ts = [t for t in set(split(text)) if t in df]
        scores = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) *
                    (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in ts if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k])]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def check(spark, docs, items, k=10, slices=3):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(slices)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in lexical.search(lexical.build_index(d), q, k).collect()]
    assert ordered(got) == ordered(plain(docs, items, k))
    return got


def corpus(n, seed):
    rnd = random.Random(seed)
    docs = [(k * 7 % (3 * n), prose(k, rnd.randrange(1, 80))) for k in range(n)]
    docs += [(10_000 + k, prose(1, 40)) for k in range(30)]  # copies: equal scores
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_scoring_every_document(spark, seed):
    docs = corpus(250, seed)
    items = [(k, prose(k, 12)) for k in range(8)] + [(100, "river riverstone bridge paper"), (101, "nothinglikeit")]
    check(spark, docs, items)


def test_small_parts_and_blocks_of_items(spark, monkeypatch):
    """Parts of a few documents, a search state at a time, items in several blocks."""
    monkeypatch.setattr(lexical, "PART_POSTINGS", 200)
    monkeypatch.setattr(lexical, "BATCH", 1)
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 300)
    check(spark, corpus(60, 3), [(k, prose(k, 12)) for k in range(6)], k=4)


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    items = [(1, "one two SEVEN"), (1, "one two SEVEN"), (None, "single text"), (2, None), (3, " ,;"), (4, "é 日本 x"),
             (5, prose(1, 5))]
    q = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in lexical.search(lexical.build_index(edge_docs(spark)), q).collect()]
    assert ordered(got) == ordered(plain(docs, items, 10))
    assert lexical.search(lexical.build_index(no_docs(spark)), q).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(lexical.build_index(edge_docs(spark)), none).collect() == []


def test_large_ids_stay_exact(spark):
    docs = [((1 << 60) + 1, "alpha beta"), ((1 << 60) + 3, "alpha beta"), (None, "alpha beta"), (5, "gamma")]
    got = check(spark, docs, [((1 << 60) + 7, "alpha")], slices=1)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [(1 << 60) + 1, (1 << 60) + 3, None]


def test_terms():
    assert lexical.terms("A-b_C9 é\x1cŁ~x¡y") == [t.encode() for t in split("A-b_C9 é\x1cŁ~x¡y")]


def test_tree_holds_every_cell_and_the_maxima():
    rng = np.random.default_rng(4)
    grid = np.where(rng.random((37, 90)) < 0.1, rng.integers(1, 1000, (37, 90)), 0)
    rows, cols = np.nonzero(grid)
    treap = lexical.Treap(*lexical.build_levels(rows, cols, grid[rows, cols]))
    assert treap.best[0] == grid.max()
    for r in range(37):
        cell = np.zeros(90, np.int64)
        for level in range(treap.height - 1, -1, -1):
            quarter = ((r >> level) & 1) << 1 | (np.arange(90) >> level) & 1
            cell = treap.child(cell, quarter)
            size = 1 << level
            for c in range(0, 90, size):
                block = grid[r // size * size:(r // size + 1) * size, c:c + size]
                assert (treap.best[cell[c]] if cell[c] >= 0 else 0) == block.max()
        assert np.array_equal(np.where(cell >= 0, treap.best[cell], 0), grid[r])


def test_search_expands_few_states(monkeypatch):
    """Best first: a document that holds all terms is found early."""
    rng = np.random.default_rng(6)
    n = 4096
    rows, cols = np.nonzero(rng.random((400, n)) < 0.01)
    extra = np.array([7, 90, 311])
    rows, cols = np.r_[rows, extra], np.r_[cols, np.full(3, 1234)]
    cells = np.unique(np.stack([rows, cols]), axis=1)
    treap = lexical.Treap(*lexical.build_levels(cells[0], cells[1], np.full(cells.shape[1], 50)))
    seen = []
    child = treap.child
    monkeypatch.setattr(treap, "child", lambda cell, q: seen.append(cell.shape[0]) or child(cell, q))
    at, score = lexical.search_part(treap, n, extra, np.ones(3, np.int64), 1, 1)
    assert at.tolist() == [1234] and score.tolist() == [150]
    assert sum(seen) < n
