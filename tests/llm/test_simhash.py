import random

import numpy as np
from llm_helpers import edge_docs, edge_rows, no_docs
from xxhash import xxh64_intdigest

from tollstream.llm import simhash


def plain_fingerprint(text, words):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[k:k + words]) for k in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    ones = [sum(xxh64_intdigest(x, 42) >> b & 1 for x in s) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def plain_components(codes, max_bits):
    parent = {c: c for c in codes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in codes:
        for b in codes:
            if a < b and (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def test_fingerprint_matches_definition():
    for _, text, *_ in edge_rows():
        if text is None or len(text) < 5000:
            for words in (1, 3, 5):
                assert simhash.fingerprint(text or "", words) == plain_fingerprint(text, words)


def test_long_text_counts_every_shingle(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(1 << 10, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_index_finds_all_pairs():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    codes = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base for _ in range(8)})
    u = np.array(codes, dtype=np.uint64)
    u = u[np.argsort(simhash.gray_rank(u))]
    got = {(int(a), int(b)) for x, y in simhash.near_pairs(u, 2, block=50) for a, b in zip(x, y)}
    want = {(a, b) for a in range(len(u)) for b in range(a + 1, len(u)) if (int(u[a]) ^ int(u[b])).bit_count() <= 2}
    assert got == want and want


def test_components_with_crowded_buckets(spark):
    """Buckets of at most 4 codes: every code goes through several cuts."""
    rng = random.Random(5)
    codes = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            codes.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.4:
                x ^= 1 << rng.randrange(64)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "code long")
    for rows in (4, 64):
        found = simhash.components(simhash.links(df, 2, rows)).collect()
        got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found}
        want = plain_components(sorted(codes), 2)
        groups = lambda m: sorted(sorted(c for c in codes if m.get(c, c) == r) for r in {m.get(c, c) for c in codes})
        assert groups(got) == groups(want)


def test_near_duplicates_of_odd_rows(spark):
    rows = edge_rows()
    prints = [plain_fingerprint(t, 3) if t is None or len(t) < 5000 else simhash.fingerprint(t) for _, t, *_ in rows]
    root = plain_components(sorted(set(prints)), 2)
    ids = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            ids[root[p]] = min(i, ids.get(root[p], i))
    want = sorted(((i, p, ids.get(root[p])) for (i, *_), p in zip(rows, prints)), key=str)
    got = sorted(((r["doc_id"], r["__fp"] % (1 << 64), r["component_id"])
                  for r in simhash.near_duplicates(edge_docs(spark)).collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_keep_first_keeps_one_row_of_each_component(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    roots = simhash.near_duplicates(docs).select("__root").distinct().count()
    rows = kept.collect()
    assert len(rows) == roots
    assert {r["doc_id"] for r in rows} >= {1, 2, 5, 6, 8, 10}
    assert simhash.keep_first(no_docs(spark)).count() == 0
