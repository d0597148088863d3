import random
import zlib

import numpy as np
from llm_helpers import edge_docs, edge_rows, no_docs

from tollstream.llm import tokenfiles
from tollstream.llm.tokens import encoder, tokenizer_path
from tollstream.session import scratch_path

WORD = tokenizer_path("word_bpe_49k.json")


def sequences(seed, n_docs):
    rng = random.Random(seed)
    phrases = [[rng.randrange(60) for _ in range(rng.randint(2, 9))] for _ in range(12)]
    docs = []
    for _ in range(n_docs):
        ids = []
        for _ in range(rng.randint(0, 40)):
            ids += rng.choice(phrases) if rng.random() < 0.8 else [5, 5, 5, 5, 5]
        docs.append(np.array(ids + [2], dtype="<u4").tobytes())
    return docs


def test_shard_round_trip_and_gain():
    docs = sequences(1, 80)
    data = tokenfiles.write_shard(list(range(80)), docs, min_count=4)
    shard = tokenfiles.Shard(data)
    assert shard.all().astype("<u4").tobytes() == b"".join(docs)
    assert [shard.document(k).astype("<u4").tobytes() for k in range(80)] == docs
    assert len(shard.rules) and len(shard.symbols) < len(b"".join(docs)) // 8
    assert shard.doc_ids == list(range(80))


def test_rules_replace_frequent_pairs_only():
    ids = np.array([1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 4, 1, 2, 5], dtype=np.uint32)
    ends = np.zeros(len(ids), bool)
    ends[-1] = True
    x, _, base, rules = tokenfiles.compress(ids, ends, min_count=4)
    assert rules.tolist() == [[1, 2]] and base == 10
    assert x.tolist() == [10, 3, 9, 10, 3, 8, 10, 4, 10, 5]


def test_pairs_stay_inside_documents():
    ids = np.array([1, 2] * 6, dtype=np.uint32)
    ends = np.zeros(12, bool)
    ends[::2] = True  # each pair (1, 2) spans two documents
    ends[-1] = True
    x, last, _, rules = tokenfiles.compress(ids, ends, min_count=2, rule_bytes=0, least_gain=0.0)
    assert [1, 2] not in rules.tolist()
    assert last.sum() == ends.sum()


def test_window_decodes_any_part():
    docs = sequences(2, 30)
    shard = tokenfiles.Shard(tokenfiles.write_shard([None, *range(29)], docs, min_count=4))
    rng = random.Random(0)
    for k, raw in enumerate(docs):
        ids = np.frombuffer(raw, "<u4").tolist()
        for _ in range(10):
            a = rng.randrange(len(ids))
            n = rng.randint(1, len(ids) - a)
            assert shard.window(k, a, n).tolist() == ids[a:a + n]
    assert shard.doc_ids[0] is None


def test_expansion_lengths():
    rules = np.array([[0, 1], [10, 2], [11, 10], [12, 12]], dtype=np.uint32)
    assert tokenfiles.expansion_lengths(rules, 10).tolist() == [2, 3, 5, 10]


def test_files_of_odd_rows(spark):
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_files(edge_docs(spark), folder, WORD, shard_ids=300, rows_per_range=4)
    got = tokenfiles.read_files(spark, folder).collect()
    enc = encoder(WORD, "word")
    want = sorted(((i, b) for i, b in ((i, enc.ids([t or ""])[0] + (2).to_bytes(4, "little"))
                                       for i, t, *_ in edge_rows())), key=lambda x: (x[0] is not None, x[0] or 0))
    rows = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [i for i, _ in want]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    summed = lambda xs: sorted(xs, key=str)  # noqa: E731  rows of equal ids come in any order
    assert summed((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == summed(
        (i, len(b) // 4, zlib.crc32(b)) for i, b in want)
    assert spark.read.parquet(folder).count() > 3


def test_no_rows(spark):
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_files(no_docs(spark), folder, WORD)
    assert tokenfiles.read_files(spark, folder).count() == 0


def test_large_ids_beside_a_null_stay_exact(spark):
    big, folder = 1 << 60, scratch_path(spark, "files")
    docs = spark.createDataFrame([(big + 1, "a b c"), (None, "d e"), (big + 3, "f g")], "doc_id long, text string").coalesce(1)
    tokenfiles.write_files(docs, folder, WORD)
    got = tokenfiles.read_files(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, big + 1, big + 3]


def test_copies_are_factored_in_a_full_shard():
    """The minimum count does not grow with the shard: 200 copies of a
    passage of 500 ids among a million others become rules."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 49000, 500).astype("<u4").tobytes()
    docs = [rng.integers(0, 49000, 4750).astype("<u4").tobytes() + passage for _ in range(200)]
    data = tokenfiles.write_shard(list(range(200)), docs)
    shard = tokenfiles.Shard(data)
    assert shard.all().astype("<u4").tobytes() == b"".join(docs)
    assert len(shard.symbols) <= 200 * (4750 + 64)  # the passage is 64 symbols at most
    few = tokenfiles.Shard(tokenfiles.write_shard(list(range(20)), docs[:20]))
    assert len(few.symbols) <= 20 * (4750 + 64)  # as in a small shard


def test_rules_are_those_of_pair_by_pair_replacement():
    """A round at once is at least as small as Re-Pair that replaces one pair
    after the other, within a few per cent."""
    from collections import Counter

    docs = sequences(7, 60)
    ids = [np.frombuffer(d, "<u4").tolist() for d in docs]
    rules, fresh = 0, 1000
    while True:
        seen = Counter(p for d in ids for p in zip(d, d[1:]))
        pair, n = max(seen.items(), key=lambda x: (x[1], x[0]), default=((0, 0), 0))
        if n < 16:
            break
        out = []
        for d in ids:
            new, k = [], 0
            while k < len(d):
                if tuple(d[k:k + 2]) == pair:
                    new.append(fresh)
                    k += 2
                else:
                    new.append(d[k])
                    k += 1
            out.append(new)
        ids, fresh, rules = out, fresh + 1, rules + 1
    plain = 3 * sum(map(len, ids)) + 12 * rules
    flat = np.frombuffer(b"".join(docs), "<u4")
    ends = np.zeros(len(flat), bool)
    ends[np.cumsum([len(d) // 4 for d in docs]) - 1] = True
    x, _, _, made = tokenfiles.compress(flat, ends)
    assert 3 * len(x) + 12 * len(made) <= 1.1 * plain


def test_copies_of_a_row_lie_in_several_ranges(spark):
    """A third of all rows are one row: no range holds them all, and the ids
    still follow each other."""
    folder = scratch_path(spark, "files")
    docs = spark.range(900).selectExpr("if(id % 3 = 0, 7, id + 1000) AS doc_id", "if(id % 3 = 0, 'a b c', 'd e') AS text")
    tokenfiles.write_files(docs.repartition(3), folder, WORD, rows_per_range=50)
    sizes = [len(tokenfiles.Shard(bytes(r["data"])).doc_ids) for r in spark.read.parquet(folder).select("data").collect()]
    assert sum(sizes) == 900 and max(sizes) < 200
    got = tokenfiles.read_files(spark, folder).orderBy("start").collect()
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
