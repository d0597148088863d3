import itertools
import random
import zlib

import numpy as np
from llm_helpers import edge_docs, edge_rows, no_docs

from tollstream.llm import packing
from tollstream.llm.tokens import Encoder, encoder, tokenizer_path

BYTE = tokenizer_path("byte_bpe_50k.json")


def fewest(items, capacity):
    """Brute force: fewest sequences, by trying to place longest first."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(items):
            best = len(room)
            return
        for i in sorted({r: i for i, r in enumerate(room)}.values()):
            if room[i] >= items[k]:
                go(k + 1, [*room[:i], room[i] - items[k], *room[i + 1:]])
        go(k + 1, [*room, capacity - items[k]])

    go(0, [])
    return best


def counted(items):
    return {k: len(list(g)) for k, g in itertools.groupby(sorted(items))}


def test_plan_places_every_piece_once():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([10, 50, 2048])
        counts = counted([rng.randint(1, capacity) for _ in range(rng.randint(0, 60))])
        plan = packing.plan(counts, capacity)
        assert all(sum(p) <= capacity and n > 0 for p, n in plan)
        used = {}
        for p, n in plan:
            for x in p:
                used[x] = used.get(x, 0) + n
        assert used == counts


def test_reduction_keeps_an_optimum():
    """The fixed sets and the best packing of the rest are as few as the best
    packing of all."""
    rng = random.Random(2)
    for _ in range(300):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = packing.reduce_dominated(counted(items), capacity)
        left = [k for k, n in rest.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + fewest(left, capacity) == fewest(items, capacity)


def test_best_fit_is_the_sequential_one():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([10, 50, 100])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        rooms = []
        for x in sorted(items, reverse=True):
            fit = [r for r in rooms if r >= x]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - x)
            else:
                rooms.append(capacity - x)
        plan = packing.best_fit(counted(items), capacity)
        assert sorted(capacity - sum(p) for p, n in plan for _ in range(n)) == sorted(rooms)


def test_encoder_gives_the_library_ids():
    texts = [t or "" for _, t, *_ in edge_rows()] + [
        "  a  b \n c\tdé e's don't <|endoftext|> 日本 語　x ñ́ á b 12 34.5, x. y.. z", "a\n", "\n", " ", "x y\n\nz",
        "it 's\nI 'll", "a\x02b c", "it's ok*** &&& a-b, c!d (e) f%. x...\n\"y\" z dogs' s it' s a'b' c", "é, ñ. x"]
    for name, kind in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        e = Encoder(tokenizer_path(name), kind)
        want = [x.ids for x in e.tok.encode_batch(texts, add_special_tokens=False)]
        for _ in range(2):  # the second time from the table
            assert [np.frombuffer(b, "<u4").tolist() for b in e.ids(texts)] == want


def test_added_tokens_are_one_id():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>y z", "<|endoftext|>", "plain words here", "<|EndOfText|> <|",
             "it's a line\n<|startoftext|> Two words"]
    for name, kind, end in (("byte_bpe_50k.json", "byte", 50256), ("word_bpe_49k.json", "word", 49407)):
        tok = Tokenizer.from_file(tokenizer_path(name))
        want = [x.ids for x in tok.encode_batch(texts, add_special_tokens=False)]
        e = Encoder(tokenizer_path(name), kind)
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in e.ids(texts)] == want
        assert want[2] == [end]


def test_encoder_table_is_bounded():
    e = Encoder(BYTE, "byte", words_kept=20)
    texts = [f"word{k} other{k} third" for k in range(60)]
    for t in texts:
        assert np.frombuffer(e.ids([t])[0], "<u4").tolist() == e.tok.encode(t, add_special_tokens=False).ids
    assert len(e.words) < 40


def test_pack_odd_rows(spark):
    out = packing.pack(edge_docs(spark), BYTE, keep_ids=True).collect()
    enc = encoder(BYTE, "byte")
    want = []
    for i, t, *_ in edge_rows():
        ids = enc.ids([t or ""])[0] + bytes(4)
        n = len(ids) // 4
        cut = [0, *range(n % 2048 or 2048, n + 1, 2048)]
        want += [(i, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in out)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(no_docs(spark), BYTE).count() == 0


def test_large_ids_beside_a_null_stay_exact(spark):
    big = 1 << 60
    docs = spark.createDataFrame([(big + 1, "a b c"), (None, "d e"), (big + 3, "f g")], "doc_id long, text string").coalesce(1)
    got = packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted([big + 1, None, big + 3], key=str)
