import hashlib
import random

from llm_helpers import SCHEMA, edge_docs, edge_rows, no_docs, prose
from xxhash import xxh64

from pyspark.sql import functions as F

from tollstream.llm import fingerprints


def chained(seed, *longs):
    for x in longs:
        seed = xxh64((x % (1 << 64)).to_bytes(8, "little"), seed).intdigest()
    return seed


def plain_fingerprint(text, bins=128, bits=8, words=5):
    """Brute force: every bin's smallest hash (as a signed number); an empty
    bin copies the bin that comes first in its own hashed order."""
    w = (text or "").lower().split()
    if not w:
        return []
    h = [xxh64(x.encode(), 42).intdigest() for x in w]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    seed = xxh64((1).to_bytes(4, "little"), 42).intdigest()
    hashes = ([chained(seed, *h[k:k + words]) for k in range(len(h) - words + 1)] if len(w) >= words
              else [xxh64(" ".join(w).encode(), 42).intdigest()])
    own = {}
    for x in hashes:
        b = x >> 64 - bins.bit_length() + 1
        own[b] = min(own.get(b, signed(x)), signed(x))
    out = []
    for j in range(bins):
        if j in own:
            value = own[j]
        else:
            first = xxh64((j).to_bytes(4, "little"), 42).intdigest()
            value = min((signed(chained(first, b)), v) for b, v in own.items())[1]
        out.append(value & (1 << bits) - 1)
    return out


def likeness(a, b):
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    same = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, min(1.0, (same - 2 ** -8) / (1 - 2 ** -8)))


def digits(fp):
    return "".join(f"{v:02x}" for v in fp)


def test_odd_rows_against_brute_force(spark):
    rows = [r for r in edge_rows() if len(r[1] or "") < 10000]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = fingerprints.edited_fingerprints(docs).collect()
    order = sorted(((i, t or "") for i, t, *_ in rows if i is not None), key=lambda x: (x[0], x[1]))
    want = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        edited = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        a, b, c = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(nxt)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), digits(a), digits(b),
                     round(likeness(a, b), 9), round(likeness(a, c), 9)))
    key = lambda r: (r[0], r[1], r[2], r[5])
    have = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                    round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got if r["doc_id"] is not None), key=key)
    assert have == sorted(want, key=key)
    loose = [r for r in got if r["doc_id"] is None]
    assert len(loose) == 2 and all(r["near_next"] is None for r in loose)
    assert fingerprints.edited_fingerprints(no_docs(spark)).count() == 0


def test_next_row_over_many_ranges(spark):
    rng = random.Random(4)
    ids = sorted(rng.sample(range(100000), 700))
    docs = spark.createDataFrame([(i, f"t{i}") for i in rng.sample(ids, len(ids))], "doc_id long, text string")
    got = fingerprints.with_next(docs, "doc_id", ["text"], rows_per_range=16).collect()
    nxt = dict(zip(ids, ids[1:] + ids[:1]))
    assert len(got) == 700 and all(r["__next"]["text"] == f"t{nxt[r['doc_id']]}" for r in got)


def test_likeness_is_near_the_shingles_likeness(spark):
    rows = []
    for k in range(60):
        base = prose(k, 40 + 12 * k).split()
        cut = len(base) * (k % 5) // 5
        rows.append((k, " ".join(base), " ".join(base[:cut] + prose(k + 500, len(base)).split()[cut:])))
    sets = lambda t: set(zip(*(t.split()[j:] for j in range(5))))
    df = spark.createDataFrame(rows, "k int, a string, b string").select(
        "k", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("s"))
    got = {r["k"]: r["s"] for r in df.collect()}
    errors = [got[k] - len(sets(a) & sets(b)) / len(sets(a) | sets(b)) for k, a, b in rows]
    assert max(map(abs, errors)) < 0.17 and abs(sum(errors) / len(errors)) < 0.02


def test_plan_is_native(spark):
    plan = fingerprints.edited_fingerprints(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
