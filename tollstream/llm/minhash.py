"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is its distinct ``words``-word shingles. Documents with the
same set are one class (a copy group is one row). Each class has a MinHash
signature of ``coords`` values and is posted under its (coordinate, value)
pairs. Two classes are candidates if they collide in at least
:func:`least_matches` coordinates: the largest count that a pair at the
wanted similarity falls short of with a probability of at most ``MISS``.

- Prefix: pairs are ordered by how many classes hold them. Classes with
  ``t`` common pairs share one within their first ``coords - t + 1``, so only
  those are posted, the rarest ones; pairs of one class only are not posted
  at all, and what a frequent passage brings along is not reached.
- Skip merging: within a list, collisions are counted coordinate by
  coordinate block; a partner is skipped once the rest can't lift it over
  the threshold, or once it is connected with the class already.
- Confirmation: candidate groups get the full sets and check pairs by
  descending collisions, until everything is connected or checked.

Scale: a list of over ``LIST_ROWS`` classes, and a candidate group of over
``LIST_ROWS`` classes or ``SET_ROWS`` shingles, is cut into blocks, and every pair of blocks is a task
of its own: no task grows with a hot list, no pair is lost. Lists give a
spanning forest of their candidates and groups one of their links, never all
pairs. The driver sees row counts only.

Defined cases: a null text is empty; an empty set is linked with nothing, and
its component is its own id; null ids take part, and a component's id is its
smallest id that is not null (null if there is none); repeated rows get equal
answers; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import release_memory, ship, stage, table, text_col
from .simhash import components

COORDS = 64
MISS = 1e-9
LIST_ROWS = 1024
SET_ROWS = 1 << 19
BROADCAST_ROWS = 1 << 18  # of three longs each
CHUNK = 4096  # shingles whose coordinates are hashed at once


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, stream: int) -> np.ndarray:
    start = np.uint64(stream << 32)
    return mixed((start + np.arange(1, n + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words``
    words (fewer words: the whole sequence as one)."""
    from xxhash import xxh64_intdigest

    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, w), np.uint64, len(w))
    size = min(words, len(w))
    total = np.full(len(w) - size + 1, size, np.uint64)
    for k, m in enumerate(_seeds(size, 1) | np.uint64(1)):
        total += h[k:k + len(total)] * m
    return np.unique(mixed(total))


def signature(hashes: np.ndarray, coords: int) -> np.ndarray:
    """The smallest hash of the set in each coordinate, 32 bits each."""
    factor, shift = _seeds(coords, 2) | np.uint64(1), _seeds(coords, 3)
    out = np.full(coords, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK]
        for c in range(coords):
            out[c] = min(out[c], ((part * factor[c] + shift[c]) >> np.uint64(32)).min())
    return out


def least_matches(coords: int, percent: int, miss: float = MISS) -> int:
    """The largest number of collisions that a pair of ``percent`` similarity
    stays under with a probability of at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coords + 1):
        below += math.comb(coords, t) * p**t * (1 - p)**(coords - t)
        if below > miss:
            return max(1, t)
    return coords


def _prints(words: int, coords: int):
    @F.pandas_udf("n long, key binary, sig array<int>")
    def prints(texts: pd.Series) -> pd.DataFrame:
        n, key, sig = [], [], []
        for t in texts:
            s = shingle_set(t, words)
            n.append(len(s))
            key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            sig.append(signature(s, coords).view(np.int32))
        release_memory()
        return pd.DataFrame({"n": np.array(n, np.int64), "key": key, "sig": sig})

    return prints(text_col())


# --- inside a task ---------------------------------------------------------------

def matches(sig: np.ndarray, x: int, others: np.ndarray, t: int, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Out of ``others`` the rows that collide with row ``x`` in ``t``
    coordinates or more, and in how many."""
    coords = sig.shape[1]
    count = np.zeros(len(others), np.int64)
    for at in range(0, coords, step):
        count += (sig[others, at:at + step] == sig[x, at:at + step]).sum(axis=1)
        left = max(0, coords - at - step)
        if t > left:
            keep = count >= t - left  # the others can't reach t any more
            others, count = others[keep], count[keep]
    return others, count


class _Forest:
    """Connected rows of one group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def tie(self, a: int, b: int) -> bool:
        la, lb = self.label[a], self.label[b]
        if la == lb:
            return False
        self.label[self.label == max(la, lb)] = min(la, lb)
        return True


def _partners(x: int, side: np.ndarray, two: bool) -> np.ndarray:
    """Rows after ``x`` that it is compared with: all, or in a task of two
    blocks those of the other one."""
    after = np.arange(x + 1, len(side))
    return after[side[after] != side[x]] if two else after


def _list_candidates(frames: Iterator[pd.DataFrame], coords: int, t: int) -> Iterator[pd.DataFrame]:
    for f in frames:
        a, b = [], []
        for ids, side, flat, two in zip(f["ids"], f["side"], f["sigs"], f["two"]):
            sig = np.asarray(flat, np.int32).reshape(len(ids), coords)
            forest = _Forest(len(ids))
            for x in range(len(ids) - 1):
                y = _partners(x, side, two)
                y = y[forest.label[y] != forest.label[x]]
                for k in matches(sig, x, y, t)[0].tolist():
                    if forest.tie(x, k):
                        a.append(ids[x])
                        b.append(ids[k])
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _confirmed(frames: Iterator[pd.DataFrame], coords: int, t: int, percent: int) -> Iterator[pd.DataFrame]:
    for f in frames:
        a, b = [], []
        for ids, side, flat, raw, two in zip(f["ids"], f["side"], f["sigs"], f["sets"], f["two"]):
            sig = np.asarray(flat, np.int32).reshape(len(ids), coords)
            sets = [np.frombuffer(s, "<u8") for s in raw]
            size = np.array([len(s) for s in sets])
            xs, ys, counts = [], [], []
            for x in range(len(ids) - 1):
                y = _partners(x, side, two)
                y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
                y, count = matches(sig, x, y, t)
                xs.append(np.full(len(y), x))
                ys.append(y)
                counts.append(count)
            if not xs:
                continue
            xs, ys, counts = map(np.concatenate, (xs, ys, counts))
            forest = _Forest(len(ids))
            for i in np.argsort(-counts, kind="stable").tolist():
                x, y = int(xs[i]), int(ys[i])
                if forest.label[x] == forest.label[y]:
                    continue
                small, large = (sets[x], sets[y]) if size[x] < size[y] else (sets[y], sets[x])
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if 100 * both >= percent * (len(small) + len(large) - both):
                    forest.tie(x, y)
                    a.append(ids[x])
                    b.append(ids[y])
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


# --- plans -----------------------------------------------------------------------

def _in_blocks(rows: DataFrame, key: str, blocks: Column, payload: list[str]) -> DataFrame:
    """Rows grouped by (key, pair of blocks): arrays ``ids``, ``side`` (the
    block) and of the payload, and ``two`` for pairs of different blocks.
    Every two rows of a key meet in one group."""
    block = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    dealt = (rows.withColumn("blocks", blocks).withColumn("side", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))))
    grouped = dealt.groupBy(key, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")).agg(
        F.collect_list(F.struct("c", "side", *payload)).alias("m"))
    return (grouped.where(F.size("m") > 1)
            .select(F.col("m.c").alias("ids"), F.col("m.side").alias("side"), F.flatten("m.sig").alias("sigs"),
                    *[F.col(f"m.{p}").alias(f"{p}s") for p in payload if p != "sig"],
                    (F.col("i") != F.col("j")).alias("two")))


def candidates(classes: DataFrame, coords: int, t: int) -> DataFrame:
    """Edges (a, b) between classes (c, sig) that connect all pairs of at
    least ``t`` collisions."""
    held = classes.select("c", F.posexplode("sig").alias("at", "value")).select(
        "c", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long") + (1 << 31)).alias("e"))
    often = held.groupBy("e").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    own = (held.join(often, "e").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("held", "e"))).alias("own"))
           .where(F.size("own") >= t)
           .select("c", F.explode(F.slice("own", F.lit(1), F.size("own") - t + 1)).alias("p")))
    posted = stage(own.select("c", "p.e", "p.held"), "postings")
    lists = posted.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = posted.join(lists, "e").join(classes.select("c", "sig"), "c")
    grouped = _in_blocks(rows.select("e", "c", "sig", "n"), "e", F.ceil(F.col("n") / LIST_ROWS), ["sig"])
    return grouped.mapInPandas(lambda it: _list_candidates(it, coords, t), "a long, b long").distinct()


def confirmed(docs: DataFrame, classes: DataFrame, edges: DataFrame, words: int, coords: int, t: int,
              percent: int) -> DataFrame:
    """Links (a, b) between classes that connect all pairs of at least
    ``percent`` similarity, checked on full sets."""
    below = components(edges)  # without the roots themselves
    groups = stage(below.unionByName(below.select(F.col("root").alias("node"), "root").distinct()), "groups")
    total = groups.join(classes.select("c", "n"), groups["node"] == F.col("c")).groupBy("root").agg(
        F.greatest(F.ceil(F.sum("n") / SET_ROWS), F.ceil(F.count(F.lit(1)) / LIST_ROWS)).alias("cuts"))
    chosen = stage(groups.join(classes, groups["node"] == F.col("c")).join(total, "root")
                   .select("root", "cuts", "c", "at.doc_id", "at.hash"), "members")
    few = chosen.count()
    side = chosen.select("c", F.col("doc_id").alias("id"), F.col("hash").alias("h"))
    side = F.broadcast(side) if few <= BROADCAST_ROWS else side
    texts = (docs.select("doc_id", text_col().alias("text"), F.xxhash64(text_col()).alias("hash"))
             .join(side, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
             .groupBy("c").agg(F.min("text").alias("text")))

    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        out = pd.Series([shingle_set(t, words).astype("<u8").tobytes() for t in texts], dtype=object)
        release_memory()
        return out

    full = (texts.select("c", sets("text").alias("set")).join(chosen.select("root", "cuts", "c"), "c")
            .join(classes.select("c", "sig"), "c"))
    grouped = _in_blocks(full, "root", F.col("cuts"), ["sig", "set"])
    return grouped.mapInPandas(lambda it: _confirmed(it, coords, t, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    ship(docs.sparkSession)
    t = least_matches(coords, percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = stage(texts.select("doc_id", F.xxhash64(text_col()).alias("hash"), _prints(words, coords).alias("p"))
                   .select("doc_id", "hash", "p.*"), "prints")
    classes = stage(prints.where("n > 0").groupBy("key")
                    .agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "hash")).alias("at"),
                         F.first("n").alias("n"), F.first("sig").alias("sig"))
                    .withColumn("c", F.monotonically_increasing_id()), "classes")
    edges = stage(candidates(classes, coords, t), "candidates")
    links = stage(confirmed(texts, classes, edges, words, coords, t, percent), "links")
    found = components(links)
    rooted = classes.join(found, classes["c"] == found["node"], "left").select(
        "key", "first_id", F.coalesce("root", "c").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("first"))
    named = stage(rooted.join(firsts, "root").select("key", F.col("first").alias("component")), "components")
    whole = prints.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left")
    return whole.select("doc_id", "n_shingles",
                        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
                        .alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 5-word shingles, 100 * intersection >= 85 * union."""
    found = near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
