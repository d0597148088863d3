"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles. Two texts are linked when
their fingerprints differ in at most ``max_bits`` bits; a component is what
links reach.

Scale: equal fingerprints are one class (a copy group is one row). Classes
meet in buckets that share a block of bits: with ``max_bits + 1`` blocks, two
classes within the distance agree in one block at least. A bucket with more
than ``bucket_rows`` classes is cut again on its remaining bits, by the same
argument, so no bucket grows with the data and no link is lost. Each bucket
is joined with itself through the index: codes in Gray order, nodes of
``fan`` children that keep the bits all codes below agree in, and pairs of
nodes dropped as soon as those bits differ too often.

Defined cases: a null text is empty; a text without words has fingerprint 0
and is linked like any other; null ids take part, and a component's id is the
smallest id that is not null (null if there is none); repeated rows get equal
answers; only ``doc_id`` and ``text`` are read, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import release_memory, ship, stage, table, text_col

BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the shingle hashes."""
    from xxhash import xxh64_intdigest

    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < words:
        return xxh64_intdigest(b" ".join(w), 42)
    total, ones = len(w) - words + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, total, BLOCK):
        part = w[at:at + BLOCK + words - 1]
        h = np.array([xxh64_intdigest(b" ".join(s), 42)
                      for s in zip(*(part[k:] for k in range(words)))], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame, words: int = 3, column: str = "__fp") -> DataFrame:
    """The documents and their fingerprint as a signed long."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        out = pd.Series([_signed(fingerprint(t, words)) for t in texts], dtype="int64")
        release_memory()
        return out

    return docs.withColumn(column, simhash(text_col()))


# --- the index over the codes of one bucket ---------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def gray_index(codes: np.ndarray, fan: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (pattern, mask), leaves first, over codes in Gray order. A
    node's mask has the bits all codes below it agree in."""
    full = np.full(len(codes), ~np.uint64(0), dtype=np.uint64)
    levels = [(codes, full)]
    while len(levels[-1][0]) > 1:
        pattern, mask = levels[-1]
        starts = np.arange(0, len(pattern), fan)
        ones = np.bitwise_and.reduceat(pattern & mask, starts)
        zeros = np.bitwise_and.reduceat(~pattern & mask, starts)
        levels.append((ones, ones | zeros))
    return levels


def near_pairs(codes: np.ndarray, max_bits: int, fan: int = 8,
               block: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a < b) of codes within ``max_bits``; codes in Gray order.

    Depth first over pairs of nodes, from the root: a pair is dropped when
    the bits that both nodes share already differ in more than ``max_bits``.
    """
    levels = gray_index(codes, fan)
    sizes = [len(p) for p, _ in levels]
    todo = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    child = np.arange(fan)
    while todo:
        level, a, b = todo.pop()
        pattern, mask = levels[level]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        keep = apart <= max_bits
        a, b = a[keep], b[keep]
        if level == 0:
            other = a < b
            if other.any():
                yield a[other], b[other]
            continue
        if not len(a):
            continue
        ca = (a[:, None, None] * fan + child[None, :, None] + np.zeros((1, 1, fan), np.int64)).ravel()
        cb = (b[:, None, None] * fan + child[None, None, :] + np.zeros((1, fan, 1), np.int64)).ravel()
        real = (ca <= cb) & (cb < sizes[level - 1])
        ca, cb = ca[real], cb[real]
        for at in range(0, len(ca), block):
            todo.append((level - 1, ca[at:at + block], cb[at:at + block]))


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position reachable over the pairs, for each position."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def _bucket_links(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        src, dst = [], []
        for codes in frame["codes"]:
            u = np.array(codes, dtype=np.int64).view(np.uint64)
            u = u[np.argsort(gray_rank(u), kind="stable")]
            root = _roots(len(u), near_pairs(u, max_bits))
            linked = root != np.arange(len(u))
            src.append(u[linked].view(np.int64))
            dst.append(u[root[linked]].view(np.int64))
        yield pd.DataFrame({"a": np.concatenate(src) if src else np.zeros(0, np.int64),
                            "b": np.concatenate(dst) if dst else np.zeros(0, np.int64)})


# --- buckets ------------------------------------------------------------------

def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(np.array(bits), n)]


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def buckets(codes: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """Distinct codes (column ``code``) dealt to buckets: rows (mask, key,
    codes). Codes within ``max_bits`` of each other share a bucket.

    One round cuts every bucket on its free bits into ``max_bits + 1``
    blocks. Buckets of over ``bucket_rows`` codes go on to the next round
    with fewer free bits; a bucket with no more than log2(bucket_rows) free
    bits can't exceed the bound.
    """
    n = max_bits + 1
    masks = {0: list(range(64))}  # mask of agreed bits -> its free bits
    rows = codes.select("code", F.lit(0).cast("long").alias("mask"))
    done = None
    while True:
        cuts = {}
        for mask, free in masks.items():
            cuts[mask] = [(_signed((mask | _mask(b)) & ((1 << 64) - 1)), [x for x in free if x not in b])
                          for b in _blocks(free, n)]
        choice = F.create_map(*[y for m, c in cuts.items() for y in
                                (F.lit(m), F.array(*[F.lit(k) for k, _ in c]))])
        rows = rows.select("code", F.explode(choice[F.col("mask")]).alias("mask"))
        rows = rows.withColumn("key", F.col("code").bitwiseAND(F.col("mask")))
        masks = {m: free for c in cuts.values() for m, free in c}
        if min(len(f) for f in masks.values()) <= max(1, int(np.log2(bucket_rows))):
            crowded = None
        else:
            crowded = stage(rows.groupBy("mask", "key").count()
                            .where(F.col("count") > bucket_rows).select("mask", "key"), "crowded")
            if crowded.isEmpty():
                crowded = None
        here = rows if crowded is None else rows.join(crowded, ["mask", "key"], "left_anti")
        part = here.select("mask", "key", "code")
        done = part if done is None else done.unionByName(part)
        if crowded is None:
            break
        rows = rows.join(crowded, ["mask", "key"], "left_semi").select("code", "mask")
    return (done.groupBy("mask", "key").agg(F.collect_list("code").alias("codes"))
            .where(F.size("codes") > 1))


def links(codes: DataFrame, max_bits: int, bucket_rows: int = 2048) -> DataFrame:
    """Links (a, b) between distinct codes that connect every pair within
    ``max_bits``: per bucket, each code with the first code it reaches."""
    schema = "a long, b long"
    return (buckets(codes, max_bits, bucket_rows)
            .mapInPandas(lambda it: _bucket_links(it, max_bits), schema).distinct())


# --- components -----------------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links; root is the smallest node.

    Alternating stars: each node's larger neighbours are tied to its smallest
    one, then each node's smaller ones; every round is two shuffles of the
    links, the number of rounds grows with the logarithm of the longest
    chain. Hot nodes: the smallest neighbour is a partial aggregate, and the
    join that follows is one that Spark may split.
    """
    now = stage(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), "links")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stage(large, "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = stage(small, "small")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2,
                    bucket_rows: int = 2048) -> DataFrame:
    """doc_id, ``__fp`` (signed long) and component_id of every row."""
    prints = stage(with_fingerprints(docs.select("doc_id", "text"), words)
                   .select("doc_id", "__fp"), "fingerprints")
    return _with_components(prints, max_bits, bucket_rows)


def _with_components(prints: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    classes = stage(prints.groupBy(F.col("__fp").alias("code"))
                    .agg(F.min("doc_id").alias("first_id")), "classes")
    found = components(links(classes.select("code"), max_bits, bucket_rows))
    rooted = (classes.join(found, classes["code"] == found["node"], "left")
              .select("code", "first_id", F.coalesce("root", "code").alias("root")))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stage(rooted.join(firsts, "root").select("code", "root", "component_id"), "components")
    return prints.join(named, prints["__fp"] == named["code"]).select(
        *prints.columns, F.col("root").alias("__root"), "component_id")


def keep_first(docs: DataFrame, words: int = 3, max_bits: int = 2,
               bucket_rows: int = 2048) -> DataFrame:
    """One row of each component, with all columns: the one with the
    component's id (null if no member has an id); of several texts with that
    id, one by their hash.

    The texts are fingerprinted once. The kept rows are found again by id and
    text hash; whole rows are shuffled once, for that join, and rows that
    occur again are told apart in the same partitions.
    """
    key = {"__key": F.xxhash64("doc_id", "text"), "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit(""))}
    prints = stage(with_fingerprints(docs.select("doc_id", "text"), words)
                   .select("doc_id", "__fp", *[c.alias(k) for k, c in key.items()]), "fingerprints")
    named = _with_components(prints, max_bits, bucket_rows)
    heads = (named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("__root").agg(F.min(F.struct("__key", "__id")).alias("head")).select("head.*"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    kept = docs.select(row, *[c.alias(k) for k, c in key.items()]).join(heads, ["__key", "__id"])
    again = F.row_number().over(Window.partitionBy("__key", "__id").orderBy("__key"))
    return kept.withColumn("place", again).where("place = 1").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 3-word shingles, at most 2 differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")
