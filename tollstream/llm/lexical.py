"""Ranked lexical search with a K2-treap over the term-document grid.

Documents are cut into parts as they are scanned. A part's grid has a row per
term (frequent terms first) and a column per document (ascending id); a cell
holds the term's impact in the document. The grid is stored as a compressed
quadtree: level by level one byte for the four children of each cell, and the
largest impact below each cell as the difference from its parent's. Empty
quarters take no space.

A search follows the row paths of an item's terms down together: a state is a
range of documents with the cell of each term, and the weighted sum of their
maxima bounds every score in the range. States are expanded best first, a
batch at a time; at the last level the sum is the score. What is bounded
below the tenth best score so far, in this part or an earlier one of the
task, is not expanded: nothing that ranks is left out.

Impacts: ``10**9 * tf div (1000 * tf + 8 * m)`` with ``m = 10 + 90 * n * N div
L``; a term weighs ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``. N counts
the documents with a term, L all terms, n a document's terms.

Scale: the index needs no shuffle (a part never leaves its task, and is a row
of a staged table); a task gives at most ``k`` rows an item, merged in two
steps. Items are read in blocks of about ``BLOCK_CHARS`` characters, so the
driver and the tasks hold one block and its term weights at a time.

Defined cases: a null or empty text has no terms, is not counted and is never
found; an item without terms has no rows; every row of the items is ranked
for itself, also with a null or repeated id; repeated documents are found
each; among equal scores a null doc_id comes last. Only the id and text
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import release_memory, ship, stage, table, text_col

PART_POSTINGS = 1 << 20
PART_DOCS = 1 << 16
BLOCK_CHARS = 1 << 22
BATCH = 128  # states expanded at once
MERGE_PARTS = 64

# Bytes of a term: digits, letters (A-Z lower-cased) and all beyond ASCII.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
               for c in range(256))
_COUNT = np.array([bin(x).count("1") for x in range(16)], np.uint8)


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


# --- the index of one part --------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of a 32-bit number on the even places of 64."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build_levels(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(height, children, drops) of the quadtree over distinct cells: from
    the root down, the child bits of each inner cell, and of each cell how
    far its maximum is below its parent's (the root's below 0, negated)."""
    height = max(int(rows.max()).bit_length(), int(cols.max()).bit_length(), 1)
    code = (_spread(rows) << np.uint64(1)) | _spread(cols)
    order = np.argsort(code)
    code, best = code[order], values[order].astype(np.int64)
    children, drops = [], []
    for _ in range(height):
        up = code >> np.uint64(2)
        starts = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
        bit = np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)
        above = np.maximum.reduceat(best, starts)
        size = np.diff(np.r_[starts, len(code)])
        children.append(np.bitwise_or.reduceat(bit, starts))
        drops.append(np.repeat(above, size) - best)
        code, best = up[starts], above
    drops.append(-best)
    return height, np.concatenate(children[::-1]), np.concatenate(drops[::-1]).astype("<i4")


class Treap:
    """A part's quadtree in memory: cells of all levels in one numbering."""

    def __init__(self, height: int, children: np.ndarray, drops: np.ndarray):
        self.height, self.children = height, children
        count = _COUNT[children].astype(np.int64)
        self.first = 1 + np.cumsum(count) - count  # number of a cell's first child
        best = -drops.astype(np.int64)
        start, end = 0, 1
        for _ in range(height):  # from a level's maxima to those of the next
            below = end + int(count[start:end].sum())
            best[end:below] += np.repeat(best[start:end], count[start:end])
            start, end = end, below
        self.best = best

    def child(self, cell: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """Number of the child in a quarter; -1 where there is none."""
        bits = np.where(cell >= 0, self.children[cell], 0)
        before = _COUNT[bits & ((1 << quarter) - 1)]
        return np.where((bits >> quarter) & 1 == 1, self.first[cell] + before, -1)


def search_part(treap: Treap, docs: int, rows: np.ndarray, weights: np.ndarray, k: int,
                least: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the up to ``k`` best documents with a score of
    at least ``least`` (and above 0), equal scores by column."""
    none = np.zeros(0, np.int64)
    cells = np.zeros((1, len(rows)), np.int64)
    level, at = np.array([treap.height]), np.array([0])
    bound = (treap.best[cells] * weights).sum(axis=1)
    found, score = none, none
    while len(level):
        if len(level) > BATCH:
            pick = np.argpartition(-bound, BATCH - 1)
            now, later = pick[:BATCH], pick[BATCH:]
        else:
            now, later = np.arange(len(level)), none
        down = level[now] - 1
        kept = [(level[later], at[later], cells[later], bound[later])]
        row_bit = (rows[None, :] >> down[:, None]) & 1
        for side in (0, 1):
            c = treap.child(cells[now], row_bit << 1 | side)
            b = (np.where(c >= 0, treap.best[c], 0) * weights).sum(axis=1)
            kept.append((down, at[now] << 1 | side, c, b))
        level, at, cells, bound = (np.concatenate(x) for x in zip(*kept))
        done = level == 0
        if done.any():
            found, score = np.r_[found, at[done]], np.r_[score, bound[done]]
            order = np.lexsort((found, -score))[:k]
            found, score = found[order], score[order]
        bar, last = (score[-1], found[-1]) if len(found) == k else (least, docs)
        if bar < least:
            bar, last = least, docs
        keep = ~done & (bound > 0) & ((bound > bar) | ((bound == bar) & (at << level < last)))
        level, at, cells, bound = level[keep], at[keep], cells[keep], bound[keep]
    good = (score > 0) & (score >= least)
    return found[good], score[good]


# --- index and search over tables -------------------------------------------------

INDEX = ("docs int, height int, ids binary, no_id binary, terms binary, held binary, children binary, drops binary")


def _pack(x: bytes | np.ndarray) -> bytes:
    raw = x if isinstance(x, bytes) else x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(x: bytes) -> bytes:
    return pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def _part(docs: list[tuple], vocabulary: dict[bytes, int], docs_with: int, all_terms: int) -> tuple:
    """One row of the index, from (no id, id, n, term numbers, counts)."""
    docs.sort(key=lambda d: d[:2])
    m = np.array([10 + 90 * d[2] * docs_with // all_terms for d in docs], np.int64)
    size = [len(d[3]) for d in docs]
    cols = np.repeat(np.arange(len(docs)), size)
    number, tf = (np.concatenate([d[i] for d in docs]).astype(np.int64) for i in (3, 4))
    held = np.bincount(number, minlength=len(vocabulary))
    words = list(vocabulary)
    by_held = np.lexsort((np.arange(len(words)), -held))
    row = np.empty(len(words), np.int64)
    row[by_held] = np.arange(len(words))
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[cols])
    height, children, drops = build_levels(row[number], cols, impact)
    return (len(docs), height, _pack(np.array([d[1] for d in docs], "<i8")),
            _pack(np.array([d[0] for d in docs], bool)), _pack(b"\n".join(words[i] for i in by_held)),
            _pack(held[by_held].astype("<i4")), _pack(children), _pack(drops))


@dataclass
class Index:
    parts: DataFrame
    docs_with: int
    all_terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Index:
    """Index every document. Two scans: the totals, then the parts."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(terms(t)) for t in texts], dtype="int64")

    totals = docs.select(count(text_col(text)).alias("n")).where("n > 0").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    docs_with, all_terms = totals["docs"], totals["terms"]

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, vocabulary, postings = [], {}, 0
        for f in frames:
            for no_id, i, t in zip(f["no_id"].tolist(), f["id"].tolist(), f["t"]):
                words = terms(t)
                if not words:
                    continue
                number = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int32, len(words))
                number, tf = np.unique(number, return_counts=True)
                held.append((no_id, i, len(words), number, tf.astype(np.int32)))
                postings += len(number)
                if postings >= PART_POSTINGS or len(held) >= PART_DOCS:
                    yield pd.DataFrame([_part(held, vocabulary, docs_with, all_terms)], columns=names)
                    held, vocabulary, postings = [], {}, 0
                    release_memory()
        if held:
            yield pd.DataFrame([_part(held, vocabulary, docs_with, all_terms)], columns=names)
        release_memory()

    names = [c.split()[0] for c in INDEX.split(", ")]
    rows = docs.select(F.col(id_col).isNull().alias("no_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), text_col(text).alias("t"))
    return Index(stage(rows.mapInPandas(parts, INDEX), "treaps"), docs_with, all_terms)


def _weights(index: Index, wanted: list[bytes]) -> dict[bytes, int]:
    """Weight of each wanted term that some document holds."""
    place = {w: k for k, w in enumerate(wanted)}

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(place), np.int64)
        for f in frames:
            for words, n in zip(f["terms"], f["held"]):
                for w, c in zip(_unpack(words).split(b"\n"), np.frombuffer(_unpack(n), "<i4").tolist()):
                    if w in place:
                        total[place[w]] += c
        at = np.flatnonzero(total)
        yield pd.DataFrame({"term": at.astype("i4"), "held": total[at]})

    n = index.docs_with
    rows = index.parts.select("terms", "held").mapInPandas(held, "term int, held long").groupBy("term").agg(
        F.sum("held").alias("held")).collect()  # at most the terms of one block of items
    return {wanted[r["term"]]: math.floor(1000 * math.log((2 * n + 2) / (2 * r["held"] + 1))) for r in rows}


def _search_block(index: Index, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """Candidates (item, no_id, id, score): the best ``k`` of each task."""
    weight = _weights(index, sorted({t for _, ts in items for t in ts}))
    wanted = [(i, [(t, weight[t]) for t in ts if weight.get(t, 0) > 0]) for i, ts in items]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list] = {i: [] for i, _ in wanted}  # (-score, no id, id)
        for f in frames:
            for p in f.itertuples(index=False):
                row = {w: r for r, w in enumerate(_unpack(p.terms).split(b"\n")) if w in weight}
                treap = Treap(p.height, np.frombuffer(_unpack(p.children), np.uint8),
                              np.frombuffer(_unpack(p.drops), "<i4"))
                ids, no_id = np.frombuffer(_unpack(p.ids), "<i8"), np.frombuffer(_unpack(p.no_id), bool)
                for i, ts in wanted:
                    here = [(row[t], w) for t, w in ts if t in row]
                    if not here:
                        continue
                    rows, weights = (np.array(x, np.int64) for x in zip(*here))
                    least = -best[i][-1][0] if len(best[i]) == k else 1
                    at, score = search_part(treap, p.docs, rows, weights, k, least)
                    new = [(-s, bool(no_id[c]), int(ids[c])) for c, s in zip(at.tolist(), score.tolist())]
                    best[i] = sorted(best[i] + new)[:k]
                del treap
                release_memory()
        out = [(i, n, d, -s) for i, b in best.items() for s, n, d in b]
        item, no, doc, score = zip(*out) if out else ((), (), (), ())
        yield pd.DataFrame({"item": np.array(item, np.int64), "no_id": np.array(no, bool),
                            "id": np.array(doc, np.int64), "score": np.array(score, np.int64)})

    return (index.parts.select("docs", "height", "ids", "no_id", "terms", "children", "drops")
            .mapInPandas(run, "item long, no_id boolean, id long, score long"))


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every
    item, those with a score above 0."""
    spark = items.sparkSession
    asked = stage(items.select(F.col(id_col).alias("item_id"), text_col(text).alias("t"))
                  .withColumn("item", F.monotonically_increasing_id()), "items")
    chars = asked.agg(F.coalesce(F.sum(F.char_length("t") + 1), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS) if index.all_terms else 0
    found = spark.createDataFrame([], "item long, no_id boolean, id long, score long")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "t").collect()
        block = [(r["item"], sorted(set(terms(r["t"])))) for r in rows]
        found = found.unionByName(stage(_search_block(index, block, k), "found"))
    order = [F.desc("score"), "no_id", "id"]
    dealt = found.withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    few = (dealt.withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
           .where(F.col("place") <= k).drop("place", "part"))
    best = (few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k))
    return best.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: the 10 best of all documents for every benchmark item."""
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 10)


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL)
  WHERE len(w) > 0),
totals AS (SELECT count(*) AS N, sum(len(w))::BIGINT AS L FROM docs),
asked AS MATERIALIZED (
  SELECT DISTINCT item, item_id, t
  FROM (SELECT item, item_id, unnest(w) AS t
        FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS w FROM benchmark WHERE text IS NOT NULL))),
held AS MATERIALIZED (
  SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY rid, t),
weight AS (
  SELECT t, floor(1000 * ln((2 * N + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), totals),
impact AS (
  SELECT rid, doc_id, t, weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(docs.w) * N) // L))) AS x
  FROM held JOIN docs USING (rid) JOIN weight USING (t), totals),
scored AS (
  SELECT item, item_id, rid, doc_id, sum(x)::BIGINT AS score
  FROM asked JOIN impact USING (t) GROUP BY item, item_id, rid, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10
"""
