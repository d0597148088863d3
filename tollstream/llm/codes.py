"""Vector codes: integer product quantisation over Hilbert-sorted flat blocks.

Vectors become integers and are cut into ``parts`` equal consecutive parts.
The parts of one position are sorted along a Hilbert curve and stored in flat
blocks of ``block_rows``: the values, their minimum and maximum per component
(the box) and their sum. A round of training, and the final coding, reads the
blocks once: the distances from a codebook entry to a block's box bound those
to all its members, so entries whose least distance is over the smallest
greatest distance drop out. What is left is the block's shortlist. A
shortlist of one entry takes the block by its stored sum; a longer one is
evaluated member by member in 64-bit integers. Nothing is approximated, the
shortlist only leaves out entries that can't be nearest.

Scale: one range shuffle deals blocks (equal vectors are spread by a row
number, so copies don't meet in one task); each round returns a row per
(part, entry) from each task, summed by Spark; the driver holds codebooks
only (``parts * entries`` rows, a parameter). Blocks are a staged table, so a
lost executor costs its tasks.

Defined cases: rows whose vector is null, or holds a null or non-finite
component, are dropped, and so are vectors of another length than the most
frequent one (ties: the longer). A length that ``parts`` doesn't divide is
filled up with zeros. Integers are held within +-2^28, so that sums of
squares stay in 64 bits. Repeated rows are coded each; null ids sort last; a
null label is a group of its own. With fewer vectors than entries the
codebooks are as long as there are vectors. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship, stage, table

SCALE = 1024
LIMIT = 1 << 28
BLOCK_ROWS = 64


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of rows of ``bits``-bit coordinates
    (at most 64 bits in all), as a signed long of the same order."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the turns of the curve, large cells first
        low = np.uint64((1 << b) - 1)
        for i in range(dims):
            flip = (x[i] >> np.uint64(b)) & one == one
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low).astype(np.uint64)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code over the dimensions
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] >> np.uint64(b)) & one == one, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= fix
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return (key ^ np.uint64(1 << 63)).view(np.int64) if dims * bits == 64 else key.view(np.int64)


def box_shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Indexes of the entries that may be nearest to some point of the box,
    ascending: least distance not over the smallest greatest distance."""
    below, above = low - entries, entries - high
    least = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=1)
    most = np.square(np.maximum(np.abs(entries - low), np.abs(high - entries))).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(values: np.ndarray, entries: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each value's nearest entry out of the
    shortlist ``few``; ties go to the lower index.

    Integers throughout: as a matrix product of doubles where every sum is
    below 2^53 and so exact, else of 64-bit integers.
    """
    own = entries[few]
    most = max(int(np.abs(values).max()), int(np.abs(own).max()))
    if 4 * values.shape[1] * most * most < 1 << 53:
        v, e = values.astype(np.float64), own.astype(np.float64)
        apart = (v * v).sum(axis=1)[:, None] - 2 * (v @ e.T) + (e * e).sum(axis=1)
    else:
        apart = np.square(values[:, None, :] - own[None, :, :]).sum(axis=2)
    best = apart.argmin(axis=1)
    return few[best], apart[np.arange(len(values)), best].astype(np.int64)


def integers(column: str, length: int, dims: int):
    """Column expression: floor(1024 * x) of ``length`` components, filled to
    ``dims``, as little-endian 32-bit integers."""

    @F.pandas_udf("binary")
    def cast(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            whole = np.zeros(dims, "<i4")
            whole[:length] = np.clip(np.floor(np.asarray(v, np.float64) * SCALE), -LIMIT, LIMIT)
            out.append(whole.tobytes())
        return pd.Series(out, dtype=object)

    return cast(F.col(column))


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, vector and label of the rows that can be coded, and the vector's
    length as ``n``."""
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                           F.col(label_col).alias("label"))
            .where(F.col("v").isNotNull() & finite).withColumn("n", F.size("v")))


def blocks(base: DataFrame, parts: int, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The flat blocks of all part positions, from rows (rid, v)."""
    spark = base.sparkSession
    bits = max(1, min(16, 64 // width))
    used = min(width, 64)

    def reach(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = high = None
        for f in frames:
            for v in f["v"]:
                v = np.frombuffer(v, "<i4")
                low, high = (v, v) if low is None else (np.minimum(low, v), np.maximum(high, v))
        if low is not None:
            yield pd.DataFrame({"at": np.arange(len(low)), "low": low.astype("i8"), "high": high.astype("i8")})

    ends = sorted((r["at"], r["low"], r["high"]) for r in base.select("v").mapInPandas(reach, "at int, low long, high long")
                  .groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    low = np.array([e[1] for e in ends], np.int64).reshape(parts, width)
    span = np.maximum(np.array([e[2] for e in ends], np.int64).reshape(parts, width) - low, 1)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            v = np.frombuffer(b"".join(f["v"]), "<i4").reshape(len(f), parts, width)
            for p in range(parts):
                own = np.ascontiguousarray(v[:, p])
                cells = ((own - low[p]) * (1 << bits) // (span[p] + 1))[:, :used]
                yield pd.DataFrame({"part": np.full(len(f), p, "i4"), "place": hilbert_key(cells, bits),
                                    "rid": f["rid"], "sub": [x.tobytes() for x in own]})

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for p, own in f.groupby("part", sort=False):
                rid = own["rid"].to_numpy().astype("<i8")
                v = np.frombuffer(b"".join(own["sub"]), "<i4").reshape(len(own), width)
                for at in range(0, len(own), block_rows):
                    b = v[at:at + block_rows]
                    rows.append((int(p), len(b), b.min(axis=0).tobytes(), b.max(axis=0).tobytes(),
                                 b.sum(axis=0, dtype="<i8").tobytes(), rid[at:at + block_rows].tobytes(), b.tobytes()))
            yield pd.DataFrame(rows, columns=["part", "n", "low", "high", "total", "rids", "members"])

    dealt = stage(base.select("rid", "v").mapInPandas(deal, "part int, place long, rid long, sub binary"), "parts")
    sorted_ = dealt.repartitionByRange("part", "place", "rid").sortWithinPartitions("part", "place", "rid")
    return stage(sorted_.mapInPandas(
        cut, "part int, n int, low binary, high binary, total binary, rids binary, members binary"), "blocks")


def _assigned(f: pd.DataFrame, codebooks: np.ndarray) -> Iterator[tuple]:
    """Per block of a batch: its row, part and shortlist; index and distance
    of each member, or None if one entry takes the whole block."""
    for b in f.itertuples(index=False):
        entries = codebooks[b.part]
        few = box_shortlist(np.frombuffer(b.low, "<i4").astype(np.int64),
                            np.frombuffer(b.high, "<i4").astype(np.int64), entries)
        yield b, entries, few


def train_round(flat: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, each used entry to the
    floored mean of its parts."""
    parts, entries, width = codebooks.shape

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for f in frames:
            for b, book, few in _assigned(f, codebooks):
                if len(few) == 1:
                    count[b.part, few[0]] += b.n
                    total[b.part, few[0]] += np.frombuffer(b.total, "<i8")
                else:
                    v = np.frombuffer(b.members, "<i4").reshape(b.n, width).astype(np.int64)
                    code, _ = nearest(v, book, few)
                    np.add.at(count[b.part], code, 1)
                    np.add.at(total[b.part], code, v)
        part, entry = np.nonzero(count)
        yield pd.DataFrame({"part": part.astype("i4"), "entry": entry.astype("i4"), "count": count[part, entry],
                            "total": list(total[part, entry])})

    found = (flat.mapInPandas(sums, "part int, entry int, count long, total array<long>")
             .groupBy("part", "entry")
             .agg(F.sum("count").alias("count"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")))
    out = codebooks.copy()
    for r in found.collect():  # at most parts * entries rows
        out[r["part"], r["entry"]] = np.array(r["total"], np.int64) // r["count"]
    return out


def coded(flat: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """rid, part, code and squared distance of every part."""
    width = codebooks.shape[2]

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for b, book, few in _assigned(f, codebooks):
                v = np.frombuffer(b.members, "<i4").reshape(b.n, width).astype(np.int64)
                index, apart = nearest(v, book, few)
                yield pd.DataFrame({"rid": np.frombuffer(b.rids, "<i8"), "part": np.full(b.n, b.part, "i4"),
                                    "code": index.astype("i4"), "apart": apart})

    return flat.mapInPandas(code, "rid long, part int, code int, apart long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes array, error) of every vector that can be coded, and
    the codebooks as an array (parts, entries, components).

    Each codebook starts as that part of the ``entries`` smallest ids.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_col, vector_col, label_col)
    common = rows.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    length = common["n"] if common else 0
    width = max(1, -(-length // parts))
    base = stage(rows.where(F.col("n") == length).select("id", "label", integers("v", length, parts * width).alias("v"))
                 .withColumn("rid", F.monotonically_increasing_id()), "vectors")
    start = base.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
    books = np.array([np.frombuffer(r["v"], "<i4") for r in start], np.int64).reshape(len(start), parts, width)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    named = base.select("rid", "id", "label")
    if not start:
        return named.select("id", "label", F.array().cast("array<int>").alias("codes"),
                            F.lit(0).cast("long").alias("error")), books
    flat = blocks(base, parts, width)
    for _ in range(rounds):
        books = train_round(flat, books)
    whole = coded(flat, books).groupBy("rid").agg(
        F.array(*[F.max(F.when(F.col("part") == p, F.col("code"))) for p in range(parts)]).alias("codes"),
        F.sum("apart").alias("error"))
    return named.join(whole, "rid").select("id", "label", "codes", "error"), books


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 4 parts, 256 entries, 4 rounds over ``embeddings``."""
    out, books = compress(table(spark, sf_dir, "embeddings"))
    out = stage(out, "codes")
    by_label = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "l")
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return out.join(by_label, out["label"].eqNullSafe(by_label["l"])).select(
        F.col("id").alias("vec_id"), F.array_join(hexed, "").alias("code"), "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    return f"""
a{k} AS (SELECT rid, part, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
    SELECT p.rid, p.part, c.e, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM p JOIN c{k} c USING (part)) GROUP BY rid, part)"""


def _update_sql(k: int) -> str:
    """Codebook k + 1: floored means of what round k assigned."""
    return f"""
s{k} AS (SELECT part, e, i, (s - ((s % n) + n) % n) // n AS x FROM (
    SELECT part, e, i, sum(v[i])::BIGINT AS s, count(*) AS n
    FROM a{k} JOIN p USING (rid, part), i GROUP BY part, e, i)),
c{k + 1} AS (SELECT c.part, c.e, coalesce(m.v, c.v) AS v FROM c{k} c
    LEFT JOIN (SELECT part, e, list(x::BIGINT ORDER BY i) AS v FROM s{k} GROUP BY part, e) m USING (part, e))"""


# The contract as plain SQL: every part against every entry, no blocks.
SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
part AS (SELECT unnest(range(4)) AS part),
p AS MATERIALIZED (
  SELECT rid, part, list_slice(v, 1 + part * (len(v) // 4), (part + 1) * (len(v) // 4)) AS v FROM kept, part),
i AS (SELECT unnest(range(1, 1 + coalesce((SELECT max(len(v)) FROM p), 0))) AS i),
c0 AS (SELECT part, rid - 1 AS e, v FROM p WHERE rid <= 256)""" + "".join(
    "," + _round_sql(k) + "," + _update_sql(k) for k in range(4)) + "," + _round_sql(4) + """,
book AS (SELECT sha256(string_agg(v[i]::VARCHAR, ',' ORDER BY part, e, i)) AS codebooks_sha256 FROM c4, i),
coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a4 GROUP BY rid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), book
"""
