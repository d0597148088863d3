"""Rendezvous sharding of records by a stable key over weighted shards.

Every (key, shard) pair has a hash; a record goes to the shard with the
highest ``-weight / ln(u)``, u being that hash as a number in (0, 1). A
shard's draw doesn't depend on the other shards, so a new shard only takes
records, from all others in proportion, and moves none between them.

The draws are column expressions over md5, which other engines have too; no
shuffle is needed to place a record. Places inside a shard (slots) follow
(key, checksum, size). A shard can hold any share of the rows, so they are
counted in ranges of that order: rows are numbered inside a range, and a
range begins where the shard's rows of the ranges before it end. Equal rows
are told apart by a row number, so that copies don't fill one range.

Defined cases: a null key is a key like any other ('' with a mark no id has);
a null text has no bytes: size 1; repeated rows go to the same shard, each
with its own slot; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stage, table

RANGE_ROWS = 100_000


def draw(key: Column, shard: int, seed: str = "") -> Column:
    """The pair's number in (0, 1): 48 bits of md5."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"/{shard}/{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 48))


def shard_of(key: Column, weights: list[float], seed: str = "") -> Column:
    """Number of the winning shard; of equal scores the lowest number."""
    scored = [F.struct((-F.lit(float(w)) / F.log(draw(key, s, seed))).alias("score"),
                       F.lit(-s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    return -(F.greatest(*scored) if len(scored) > 1 else scored[0])["shard"]


def assign(docs: DataFrame, weights: list[float], grown: list[float] | None = None,
           seed: str = "") -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with the weights
    ``grown``) and slot, gapless from 0 within a shard."""
    text = F.col("text").cast("string")
    placed = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id"), weights, seed).cast("int").alias("shard"),
        (shard_of(F.col("doc_id"), grown, seed) if grown else F.lit(None)).cast("int").alias("grown_shard"))
    return _with_slots(stage(placed.withColumn("__row", F.monotonically_increasing_id()), "placed"))


def _with_slots(placed: DataFrame) -> DataFrame:
    order = ["doc_id", "text_crc32", "size", "__row"]
    ranges = max(1, -(-placed.count() // RANGE_ROWS))
    dealt = stage(placed.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("__n")).select(  # a row per shard and range
        "shard", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    inside = F.row_number().over(Window.partitionBy("shard", "__range").orderBy(*order)) - 1
    return (dealt.withColumn("__inside", inside).join(begins, ["shard", "__range"])
            .withColumn("slot", (F.col("__begin") + F.col("__inside")).cast("long"))
            .select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: shards 0 to 7 of equal weight, and 8 beside them."""
    out = assign(table(spark, sf_dir, "documents"), [1.0] * 8, [1.0] * 9)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# crc32 by the bytes of the text: table of 256, one step a byte.
SQL = """
WITH crc AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1
             THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n))),
sized AS (
  SELECT row_number() OVER () AS n, doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents),
summed AS (
  SELECT n, doc_id, size, xor(4294967295, list_reduce(
           [CAST(4294967295 AS BIGINT)] || list_transform(range(CAST(length(h) // 2 AS BIGINT)),
             lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
           lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8))) AS text_crc32
  FROM sized, crc),
scored AS (
  SELECT n, doc_id, size, text_crc32, s,
         -1.0 / ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || s || '/'), 1, 12)
                    AS BIGINT) + 0.5) / 281474976710656.0) AS score
  FROM summed, range(9) r(s)),
placed AS (
  SELECT doc_id, size, text_crc32,
         CAST(arg_max(s, score) FILTER (s < 8) AS INTEGER) AS shard,
         CAST(arg_max(s, score) AS INTEGER) AS grown_shard
  FROM scored GROUP BY n, doc_id, size, text_crc32)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot,
       grown_shard
FROM placed
"""
