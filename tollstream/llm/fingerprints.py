"""One-permutation MinHash fingerprints with optimal densification, packed to
low-order bits.

A text's word shingles are hashed once; the high bits of a hash are its bin,
and each bin keeps its smallest hash. An empty bin copies a bin that is not
empty: bins are tried in an order of their own drawn by hashing (bin, other
bin), which is what makes the densification optimal (no run of empty bins
copies one neighbour). The fingerprint is the low ``bits`` bits of every bin.
Likeness is the share of equal bins, corrected for the chance 2^-bits that
unequal hashes agree in their low bits.

All of it is column expressions over the rows of the scan: no explode, no
shuffle, memory for one text at a time.

Defined cases: a null text is empty; a text without words has an empty
fingerprint, which is alike (1) to another empty one only; a text with fewer
words than a shingle is one shingle; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import let, table, text_col

BINS, BITS, WORDS, SEED = 128, 8, 5, 1


def _bin(h: Column, bins: int) -> Column:
    return F.shiftrightunsigned(h, 64 - int(math.log2(bins)))


def minima(text: Column, bins: int = BINS, words: int = WORDS) -> Column:
    """The smallest shingle hash of each bin that has one, ascending."""
    split = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        shingle = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(0), F.size(w) - words),
            lambda i: F.xxhash64(F.lit(SEED), *[F.get(h, i + k) for k in range(words)])))
        return (F.when(F.size(w) >= words, shingle)
                .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
                .otherwise(F.array().cast("array<bigint>")))

    return let(F.sort_array(let(split, hashes)), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (_bin(x, bins) != _bin(F.get(s, i - 1), bins))))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> Column:
    """Low bits of each bin's hash as array<smallint>; [] without words."""
    low = (1 << bits) - 1

    def dense(m: Column) -> Column:
        by_bin = F.map_from_arrays(F.transform(m, lambda x: _bin(x, bins)), m)
        own = let(by_bin, lambda at: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda j: F.coalesce(
            F.get(F.map_values(F.map_filter(at, lambda k, v: k == j)), F.lit(0)),
            # the first bin that is not empty in j's own order of the bins
            F.array_min(F.transform(m, lambda x: F.struct(
                F.xxhash64(j, _bin(x, bins)).alias("draw"), x.alias("hash"))))["hash"])))
        return F.transform(own, lambda h: h.bitwiseAND(F.lit(low)).cast("smallint"))

    return let(minima(text, bins, words), lambda m: F.when(F.size(m) > 0, dense(m))
               .otherwise(F.array().cast("array<smallint>")))


def packed(fp: Column, bits: int = BITS) -> Column:
    """The fingerprint as hex digits, ``ceil(bits / 4)`` a bin."""
    digits = -(-bits // 4)
    return F.array_join(F.transform(fp, lambda v: F.lower(F.lpad(F.hex(v.cast("bigint")), digits, "0"))), "")


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Similarity of the texts' shingle sets, from two fingerprints."""
    chance = 2.0 ** -bits
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    est = (same / F.size(a) - chance) / (1 - chance)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), est))))


def with_next(docs: DataFrame, key: str, carried: list[str], rows_per_range: int = 512,
              most_ranges: int = 1 << 16) -> DataFrame:
    """``docs`` with a struct ``__next`` of the columns ``carried`` of the
    next row in ascending ``key`` (the first row's, after the last). Rows
    without a key have no place in the order and a null ``__next``. Columns
    ``__next``, ``__range``, ``__copies`` and ``__spread`` are this function's.

    One shuffle, by ranges of the key: their limits are quantiles, and actual
    keys, so the row that begins a range is known before the shuffle and also
    goes, as a ghost, to the end of the range before.
    """
    seen = docs.agg(F.count(key).alias("n"), F.min(key).alias("low")).first()
    n, low = seen["n"], seen["low"]
    cuts: list = []
    if n:
        ranges = min(most_ranges, -(-n // rows_per_range))
        if ranges > 1:
            at = [k / ranges for k in range(1, ranges)]
            cuts = docs.agg(F.percentile_approx(key, at, 20 * ranges)).first()[0]
        cuts = sorted({low, *cuts})
    side = max(1, math.isqrt(len(cuts)))
    groups = [cuts[k:k + side] for k in range(0, len(cuts), side)]
    heads = F.array(*[F.lit(g[0]) for g in groups]) if cuts else F.array().cast("array<bigint>")
    inner = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups]) if cuts else F.array().cast(
        "array<array<bigint>>")
    ended = lambda xs, x: F.size(F.filter(xs, lambda c: c <= x))
    group = ended(heads, F.col(key)) - 1
    place = let(group, lambda g: g * side + ended(F.get(inner, g), F.col(key)) - 1)
    last = len(cuts) - 1
    begins = F.array_contains(F.get(inner, F.floor(F.col("__range") / side).cast("int")), F.col(key))
    body = F.struct(*[F.col(c) for c in carried])
    dealt = docs.withColumn("__range", F.when(F.col(key).isNotNull(), place))
    dealt = dealt.withColumn("__copies", F.when(F.col("__range").isNull(), F.array(F.lit(-1)))
                             .when(begins, F.array(F.col("__range"), F.when(F.col("__range") == 0, F.lit(last))
                                                   .otherwise(F.col("__range") - 1)))
                             .otherwise(F.array(F.col("__range"))))
    dealt = dealt.select(*docs.columns, F.posexplode("__copies").alias("__ghost", "__range"))
    # rows without a key are dealt by hash, the ghosts of the first row come last
    spread = F.when(F.col("__range") < 0, -1 - F.pmod(F.xxhash64(*carried), F.lit(4096)).cast("int")).otherwise(
        F.col("__range"))
    wrapped = (F.col("__ghost") == 1) & (F.col(key) == F.lit(low)) if n else F.lit(False)
    order = Window.partitionBy("__spread").orderBy(F.coalesce(wrapped, F.lit(False)), key, *carried, "__ghost")
    return (dealt.withColumn("__spread", spread)
            .withColumn("__next", F.when(F.col("__range") >= 0, F.lead(body).over(order)))
            .where("__ghost = 0").drop("__ghost", "__range", "__spread"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text: its last quarter
    replaced by the beginning of the next document."""
    rows = docs.select(F.col("doc_id"), text_col().alias("__text"))
    rows = rows.withColumn("__fp", fingerprint(F.col("__text")))
    rows = with_next(rows, "doc_id", ["__text", "__fp"])
    n = F.char_length("__text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("__text", F.lit(1), n - tail),
                      F.coalesce(F.substring(F.col("__next")["__text"], F.lit(1), tail), F.lit("")))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "__fp", F.col("__next")["__fp"].alias("__next_fp"),
                       F.col("__next").isNotNull().alias("__has"), edited.alias("__edited"))
    rows = rows.withColumn("__edited_fp", fingerprint(F.col("__edited")))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
                       packed(F.col("__fp")).alias("fingerprint"), packed(F.col("__edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("__fp"), F.col("__edited_fp")).alias("near_edited"),
                       F.when(F.col("__has"), likeness(F.col("__fp"), F.col("__next_fp"))).alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 128 bins of 8 bits over 5-word shingles of every text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
