"""Helpers the text operators share: tables, staging, ranks, worker code."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_code

# Spark's settings for the batches that go to Python, their defaults, and
# what suits rows that hold whole texts: the buffers of a batch are direct
# memory, which the JVM gives back late.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
           "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers. Arrow batches get a
    size for rows with texts, unless the session has one of its own."""
    for key, (default, suited) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, suited)
    ship_code(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back with the known schema: cuts
    the lineage, survives the loss of executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory back to the system: a worker lives on for other
    stages, and allocators keep what they once held."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows as pandas; without rows the columns keep no type of their own."""
    return pd.DataFrame(rows, columns=columns) if rows else pd.DataFrame(columns=columns, dtype=object)


def text_col(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where
    ``body`` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def training_fold(doc_id: Column) -> Column:
    """True for rows whose labels may be learned from: crc32 of the id as
    text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def ranked(df: DataFrame, groups: list[str], order: list[str], salt: Column,
           rank: str, rows_per_task: int = 10_000) -> DataFrame:
    """A gapless number from 0 within each group, without one task per group.

    Each group is dealt over ``salt`` parts; parts are counted first (a row
    per group and part), their running sums are the offsets, and rows are
    numbered inside their part. The number of groups must be bounded; the
    number of parts follows the row count.
    """
    rows = df.count()
    parts = max(1, -(-rows // rows_per_task))
    dealt = df.withColumn("__part", F.pmod(salt, F.lit(parts)).cast("int"))
    # a few groups with as many rows as the rest: window by (group, part)
    counts = dealt.groupBy(*groups, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "__part",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    keys = [*groups, "__part"]
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    numbered = dealt.withColumn("__local", local)
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    both = cond[0]
    for c in cond[1:]:
        both = both & c
    joined = numbered.alias("l").join(offsets.alias("r"), both, "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns],
                         (F.col("l.__local") + F.col("r.__before")).cast("long").alias(rank))
