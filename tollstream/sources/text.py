"""Line-file source (S3) with an exact file order.

Arrival order matters to the vehicle operators, and a text scan has no
offset. Every file split is read by one task in file order, so (file name,
split start, position) orders the lines: that struct is the order value, made
in the scan itself. Operators only compare order values, so it serves them
as a number does. A dense line number costs a second scan and a join and is
made on request only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import ORDER_COL


def natural_name(path: Column) -> Column:
    """The path with its digit runs padded to 20, so that text order is
    number order (part-100000 after part-99999)."""
    runs = F.regexp_extract_all(path, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike(r"\A\d+\z"), F.lpad(x, 20, "0")).otherwise(x)), "")


def read_lines(spark: SparkSession, path: str, line_number: bool = True, out: str = ORDER_COL,
               order: str = "number", ingest_ts: str | None = None) -> DataFrame:
    """``value`` per line. With ``line_number`` also ``out``: the 0-based line
    number over the files in natural path-name order (``order="number"``), or
    an order value of the same order (``order="value"``). ``ingest_ts`` names
    a column for the time the line's file landed."""
    df = spark.read.text(path)
    stamp = [F.col("_metadata.file_modification_time").alias(ingest_ts)] if ingest_ts else []
    if not line_number:
        return df.select("value", *stamp)
    if order == "value":
        return df.select(order_value().alias(out), "value", *stamp)
    if order != "number":
        raise ValueError(order)
    return number_lines(df, out)


def order_value() -> Column:
    """(file, split start, position) of a line of a text scan."""
    return F.struct(natural_name(F.col("_metadata.file_path")).alias("file"),
                    F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("position"))


def number_lines(df: DataFrame, out: str = ORDER_COL) -> DataFrame:
    """Dense numbers: lines are counted per split (one row per split) and the
    running totals joined back."""
    staged = df.select("value", order_value().alias("_o"))
    splits = staged.groupBy("_o.file", "_o.start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_o.position").alias("_m0"))
    # One row per file split: the running total is over that small table.
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(F.col("file").alias("_f"), F.col("start").alias("_b"), "_m0",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    same_split = (F.col("_o.file") == F.col("_f")) & (F.col("_o.start") == F.col("_b"))
    return staged.join(starts, same_split).select(
        (F.col("_s") + F.col("_o.position") - F.col("_m0")).alias(out), "value")


def write_lines(df: DataFrame, path: str, value_col: str = "value", order_col: str | None = ORDER_COL,
                partitions: int | None = None, mode: str = "errorifexists") -> None:
    """Write one line per row. With ``order_col`` the files are range
    partitioned and sorted on it, so path-name order is row order."""
    out = df
    if order_col is not None:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
    out.select(F.col(value_col).alias("value")).write.mode(mode).text(path)


# Ingest cap of file streams (S4): files a micro-batch takes at most, unless
# the caller says otherwise.
MAX_FILES_PER_TRIGGER = 64


def read_lines_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming line files (S3 + S4): ``value``, ``file`` and ``ingest_ts``
    (the file's modification time: when the lines landed).

    A stream has no line position (``monotonically_increasing_id`` is not
    allowed in streams), so it orders reports by ``time`` with
    ``stream_order`` (``__main__``), which refuses input where that is
    ambiguous; a topic offset is the general answer (``sources.kafka``).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    return df.select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_modification_time").alias("ingest_ts"))


def read_historical_tolls(spark: SparkSession, path: str) -> DataFrame:
    """The historical tolls file (CSV ``vid, day, xway, tolls``), typed. The
    reference documents it but no application reads it."""
    from ..schema import historical_tolls_schema
    return spark.read.schema(historical_tolls_schema()).option("mode", "FAILFAST").csv(path)
