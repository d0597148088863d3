"""Log analysis of pass-through output.

The reference cut one wall second out of a worker log with ``sed`` and
counted lines by hand. Here a log is a table of text lines whose first 23
characters are a ``yyyy-MM-dd HH:mm:ss.SSS`` stamp; the range is a true
time range (the ``sed`` form needs a line at the exact start stamp).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CLOCK_FORMAT

STAMP_WIDTH = len("yyyy-MM-dd HH:mm:ss.SSS")


def log_lines(lines: DataFrame, stamp: Column, logger: Column, value_col: str = "value",
              keep: list[str] | None = None) -> DataFrame:
    """Build log text ``<stamp> INFO <logger> - input = [<line>]``."""
    keep = [] if keep is None else keep
    text = F.format_string("%s INFO %s - input = [%s]", F.date_format(stamp, CLOCK_FORMAT),
                           logger, F.col(value_col))
    return lines.select(*keep, text.alias("line"))


def log_stamp(line_col: str = "line") -> Column:
    """The leading stamp as a zone-free timestamp."""
    return F.to_timestamp_ntz(F.substring(F.col(line_col), 1, STAMP_WIDTH), F.lit(CLOCK_FORMAT))


def marker_filter(log: DataFrame, marker: str, line_col: str = "line") -> DataFrame:
    """lines containing ``marker`` (``sed -n '/marker/p'``)."""
    return log.where(F.col(line_col).contains(marker))


def _ntz(v: str | _dt.datetime) -> Column:
    if isinstance(v, _dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(v))


def time_range(log: DataFrame, start: str | _dt.datetime, end: str | _dt.datetime,
               line_col: str = "line") -> DataFrame:
    """lines stamped in ``[start, end)``."""
    ts = log_stamp(line_col)
    return log.where((ts >= _ntz(start)) & (ts < _ntz(end)))


def throughput_per_second(log: DataFrame, line_col: str = "line", slice_seconds: int = 1,
                          delay: str = "1 second") -> DataFrame:
    """Records per one-second slice of the log stamps, ``second`` as
    ``yyyy-MM-dd HH:mm:ss`` text and ``records``. Partial counts per task,
    one row per second after the shuffle. On a stream the stamp is
    watermarked (``delay``; watermarks need a zoned timestamp, read and
    written back in the session zone) and a second is emitted once closed."""
    if log.isStreaming:
        zoned = F.to_timestamp(F.substring(F.col(line_col), 1, STAMP_WIDTH), CLOCK_FORMAT)
        log = log.withColumn("_stamp", zoned).withWatermark("_stamp", delay)
        stamp = F.col("_stamp")
    else:
        stamp = log_stamp(line_col)
    w = F.window(stamp, f"{slice_seconds} second")
    return (log.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("records"))
            .select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("second"), "records"))
