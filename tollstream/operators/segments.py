"""Segment statistics, LAV, car count and enrichment.

Statistics are "complete minute" statistics. The reference reads them as
seen so far in arrival order; with event time non-decreasing in arrival
order (true of Linear Road input) only minutes before the report's minute
are read, and those are complete, so both agree. The exact arrival-order
variant is in ``tollstream.streaming.exact``.

Scale notes
- A1 is a two-level aggregate: (key, minute, vid) then (key, minute). Both
  levels combine map-side, so a hot segment or vehicle is reduced before
  the shuffle; the distinct count needs no set of vids in memory.
- A2/A3 run on the aggregated rows, never on reports. The keyed form is a
  window partitioned by segment; one partition holds one row per minute of
  that segment, at most 1093 rows because ``time`` is a short.
- The global form has no partition key, so instead of an unpartitioned
  window each minute row is fed forward to the five minutes it serves and
  re-aggregated (an aggregate, not a window).
- A6 joins reports to the aggregated rows. Keyed: the history table grows
  with expressways x segments x minutes, so no broadcast is forced; AQE
  broadcasts it when its measured size is under the threshold and splits
  skewed partitions otherwise. Global: the table has one row per minute,
  bounded by the short ``time`` type, and is broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.toll import lav as lav_expr
from ..schema import HISTORY_MINUTES, SEGMENT_KEYS

# Rows of a per-minute table when `time` is a short: minutes -545 .. 547
# (1093 values, Java/Spark integer division truncates), plus the minutes fed
# forward by the history.
MINUTES_BOUND = 1093 + HISTORY_MINUTES


def segment_minute_stats(reports: DataFrame, keys: list[str] | None = None,
                         minute_col: str = "minute", vid_col: str = "vid",
                         speed_col: str = "speed") -> DataFrame:
    """A1/A4: per key and minute: ``reports`` (count), ``speed_sum``, ``cars``
    (distinct vehicles). ``keys=[]`` gives the per-minute (global) form."""
    keys = SEGMENT_KEYS if keys is None else keys
    per_vehicle = reports.groupBy(*keys, minute_col, vid_col).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(speed_col).cast("bigint")).alias("_s"))
    return per_vehicle.groupBy(*keys, minute_col).agg(
        F.sum("_n").cast("bigint").alias("reports"),
        F.sum("_s").cast("bigint").alias("speed_sum"),
        F.count(F.lit(1)).cast("bigint").alias("cars"),
    )


def _finish(df: DataFrame, minute_col: str, hist_cnt: str, hist_speed: str, prev_cars: str) -> DataFrame:
    """LAV and car count from the history sums; 0 for minute <= 1."""
    first = F.col(minute_col) <= 1
    cnt = F.coalesce(F.col(hist_cnt), F.lit(0))
    spd = F.coalesce(F.col(hist_speed), F.lit(0))
    lav = F.when(first, F.lit(0)).otherwise(lav_expr(spd, cnt))
    cars = F.when(first, F.lit(0)).otherwise(F.coalesce(F.col(prev_cars), F.lit(0)).cast("int"))
    keep = [c for c in df.columns if c not in (hist_cnt, hist_speed, prev_cars)]
    return df.select(*keep, lav.alias("lav"), cars.alias("num_vehicles"))


def segment_history(stats: DataFrame, keys: list[str] | None = None, minute_col: str = "minute",
                    history: int = HISTORY_MINUTES) -> DataFrame:
    """A2 + A3 (keyed), one window operator with two frames.

    ``lav``: report-weighted mean speed over minutes m-5..m-1 present for the
    segment (missing minutes are skipped), 0 without history.
    ``num_vehicles``: distinct vehicles in minute m-1, 0 if that minute is
    absent. Both are 0 for minute <= 1.
    """
    keys = SEGMENT_KEYS if keys is None else keys
    w = Window.partitionBy(*keys).orderBy(minute_col)
    hist = w.rangeBetween(-history, -1)
    prev = w.rangeBetween(-1, -1)
    df = stats.select(
        *keys, minute_col, "reports", "speed_sum", "cars",
        F.sum("reports").over(hist).alias("_hc"),
        F.sum("speed_sum").over(hist).alias("_hs"),
        F.max("cars").over(prev).alias("_pc"),
    )
    return _finish(df, minute_col, "_hc", "_hs", "_pc")


def minute_history(stats: DataFrame, keys: list[str] | None = None, minute_col: str = "minute",
                   history: int = HISTORY_MINUTES, present_only: bool = False) -> DataFrame:
    """A5: the same quantities without a window: each minute row is sent to
    itself and the ``history`` minutes after it and re-aggregated. Rows exist
    for every minute that has history or reports; with ``present_only`` for
    the minutes of ``stats`` alone."""
    keys = [] if keys is None else keys
    shifted = stats.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.lit(history))).alias("_d"),
        F.col(minute_col).alias("_src"), "reports", "speed_sum", "cars",
    ).select(*keys, (F.col("_src") + F.col("_d")).alias(minute_col), "_d", "reports", "speed_sum", "cars")
    before = F.col("_d") > 0
    agg = shifted.groupBy(*keys, minute_col).agg(
        F.sum(F.when(before, F.col("reports"))).alias("_hc"),
        F.sum(F.when(before, F.col("speed_sum"))).alias("_hs"),
        F.max(F.when(F.col("_d") == 1, F.col("cars"))).alias("_pc"),
        F.min("_d").alias("_nearest"),
    )
    agg = agg.where("_nearest = 0") if present_only else agg
    return _finish(agg.drop("_nearest"), minute_col, "_hc", "_hs", "_pc")


def minute_lav(stats: DataFrame, minute_col: str = "minute", history: int = HISTORY_MINUTES) -> DataFrame:
    """A5 restricted to the minutes present in ``stats`` (global dialect)."""
    return minute_history(stats, [], minute_col, history, present_only=True)


def time_is_short(df: DataFrame, time_col: str = "time") -> bool:
    return time_col in df.columns and isinstance(df.schema[time_col].dataType, T.ShortType)


def enrich(reports: DataFrame, history: DataFrame, keys: list[str] | None = None,
           minute_col: str = "minute", bounded: bool = False) -> DataFrame:
    """Attach ``lav`` and ``num_vehicles`` to each report.

    A report whose key and minute has no history row gets 0 and 0 (that is
    also the rule for minute <= 1). ``bounded=True`` states that ``history``
    has a proven small size (one row per minute of a short time range) and
    broadcasts it; otherwise AQE decides from the measured size.
    """
    keys = SEGMENT_KEYS if keys is None else keys
    side = history.select(*keys, minute_col, "lav", "num_vehicles")
    if bounded:
        side = F.broadcast(side)
    j = reports.join(side, [*keys, minute_col], "left")
    return j.select(*reports.columns, F.coalesce(F.col("lav"), F.lit(0)).alias("lav"),
                    F.coalesce(F.col("num_vehicles"), F.lit(0)).alias("num_vehicles"))
