"""Toll assessments, global dialect (batch).

Vehicle stage *filters* (first segment only), statistics are per minute
over all segments together, zero tolls are emitted. The per-minute history
has one row per minute (bounded by the short ``time``), so it is broadcast
and the kept reports are never shuffled for A6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.format import toll_text_global
from ..functions.parse import with_minute
from ..functions.toll import latency_ms, toll
from ..operators.arrival import arrival_history
from ..operators.filters import non_exit, position_reports
from ..operators.segments import enrich, minute_history, minute_lav, segment_minute_stats, time_is_short
from ..operators.vehicle import keep_first_segment
from ..schema import EXIT_LANE, ORDER_COL
from ..session import stage_table


def global_kept(parsed: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """V2 output with ``minute``."""
    return keep_first_segment(with_minute(position_reports(parsed)), order_col)


def global_stats(parsed: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """A4: per-minute statistics over the kept reports."""
    return segment_minute_stats(global_kept(parsed, order_col), keys=[])


def global_lav(parsed: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """A5: per minute present, ``lav`` and ``num_vehicles``."""
    return minute_lav(global_stats(parsed, order_col))


def toll_notifications_global(parsed: DataFrame, order_col: str = ORDER_COL,
                              emit_ts: str | None = None, ingest_ts: str | None = None,
                              with_text: bool = False, materialize: bool = True,
                              statistics: str = "complete") -> DataFrame:
    """Global toll assessments; ``materialize`` and ``statistics`` as in the
    keyed plan (the input is read three times: reports, per-vehicle
    aggregate, threshold)."""
    if statistics not in ("complete", "arrival"):
        raise ValueError(statistics)
    if materialize:
        parsed = stage_table(position_reports(parsed), "parsed-reports")
    kept = global_kept(parsed, order_col)
    if statistics == "arrival":
        out = arrival_history(kept.withColumn("_asked", F.col("lane") != EXIT_LANE), [], order_col, asked="_asked")
    else:
        history = minute_history(segment_minute_stats(kept, keys=[]))
        out = enrich(non_exit(kept), history, keys=[], bounded=time_is_short(kept))
    out = out.select("*", toll(F.col("num_vehicles"), F.col("lav")).alias("toll"))
    cols = [order_col, "vid", "time", "lav", "num_vehicles", "toll"]
    if ingest_ts is not None:
        emit = latency_ms(F.col(emit_ts) if emit_ts else F.current_timestamp(), F.col(ingest_ts))
        out = out.withColumn("emit", emit)
        cols.append("emit")
        if with_text:
            out = out.withColumn("text", toll_text_global(F.col("vid"), F.col("time"), F.col("emit"),
                                                          F.col("lav"), F.col("toll")))
            cols.append("text")
    return out.select(*cols)
