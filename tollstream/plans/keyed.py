"""Toll notifications, keyed dialect (batch).

    reports (type 0) --+--> A1 segment-minute stats --> A2/A3 history --+
                       +--> first report per vid ----------+             |
                       +--> non-exit reports --> V1 join --+-> new seg --> A6 join --> toll

Shuffles: the two aggregates (combined map-side) and at most two joins of
the report stream (by vid, then by segment-minute, the second on the
new-segment rows only); either becomes a broadcast when AQE measures the
small side under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.format import toll_text_keyed
from ..functions.parse import with_minute
from ..functions.toll import latency_ms, toll
from ..operators.arrival import arrival_history
from ..operators.filters import new_segment_only, non_exit, nonzero_toll, position_reports
from ..operators.segments import enrich, segment_history, segment_minute_stats
from ..operators.vehicle import first_reports, flag_new_segment
from ..schema import EXIT_LANE, ORDER_COL, SEGMENT_KEYS
from ..session import stage_table

def keyed_reports(parsed: DataFrame) -> DataFrame:
    return with_minute(position_reports(parsed))


def keyed_enriched(parsed: DataFrame) -> DataFrame:
    """A6 (keyed): every position report with ``minute``, ``lav``, ``num_vehicles``."""
    reports = keyed_reports(parsed)
    history = segment_history(segment_minute_stats(reports))
    return enrich(reports, history, SEGMENT_KEYS)


def toll_notifications_keyed(parsed: DataFrame, emit_zero: bool = False, order_col: str = ORDER_COL,
                             emit_ts: str | None = None, ingest_ts: str | None = None,
                             with_text: bool = False, materialize: bool = True,
                             statistics: str = "complete") -> DataFrame:
    """Keyed toll notifications from parsed reports.

    Rows: new-segment, non-exit position reports, with ``lav``,
    ``num_vehicles`` and ``toll``; zero tolls are dropped unless
    ``emit_zero``. With ``ingest_ts``/``emit_ts`` columns the latency ``emit``
    (ms) is added; ``with_text`` adds the notification text.

    The plan reads its input four times (reports, per-vehicle aggregate,
    its hot-key threshold, segment statistics). With ``materialize`` (the
    default) the position reports are first written to a table in the shared
    folder: a line source is parsed once, each read scans only its columns,
    and the lineage is cut there. Pass ``materialize=False`` when the input
    already is a columnar table.

    ``statistics``: ``complete`` minutes (what arrival order gives where event
    time never decreases), or ``arrival``: as they stood when each report
    arrived, for input in any order.
    """
    if statistics not in ("complete", "arrival"):
        raise ValueError(statistics)
    if materialize:
        parsed = stage_table(position_reports(parsed), "parsed-reports")
    reports = keyed_reports(parsed)
    if statistics == "arrival":  # all reports count, the candidates are answered
        asked = flag_new_segment(reports, order_col).withColumn(
            "_asked", F.col("in_new_seg") & (F.col("lane") != EXIT_LANE))
        enriched = arrival_history(asked, SEGMENT_KEYS, order_col, asked="_asked")
    else:
        history = segment_history(segment_minute_stats(reports))
        first = first_reports(reports, order_col)
        candidates = new_segment_only(flag_new_segment(non_exit(reports), order_col, first=first, counted=reports))
        enriched = enrich(candidates, history, SEGMENT_KEYS)
    out = enriched.select("*", toll(F.col("num_vehicles"), F.col("lav")).alias("toll"))
    if not emit_zero:
        out = nonzero_toll(out)
    cols = [order_col, "vid", "time", "lav", "num_vehicles", "toll"]
    if ingest_ts is not None:
        emit = latency_ms(F.col(emit_ts) if emit_ts else F.current_timestamp(), F.col(ingest_ts))
        out = out.withColumn("emit", emit)
        cols.append("emit")
        if with_text:
            out = out.withColumn("text", toll_text_keyed(F.col("vid"), F.col("time"), F.col("emit"),
                                                         F.col("lav"), F.col("toll")))
            cols.append("text")
    return out.select(*cols)
