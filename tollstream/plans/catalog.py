"""Registered queries: one per operator of the inventory, each
``(spark, sf_dir) -> DataFrame`` over the ``events`` table of ``sf_dir``.

The fixed inputs used here (clock, emit, time range, replay second) are
deterministic stand-ins for the wall clock, so results can be compared with
the SQL oracles in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.format import full_csv, toll_text_global, toll_text_keyed
from ..functions.parse import (event_time, parse_full_lenient, parse_reports, rejected_lines,
                               with_ingest_time, with_minute)
from ..functions.toll import latency_ms, toll
from ..operators.filters import non_exit, position_reports
from ..operators.logs import log_lines, marker_filter, throughput_per_second, time_range
from ..operators.replay import replay_prefix
from ..operators.segments import segment_history, segment_minute_stats
from ..operators.vehicle import flag_new_segment, keep_first_segment
from ..schema import ORDER_COL
from ..session import scratch_path, stage_table
from ..sources.events import (TIME_ORIGIN, load_lines, load_reports, load_table, once_per_session, report_lines,
                              reports_from_events, staged_lines, staged_reports)
from ..sources.json_value import json_value_text
from ..sources.kafka import drop_redelivered
from ..sources.text import read_lines, write_lines
from ..streaming.sinks import to_kafka_frame
from .global_ import global_lav, global_stats, toll_notifications_global
from .keyed import keyed_enriched, toll_notifications_keyed
from .passthrough import passthrough_stamped, passthrough_text

Query = Callable[[SparkSession, str], DataFrame]

REPORT_COLS = [ORDER_COL, "type", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos"]
REPLAY_SECOND = 600
LOG_MARKER = "consume"
LOG_RANGE = ("2024-01-01 00:10:00", "2024-01-01 00:10:10")


def parsed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as the applications see them: CSV lines from the source,
    strictly parsed."""
    return parse_reports(staged_lines(spark, sf_dir))


def _fixed_clock() -> Column:
    """Deterministic clock: 1970-01-02 + time s + (offset % 1000) ms (zone free)."""
    return F.expr("timestampadd(MILLISECOND, `offset` % 1000, "
                  "timestampadd(SECOND, `time`, TIMESTAMP_NTZ'1970-01-02 00:00:00'))")


def _fixed_emit() -> Column:
    return (F.col(ORDER_COL) % 997).cast("bigint")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass-through log built from the lines: the stamp is the event time
    compressed like report time, every fifth line comes from another logger.
    A log is a stored table (a filter on a line that is still an expression
    would build every line twice), so it is written once per session."""
    def make() -> DataFrame:
        events = load_table(spark, sf_dir, "events")
        lines = report_lines(reports_from_events(events, keep=["ts"]), keep=["ts"])
        stamp = F.expr(f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{TIME_ORIGIN}', ts) "
                       f"div 1440, TIMESTAMP_NTZ'{TIME_ORIGIN}')")
        logger = F.when(F.col(ORDER_COL) % 5 == 0, F.lit("parse")).otherwise(F.lit("consume"))
        return stage_table(log_lines(lines, stamp, logger, keep=[ORDER_COL]), "log")

    return once_per_session(spark, ("log", sf_dir), make)


def q_position_reports(spark, sf_dir):
    return position_reports(parsed_reports(spark, sf_dir)).select(*REPORT_COLS)


def q_parse_position_reports(spark, sf_dir):
    return parsed_reports(spark, sf_dir).select(*REPORT_COLS)


def q_parse_permissive_reports(spark, sf_dir):
    return parse_reports(staged_lines(spark, sf_dir, broken=True), mode="permissive")


def q_parse_rejects(spark, sf_dir):
    return rejected_lines(staged_lines(spark, sf_dir, broken=True))


def q_parse_full_lenient(spark, sf_dir):
    return parse_full_lenient(staged_lines(spark, sf_dir, broken=True))


def q_format_full_csv(spark, sf_dir):
    t = parse_full_lenient(staged_lines(spark, sf_dir, broken=True))
    return t.select(ORDER_COL, full_csv(t).alias("value"))


def q_minute_bucket(spark, sf_dir):
    return with_minute(load_reports(spark, sf_dir)).select(ORDER_COL, "time", "minute")


def q_event_time(spark, sf_dir):
    r = load_reports(spark, sf_dir)
    return r.select(ORDER_COL, F.unix_micros(event_time(F.col("time"))).alias("event_time_us"))


def q_passthrough_stamped(spark, sf_dir):
    # The fixed clock needs `time`: field 1 of the line itself.
    lines = staged_lines(spark, sf_dir)
    lines = lines.withColumn("time", F.get(F.split("value", ","), 1).cast("smallint"))
    return passthrough_stamped(lines, clock=_fixed_clock()).select(ORDER_COL, "stamp", "value", "text")


def q_passthrough_text(spark, sf_dir):
    return passthrough_text(staged_lines(spark, sf_dir))


def q_toll_formula(spark, sf_dir):
    r = load_reports(spark, sf_dir).select(
        ORDER_COL, (F.col("vid") % 120).cast("int").alias("num_vehicles"),
        (F.col("speed") % 80).cast("int").alias("lav"))
    return r.withColumn("toll", toll(F.col("num_vehicles"), F.col("lav")))


def q_latency_ms(spark, sf_dir):
    r = load_reports(spark, sf_dir)
    ingest = event_time(F.col("time"))
    emit = F.timestamp_micros(F.unix_micros(ingest) + (F.col(ORDER_COL) % 997) * 1000 + (F.col(ORDER_COL) % 7) * 100)
    return r.select(ORDER_COL, latency_ms(emit, ingest).alias("emit"))


def q_non_exit_reports(spark, sf_dir):
    return non_exit(position_reports(load_reports(spark, sf_dir))).select(*REPORT_COLS)


def q_vehicle_new_segment(spark, sf_dir):
    r = position_reports(staged_reports(spark, sf_dir))
    return flag_new_segment(r).select(ORDER_COL, "vid", "seg", "in_new_seg")


def q_vehicle_same_segment(spark, sf_dir):
    r = position_reports(staged_reports(spark, sf_dir))
    return keep_first_segment(r).select(ORDER_COL, "vid", "seg")


def _segment_stats(spark, sf_dir):
    return segment_minute_stats(with_minute(position_reports(staged_reports(spark, sf_dir))))


def q_segment_minute_stats(spark, sf_dir):
    return _segment_stats(spark, sf_dir)


def q_segment_lav(spark, sf_dir):
    return segment_history(_segment_stats(spark, sf_dir)).select("xway", "dir", "seg", "minute", "lav")


def q_segment_car_count(spark, sf_dir):
    return segment_history(_segment_stats(spark, sf_dir)).select("xway", "dir", "seg", "minute", "num_vehicles")


def q_reports_with_stats(spark, sf_dir):
    return keyed_enriched(staged_reports(spark, sf_dir)).select(
        ORDER_COL, "vid", "xway", "dir", "seg", "minute", "lav", "num_vehicles")


def q_global_minute_stats(spark, sf_dir):
    return global_stats(staged_reports(spark, sf_dir))


def q_global_lav(spark, sf_dir):
    return global_lav(position_reports(staged_reports(spark, sf_dir)))


def q_toll_notifications_keyed(spark, sf_dir):
    return toll_notifications_keyed(parsed_reports(spark, sf_dir))


def q_toll_notifications_keyed_all(spark, sf_dir):
    return toll_notifications_keyed(parsed_reports(spark, sf_dir), emit_zero=True)


def q_toll_notifications_global(spark, sf_dir):
    return toll_notifications_global(parsed_reports(spark, sf_dir))


def _shuffled_reports(spark, sf_dir):
    """Reports that arrive up to 3 000 places late: ``arrival`` is their
    order (unique: equal delayed places differ modulo 4096)."""
    late = F.col(ORDER_COL) + (F.col(ORDER_COL) * 7919) % 3001
    return parsed_reports(spark, sf_dir).withColumn("arrival", late * 4096 + F.col(ORDER_COL) % 4096)


def q_toll_notifications_arrival(spark, sf_dir):
    """T1 from statistics as they stood when each report arrived."""
    return toll_notifications_keyed(_shuffled_reports(spark, sf_dir), emit_zero=True, order_col="arrival",
                                    statistics="arrival")


def q_toll_notifications_global_arrival(spark, sf_dir):
    """T2 in arrival order."""
    return toll_notifications_global(_shuffled_reports(spark, sf_dir), order_col="arrival", statistics="arrival")


def q_toll_latency_keyed(spark, sf_dir):
    """P3 + P9 in T1: lines with fixed ingest and emit stamps."""
    ingest = F.timestamp_seconds(F.lit(86400) + F.col(ORDER_COL))
    emit = F.timestamp_micros(F.unix_micros(ingest) + (F.col(ORDER_COL) % 997) * 1000 + 400)
    lines = staged_lines(spark, sf_dir).withColumns({"emit_ts": emit})
    lines = with_ingest_time(lines.withColumn("record_ts", ingest), "record_ts").drop("record_ts")
    return toll_notifications_keyed(parse_reports(lines), emit_zero=True, ingest_ts="ingest_ts", emit_ts="emit_ts")


def q_format_toll_keyed(spark, sf_dir):
    t = toll_notifications_keyed(parsed_reports(spark, sf_dir))
    text = toll_text_keyed(F.col("vid"), F.col("time"), _fixed_emit(), F.col("lav"), F.col("toll"),
                           clock=_fixed_clock())
    return t.select(ORDER_COL, text.alias("text"))


def q_format_toll_global(spark, sf_dir):
    t = toll_notifications_global(parsed_reports(spark, sf_dir))
    text = toll_text_global(F.col("vid"), F.col("time"), _fixed_emit(), F.col("lav"), F.col("toll"))
    return t.select(ORDER_COL, text.alias("text"))


def q_replay_prefix(spark, sf_dir):
    return replay_prefix(staged_reports(spark, sf_dir), REPLAY_SECOND).select(ORDER_COL, "time", "vid")


def q_to_kafka_frame(spark, sf_dir):
    return to_kafka_frame(load_lines(spark, sf_dir))


def q_src_text_lines(spark, sf_dir):
    """S3: the lines are written as text files (range partitioned in arrival
    order) under the shared folder, then read back with line numbers."""
    path = scratch_path(spark, "lines")
    write_lines(load_lines(spark, sf_dir), path)
    return read_lines(spark, path).select(ORDER_COL, "value")


def q_json_value_decode(spark, sf_dir):
    e = load_table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias(ORDER_COL), json_value_text(F.col("props")).alias("json"),
                    F.get_json_object("props", "$.k").cast("int").alias("k"))


def q_log_marker_filter(spark, sf_dir):
    return marker_filter(_log(spark, sf_dir), LOG_MARKER)


def q_log_time_range(spark, sf_dir):
    return time_range(_log(spark, sf_dir), *LOG_RANGE)


def q_throughput_per_second(spark, sf_dir):
    return throughput_per_second(marker_filter(_log(spark, sf_dir), LOG_MARKER))


def _stream(spark, sf_dir, app, **kw):
    from ..streaming.jobs import run_app
    return run_app(spark, staged_lines(spark, sf_dir), app, **kw).result


def q_stream_toll_notifications_keyed(spark, sf_dir):
    """T1 as a stream, exact arrival-order mode, 4 micro-batches."""
    return _stream(spark, sf_dir, "keyed", mode="exact")


def q_stream_toll_notifications_keyed_window(spark, sf_dir):
    """T1 as a stream, sliding-window statistics joined to the reports."""
    return _stream(spark, sf_dir, "keyed", mode="window")


def q_stream_toll_notifications_global(spark, sf_dir):
    """T2 as two chained streams (vehicle stage, then statistics and join)."""
    return _stream(spark, sf_dir, "global")


def _late_lines(spark, sf_dir):
    """The lines in the arrival order of :func:`_shuffled_reports`."""
    late = F.col(ORDER_COL) + (F.col(ORDER_COL) * 7919) % 3001
    return staged_lines(spark, sf_dir).select((late * 4096 + F.col(ORDER_COL) % 4096).alias(ORDER_COL), "value")


def q_stream_toll_notifications_arrival(spark, sf_dir):
    """T1 as a stream of late reports, state in tables."""
    from ..streaming.jobs import run_app
    out = run_app(spark, _late_lines(spark, sf_dir), "keyed", mode="arrival", emit_zero=True).result
    return out.withColumnRenamed(ORDER_COL, "arrival")


def q_stream_toll_notifications_global_arrival(spark, sf_dir):
    """T2 as one exact stream of late reports, state in tables."""
    from ..streaming.jobs import run_app
    return run_app(spark, _late_lines(spark, sf_dir), "global", mode="arrival").result.withColumnRenamed(ORDER_COL, "arrival")


def q_toll_notifications_redelivered(spark, sf_dir):
    """T1 from at-least-once input: every seventh record comes twice."""
    lines = staged_lines(spark, sf_dir).withColumn("partition", F.lit(0))
    again = lines.where(F.col(ORDER_COL) % 7 == 3)
    return toll_notifications_keyed(parse_reports(drop_redelivered(lines.unionByName(again))))


def q_stream_passthrough_text(spark, sf_dir):
    """T4 as a stream into the text sink, read back."""
    return _stream(spark, sf_dir, "text")


QUERIES: dict[str, Query] = {
    "position_reports": q_position_reports,
    "parse_position_reports": q_parse_position_reports,
    "parse_permissive_reports": q_parse_permissive_reports,
    "parse_rejects": q_parse_rejects,
    "parse_full_lenient": q_parse_full_lenient,
    "format_full_csv": q_format_full_csv,
    "minute_bucket": q_minute_bucket,
    "event_time": q_event_time,
    "passthrough_stamped": q_passthrough_stamped,
    "passthrough_text": q_passthrough_text,
    "toll_formula": q_toll_formula,
    "latency_ms": q_latency_ms,
    "non_exit_reports": q_non_exit_reports,
    "vehicle_new_segment": q_vehicle_new_segment,
    "vehicle_same_segment": q_vehicle_same_segment,
    "segment_minute_stats": q_segment_minute_stats,
    "segment_lav": q_segment_lav,
    "segment_car_count": q_segment_car_count,
    "reports_with_stats": q_reports_with_stats,
    "global_minute_stats": q_global_minute_stats,
    "global_lav": q_global_lav,
    "toll_notifications_keyed": q_toll_notifications_keyed,
    "toll_notifications_keyed_all": q_toll_notifications_keyed_all,
    "toll_notifications_global": q_toll_notifications_global,
    "toll_notifications_arrival": q_toll_notifications_arrival,
    "toll_notifications_global_arrival": q_toll_notifications_global_arrival,
    "toll_latency_keyed": q_toll_latency_keyed,
    "format_toll_keyed": q_format_toll_keyed,
    "format_toll_global": q_format_toll_global,
    "replay_prefix": q_replay_prefix,
    "to_kafka_frame": q_to_kafka_frame,
    "src_text_lines": q_src_text_lines,
    "json_value_decode": q_json_value_decode,
    "log_marker_filter": q_log_marker_filter,
    "log_time_range": q_log_time_range,
    "throughput_per_second": q_throughput_per_second,
    "stream_toll_notifications_keyed": q_stream_toll_notifications_keyed,
    "stream_toll_notifications_keyed_window": q_stream_toll_notifications_keyed_window,
    "stream_toll_notifications_global": q_stream_toll_notifications_global,
    "stream_toll_notifications_arrival": q_stream_toll_notifications_arrival,
    "stream_toll_notifications_global_arrival": q_stream_toll_notifications_global_arrival,
    "toll_notifications_redelivered": q_toll_notifications_redelivered,
    "stream_passthrough_text": q_stream_passthrough_text,
}
