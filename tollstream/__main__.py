"""Command line: run the applications on line files or Kafka.

    python -m tollstream keyed       --input DIR --output DIR [--emit-zero]
    python -m tollstream global      --input DIR --output DIR
    python -m tollstream passthrough --input DIR --output DIR [--stamped]
    python -m tollstream produce     --input DIR --output DIR [--second N] [--kafka HOST:PORT]
    python -m tollstream logstats    --input LOG_DIR --output DIR [--marker M] [--start TS --end TS]

``produce`` is the producer side: lines read the way the C feeder reads them
(lenient 15 fields), written back canonical; with ``--second`` only the
replay prefix released by that elapsed second; with ``--kafka`` sent to
``--topic`` (key = line number). ``logstats`` is the log analysis: lines
with ``--marker`` (and in ``[--start, --end)``), counted per second, written
as ``second,records``.

Add ``--stream`` to run as a Structured Streaming query (``--once``: process
what is there and stop; otherwise a 1 s trigger, as the original's 1 s file
roll), ``--mode exact|window|arrival``, ``--kafka HOST:PORT [--topic lrb]`` to read
a topic instead of files. ``arrival`` keeps its state in tables beside the
checkpoint and is exact for both dialects; with ``--keep-minutes N`` reports
further behind are late, kept under ``--late``. In batch ``--statistics
arrival`` answers each report as of its arrival. Output is text, one
notification or pass-through line per row.

Batch file input is ordered by its place in the files, and so is a stream
with ``--positions``, in micro-batches of at most ``--max-records`` lines;
new files must sort after those already read. Spark's own file stream has no
line position: with ``--numbered`` each line begins with its number and a tab
(``produce --numbered`` writes such lines) and batch and stream use that;
otherwise a stream's vehicle order is ``time`` (a Linear Road vehicle reports
once per 30 s), and a vehicle whose first reports share a second but not the
segment ends the query, since its first segment can't be told. Kafka input
uses the record offset; topics of several partitions must be keyed by vehicle
(``--keyed-topic``, ``produce --by-vehicle``).

``emit`` in the notifications is the latency from the ingest stamp (the
record's timestamp, or when the line's file landed) to the clock of the
(micro-)batch. ``--delay`` is how late a report may come in window mode;
dropped ones are printed as they come, ``--on-late error`` makes them an
error that ends the query. A checkpoint remembers the settings its state depends
on and refuses others.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions.format import full_csv
from .functions.parse import parse_full_lenient, parse_reports
from .operators.logs import marker_filter, throughput_per_second, time_range
from .operators.replay import replay_prefix
from .plans.global_ import toll_notifications_global
from .plans.keyed import toll_notifications_keyed
from .schema import HISTORY_MINUTES, ORDER_COL
from .session import build_session, drop_scratch, scratch_path
from .sources.kafka import MAX_RECORDS_PER_TRIGGER, kafka_lines, kafka_options, read_kafka
from .sources.linefiles import MAX_RECORDS, read_line_stream
from .sources.text import MAX_FILES_PER_TRIGGER, read_lines, read_lines_stream, write_lines
from .streaming.applications import (DEFAULT_DELAY, kept_reports_stream, notification_text, passthrough_stream,
                                     toll_stream_global, toll_stream_keyed)
from .streaming.arrival import ArrivalTolls, late_total, start_arrival_tolls
from .streaming.layout import JOIN_SALTS, VEHICLE_BUCKETS, keep_layout
from .streaming.runner import LateRowsDropped, counted_late_rows, no_data_batches, read_stream_like
from .streaming.sinks import text_sink, vehicle_key, write_kafka

INGEST = "ingest_ts"


def _args(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m tollstream")
    p.add_argument("app", choices=["keyed", "global", "passthrough", "produce", "logstats"])
    p.add_argument("--input", help="folder of line files")
    p.add_argument("--output", required=True, help="output folder (text)")
    p.add_argument("--kafka", help="bootstrap servers; reads --topic instead of files (streams)")
    p.add_argument("--topic", default="lrb")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--once", action="store_true", help="stream: process what is there, then stop")
    p.add_argument("--mode", choices=["exact", "window", "arrival"], default="exact")
    p.add_argument("--statistics", choices=["complete", "arrival"], default="complete", help="batch tolls")
    p.add_argument("--keep-minutes", type=int, default=None, help="arrival mode: minutes a report may be behind")
    p.add_argument("--late", default=None, help="arrival mode: folder of late reports (default: beside the checkpoint)")
    p.add_argument("--positions", action="store_true", help="file stream: lines in file order, capped by --max-records")
    p.add_argument("--max-records", type=int, default=MAX_RECORDS, help="with --positions: lines per trigger")
    p.add_argument("--delay", default=DEFAULT_DELAY, help="window statistics: how late a report may come")
    p.add_argument("--on-late", choices=["report", "error"], default="report")
    p.add_argument("--ttl-ms", type=int, default=None, help="exact mode: forget state after this time")
    p.add_argument("--keyed-topic", action="store_true", help="Kafka: records are keyed by vehicle")
    p.add_argument("--numbered", action="store_true", help="lines begin with their number and a tab")
    p.add_argument("--by-vehicle", action="store_true", help="produce: key records by vehicle")
    p.add_argument("--max-offsets", type=int, default=MAX_RECORDS_PER_TRIGGER, help="Kafka: records per trigger")
    p.add_argument("--emit-zero", action="store_true", help="keyed: keep zero tolls")
    p.add_argument("--stamped", action="store_true", help="passthrough: (stamp,line) instead of input = [line]")
    p.add_argument("--checkpoint", help="stream checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--max-files", type=int, default=MAX_FILES_PER_TRIGGER, help="file stream: files per trigger")
    p.add_argument("--master", default=None, help="for local runs, e.g. local[8]")
    p.add_argument("--second", type=int, default=None, help="produce: replay prefix at this elapsed second")
    p.add_argument("--marker", default=None, help="logstats: keep lines containing this text")
    p.add_argument("--start", default=None, help="logstats: range start, yyyy-MM-dd HH:mm:ss[.SSS]")
    p.add_argument("--end", default=None, help="logstats: range end (exclusive)")
    a = p.parse_args(argv)
    if not a.input and not a.kafka:
        p.error("give --input or --kafka")
    if a.kafka and not a.stream and a.app != "produce":
        p.error("--kafka is for streams (and produce)")
    return a


def _stream_lines(spark: SparkSession, a: argparse.Namespace, checkpoint: str) -> DataFrame:
    """``offset, ingest_ts, value`` of the stream's lines."""
    if a.positions:
        return read_line_stream(spark, a.input, f"{checkpoint}/progress", a.max_records, unterminated="wait")
    if a.kafka:
        records = read_kafka(spark, kafka_options(a.kafka, a.topic, max_offsets_per_trigger=a.max_offsets))
        return kafka_lines(records, a.keyed_topic).select(ORDER_COL, INGEST, "value")
    lines = read_lines_stream(spark, a.input, a.max_files)
    return numbered(lines) if a.numbered else lines.select(time_order(F.col("value")).alias(ORDER_COL), INGEST, "value")


def numbered(lines: DataFrame) -> DataFrame:
    """``offset, ingest_ts, value`` of lines that carry their number."""
    parts = F.split("value", "\t", 2)
    return lines.select(parts[0].cast("bigint").alias(ORDER_COL), INGEST, parts[1].alias("value"))


def time_order(value: Column) -> Column:
    """Order value of a line without a position: its time."""
    return F.get(F.split(value, ","), 1).try_cast("bigint")


def _produce(a: argparse.Namespace, spark: SparkSession) -> None:
    tuples = parse_full_lenient(read_lines(spark, a.input, order="number" if a.numbered else "value"))
    if a.second is not None:
        tuples = replay_prefix(tuples, a.second)
    out = tuples.select(ORDER_COL, full_csv(tuples).alias("value"))
    if a.kafka:
        # one vehicle's records must reach its partition in order
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        keyed = out.withColumn("_v", vehicle_key(F.col("value")))
        ordered = keyed.repartition(n, "_v").sortWithinPartitions(ORDER_COL) if a.by_vehicle \
            else out.repartitionByRange(1, ORDER_COL).sortWithinPartitions(ORDER_COL)
        write_kafka(ordered.select("value"), a.kafka, a.topic, key_col=None, by_vehicle=a.by_vehicle)
    else:
        text = F.concat_ws("\t", F.col(ORDER_COL).cast("string"), "value") if a.numbered else F.col("value")
        write_lines(out.withColumn("value", text), a.output)


def _logstats(a: argparse.Namespace, spark: SparkSession) -> None:
    log = spark.read.text(a.input).select(F.col("value").alias("line"))
    if a.marker:
        log = marker_filter(log, a.marker)
    if a.start and a.end:
        log = time_range(log, a.start, a.end)
    counts = throughput_per_second(log)
    counts.select(F.concat_ws(",", "second", F.col("records").cast("string")).alias("value")).write.text(a.output)


def run(a: argparse.Namespace, spark: SparkSession) -> None:
    if a.app == "produce":
        return _produce(a, spark)
    if a.app == "logstats":
        return _logstats(a, spark)
    if not a.stream:
        if a.app == "passthrough":
            lines = read_lines(spark, a.input, line_number=False)
            out = passthrough_stream(lines, "stamped" if a.stamped else "text")
        else:
            lines = read_lines(spark, a.input, not a.numbered, order="value", ingest_ts=INGEST)
            parsed = parse_reports(numbered(lines) if a.numbered else lines)
            how = {"ingest_ts": INGEST, "statistics": a.statistics}
            tolls = toll_notifications_keyed(parsed, emit_zero=a.emit_zero, **how) if a.app == "keyed" \
                else toll_notifications_global(parsed, **how)
            out = notification_text(tolls, a.app, latency="emit")
        out.select("text").write.text(a.output)
        return

    trigger = "0 seconds" if a.once and a.positions else "availableNow" if a.once else "1 second"
    ck = a.checkpoint or scratch_path(spark, f"cli-{a.app}")
    if a.mode == "arrival" and a.app != "passthrough":
        # no layout: nothing of this state depends on a count
        keep_layout(spark, ck, app=a.app, mode=a.mode, keep_minutes=a.keep_minutes, history=HISTORY_MINUTES)
        step = ArrivalTolls(spark, a.app, a.output, f"{ck}/state", late=a.late or f"{ck}/late",
                            keep_minutes=a.keep_minutes, emit_zero=a.emit_zero, ingest_ts=INGEST, fmt="text",
                            shape=lambda tolls: notification_text(tolls, a.app, INGEST).select("text"))
        q = start_arrival_tolls(parse_reports(_stream_lines(spark, a, ck)), step, f"{ck}/checkpoint",
                                trigger == "availableNow", trigger)
        _finish(a, [q])
        if a.keep_minutes is not None and a.once and (late := late_total(spark, step.late)):
            print(f"{late} late reports are kept in {step.late}")
        return
    keep_layout(spark, ck, app=a.app, mode=a.mode, delay=a.delay, ttl_ms=a.ttl_ms, buckets=VEHICLE_BUCKETS,
                salts=JOIN_SALTS, history=HISTORY_MINUTES)
    stopped: list[int] = []  # the late total at which the run was ended

    def on_late(query: str, rows: int, total: int) -> None:
        print(f"{rows} rows came behind the watermark and were dropped (--delay), {total} so far", flush=True)
        if a.on_late == "error" and not stopped:
            stopped.append(total)
            for running in spark.streams.active:
                running.stop()

    with counted_late_rows(spark, on_late) as late:
        queries = _start(a, spark, ck, trigger)
        _finish(a, queries)
        for q in queries if a.once else []:
            late.final(q)
    if stopped:
        raise LateRowsDropped(f"{stopped[0]} rows came behind the watermark")


def _start(a: argparse.Namespace, spark: SparkSession, ck: str, trigger: str) -> list[StreamingQuery]:
    """The queries of a stream in exact or window mode, and of pass-through."""
    lines = _stream_lines(spark, a, ck)
    queries = []
    if a.app == "keyed":
        out = notification_text(toll_stream_keyed(parse_reports(lines), mode=a.mode, emit_zero=a.emit_zero, delay=a.delay,
                                                  ttl_ms=a.ttl_ms, ingest_ts=INGEST, refuse_ties=True), "keyed", INGEST)
    elif a.app == "global":
        kept_path = f"{ck}/kept"
        kept_stream = kept_reports_stream(parse_reports(lines), refuse_ties=True)
        stage1 = (kept_stream.writeStream.format("parquet")
                  .option("path", kept_path).option("checkpointLocation", f"{ck}/kept-checkpoint"))
        stage1 = stage1.trigger(availableNow=True) if trigger == "availableNow" else stage1.trigger(processingTime=trigger)
        q1 = stage1.start()
        if a.once:
            _finish(a, [q1])
        else:
            queries.append(q1)
            q1.processAllAvailable()
        kept = read_stream_like(spark, kept_path, kept_stream.schema)
        out = notification_text(toll_stream_global(kept, delay=a.delay, ingest_ts=INGEST), "global", INGEST)
    else:
        out = passthrough_stream(lines.select("value"), "stamped" if a.stamped else "text")
    with no_data_batches(spark, a.ttl_ms is None):
        queries.append(text_sink(out, a.output, checkpoint=f"{ck}/sink-checkpoint", trigger=trigger))
    return queries


def _finish(a: argparse.Namespace, queries: list[StreamingQuery]) -> None:
    """Wait for the queries: with ``--once`` until all that is there is
    processed, otherwise until one of them ends."""
    if not a.once:
        SparkSession.getActiveSession().streams.awaitAnyTermination()
        return
    for q in queries:
        if a.positions and q.isActive:
            q.processAllAvailable()
            q.stop()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def main(argv: list[str] | None = None) -> None:
    a = _args(argv)
    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    try:
        run(a, spark)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
