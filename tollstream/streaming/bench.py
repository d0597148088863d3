"""Streaming figures for bench.py: input rows, batches and processed rows
per second from ``StreamingQueryProgress`` of the pass-through and toll
streams, fed in ``chunks`` micro-batches. The pass-through streams get the
lines once per micro-batch, so that at sf0.1 a micro-batch is as large as the
ingest cap (100 000 records), as at full speed; the toll streams get a part
of the lines per micro-batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ORDER_COL
from ..sources.events import staged_lines
from .jobs import run_app


def _repeated(lines: DataFrame, times: int) -> DataFrame:
    """The lines ``times`` times in a row."""
    n = lines.agg(F.max(ORDER_COL)).first()[0] or 0
    return lines.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).select(
        (F.col(ORDER_COL) + F.col("_k") * (n + 1)).alias(ORDER_COL), "value")


def stream_figures(spark: SparkSession, sf_dir: str, chunks: int = 4) -> dict[str, object]:
    lines = staged_lines(spark, sf_dir)
    out: dict[str, object] = {}
    for name, app, kw in (
        ("stream_passthrough_text", "text", {}),
        ("stream_passthrough_stamped", "stamped", {}),
        ("stream_toll_keyed_exact", "keyed", {"mode": "exact"}),
        ("stream_toll_keyed_window", "keyed", {"mode": "window"}),
        ("stream_toll_keyed_arrival", "keyed", {"mode": "arrival"}),
    ):
        t0 = time.perf_counter()
        fed = _repeated(lines, chunks) if app in ("text", "stamped") else lines
        run = run_app(spark, fed, app, chunks=chunks, **kw)
        wall = time.perf_counter() - t0
        fig = run.figures
        out[name] = {
            "num_input_rows": fig["num_input_rows"],
            "batches": fig["batches"],
            "processed_rows_per_sec": fig["processed_rows_per_sec"],
            "max_batch_processed_rows_per_sec": fig["max_batch_processed_rows_per_sec"],
            "batch_ms_total": fig["batch_ms_total"],
            "wall_sec_incl_replay_write": round(wall, 2),
        }
    return out
