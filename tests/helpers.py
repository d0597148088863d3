"""Small builders for hand-written report rows."""

from __future__ import annotations

from tollstream.schema import report_schema

COLS = ["offset", "type", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos"]


def rep(offset, time, vid, speed=50, seg=5, lane=1, xway=0, dir=0, type=0, pos=0):
    return (offset, type, time, vid, speed, xway, lane, dir, seg, pos)


def reports_df(spark, rows):
    return spark.createDataFrame(rows, report_schema())


def by_offset(df, *cols):
    return {r["offset"]: tuple(r[c] for c in cols) for r in df.collect()}
