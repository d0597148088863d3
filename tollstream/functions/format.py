"""Text forms of records.

Records stay typed through the plan; text is produced only here, at the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CLOCK_FORMAT, LRB_FIELDS


def clock_text(ts: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` of ``ts`` (default: the batch clock)."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), CLOCK_FORMAT)


def stamped(df: DataFrame, value_col: str = "value", clock: Column | None = None) -> DataFrame:
    """P5: pass-through pair ``(stamp, line)`` and its text ``(stamp,line)``."""
    stamp = clock_text(clock)
    return df.select(
        *[c for c in df.columns if c != value_col],
        stamp.alias("stamp"),
        F.col(value_col),
        F.concat(F.lit("("), stamp, F.lit(","), F.col(value_col), F.lit(")")).alias("text"),
    )


def consumed_text(value: Column) -> Column:
    """Pass-through log message ``input = [<line>]``."""
    return F.format_string("input = [%s]", value)


def toll_text_keyed(vid: Column, time: Column, emit: Column, lav: Column, toll: Column,
                    clock: Column | None = None) -> Column:
    """P10: ``<clock>,0,<vid>,<time>,<emit>,<lav>,<toll>``."""
    parts = [clock_text(clock), F.lit("0"), vid, time, emit, lav, toll]
    return F.concat_ws(",", *[p.cast("string") for p in parts])


def toll_text_global(vid: Column, time: Column, emit: Column, lav: Column, toll: Column) -> Column:
    """``0, <vid>, <time>, <emit>, <lav>, <toll>`` (comma and blank)."""
    parts = [F.lit("0"), vid, time, emit, lav, toll]
    return F.concat_ws(", ", *[p.cast("string") for p in parts])


def full_csv(df: DataFrame) -> Column:
    """The canonical 15-field line; the text sink adds the newline."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in LRB_FIELDS])
