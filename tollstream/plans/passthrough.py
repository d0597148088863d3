"""Pass-through applications (batch form; streaming form in
``tollstream.streaming.applications``). Narrow projections: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.format import consumed_text, stamped


def passthrough_stamped(lines: DataFrame, clock: Column | None = None, value_col: str = "value") -> DataFrame:
    """Each line with a processing stamp: ``stamp``, ``value``, ``text``."""
    return stamped(lines, value_col, clock)


def passthrough_text(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """T4: each line as ``input = [<line>]``."""
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, consumed_text(F.col(value_col)).alias("text"))
