"""Event-time replay (T5).

The feeder releases a record once the elapsed wall second ``ts`` reaches
``time - 1``, and it releases in file order: a record with a later time
blocks everything behind it. So what is out at second ``ts`` is the longest
prefix in arrival order whose times are all ``<= ts + 1``, not a filter.

Plan: one global ``min`` (partial per task, one row at the end) gives the
first blocking position; the prefix is then a plain predicate. No sort, no
unpartitioned window, nothing collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ORDER_COL


def replay_prefix(reports: DataFrame, ts: int, order_col: str = ORDER_COL,
                  time_col: str = "time") -> DataFrame:
    cut = reports.where(F.col(time_col) > F.lit(ts) + 1).select(F.min(order_col)).scalar()
    return reports.where(F.coalesce(F.col(order_col) < cut, F.lit(True)))

