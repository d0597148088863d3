"""Row filters (F1-F4). Plain predicates: Catalyst pushes them to the scan
or below joins where that keeps the result unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EXIT_LANE, POSITION_REPORT


def position_reports(df: DataFrame, type_col: str = "type") -> DataFrame:
    """keep position reports (``type = 0``)."""
    return df.where(F.col(type_col) == POSITION_REPORT)


def non_exit(df: DataFrame, lane_col: str = "lane", exit_lane: int = EXIT_LANE) -> DataFrame:
    """drop exit-lane rows. Apply to the report branch only, after the
    statistics were taken: exit-lane reports still count there."""
    return df.where(F.col(lane_col) != exit_lane)


def new_segment_only(df: DataFrame, flag_col: str = "in_new_seg") -> DataFrame:
    """keep reports flagged as entering a new segment (keyed dialect)."""
    return df.where(F.col(flag_col))


def nonzero_toll(df: DataFrame, toll_col: str = "toll") -> DataFrame:
    """drop zero tolls (keyed dialect)."""
    return df.where(F.col(toll_col) != 0)
