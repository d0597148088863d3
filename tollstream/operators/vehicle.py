"""Per-vehicle operators (V1, V2).

Both only need, per vehicle, the order value and segment of its *first*
report. That is an aggregate (``min`` / ``min_by``, combined map-side, so a
vehicle holding a third of all rows costs one partial row per task), joined
back on ``vid``. A window over ``vid`` would instead sort every report of a
hot vehicle in one task. The join back splits hot vehicles off
(``operators.skew``): their rows are joined to a broadcast of at most
``2 * partitions`` per-vehicle rows without a shuffle; the rest is planned
by AQE (broadcast when the measured per-vehicle table is small, otherwise a
sort-merge join).

A broadcast goes through the driver. A stream that joins once per micro-batch
would send it one after another for ever, so with ``split_hot=False`` the join
is a sort-merge join, nothing is broadcast and ``first`` must be a table (then
AQE splits skewed partitions). A hot vehicle's rows of one micro-batch, which
the ingest cap bounds, may meet in one task.

Only orders *within* one vehicle are compared, so ``order_col`` only has to
be ordered per vehicle (a Kafka offset is enough when producers key by vid).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ORDER_COL
from .skew import join_with_hot_split

_FIRST_ORDER = "_first_order"
_FIRST_SEG = "_first_seg"
_COUNT = "_vid_rows"
_VID = "_first_vid"
FIRST_COLUMNS = (_FIRST_ORDER, _FIRST_SEG)


def first_reports(reports: DataFrame, order_col: str = ORDER_COL, vid_col: str = "vid",
                  seg_col: str = "seg") -> DataFrame:
    """One row per vehicle: order value and segment of its first report, and
    its number of reports (to find hot vehicles)."""
    return reports.groupBy(vid_col).agg(
        F.min(order_col).alias(_FIRST_ORDER),
        F.min_by(seg_col, order_col).alias(_FIRST_SEG),
        F.count(F.lit(1)).alias(_COUNT),
    )


def _with_first(reports: DataFrame, first: DataFrame | None, order_col: str, vid_col: str,
                seg_col: str, counted: DataFrame | None = None, split_hot: bool = True) -> DataFrame:
    if first is None:
        first = first_reports(reports, order_col, vid_col, seg_col)
    if not split_hot:
        side = first.select(F.col(vid_col).alias(_VID), _FIRST_ORDER, _FIRST_SEG)
        return reports.join(side.hint("merge"), F.col(vid_col).eqNullSafe(F.col(_VID)))
    return join_with_hot_split(reports, first, vid_col, _COUNT, salt_cols=[order_col, vid_col], counted=counted)


def flag_new_segment(reports: DataFrame, order_col: str = ORDER_COL, out: str = "in_new_seg",
                     vid_col: str = "vid", seg_col: str = "seg",
                     first: DataFrame | None = None, counted: DataFrame | None = None,
                     split_hot: bool = True) -> DataFrame:
    """V1 (keyed): flag a report when it is the vehicle's first, or when its
    segment differs from the segment of the vehicle's *first* report.

    The remembered segment is never updated, so returning to the first
    segment is not new. State is per vid across expressways and directions.
    Pass ``first`` (from :func:`first_reports` over all reports) to flag a
    filtered subset of them, and all reports as ``counted``.
    """
    j = _with_first(reports, first, order_col, vid_col, seg_col, counted, split_hot)
    flag = (F.col(order_col) == F.col(_FIRST_ORDER)) | (F.col(seg_col) != F.col(_FIRST_SEG))
    return j.select(*reports.columns, flag.alias(out))


def keep_first_segment(reports: DataFrame, order_col: str = ORDER_COL, vid_col: str = "vid",
                       seg_col: str = "seg", first: DataFrame | None = None, split_hot: bool = True) -> DataFrame:
    """V2 (global): keep a vehicle's first report and its reports in the same
    segment as the first one; drop the rest (the opposite sense of V1).

    The original uses -1 as "not seen", so a real segment of -1 would be
    emitted twice; segments are 0..99, that duplication is not reproduced.
    """
    j = _with_first(reports, first, order_col, vid_col, seg_col, split_hot=split_hot)
    keep = (F.col(order_col) == F.col(_FIRST_ORDER)) | (F.col(seg_col) == F.col(_FIRST_SEG))
    return j.where(keep).select(*reports.columns)
