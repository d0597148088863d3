"""Scalar rules of the toll applications."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CAR_COUNT_THRESHOLD, INT_MAX, LAV_THRESHOLD, TOLL_FACTOR


def toll(num_vehicles: Column, lav: Column, car_threshold: int = CAR_COUNT_THRESHOLD,
         lav_threshold: int = LAV_THRESHOLD, factor: int = TOLL_FACTOR) -> Column:
    """``2 * (n - 50)^2`` when ``n > 50`` and ``lav < 40``, else 0.

    Computed in bigint; the int result saturates like a double-to-int cast.
    """
    excess = num_vehicles.cast("bigint") - car_threshold
    raw = F.when((num_vehicles > car_threshold) & (lav < lav_threshold),
                 F.lit(factor).cast("bigint") * excess * excess).otherwise(F.lit(0).cast("bigint"))
    return F.least(raw, F.lit(INT_MAX).cast("bigint")).cast("int")


def lav(speed_sum: Column, count: Column) -> Column:
    """``round(sum / (float) count)``, 0 when the count is 0.

    The quotient is rounded to float32 (Spark's ``/`` on floats yields a
    double, the outer cast restores float32) and rounded half up, which is
    ``Math.round(float)``. Adding 0.5 in double is exact for a float value.
    """
    q = (speed_sum.cast("float") / count.cast("float")).cast("float")
    return F.when(count > 0, F.floor(q.cast("double") + F.lit(0.5)).cast("int")).otherwise(F.lit(0))


def lav_values(speed_sum: np.ndarray, count: np.ndarray) -> np.ndarray:
    """P8 over arrays."""
    quotient = speed_sum.astype(np.float32) / np.maximum(count, 1).astype(np.float32)
    return np.where(count > 0, np.floor(quotient.astype(np.float64) + 0.5), 0).astype(np.int32)


def latency_ms(emit_ts: Column, ingest_ts: Column) -> Column:
    """``emit - ingest`` in whole milliseconds (clock-millis difference)."""
    return F.unix_millis(emit_ts) - F.unix_millis(ingest_ts)
