"""Record layout and the fixed constants of the toll rules.

Everything here is data, not logic: the Linear Road tuple layout and the
numbers the toll formula is defined with.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values of the toll rules being
# reproduced, otherwise results differ.
#   position report type ........ 0
#   exit lane ................... 4
#   car count threshold ......... 50   (toll only when more than 50 cars)
#   LAV threshold ............... 40   (toll only when LAV below 40 mph)
#   toll factor ................. 2    (toll = 2 * (cars - 50) ^ 2)
#   LAV history ................. 5 minutes (m-5 .. m-1)
#   minute of a report .......... time / 60 + 1 (integer division)
#   notification timestamp ...... yyyy-MM-dd HH:mm:ss.SSS
#   global notification separator ", " ; keyed notification separator ","
#   pass-through log text ....... input = [<line>]
# ---------------------------------------------------------------------------
POSITION_REPORT = 0
EXIT_LANE = 4
CAR_COUNT_THRESHOLD = 50
LAV_THRESHOLD = 40
TOLL_FACTOR = 2
HISTORY_MINUTES = 5
SECONDS_PER_MINUTE = 60
CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
INT_MAX = 2147483647

# Linear Road tuple: 15 integer fields, comma separated, in this order.
LRB_FIELDS = [
    "type", "time", "vid", "speed", "xway", "lane", "dir", "seg", "pos",
    "qid", "sinit", "send", "dow", "tod", "day",
]
# Historical tolls file: vid, day (1 = yesterday .. 69), xway, tolls. Part of
# the data set's description; no toll application reads it.
HISTORICAL_TOLLS_FIELDS = ["vid", "day", "xway", "tolls"]

# Only the first nine are read by the toll applications.
REPORT_FIELDS = LRB_FIELDS[:9]

# Segment key of the keyed dialect.
SEGMENT_KEYS = ["xway", "dir", "seg"]

# Event time is `base + time` seconds. The base is a whole day after 1970 so
# that a watermark starting at epoch 0 never treats the first rows as late.
EVENT_TIME_BASE_SECONDS = 86400

ORDER_COL = "offset"


def lrb_tuple_schema() -> T.StructType:
    """All 15 fields as int (the lenient full-tuple parse)."""
    return T.StructType([T.StructField(f, T.IntegerType(), False) for f in LRB_FIELDS])


def report_schema(with_offset: bool = True) -> T.StructType:
    """Parsed position report: `time` is a short, the rest ints."""
    fields = []
    if with_offset:
        fields.append(T.StructField(ORDER_COL, T.LongType(), False))
    for f in REPORT_FIELDS:
        fields.append(T.StructField(f, T.ShortType() if f == "time" else T.IntegerType(), False))
    return T.StructType(fields)


def historical_tolls_schema() -> T.StructType:
    return T.StructType([T.StructField(f, T.IntegerType(), False) for f in HISTORICAL_TOLLS_FIELDS])


def field_type(name: str) -> T.DataType:
    return T.ShortType() if name == "time" else T.IntegerType()
