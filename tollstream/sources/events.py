"""Position reports derived from the ``events`` table (the ``pr`` fixture).

30 days of events are compressed into 30 minutes (1440 s of event time to one
second of report time); ``event_id`` is the arrival order. The mapping is a
plain projection, so it stays a narrow, pushdown-friendly scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LRB_FIELDS, ORDER_COL
from ..session import app_id, task_slots

# Fixed values of the fixture mapping (shared with the SQL oracles).
#   time origin ............. 2024-01-01 00:00:00
#   compression ............. 1440 s of event time -> 1 s of report time
#   request tuples .......... event_id % 10 = 9 -> type 2
#   segment split ........... props.k < 70 -> seg 0, else seg 1
#   speed ................... (floor(value) + 25 * seg) % 101
#   lanes by event_type ..... click 0, view 1, purchase 2, signup 3, other 4
#   direction ............... event_id % 2
#   position ................ seg * 5280 + floor(value) % 5280
#   broken lines ............ event_id % 97 = 0 keeps fields 0..6,
#                             event_id % 89 = 0 puts 'x' in field 3,
#                             event_id % 83 = 0 doubles the first comma
TIME_ORIGIN = "2024-01-01 00:00:00"
MICROS_PER_REPORT_SECOND = 1440 * 1_000_000
LANE_BY_EVENT_TYPE = {"click": 0, "view": 1, "purchase": 2, "signup": 3}


def distribute(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """Deal the rows out over ``n`` tasks, round robin or by the hash of
    ``key``. A choice of the caller, for inputs whose splits are too few for
    the work behind them; no plan here makes it by itself."""
    return df.repartition(n, key) if key else df.repartition(n)


# Source DataFrames per session: a DataFrame is an immutable plan, so one
# scan definition (schema read, split count) serves every query built on it.
_SOURCES: dict[tuple, DataFrame] = {}


def once_per_session(spark: SparkSession, key: tuple, make) -> DataFrame:
    """``make()``, or what it returned under ``key`` earlier in this session."""
    full = (app_id(spark), *key)
    df = _SOURCES.get(full)
    if df is None:
        df = _SOURCES[full] = make()
    return df


def forget_sources(spark: SparkSession) -> None:
    """Make the sources of this application anew when they are next used."""
    app = app_id(spark)
    for key in [k for k in _SOURCES if k[0] == app]:
        del _SOURCES[key]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return once_per_session(spark, ("table", sf_dir, name),
                 lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _seg_flag(props: Column) -> Column:
    k = F.get_json_object(props, "$.k").cast("int")
    return F.when(k < 70, F.lit(0)).otherwise(F.lit(1))


def _lane(event_type: Column) -> Column:
    expr = F.lit(4)
    for name, lane in reversed(list(LANE_BY_EVENT_TYPE.items())):
        expr = F.when(event_type == name, F.lit(lane)).otherwise(expr)
    return expr


def reports_from_events(events: DataFrame, with_pos: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Typed reports ``offset, type, time, vid, speed, xway, lane, dir, seg[, pos]``
    (plus the ``events`` columns named in ``keep``)."""
    seg = _seg_flag(F.col("props"))
    fl = F.floor(F.col("value")).cast("bigint")
    # NTZ arithmetic: independent of the session time zone.
    time = F.expr(f"cast(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{TIME_ORIGIN}', ts) "
                  f"div {MICROS_PER_REPORT_SECOND} as smallint)")
    cols = [
        F.col("event_id").alias(ORDER_COL),
        F.when(F.col("event_id") % 10 == 9, F.lit(2)).otherwise(F.lit(0)).alias("type"),
        time.alias("time"),
        F.col("user_id").cast("int").alias("vid"),
        ((fl + 25 * seg) % 101).cast("int").alias("speed"),
        F.lit(0).alias("xway"),
        _lane(F.col("event_type")).alias("lane"),
        (F.col("event_id") % 2).cast("int").alias("dir"),
        seg.alias("seg"),
    ]
    if with_pos:
        cols.append((seg * 5280 + fl % 5280).cast("int").alias("pos"))
    return events.select(*cols, *(keep or []))


def load_reports(spark: SparkSession, sf_dir: str, with_pos: bool = True) -> DataFrame:
    return reports_from_events(load_table(spark, sf_dir, "events"), with_pos=with_pos)


def report_lines(reports: DataFrame, broken: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Raw CSV lines ``offset, value`` as a producer would send them.

    With ``broken=True`` some lines are damaged by the fixed rule above, to
    exercise the permissive and lenient parsers.
    """
    fields = [F.col(c).cast("string") for c in LRB_FIELDS[:9]] + [F.lit("-1")] * 6
    clean = F.concat_ws(",", *fields)
    value = clean
    if broken:
        off = F.col(ORDER_COL)
        short = F.concat_ws(",", *fields[:7])
        bad_speed = F.concat_ws(",", *(fields[:3] + [F.lit("x")] + fields[4:]))
        double_comma = F.concat_ws(",", fields[0], F.lit(""), *fields[1:])
        value = (F.when(off % 97 == 0, short)
                 .when(off % 89 == 0, bad_speed)
                 .when(off % 83 == 0, double_comma)
                 .otherwise(clean))
    return reports.select(F.col(ORDER_COL), value.alias("value"), *(keep or []))


def load_lines(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    return report_lines(load_reports(spark, sf_dir), broken=broken)


def staged_lines(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The report lines as a source table: ``offset, value`` written once per
    session as parquet under the shared checkpoint folder (a stand-in for the
    topic or file the lines arrive in), range partitioned on the offset.

    Generated lines are an expression over ``events``; every reference to
    ``value`` (validity check, split) would re-evaluate it, JSON parse
    included. A real source delivers them as a column, and so does this.
    """
    return _staged(spark, ("lines", sf_dir, broken), lambda: load_lines(spark, sf_dir, broken))


def staged_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports as a table, written once per session as
    :func:`staged_lines`: operators that read them more than once would parse
    the events' JSON each time."""
    return _staged(spark, ("reports", sf_dir), lambda: load_reports(spark, sf_dir))


def _staged(spark: SparkSession, key: tuple, make) -> DataFrame:
    from ..session import scratch_path

    def staged() -> DataFrame:
        path = scratch_path(spark, f"staged-{key[0]}")
        made = make()
        made.repartitionByRange(task_slots(spark), ORDER_COL).write.parquet(path)
        return spark.read.schema(made.schema).parquet(path)
    return once_per_session(spark, key, staged)
