"""Parsing CSV report lines and the per-record time columns.

All column expressions: they stay inside whole-stage codegen, no Python runs
per row. ``split`` is evaluated once in a projection below the casts so the
array is not rebuilt for every field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (EVENT_TIME_BASE_SECONDS, LRB_FIELDS, REPORT_FIELDS,
                      SECONDS_PER_MINUTE, field_type)

# Java's Integer.parseInt / Short.parseShort accept an optional sign and
# digits, nothing else (no blanks); Spark's cast trims blanks, hence a regex.
# A line is well formed when fields 0..8 are such integers; more fields may
# follow and are ignored.
STRICT_INT = r"[+-]?[0-9]+"
# Anchored at the true ends, line breaks inside count as any character.
STRICT_LINE = rf"(?s)\A{STRICT_INT}(,{STRICT_INT}){{{len(REPORT_FIELDS) - 1}}}(,.*)?\z"
# C atoi: leading blanks, optional sign, digits; stops at the first other char.
ATOI_PREFIX = r"^\s*([+-]?[0-9]+)"

_TOKENS = "_tokens"


# Fast path: a line whose fields provably fit (at most 9 digits for an int,
# 0..32767 for the short `time`) is valid by one regex. Anything else is
# checked exactly: syntax by STRICT_LINE, range by casting each field.
_INT9 = r"[+-]?[0-9]{1,9}"
_SHORT = r"[+-]?(?:[0-9]{1,4}|[0-2][0-9]{4}|3[01][0-9]{3}|32[0-6][0-9]{2}|327[0-5][0-9]|3276[0-7])"
FAST_LINE = rf"(?s)\A{_INT9},{_SHORT}(?:,{_INT9}){{{len(REPORT_FIELDS) - 2}}}(?:,.*)?\z"


def line_is_valid(value: Column) -> Column:
    """True when fields 0..8 are integers that fit their types.

    One regex decides almost every line; the exact check (per-field casts
    over the split) runs only for lines it does not accept. No higher-order
    function, so the check stays in whole-stage codegen, and it refers to the
    raw line only: a filter above the parse (``type = 0``) is pushed below it
    by Catalyst with the field expressions substituted, so a check built from
    the parsed fields would be copied into that filter once per field.
    """
    tokens = F.split(value, ",")
    exact = value.rlike(STRICT_LINE)
    for i, name in enumerate(REPORT_FIELDS):
        exact = exact & F.get(tokens, i).try_cast(field_type(name)).isNotNull()
    return F.coalesce(F.when(value.rlike(FAST_LINE), F.lit(True)).otherwise(exact), F.lit(False))


def _fields(tokens: Column) -> list[Column]:
    return [F.get(tokens, i).try_cast(field_type(n)).alias(n) for i, n in enumerate(REPORT_FIELDS)]


def _keep(lines: DataFrame, value_col: str, keep: list[str] | None) -> list[str]:
    return [c for c in lines.columns if c != value_col] if keep is None else keep


def parse_reports(lines: DataFrame, value_col: str = "value", mode: str = "strict",
                  keep: list[str] | None = None) -> DataFrame:
    """Split on ``,``, read fields 0..8 as ints (``time`` as short).

    mode ``strict``: a line with a missing or malformed field fails the job,
    as an unchecked ``parseInt`` does. mode ``permissive``: such lines are
    dropped here and :func:`rejected_lines` returns them. Fields 9..14 are
    ignored. ``keep`` names input columns carried through (default: all but
    the value column).
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    keep = _keep(lines, value_col, keep)
    value = F.col(value_col)
    valid = line_is_valid(value)
    if mode == "strict":
        error = F.raise_error(F.concat(F.lit("malformed report line: "), value))
        checked = lines.where(F.when(valid, F.lit(True)).otherwise(error.cast("boolean")))
    else:
        checked = lines.where(valid)
    staged = checked.select(*keep, F.split(value, ",").alias(_TOKENS))
    return staged.select(*keep, *_fields(F.col(_TOKENS)))


def rejected_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines the permissive parse drops (its rejects side output)."""
    return lines.where(~line_is_valid(F.col(value_col)))


def parse_full_lenient(lines: DataFrame, value_col: str = "value",
                       keep: list[str] | None = None) -> DataFrame:
    """The 15-field tuple read the way the C feeder reads it.

    Empty tokens are skipped (``strtok``), each token is read as ``atoi``
    (leading integer prefix, otherwise 0), missing fields are 0. A value that
    does not fit an int gives 0 (``atoi`` leaves that case undefined).
    """
    keep = _keep(lines, value_col, keep)
    tokens = F.filter(F.split(F.col(value_col), ","), lambda x: x != "")
    staged = lines.select(*keep, tokens.alias(_TOKENS))
    cols = []
    for i, name in enumerate(LRB_FIELDS):
        digits = F.regexp_extract(F.get(F.col(_TOKENS), i), ATOI_PREFIX, 1)
        cols.append(F.coalesce(digits.try_cast("int"), F.lit(0)).alias(name))
    return staged.select(*keep, *cols)


def minute_of(time_col: str = "time") -> Column:
    """``time / 60 + 1`` with integer division (minutes are 1-based)."""
    return F.expr(f"cast(`{time_col}` div {SECONDS_PER_MINUTE} + 1 as int)")


def with_minute(df: DataFrame, time_col: str = "time", out: str = "minute") -> DataFrame:
    return df.withColumn(out, minute_of(time_col))


def event_time(time: Column, base_seconds: int = EVENT_TIME_BASE_SECONDS) -> Column:
    """Event time ``base + time`` seconds, as a timestamp."""
    return F.timestamp_seconds(F.lit(base_seconds).cast("bigint") + time.cast("bigint"))


def with_event_time(df: DataFrame, time_col: str = "time", out: str = "event_time",
                    base_seconds: int = EVENT_TIME_BASE_SECONDS) -> DataFrame:
    return df.withColumn(out, event_time(F.col(time_col), base_seconds))


def with_ingest_time(df: DataFrame, source_ts: str | None = None, out: str = "ingest_ts") -> DataFrame:
    """The ingest stamp: the source record timestamp when there is one
    (Kafka ``timestamp``), else the clock of the (micro-)batch."""
    stamp = F.col(source_ts) if source_ts else F.current_timestamp()
    return df.withColumn(out, stamp)
