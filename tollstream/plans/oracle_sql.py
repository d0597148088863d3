"""DuckDB SQL for each registered query (the independent correctness oracle).

Written as plain window/aggregate SQL over the ``events`` view, separately
from the Spark plans (which use joins and aggregates instead of windows), so
a shared mistake is unlikely.
"""

from __future__ import annotations

from ..schema import LRB_FIELDS

_SEG = "CASE WHEN CAST(json_extract_string(props,'$.k') AS INT) < 70 THEN 0 ELSE 1 END"

PR = f"""pr AS (
  SELECT event_id AS "offset",
    CASE WHEN event_id % 10 = 9 THEN 2 ELSE 0 END AS type,
    CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1440000000 AS SMALLINT) AS "time",
    CAST(user_id AS INT) AS vid,
    CAST((CAST(floor(value) AS BIGINT) + 25 * ({_SEG})) % 101 AS INT) AS speed,
    0 AS xway,
    CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                    WHEN 'signup' THEN 3 ELSE 4 END AS lane,
    CAST(event_id % 2 AS INT) AS dir,
    {_SEG} AS seg,
    CAST(({_SEG}) * 5280 + CAST(floor(value) AS BIGINT) % 5280 AS INT) AS pos,
    ts AS event_ts
  FROM events)"""

_F = [f"CAST({c} AS VARCHAR)" if c not in ("time",) else 'CAST("time" AS VARCHAR)'
      for c in LRB_FIELDS[:9]] + ["'-1'"] * 6
_CLEAN = "concat_ws(',', " + ", ".join(_F) + ")"
_SHORT = "concat_ws(',', " + ", ".join(_F[:7]) + ")"
_BADSPEED = "concat_ws(',', " + ", ".join(_F[:3] + ["'x'"] + _F[4:]) + ")"
_DOUBLE = "concat_ws(',', " + ", ".join([_F[0], "''"] + _F[1:]) + ")"

LINES = f"""lines AS (SELECT "offset", {_CLEAN} AS value FROM pr)"""
BROKEN = f"""broken AS (SELECT "offset",
    CASE WHEN "offset" % 97 = 0 THEN {_SHORT}
         WHEN "offset" % 89 = 0 THEN {_BADSPEED}
         WHEN "offset" % 83 = 0 THEN {_DOUBLE}
         ELSE {_CLEAN} END AS value FROM pr)"""

REPORTS = """reports AS (SELECT *, CAST("time" // 60 + 1 AS INT) AS minute FROM pr WHERE type = 0)"""

SEGSTATS = """segstats AS (
  SELECT xway, dir, seg, minute, CAST(count(*) AS BIGINT) AS reports,
         CAST(sum(speed) AS BIGINT) AS speed_sum, CAST(count(DISTINCT vid) AS BIGINT) AS cars
  FROM reports GROUP BY xway, dir, seg, minute)"""


def _lav(s: str, c: str) -> str:
    return (f"CASE WHEN {c} > 0 THEN CAST(floor(CAST(CAST({s} AS FLOAT) / CAST({c} AS FLOAT) AS FLOAT) + 0.5) AS INT)"
            f" ELSE 0 END")


SEGHIST = f"""seghist AS (
  SELECT xway, dir, seg, minute,
    CASE WHEN minute <= 1 THEN 0 ELSE {_lav('coalesce(hs, 0)', 'coalesce(hc, 0)')} END AS lav,
    CASE WHEN minute <= 1 THEN 0 ELSE CAST(coalesce(pc, 0) AS INT) END AS num_vehicles
  FROM (SELECT *,
      sum(reports) OVER w5 AS hc, sum(speed_sum) OVER w5 AS hs, max(cars) OVER w1 AS pc
    FROM segstats
    WINDOW w5 AS (PARTITION BY xway, dir, seg ORDER BY minute RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING),
           w1 AS (PARTITION BY xway, dir, seg ORDER BY minute RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)))"""

FLAGGED = """flagged AS (
  SELECT *, (row_number() OVER v = 1 OR seg <> first_value(seg) OVER v) AS in_new_seg
  FROM reports WINDOW v AS (PARTITION BY vid ORDER BY "offset"))"""

KEPT = """kept AS (
  SELECT * EXCLUDE (rn, fs) FROM (
    SELECT *, row_number() OVER v AS rn, first_value(seg) OVER v AS fs
    FROM reports WINDOW v AS (PARTITION BY vid ORDER BY "offset")) WHERE rn = 1 OR seg = fs)"""

MINSTATS = """minstats AS (
  SELECT minute, CAST(count(*) AS BIGINT) AS reports, CAST(sum(speed) AS BIGINT) AS speed_sum,
         CAST(count(DISTINCT vid) AS BIGINT) AS cars
  FROM kept GROUP BY minute)"""

MINHIST = f"""minhist AS (
  SELECT minute,
    CASE WHEN minute <= 1 THEN 0 ELSE {_lav('coalesce(hs, 0)', 'coalesce(hc, 0)')} END AS lav,
    CASE WHEN minute <= 1 THEN 0 ELSE CAST(coalesce(pc, 0) AS INT) END AS num_vehicles
  FROM (SELECT *,
      sum(reports) OVER w5 AS hc, sum(speed_sum) OVER w5 AS hs, max(cars) OVER w1 AS pc
    FROM minstats
    WINDOW w5 AS (ORDER BY minute RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING),
           w1 AS (ORDER BY minute RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)))"""

def _toll(n: str = "num_vehicles", lav: str = "lav") -> str:
    excess = f"CAST({n} - 50 AS BIGINT)"
    return (f"CAST(least(CASE WHEN {n} > 50 AND {lav} < 40 THEN 2 * {excess} * {excess} ELSE 0 END,"
            f" 2147483647) AS INT)")


_TOLL = _toll()

KEYED = f"""keyed AS (
  SELECT f."offset", f.vid, f."time", h.lav, h.num_vehicles, {_TOLL} AS toll
  FROM flagged f JOIN seghist h USING (xway, dir, seg, minute)
  WHERE f.in_new_seg AND f.lane <> 4)"""

GLOBAL = f"""globtoll AS (
  SELECT k."offset", k.vid, k."time", coalesce(h.lav, 0) AS lav,
         coalesce(h.num_vehicles, 0) AS num_vehicles, {_toll('coalesce(h.num_vehicles, 0)', 'coalesce(h.lav, 0)')} AS toll
  FROM kept k LEFT JOIN minhist h USING (minute)
  WHERE k.lane <> 4)"""

# Reports in another arrival order, and each asked report against all that
# arrived before it: no prefix sums.
ARRIVED = """arrived AS (
  SELECT *, ("offset" + ("offset" * 7919) % 3001) * 4096 + "offset" % 4096 AS arrival FROM reports)"""


def _arrival(rows: str, keys: list[str], asked: str) -> str:
    """Tolls of the ``asked`` rows from the ``rows`` that arrived before."""
    same = "".join(f" AND h.{k} = a.{k}" for k in keys)
    cols = "".join(f"{k}, " for k in keys)
    return f"""
  firsts AS (SELECT {cols}minute, vid, min(arrival) AS arrival FROM {rows} GROUP BY {cols}minute, vid),
  asked AS ({asked}),
  history AS (
    SELECT a.arrival, count(*) AS hc, sum(h.speed) AS hs FROM asked a JOIN {rows} h
    ON h.minute BETWEEN a.minute - 5 AND a.minute - 1 AND h.arrival < a.arrival{same} GROUP BY a.arrival),
  before AS (
    SELECT a.arrival, count(*) AS pc FROM asked a JOIN firsts h
    ON h.minute = a.minute - 1 AND h.arrival < a.arrival{same} GROUP BY a.arrival),
  answered AS (
    SELECT a.arrival, vid, "time",
      CASE WHEN minute <= 1 THEN 0 ELSE {_lav('coalesce(hs, 0)', 'coalesce(hc, 0)')} END AS lav,
      CASE WHEN minute <= 1 THEN 0 ELSE CAST(coalesce(pc, 0) AS INT) END AS num_vehicles
    FROM asked a LEFT JOIN history USING (arrival) LEFT JOIN before USING (arrival))
  SELECT arrival, vid, "time", lav, num_vehicles, {_toll()} AS toll FROM answered"""


_BY_ARRIVAL = "WINDOW v AS (PARTITION BY vid ORDER BY arrival)"
_FIRST_SEG = f"SELECT *, row_number() OVER v AS rn, first_value(seg) OVER v AS fs FROM arrived {_BY_ARRIVAL}"

_STAMP = ("strftime(TIMESTAMP '2024-01-01 00:00:00' + to_microseconds((epoch_us(event_ts) - "
          "epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1440), '%Y-%m-%d %H:%M:%S.%g')")
LOG = f"""log AS (
  SELECT l."offset", printf('%s INFO %s - input = [%s]', {_STAMP},
         CASE WHEN l."offset" % 5 = 0 THEN 'parse' ELSE 'consume' END, l.value) AS line
  FROM lines l JOIN pr USING ("offset"))"""

_FIXED_CLOCK = ("strftime(TIMESTAMP '1970-01-02 00:00:00' + to_seconds(CAST(\"time\" AS BIGINT)) + "
                "to_milliseconds(CAST(\"offset\" % 1000 AS BIGINT)), '%Y-%m-%d %H:%M:%S.%g')")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _strict_ok(tokens: str) -> str:
    parts = []
    for i, name in enumerate(LRB_FIELDS[:9], start=1):
        t = f"{tokens}[{i}]"
        typ = "SMALLINT" if name == "time" else "INT"
        parts.append(f"coalesce(regexp_full_match({t}, '[+-]?[0-9]+') AND TRY_CAST({t} AS {typ}) IS NOT NULL, false)")
    return " AND ".join(parts)


def _strict_fields(tokens: str) -> str:
    cols = []
    for i, name in enumerate(LRB_FIELDS[:9], start=1):
        typ = "SMALLINT" if name == "time" else "INT"
        cols.append(f'TRY_CAST({tokens}[{i}] AS {typ}) AS "{name}"')
    return ", ".join(cols)


def _lenient_fields(tokens: str) -> list[str]:
    return [f"COALESCE(TRY_CAST(regexp_extract({tokens}[{i}], '^\\s*([+-]?[0-9]+)', 1) AS INT), 0)"
            for i in range(1, 16)]


_LENIENT = ", ".join(f'{e} AS "{n}"' for e, n in zip(_lenient_fields("t"), LRB_FIELDS))
_REPORT_COLS = '"offset", type, "time", vid, speed, xway, lane, dir, seg, pos'

SQL: dict[str, str] = {
    "position_reports": _with(PR) + f"SELECT {_REPORT_COLS} FROM pr WHERE type = 0",
    "parse_position_reports": _with(PR) + f"SELECT {_REPORT_COLS} FROM pr",
    "parse_permissive_reports": _with(PR, BROKEN) + f"""
        SELECT "offset", {_strict_fields('t')} FROM (SELECT "offset", string_split(value, ',') AS t FROM broken)
        WHERE {_strict_ok('t')}""",
    "parse_rejects": _with(PR, BROKEN) + f"""
        SELECT "offset", value FROM (SELECT *, string_split(value, ',') AS t FROM broken)
        WHERE NOT ({_strict_ok('t')})""",
    "parse_full_lenient": _with(PR, BROKEN) + f"""
        SELECT "offset", {_LENIENT}
        FROM (SELECT "offset", list_filter(string_split(value, ','), lambda x: x <> '') AS t FROM broken)""",
    "format_full_csv": _with(PR, BROKEN) + f"""
        SELECT "offset", concat_ws(',', {', '.join(f'CAST({e} AS VARCHAR)' for e in _lenient_fields('t'))}) AS value
        FROM (SELECT "offset", list_filter(string_split(value, ','), lambda x: x <> '') AS t FROM broken)""",
    "minute_bucket": _with(PR) + """SELECT "offset", "time", CAST("time" // 60 + 1 AS INT) AS minute FROM pr""",
    "event_time": _with(PR) + """SELECT "offset", (86400 + CAST("time" AS BIGINT)) * 1000000 AS event_time_us FROM pr""",
    "passthrough_stamped": _with(PR, LINES) + f"""
        SELECT "offset", {_FIXED_CLOCK} AS stamp, value, '(' || {_FIXED_CLOCK} || ',' || value || ')' AS text
        FROM lines JOIN pr USING ("offset")""",
    "passthrough_text": _with(PR, LINES) + """SELECT "offset", 'input = [' || value || ']' AS text FROM lines""",
    "toll_formula": _with(PR) + f"""
        SELECT "offset", num_vehicles, lav, {_TOLL} AS toll
        FROM (SELECT "offset", CAST(vid % 120 AS INT) AS num_vehicles, CAST(speed % 80 AS INT) AS lav FROM pr)""",
    "latency_ms": _with(PR) + """
        SELECT "offset", CAST("offset" % 997 AS BIGINT) AS emit FROM pr""",
    "non_exit_reports": _with(PR) + f"SELECT {_REPORT_COLS} FROM pr WHERE type = 0 AND lane <> 4",
    "vehicle_new_segment": _with(PR, REPORTS, FLAGGED) + """SELECT "offset", vid, seg, in_new_seg FROM flagged""",
    "vehicle_same_segment": _with(PR, REPORTS, KEPT) + """SELECT "offset", vid, seg FROM kept""",
    "segment_minute_stats": _with(PR, REPORTS, SEGSTATS) + "SELECT * FROM segstats",
    "segment_lav": _with(PR, REPORTS, SEGSTATS, SEGHIST) + "SELECT xway, dir, seg, minute, lav FROM seghist",
    "segment_car_count": _with(PR, REPORTS, SEGSTATS, SEGHIST)
    + "SELECT xway, dir, seg, minute, num_vehicles FROM seghist",
    "reports_with_stats": _with(PR, REPORTS, SEGSTATS, SEGHIST) + """
        SELECT r."offset", r.vid, xway, dir, seg, minute, h.lav, h.num_vehicles
        FROM reports r JOIN seghist h USING (xway, dir, seg, minute)""",
    "global_minute_stats": _with(PR, REPORTS, KEPT, MINSTATS) + "SELECT * FROM minstats",
    "global_lav": _with(PR, REPORTS, KEPT, MINSTATS, MINHIST) + "SELECT minute, lav, num_vehicles FROM minhist",
    "toll_notifications_keyed": _with(PR, REPORTS, SEGSTATS, SEGHIST, FLAGGED, KEYED)
    + "SELECT * FROM keyed WHERE toll <> 0",
    "toll_notifications_keyed_all": _with(PR, REPORTS, SEGSTATS, SEGHIST, FLAGGED, KEYED) + "SELECT * FROM keyed",
    "toll_latency_keyed": _with(PR, REPORTS, SEGSTATS, SEGHIST, FLAGGED, KEYED)
    + """SELECT *, CAST("offset" % 997 AS BIGINT) AS emit FROM keyed""",
    "toll_notifications_global": _with(PR, REPORTS, KEPT, MINSTATS, MINHIST, GLOBAL) + "SELECT * FROM globtoll",
    "toll_notifications_arrival": _with(
        PR, REPORTS, ARRIVED, f"marked AS ({_FIRST_SEG})",
        _arrival("marked", ["xway", "dir", "seg"],
                 "SELECT * FROM marked WHERE (rn = 1 OR seg <> fs) AND lane <> 4").strip()),
    "toll_notifications_global_arrival": _with(
        PR, REPORTS, ARRIVED, f"kept AS (SELECT * FROM ({_FIRST_SEG}) WHERE rn = 1 OR seg = fs)",
        _arrival("kept", [], "SELECT * FROM kept WHERE lane <> 4").strip()),
    "format_toll_keyed": _with(PR, REPORTS, SEGSTATS, SEGHIST, FLAGGED, KEYED) + f"""
        SELECT "offset", concat_ws(',', {_FIXED_CLOCK}, '0', CAST(vid AS VARCHAR), CAST("time" AS VARCHAR),
            CAST("offset" % 997 AS VARCHAR), CAST(lav AS VARCHAR), CAST(toll AS VARCHAR)) AS text
        FROM keyed WHERE toll <> 0""",
    "format_toll_global": _with(PR, REPORTS, KEPT, MINSTATS, MINHIST, GLOBAL) + """
        SELECT "offset", concat_ws(', ', '0', CAST(vid AS VARCHAR), CAST("time" AS VARCHAR),
            CAST("offset" % 997 AS VARCHAR), CAST(lav AS VARCHAR), CAST(toll AS VARCHAR)) AS text
        FROM globtoll""",
    "replay_prefix": _with(PR) + """
        SELECT "offset", "time", vid FROM pr
        WHERE "offset" < coalesce((SELECT min("offset") FROM pr WHERE "time" > 600 + 1), 9223372036854775807)""",
    "to_kafka_frame": _with(PR, LINES) + """SELECT CAST("offset" AS VARCHAR) AS key, value FROM lines""",
    "src_text_lines": _with(PR, LINES) + """SELECT "offset", value FROM lines""",
    "json_value_decode": """
        SELECT event_id AS "offset",
               CASE WHEN props IS NULL THEN '{}' ELSE CAST(json_object('value', json(props)) AS VARCHAR) END AS json,
               CAST(json_extract_string(props, '$.k') AS INT) AS k
        FROM events""",
    "log_marker_filter": _with(PR, LINES, LOG) + """SELECT "offset", line FROM log WHERE contains(line, 'consume')""",
    "log_time_range": _with(PR, LINES, LOG) + """
        SELECT "offset", line FROM log
        WHERE strptime(substr(line, 1, 23), '%Y-%m-%d %H:%M:%S.%g') >= TIMESTAMP '2024-01-01 00:10:00'
          AND strptime(substr(line, 1, 23), '%Y-%m-%d %H:%M:%S.%g') < TIMESTAMP '2024-01-01 00:10:10'""",
    "throughput_per_second": _with(PR, LINES, LOG) + """
        SELECT strftime(date_trunc('second', strptime(substr(line, 1, 23), '%Y-%m-%d %H:%M:%S.%g')),
                        '%Y-%m-%d %H:%M:%S') AS second, CAST(count(*) AS BIGINT) AS records
        FROM log WHERE contains(line, 'consume') GROUP BY 1""",
}

# Streaming forms answer exactly what the batch forms answer on ordered input.
SQL["stream_toll_notifications_keyed"] = SQL["toll_notifications_keyed"]
SQL["stream_toll_notifications_keyed_window"] = SQL["toll_notifications_keyed"]
SQL["stream_toll_notifications_global"] = SQL["toll_notifications_global"]
SQL["stream_passthrough_text"] = _with(PR, LINES) + "SELECT 'input = [' || value || ']' AS text FROM lines"
SQL["stream_toll_notifications_arrival"] = SQL["toll_notifications_arrival"]
SQL["stream_toll_notifications_global_arrival"] = SQL["toll_notifications_global_arrival"]
SQL["toll_notifications_redelivered"] = SQL["toll_notifications_keyed"]
