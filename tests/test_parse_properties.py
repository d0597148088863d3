"""Parsing against plain-Python models of the reference's readers, on many
random lines in one Spark job each: Java ``split(",")`` + ``parseInt`` /
``parseShort`` (strict), C ``strtok`` + ``atoi`` (lenient)."""

import random
import re

from tollstream.functions.parse import parse_full_lenient, parse_reports, rejected_lines
from tollstream.schema import LRB_FIELDS, REPORT_FIELDS

INT_MIN, INT_MAX = -2**31, 2**31 - 1


def java_split(line):
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()                      # String.split drops trailing empty strings
    return parts


def java_parse(line):
    """Fields 0..8 as the strict reader sees them, or None when it throws."""
    parts = java_split(line)
    if len(parts) < 9:
        return None
    out = []
    for i, name in enumerate(REPORT_FIELDS):
        tok = parts[i]
        if not re.fullmatch(r"[+-]?[0-9]+", tok):
            return None
        v = int(tok)
        lo, hi = (-32768, 32767) if name == "time" else (INT_MIN, INT_MAX)
        if not lo <= v <= hi:
            return None
        out.append(v)
    return tuple(out)


def c_atoi(tok):
    m = re.match(r"\s*([+-]?[0-9]+)", tok)
    if not m:
        return 0
    v = int(m.group(1))
    return v if INT_MIN <= v <= INT_MAX else 0   # out of range: undefined in C, 0 here


def c_parse(line):
    toks = [t for t in line.split(",") if t != ""]
    return tuple(c_atoi(toks[i]) if i < len(toks) else 0 for i in range(15))


def random_token(rnd):
    r = rnd.random()
    if r < 0.55:
        return str(rnd.randint(-200, 20000))
    if r < 0.62:
        return rnd.choice(["+", "-", ""]) + str(rnd.randint(0, 10**12))
    if r < 0.70:
        return " " + str(rnd.randint(0, 99))
    if r < 0.76:
        return str(rnd.randint(0, 99)) + rnd.choice(["x", ".5", " ", "e3"])
    if r < 0.82:
        return ""
    if r < 0.88:
        return rnd.choice(["x", "-", "+", "--1", "0x10"])
    return "0" * rnd.randint(1, 12) + str(rnd.randint(0, 9))


def random_lines(seed, n=3000):
    rnd = random.Random(seed)
    lines = []
    for _ in range(n):
        k = rnd.choice([7, 8, 9, 9, 10, 15, 15, 15, 16])
        line = ",".join(random_token(rnd) for _ in range(k))
        if rnd.random() < 0.1:
            line += ","
        lines.append(line)
    return lines


def test_strict_and_permissive_match_java(spark):
    lines = random_lines(1)
    df = spark.createDataFrame(list(enumerate(lines)), "offset long, value string")
    got = {r["offset"]: tuple(r[c] for c in REPORT_FIELDS)
           for r in parse_reports(df, mode="permissive").collect()}
    want = {i: v for i, line in enumerate(lines) if (v := java_parse(line)) is not None}
    assert got == want
    rejected = {r["offset"] for r in rejected_lines(df).collect()}
    assert rejected == set(range(len(lines))) - set(want)
    assert 0 < len(want) < len(lines)


def test_lenient_matches_c_reader(spark):
    lines = random_lines(2)
    df = spark.createDataFrame(list(enumerate(lines)), "offset long, value string")
    got = {r["offset"]: tuple(r[c] for c in LRB_FIELDS) for r in parse_full_lenient(df).collect()}
    assert got == {i: c_parse(line) for i, line in enumerate(lines)}
