"""JSON value decode (S5): a message becomes ``{"value": <its JSON>}``.

An absent message becomes an empty object; malformed JSON fails the job
(``mode="strict"``) or is treated as absent (``mode="try"``). Variant
parsing is a built-in expression, so it runs in codegen over any table of
strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(col: Column, mode: str = "strict") -> Column:
    """Struct ``value: variant``; the field is null for a null message."""
    if mode not in ("strict", "try"):
        raise ValueError(f"unknown mode {mode!r}")
    parsed = F.parse_json(col) if mode == "strict" else F.try_parse_json(col)
    return F.named_struct(F.lit("value"), parsed)


def json_value_text(col: Column, mode: str = "strict") -> Column:
    """The wrapped object as compact JSON text; ``{}`` for a null message
    (null fields are left out of the text)."""
    return F.to_json(json_value(col, mode))
