"""Packing documents into sequences: dominance reduction, then best fit.

A document's ids (and an end id) are one piece, or pieces of ``capacity``
ids of which the first may be shorter. Sequences are planned over piece
*lengths*: there are at most ``capacity`` of them, so the plan's input is a
histogram of bounded size, however many documents there are, and what it
returns is a bounded list of patterns (lengths in a sequence, and how often).

Reduction (Martello-Toth): for each length, longest first, a set of pieces
that dominates every other set with it is fixed for good: the exact
complement; or the largest fitting piece, when only one more piece fits, or
when no two fitting pieces are longer together than it and no three fit. The
instance shrinks by the fixed sets, until none is found. What is left goes to
best fit, longest first, into the fullest sequence with room.

Pieces get their place by their rank within their length. Ranks are counted
over salted parts (shared.ranked), so a length that a third of all pieces
share is no single task's work.

Defined cases: null or empty text: the end id alone, one piece of length 1;
null ids and repeated rows are packed like others; ids are longs, or text
that is one (other ids are an error); no rows: no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import frame as as_frame, ranked, release_memory, ship, stage, table, text_col
from .tokens import encoder, tokenizer_path

# The id goes to Python and back as text: beside a null, numbers would turn into floats.
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def _pieces(frames: Iterator[pd.DataFrame], path: str, kind: str, end_id: int, capacity: int,
            keep_ids: bool) -> Iterator[pd.DataFrame]:
    enc, end = encoder(path, kind), end_id.to_bytes(4, "little")
    for frame in frames:
        rows = []
        for doc, ids in zip(frame["doc_id"], enc.ids(list(frame["__text"]))):
            ids += end
            n = len(ids) // 4
            first = n % capacity or capacity
            cuts = [0, *range(first, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                part = ids[4 * a:4 * b]
                rows.append((doc, k, a, b - a, zlib.crc32(part), part) if keep_ids
                            else (doc, k, a, b - a, zlib.crc32(part)))
        yield as_frame(rows, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
        release_memory()


def pieces(docs: DataFrame, path: str, kind: str, end_id: int, capacity: int,
           keep_ids: bool = False) -> DataFrame:
    """The pieces of each document; with ``keep_ids`` their ids too, as
    little-endian unsigned 32-bit."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), text_col().alias("__text"))
    return texts.mapInPandas(lambda it: _pieces(it, path, kind, end_id, capacity, keep_ids),
                             PIECES + (", ids binary" if keep_ids else "")).withColumn("doc_id", F.col("doc_id").cast("long"))


# --- the plan: lengths only ----------------------------------------------------

class _Open:
    """Lengths still to pack, ascending, and their counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest(self, room: int) -> int | None:
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None

    def smallest(self, n: int) -> list[int]:
        """The n smallest pieces, repeats included."""
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(n - len(out), self.count[length])
            if len(out) == n:
                break
        return out

    def best_pair(self, room: int) -> int:
        """Longest sum of two pieces within ``room``; 0 if none fit."""
        best = 0
        for a in self.lengths:
            if 2 * a > room:
                break
            b = self.largest(room - a)
            if b is None or b < a:
                continue
            if b == a and self.count[a] < 2:
                continue
            best = max(best, a + b)
        return best


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(patterns fixed for good with how often, counts that remain)."""
    open_, fixed = _Open(counts), []

    def fix(pattern: tuple[int, ...]) -> None:
        need = {x: pattern.count(x) for x in pattern}
        n = min(open_.count[x] // k for x, k in need.items())
        for x, k in need.items():
            open_.take(x, n * k)
        fixed.append((pattern, n))

    if capacity in open_.count:
        fix((capacity,))
    for j in list(open_.lengths[::-1]):  # exact pairs dominate whatever else is open
        if j * 2 >= capacity and j in open_.count and capacity - j in open_.count:
            if j * 2 > capacity or open_.count[j] > 1:
                fix((j, capacity - j))
    changed = True
    while changed:
        changed = False
        for j in list(open_.lengths[::-1]):
            while j in open_.count:
                pattern = _dominating(open_, j, capacity - j)
                if not pattern:
                    break
                fix(pattern)
                changed = True
    return fixed, open_.count


def _dominating(open_: _Open, j: int, room: int) -> tuple[int, ...] | None:
    """A set with j that dominates every other set with j, if one of at most
    two pieces does."""
    if open_.count[j] == 1 and len(open_.lengths) == 1:
        return (j,)
    single = open_.count[j] == 1
    open_.take(j, 1)  # the other pieces, without this one
    k = open_.largest(room)
    few = open_.smallest(3)
    if k is None:
        found = (j,)
    elif k == room or len(few) < 2 or sum(few[:2]) > room:
        found = (j, k)
    elif (len(few) < 3 or sum(few) > room) and open_.best_pair(room) <= k:
        found = (j, k)
    else:
        found = None
    open_.count[j] = open_.count.get(j, 0) + 1
    if single:
        open_.lengths.insert(bisect_left(open_.lengths, j), j)
    return found


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over whole classes of equal lengths and equal
    sequences at a time: patterns and how often each occurs."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(r: int, pattern: tuple[int, ...], n: int) -> None:
        if r not in room:
            room[r] = []
            rooms.insert(bisect_left(rooms, r), r)
        room[r].append((pattern, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # new sequences
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, (length,) * each, n // each)
                if n % each:
                    put(capacity - (n % each) * length, (length,) * (n % each), 1)
                break
            r = rooms[at]
            pattern, have = room[r].pop()
            if not room[r]:
                del room[r]
                rooms.pop(at)
            each = r // length
            full = min(have, n // each)
            if full:
                put(r - each * length, pattern + (length,) * each, full)
                n -= full * each
                have -= full
            if have and n and n < each:
                put(r - n * length, pattern + (length,) * n, 1)
                n, have = 0, have - 1
            if have:
                put(r, pattern, have)
    return [p for r in rooms for p in room[r]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, rest = reduce_dominated(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank behind the last, first sequence, offset)."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            at = used.get(length, 0)
            out.append((length, at, at + n, sequence, offset))
            used[length] = at + n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, path: str, kind: str = "byte", end_id: int = 0, capacity: int = 2048,
         keep_ids: bool = False) -> DataFrame:
    """The pieces with their sequence_id and offset."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, path, kind, end_id, capacity, keep_ids), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # <= capacity rows
    spots = places(plan(counts, capacity))
    where = F.broadcast(spark.createDataFrame(spots or [(0, 0, 0, 0, 0)],
                        "p_length long, p_from long, p_to long, p_sequence long, p_offset long"))
    numbered = ranked(cut, ["length"], ["doc_id", "piece", "ids_crc32"],
                      F.xxhash64("doc_id", "piece", "ids_crc32"), "__rank")
    return (numbered.join(where, (numbered["length"] == where["p_length"])
                          & (numbered["__rank"] >= where["p_from"]) & (numbered["__rank"] < where["p_to"]))
            .select(*cut.columns, (F.col("p_sequence") + F.col("__rank") - F.col("p_from")).alias("sequence_id"),
                    F.col("p_offset").alias("offset")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: byte_bpe_50k ids, end id 0, sequences of at most 2048."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
