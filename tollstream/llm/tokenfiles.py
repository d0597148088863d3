"""Token-id files: Re-Pair grammar compression per shard, random access.

Documents are encoded, ordered by id over ranges, and cut into shards of
about ``shard_ids`` ids. In a shard the frequent pairs of neighbouring
symbols are replaced by new symbols (nonterminals), again and again, until
no pair occurs ``min_count`` times or a round saves less than ``least_gain``
of the symbols. A round replaces all frequent pairs at once: an occurrence
that overlaps one of a more frequent pair (or an earlier one of its own) is
left. No pair spans two documents, so a document is a slice of the symbols.

A shard file holds, little-endian: the head (magic, first nonterminal, number
of rules, documents and symbols), each rule's two symbols and expansion
length, the documents' ids and null marks, where their symbols begin, how
many ids they have, and the symbols in 3 bytes each (4 if a number needs it).
From the expansion lengths a reader finds the symbol that covers any id of a
document without decoding what lies before. Shard files are the rows of a
Parquet table in the shared folder, so the usual commit makes a retried task
harmless.

Defined cases: null or empty text: the end id alone; null ids come first;
rows with equal ids are ordered by a hash of the text; ids are longs, or text
that is one (other ids are an error); no rows: no shards;
only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .shared import ship, table, text_col
from .tokens import BLOCK_CHARS, encoder, tokenizer_path

HEAD = struct.Struct("<4sIIIIB")
MAGIC = b"RPR1"
HASH_BITS = 18
# A pair becomes a rule from this count on, in shards of every size: a rule
# takes 12 bytes (two symbols, expansion length), an occurrence saves 3, and
# some occurrences yield to overlapping ones.
MIN_COUNT, RULE_BYTES, SYMBOL_BYTES = 16, 12, 3
# A round must save this share of the symbols: on a shard of 1.05 million ids
# 1.967 bytes an id in 0.17 s; at 0.001 1.953 in 0.23 s, at 0 1.945 in 3 s.
LEAST_GAIN = 0.005


def _frequent_pairs(x: np.ndarray, inside: np.ndarray, min_count: int):
    """(left, right) of the frequent pairs, most frequent first, and where
    they occur: ascending positions and the number of the pair there.
    ``inside``: the pair at a position lies in one document."""
    slot = ((x[:-1] * np.uint32(0x9E3779B1) + x[1:]) * np.uint32(0x85EBCA77) >> np.uint32(32 - HASH_BITS)).view(np.int32)
    heavy = np.bincount(slot, minlength=1 << HASH_BITS) >= min_count  # a slot counts at least its pairs
    at = np.flatnonzero(heavy[slot])
    at = at[inside[at]]
    keys = (x[at].astype(np.uint64) << np.uint64(32)) | x[at + 1].astype(np.uint64)
    order = np.argsort(keys)
    sorted_keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(keys) else np.zeros(0, int)
    count = np.diff(np.append(first, len(keys)))
    good = np.flatnonzero(count >= min_count)
    good = good[np.lexsort((sorted_keys[first[good]], -count[good]))]
    number = np.full(len(first), -1, np.int64)
    number[good] = np.arange(len(good))
    pair = np.empty(len(at), np.int64)
    pair[order] = np.repeat(number, count)
    chosen = sorted_keys[first[good]]
    real = pair >= 0
    return chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF), at[real], pair[real]


def compress(ids: np.ndarray, ends: np.ndarray, min_count: int = MIN_COUNT, rule_bytes: int = RULE_BYTES,
             least_gain: float = LEAST_GAIN, first_nonterminal: int | None = None):
    """Re-Pair over one shard. ``ends`` marks the last id of each document.
    Rounds go on until no pair occurs ``min_count`` times, or a round saves
    less than ``least_gain`` of the symbols or than its rules take. A pair
    that is met again after its round keeps its rule. Returns symbols, ends,
    first nonterminal, rules (n, 2)."""
    x, last = ids.astype(np.uint32), ends.copy()
    base = int(first_nonterminal if first_nonterminal is not None else (x.max() + 1 if len(x) else 0))
    rules = np.zeros((0, 2), np.uint32)
    known, symbols = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # pairs with a rule, ascending, and its symbol
    while len(x) > 1:
        a, b, at, pair = _frequent_pairs(x, ~last[:-1], min_count)
        # an occurrence yields to an overlapping one of a more frequent pair,
        # of the same pair to the one before
        touch = np.flatnonzero(np.diff(at) == 1)
        free = np.ones(len(at), bool)
        free[touch[pair[touch] > pair[touch + 1]]] = False
        free[touch[pair[touch] <= pair[touch + 1]] + 1] = False
        keys = (a << np.uint64(32)) | b
        place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        old = known[place] == keys if len(known) else np.zeros(len(keys), bool)
        # what is left must be worth a rule; a pair met again has one
        used = np.bincount(pair[free], minlength=len(keys))
        worth = (used > 0) & (old | (SYMBOL_BYTES * used >= rule_bytes))
        free &= worth[pair] if len(pair) else free
        take, pair = at[free], pair[free]
        fresh = worth & ~old
        if len(take) < max(1, least_gain * len(x)) or SYMBOL_BYTES * len(take) < rule_bytes * fresh.sum():
            break
        symbol = np.where(old, symbols[place] if len(known) else 0, base + len(rules) + np.cumsum(fresh) - 1)
        x[take] = symbol[pair].astype(np.uint32)
        last[take] = last[take + 1]
        stay = np.ones(len(x), bool)
        stay[take + 1] = False
        x, last = x[stay], last[stay]
        rules = np.concatenate([rules, np.stack([a, b], axis=1)[fresh].astype(np.uint32)])
        known, symbols = np.concatenate([known, keys[fresh]]), np.concatenate([symbols, symbol[fresh]])
        order = np.argsort(known)
        known, symbols = known[order], symbols[order]
    return x, last, base, rules


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids below each rule. A rule uses rules before it only; batches of
    rules that use finished ones are done together."""
    size = np.zeros(len(rules), np.int64)
    todo = np.arange(len(rules))
    while len(todo):
        part = rules[todo].astype(np.int64) - base
        low = np.where(part < 0, 1, size[np.maximum(part, 0)])
        ready = (low > 0).all(axis=1)
        size[todo[ready]] = low[ready].sum(axis=1)
        todo = todo[~ready]
    return size


def write_shard(doc_ids: list, ids: list[bytes], min_count: int = MIN_COUNT) -> bytes:
    """One shard file from its documents' ids (little-endian u32 bytes)."""
    counts = np.array([len(b) // 4 for b in ids], dtype=np.uint32)
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    ends = np.zeros(len(flat), bool)
    ends[np.cumsum(counts[counts > 0]) - 1] = True
    x, last, base, rules = compress(flat, ends, min_count)
    stops = np.flatnonzero(last) + 1
    begins = np.zeros(len(ids) + 1, np.uint32)
    begins[1:] = np.concatenate([[0], stops])[np.cumsum(counts > 0)]
    wide = int(x.max() >= 1 << 24) if len(x) else 0
    raw = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    null = np.array([d is None or d != d for d in doc_ids], dtype=np.uint8)
    known = np.array([0 if n else int(d) for d, n in zip(doc_ids, null)], dtype="<i8")
    return b"".join([HEAD.pack(MAGIC, base, len(rules), len(ids), len(x), wide),
                     rules.astype("<u4").tobytes(), expansion_lengths(rules, base).astype("<u4").tobytes(),
                     known.tobytes(), null.tobytes(), begins.astype("<u4").tobytes(),
                     counts.astype("<u4").tobytes(), (raw if wide else raw[:, :3]).tobytes()])


class Shard:
    """Reader of one shard file."""

    def __init__(self, data: bytes):
        magic, self.base, n_rules, self.n_docs, n_symbols, wide = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard file")
        at = HEAD.size

        def array(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.rules = array("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = array("<u4", n_rules).astype(np.int64)
        ids, null = array("<i8", self.n_docs), array("u1", self.n_docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, null)]
        self.begins = array("<u4", self.n_docs + 1).astype(np.int64)
        self.counts = array("<u4", self.n_docs).astype(np.int64)
        width = 4 if wide else 3
        raw = np.zeros((n_symbols, 4), np.uint8)
        raw[:, :width] = array("u1", width * n_symbols).reshape(-1, width)
        self.symbols = raw.view("<u4").ravel()
        self._flat = None

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols.astype(np.int64) - self.base
        return np.where(rule < 0, 1, self.lengths[np.maximum(rule, 0)] if len(self.lengths) else 1)

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids below every rule, one after the other, and where each
        rule's begin. Built a level at a time, once a shard."""
        if self._flat is None:
            x, rule_of = self.rules.ravel(), np.repeat(np.arange(len(self.rules)), 2)
            while True:
                rule = x.astype(np.int64) - self.base
                inner = np.flatnonzero(rule >= 0)
                if not len(inner):
                    break
                n = np.ones(len(x), np.int64)
                n[inner] = 2
                at = np.cumsum(n) - n
                out = np.empty(len(x) + len(inner), np.uint32)
                out[at] = x
                out[at[inner]] = self.rules[rule[inner], 0]
                out[at[inner] + 1] = self.rules[rule[inner], 1]
                x, rule_of = out, np.repeat(rule_of, n)
            self._flat = x, np.searchsorted(rule_of, np.arange(len(self.rules)))
        return self._flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids below the symbols."""
        inner = np.flatnonzero(symbols >= self.base)
        if not len(inner):
            return symbols
        flat, begins = self._expansions()
        rule = symbols[inner].astype(np.int64) - self.base
        n = self.lengths[rule]
        more = np.zeros(len(symbols), np.int64)
        more[inner] = n - 1
        at = np.arange(len(symbols)) + np.cumsum(more) - more
        out = np.empty(len(symbols) + int(more.sum()), np.uint32)
        out[at] = symbols
        end = np.cumsum(n)
        inside = np.arange(end[-1]) - np.repeat(end - n, n)
        out[np.repeat(at[inner], n) + inside] = flat[np.repeat(begins[rule], n) + inside]
        return out

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.begins[k]:self.begins[k + 1]])

    def window(self, k: int, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of document k: only the symbols that
        cover them are expanded."""
        own = self.symbols[self.begins[k]:self.begins[k + 1]]
        end = np.cumsum(self._sizes(own))
        a = int(np.searchsorted(end, start, side="right"))
        b = int(np.searchsorted(end, start + n, side="left")) + 1
        skip = start - (int(end[a - 1]) if a else 0)
        return self.expand(own[a:b])[skip:skip + n]

    def all(self) -> np.ndarray:
        return self.expand(self.symbols)


FILES = "part int, shard int, before long, n_ids long, data binary"
# Ids go to Python and back as text: beside a null, numbers would turn into floats.
ROWS = "part int, doc_id string, inner long, n_tokens long, ids_crc32 long"


def _gathered(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of several batches at a time: a larger block of texts
    has fewer distinct words to look up."""
    docs: list = []
    texts: list[str] = []
    chars = 0
    for frame in frames:
        docs += list(frame["doc_id"])
        texts += list(frame["__text"])
        chars += int(frame["__text"].str.len().sum())
        if chars >= BLOCK_CHARS:
            yield docs, texts
            docs, texts, chars = [], [], 0
    if docs:
        yield docs, texts


def _shards(frames: Iterator[pd.DataFrame], path: str, kind: str, end_id: int, shard_ids: int) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    enc, end = encoder(path, kind, 700_000), end_id.to_bytes(4, "little")
    docs: list = []
    ids: list[bytes] = []
    size = before = number = 0

    def done() -> pd.DataFrame:
        nonlocal docs, ids, size, before, number
        row = pd.DataFrame({"part": [part], "shard": [number], "before": [before], "n_ids": [size],
                            "data": [write_shard(docs, ids)]})
        docs, ids, before, number, size = [], [], before + size, number + 1, 0
        return row

    for known, texts in _gathered(frames):
        for doc, own in zip(known, enc.ids(texts)):
            docs.append(None if doc is None else int(doc))
            ids.append(own + end)
            size += len(own) // 4 + 1
            if size >= shard_ids:
                yield done()
    if docs:
        yield done()


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part, before, data in zip(frame["part"], frame["before"], frame["data"]):
            s = Shard(data)
            flat = memoryview(s.all().astype("<u4").tobytes())
            stop = np.cumsum(s.counts)
            start = stop - s.counts
            yield pd.DataFrame({
                "part": part, "doc_id": pd.Series([None if d is None else str(d) for d in s.doc_ids], dtype=object), "inner": before + start,
                "n_tokens": s.counts,
                "ids_crc32": [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(start.tolist(), stop.tolist())]})


def write_files(docs: DataFrame, folder: str, path: str, kind: str = "word", end_id: int = 2,
                shard_ids: int = 1 << 20, rows_per_range: int = 4096) -> None:
    """Encode and write all documents as shard files in ascending doc_id."""
    ship(docs.sparkSession)
    ranges = min(1 << 16, max(1, -(-docs.count() // rows_per_range)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("__text"))
    # copies of a row are told apart, so that they don't fill one range
    rows = rows.withColumns({"__tie": F.xxhash64("__text"), "__row": F.monotonically_increasing_id()})
    order = ["doc_id", "__tie", "__row"]
    (rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .select(F.col("doc_id").cast("string").alias("doc_id"), "__text")
     .mapInPandas(lambda it: _shards(it, path, kind, end_id, shard_ids), FILES)
     .write.parquet(folder))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32,
    decoded from the shard files."""
    ship(spark)
    files = spark.read.schema(FILES).parquet(folder)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range, 65 536 at most
    parts = (files.groupBy("part").agg(F.sum("n_ids").alias("__n"))
             .select("part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead")))
    rows = files.select("part", "before", "data").mapInPandas(_read, ROWS)
    return rows.join(F.broadcast(parts), "part").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("inner") + F.col("__ahead")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: word_bpe_49k ids and end id 2, through files."""
    folder = scratch_path(spark, "llm-tokenfiles")
    write_files(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    return read_files(spark, folder)
