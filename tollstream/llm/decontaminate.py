"""Benchmark decontamination by template canonicalisation.

A text is read in three ways (layers). Two are templates: numbers, units
behind numbers and names are typed placeholders, everything else is lower
case. Names are the title-case words inside a sentence in the first, all
title-case words in the second, as names open sentences too. The third is the
plain words in lower case, so a copy in any case is found. Windows of
``width`` words of the benchmark and of the documents are hash-joined, each
layer with its like. Matching windows of a document and an item that
lie on one diagonal (document position minus item position) are checked for
consistent slots: each value in the item's slots must stand for one value in
the document and the other way round, so a question with other numbers or
names is caught, and a chance likeness with contradicting slots is not.

A document leaks an item if consistent windows on a diagonal cover
``least_share`` of the item's windows, or ``least_run`` words in a row.
Windows with fewer than ``least_words`` words that are no placeholders
identify no text and are not windows. Plain words have no placeholders:
numbers and the signs before them stay, every window counts, and an item that
is short or all numbers ("What is 48 + 37?") is found by its exact words.

Scale: the documents are read once. Their windows are hashed with numpy and
tested against a bitmap of the benchmark's window hashes, 1024 bits a window
up to 16 MB; only windows that hit it leave the task, and the join settles them
exactly. A group after the join is one document, item,
layer and diagonal: at most the item's length.

Defined cases: null and empty texts have no windows; an item shorter than a
window is one window; items without text match nothing; rows with equal ids
are told apart by their text; repeated rows count once; null ids are kept;
only ``doc_id`` and ``text`` (``item_id`` and ``text``) are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import frame as as_frame, release_memory, ship, stage, table, text_col

WIDTH, LEAST_SHARE, LEAST_RUN, LEAST_WORDS = 5, 0.8, 13, 3
MOST_BITS = 27  # of the bitmap: 16 MB
BLOCK_CHARS = 1 << 18  # of texts read together

# Units that count as such behind a number.
UNITS = frozenset("""mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet g kg mg lb
lbs oz ton tons gram grams kilogram kilograms pound pounds l ml liter liters litre litres s sec second seconds min
minute minutes h hr hour hours day days week weeks month months year years usd eur dollar dollars cent cents euro
euros percent mph kmh kph hz khz mhz ghz b kb mb gb tb w kw v a c f k""".split())

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# What a token can be: sentence end (also a colon or line end), sign before a
# number, number, title-case word, unit, another word.
_END, _SIGN, _NUM, _TITLE, _IS_UNIT, _PLAIN = range(6)
# The layers: names inside sentences, names anywhere, plain words.
INSIDE, ANYWHERE, EXACT = LAYERS = range(3)

# What a character can be. Words are letters, with apostrophes between them;
# numbers are digits, with points and commas between them.
_OTHER, _LETTER, _DIGIT, _STOP, _POINT, _COMMA, _APOSTROPHE, _OPERATOR = range(8)
_CHARS = {"!": _STOP, "?": _STOP, ":": _STOP, "\n": _STOP, ".": _POINT, ",": _COMMA, "'": _APOSTROPHE, "’": _APOSTROPHE,
          **dict.fromkeys("-+*/=<>×÷−^", _OPERATOR)}
_BMP = 1 << 16


def _character(c: str) -> tuple[int, bool, int, int]:
    """Class, white space, case (1 lower, 2 upper, 3 title), lower-case code."""
    kind = _CHARS.get(c, _DIGIT if c.isdecimal() else _LETTER if c.isalnum() else _OTHER)
    return kind, c.isspace(), 1 if c.islower() else 2 if c.isupper() else 3 if c.istitle() else 0, ord(c.lower()[:1] or c)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Table:
    """Properties of characters as arrays, and powers for word hashes: the
    hash of a word is a difference of prefix sums, so words of any number and
    kind cost the same."""

    def __init__(self):
        rows = [_character(chr(k)) for k in range(_BMP)]
        self.kind = np.array([r[0] for r in rows], np.int8)
        self.space = np.array([r[1] for r in rows])
        self.case = np.array([r[2] for r in rows], np.int8)
        self.value = _mixed(np.array([r[3] for r in rows], np.uint64) + _MULTIPLIER)
        self.power = self.inverse = np.ones(1, np.uint64)
        self.units = np.zeros(0, np.uint64)
        self.units = np.unique(np.concatenate([_read_part(u, self)[1] for u in UNITS]))

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the multiplier and of its inverse, at least ``n``."""
        if len(self.power) < n:
            inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
            self.power, self.inverse = (np.multiply.accumulate(np.concatenate(
                [np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (_MULTIPLIER, inverse))
        return self.power, self.inverse

    def __call__(self, codes: np.ndarray) -> list[np.ndarray]:
        """kind, space, case and value of each code point."""
        at = np.where(codes < _BMP, codes, 0)
        out = [t[at] for t in (self.kind, self.space, self.case, self.value)]
        far = np.flatnonzero(codes >= _BMP)
        for code in np.unique(codes[far]).tolist():
            kind, space, case, low = _character(chr(code))
            here = far[codes[far] == code]
            for x, v in zip(out, (kind, space, case, _mixed(np.array([low], np.uint64) + _MULTIPLIER)[0])):
                x[here] = v
        return out


def _read_part(text: str, table: _Table) -> tuple[np.ndarray, ...]:
    """kind, hash, title case, start and stop of each token of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.int8), none.astype(np.uint64), none.astype(bool), none, none
    char, space, case, value = table(codes)
    group = char.copy()
    inner = slice(1, n - 1)
    before, after, mid = char[:-2], char[2:], char[1:-1]
    group[inner][(mid == _APOSTROPHE) & (before == _LETTER) & (after == _LETTER)] = _LETTER
    group[inner][((mid == _POINT) | (mid == _COMMA)) & (before == _DIGIT) & (after == _DIGIT)] = _DIGIT
    # signs with a number behind them, after any white space
    sign = np.flatnonzero(group == _OPERATOR)
    if len(sign):
        solid = np.flatnonzero(~space)
        k = np.searchsorted(solid, sign, "right")
        after = solid[np.minimum(k, len(solid) - 1)]
        sign = sign[(k < len(solid)) & (char[after] == _DIGIT)]
    word = (group == _LETTER) | (group == _DIGIT)
    turn = np.flatnonzero(np.diff(group, prepend=_OTHER) != 0)
    start = turn[word[turn]]
    stop = np.append(turn[1:], n)[word[turn]]
    ends = np.flatnonzero((group == _STOP) | (group == _POINT))
    kind = np.concatenate([np.where(group[start] == _DIGIT, _NUM, _PLAIN), np.full(len(ends), _END), np.full(len(sign), _SIGN)])
    start, stop = np.concatenate([start, ends, sign]), np.concatenate([stop, ends + 1, sign + 1])
    order = np.argsort(start, kind="stable")
    kind, start, stop = kind[order].astype(np.int8), start[order], stop[order]

    power, inverse = table.powers(n)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n])])
    hashes = _mixed((prefix[stop] - prefix[start]) * inverse[start])
    lower, upper = (np.concatenate([[0], np.cumsum(x)]) for x in (case == 1, case > 1))
    plain = kind == _PLAIN
    title = plain & (case[start] == 2) & (upper[stop] == upper[start + 1]) & (lower[stop] > lower[start + 1])
    short = np.flatnonzero(plain & (stop - start < 12))
    unit = np.zeros(len(kind), bool)
    unit[short] = np.isin(hashes[short], table.units)
    kind[title] = _TITLE
    kind[unit] = _IS_UNIT
    return kind, hashes, title, start, stop


_NEXT_WORD = re.compile(r"(?<=\s)[^\W\d_]")
_tables: list[_Table] = []  # one a process


_PLACEHOLDER = {_NUM: np.uint64(0x6E756D), _IS_UNIT: np.uint64(0x756E6974), _TITLE: np.uint64(0x6E616D65)}


class Tokens:
    """The tokens of one text or of several in a row, with what they can be."""

    def __init__(self, texts: list[str]):
        if not _tables:
            _tables.append(_Table())
        self.text = "\0".join(texts)
        parts, at = [], 0
        while at < len(self.text) or not parts:  # long texts part by part, from one word to another
            found = _NEXT_WORD.search(self.text, at + BLOCK_CHARS)
            upto = found.start() if found else len(self.text)
            kind, hashes, title, start, stop = _read_part(self.text[at:upto], _tables[0])
            parts.append((kind, hashes, title, start + at, stop + at))
            at = upto
        self.kind, self.hashes, self.title, self.start, self.stop = map(np.concatenate, zip(*parts))
        begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.owner = np.searchsorted(begin, self.start, "right") - 1
        self.opens = np.ones(len(self.kind) + 1, bool)  # a text's first token, and the end
        self.opens[1:-1] = np.diff(self.owner) != 0
        self.before = np.concatenate([[_END], self.kind])  # kind of the token before; one more for the end
        self.before[self.opens] = _END

    def word(self, j: int) -> str:
        return self.text[self.start[j]:self.stop[j]].lower()


class Template:
    """The words of texts in a layer: a hash each, whether it is a
    placeholder, and the tokens it stands for."""

    def __init__(self, text: str | Tokens, layer: int = INSIDE):
        self.read = read = Tokens([text]) if isinstance(text, str) else text
        kind, hashes, before = read.kind, read.hashes, read.before[:-1]
        again = np.zeros(len(kind), bool)
        marked = np.full(len(kind), _PLAIN, np.int8)
        if layer != EXACT:
            unit = (kind == _IS_UNIT) & (before == _NUM)
            name = read.title & ~unit  # a unit that follows no number may still be a name ("Day")
            if layer == INSIDE:
                name &= before != _END
            for own, mark in ((kind == _NUM, _NUM), (unit, _IS_UNIT), (name, _TITLE)):
                marked[own] = mark
                hashes = np.where(own, _PLACEHOLDER[mark], hashes)
            again[1:] = name[1:] & name[:-1] & ~read.opens[1:-1]  # names in a row are one
        # signs are words where numbers are
        self._spoken = kind != _END if layer == EXACT else kind > _SIGN
        self.at = np.flatnonzero(self._spoken & ~again)
        self.kind, self.hashes, self.owner = marked[self.at], hashes[self.at], read.owner[self.at]
        self._ends = np.append(self.at[1:], len(kind))

    def __len__(self) -> int:
        return len(self.at)

    def said(self, k: int, n: int) -> list[str]:
        """What words k to k + n stand for, in lower case."""
        return [" ".join(self.read.word(j) for j in range(a, b) if self._spoken[j])
                for a, b in zip(self.at[k:k + n].tolist(), self._ends[k:k + n].tolist())]

    def windows(self, n: int, least_words: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``n`` words and whether it identifies a
        text; with ``whole`` only from one sentence end to another."""
        m = len(self) - n + 1
        if n < 1 or m < 1:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(m, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                out *= _MULTIPLIER
                out += self.hashes[k:k + m]
            out ^= out >> np.uint64(29)
        plain = np.concatenate([[0], np.cumsum(self.kind == _PLAIN)])
        good = (plain[n:] - plain[:-n] >= min(least_words, n)) & (self.owner[:m] == self.owner[n - 1:])
        if whole:
            good &= (self.read.before[self.at[:m]] == _END) & (self.read.before[self._ends[n - 1:]] == _END)
        return out, good


def _benchmark_windows(frames: Iterator[pd.DataFrame], width: int, least_words: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for item, key, text in zip(frame["item_id"], frame["item_key"], frame["__text"]):
            read = Tokens([text])
            for layer in LAYERS:
                t = Template(read, layer)
                n = min(width, len(t))
                h, good = t.windows(n, least_words)
                total = int(good.sum())
                rows += [(item, key, layer, k, int(h[k].astype(np.int64)), total, n, t.said(k, n))
                         for k in np.flatnonzero(good).tolist()]
        yield as_frame(rows, ["item_id", "item_key", "layer", "i_at", "hash", "i_windows", "width", "i_said"])


def _blocks(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in blocks of about BLOCK_CHARS characters."""
    upto = frame["__text"].str.len().cumsum() // BLOCK_CHARS
    for _, rows in frame.groupby(upto.to_numpy(), sort=False):
        yield rows


def _document_windows(frames: Iterator[pd.DataFrame], bitmap, bits: int, widths: list[tuple[int, int]], width: int,
                      least_words: int) -> Iterator[pd.DataFrame]:
    held = np.frombuffer(bitmap.value, np.uint8)
    shift = np.uint64(64 - bits)
    for block in (b for frame in frames for b in _blocks(frame)):
        docs, keys = block["doc_id"].tolist(), block["text_key"].tolist()
        read, rows, layers = Tokens(block["__text"].tolist()), [], {}
        for layer, n in widths:
            if layer not in layers:
                layers = {layer: Template(read, layer)}  # widths are in layer order
            t = layers[layer]
            h, good = t.windows(n, least_words, whole=n < width)
            slot = (h >> shift).astype(np.int64)
            hit = np.flatnonzero(good & ((held[slot >> 3] >> (slot & 7)) & 1).astype(bool))
            owner = t.owner[hit]
            place = hit - np.searchsorted(t.owner, owner)
            rows += [(docs[o], keys[o], layer, p, int(x), n, t.said(k, n))
                     for k, o, p, x in zip(hit.tolist(), owner.tolist(), place.tolist(), h[hit].astype(np.int64).tolist())]
        yield as_frame(rows, ["doc_id", "text_key", "layer", "d_at", "hash", "width", "d_said"])
        release_memory()


def key_windows(items: DataFrame, least_share: float, least_run: int) -> DataFrame:
    """The windows of the items one of which is in every leak, the rarest
    ones, so that a window of many items rarely has to be joined.

    A leak has ``least_share`` of an item's windows, so one of any set that
    leaves fewer of them out; or ``least_run`` words in a row, so all windows
    of an aligned block of about half as many windows.
    """
    shared = items.groupBy("layer", "hash", "width").agg(F.count(F.lit(1)).alias("shared"))
    known = items.join(shared, ["layer", "hash", "width"])
    one = ["item_id", "item_key", "layer", "width"]  # an item's text in a layer: at most its words
    rank = F.row_number().over(Window.partitionBy(*one).orderBy("shared", "i_at"))
    run = F.greatest(F.lit(1), F.lit(least_run) - F.col("width") + 1)
    block = F.floor(F.col("i_at") / F.floor((run + 1) / 2))
    first = F.row_number().over(Window.partitionBy(*one, "__block").orderBy("shared", "i_at"))
    left_out = F.greatest(F.ceil(F.lit(least_share) * F.col("i_windows")) - 1, F.lit(0))
    return (known.withColumn("__block", block).withColumn("__rank", rank).withColumn("__first", first)
            .where((F.col("__rank") <= F.col("i_windows") - left_out) | (F.col("__first") == 1))
            .select("layer", "hash", "width", "item_id", "item_key", "i_at"))


def _met(hits: DataFrame, items: DataFrame, keys: DataFrame) -> DataFrame:
    """All windows that a document and an item have on a diagonal (document
    position minus item position) on which they share a key window."""
    found = hits.join(keys, ["layer", "hash", "width"])
    pair = ["doc_id", "text_key", "item_id", "item_key", "layer", "width"]
    likely = found.select(*pair, (F.col("d_at") - F.col("i_at")).alias("diagonal")).distinct()
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"i.{c}")) for c in ("item_id", "item_key", "layer", "width")]
    wanted = likely.alias("l").join(items.alias("i"), same).select(
        *[f"l.{c}" for c in pair], "diagonal", "i_at", "hash", "i_windows", "i_said",
        (F.col("diagonal") + F.col("i_at")).alias("d_at"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("doc_id", "text_key", "layer", "width", "d_at", "hash")]
    return wanted.alias("w").join(hits.alias("h"), same).select("w.*", "h.d_said")


def _bitmap_bits(windows: int) -> int:
    """1024 bits a window or up to twice that, from 8 KB to 16 MB: below 100 000
    windows a document window hits by chance once in 1000 times at most."""
    return min(MOST_BITS, max(16, (1024 * windows).bit_length()))


def _bitmap(item_windows: DataFrame, bits: int) -> bytes:
    """2^bits bits, one set for each window hash; bytes are or-ed on the
    executors first, so the driver gets a bounded number of them."""
    # the top bits of the unsigned hash
    set_bytes = (item_windows.select(F.shiftrightunsigned("hash", 64 - bits).alias("slot"))
                 .selectExpr("shiftright(slot, 3) AS byte", "shiftleft(1, CAST(slot & 7 AS INT)) AS bit")
                 .groupBy("byte").agg(F.bit_or("bit").alias("bits")))
    out = np.zeros(1 << (bits - 3), np.uint8)
    got = set_bytes.toPandas()
    out[got["byte"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64)
    return out.tobytes()


def _checked(frames: Iterator[pd.DataFrame], least_share: float, least_run: int) -> Iterator[pd.DataFrame]:
    """One row a document, item, layer and diagonal that is a leak."""
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            found = sorted(r.found, key=lambda x: x["i_at"])
            to_doc: dict[str, str] = {}
            to_item: dict[str, str] = {}
            good, changed, last = [], 0, None
            for f in found:
                if f["i_at"] == last:
                    continue  # the same window of a repeated row
                pairs = list(zip(f["i_said"], f["d_said"]))
                if any(to_doc.get(a, b) != b or to_item.get(b, a) != a for a, b in pairs):
                    continue
                for a, b in pairs:
                    to_doc[a], to_item[b] = b, a
                last = f["i_at"]
                good.append(last)
                changed += any(a != b for a, b in pairs)
            at = np.array(good)
            run = max(map(len, np.split(at, np.flatnonzero(np.diff(at) != 1) + 1))) + r.width - 1 if len(at) else 0
            share = len(at) / max(1, r.i_windows)
            if len(at) and (share >= least_share or run >= least_run):
                rows.append((r.doc_id, r.text_key, r.item_id, len(at), share, run, changed > 0))
        yield as_frame(rows, ["doc_id", "text_key", "item_id", "n_windows", "share", "run", "changed"])


# Ids go to Python and back as text: with a null beside them, numbers would
# turn into floats.
ITEMS = "item_id string, item_key long, layer int, i_at int, hash long, i_windows int, width int, i_said array<string>"
LEAKS = "doc_id string, text_key long, item_id string, n_windows int, share double, run int, changed boolean"


def _as_text(column: str):
    return F.col(column).cast("long").cast("string").alias(column)


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, least_share: float = LEAST_SHARE,
          least_run: int = LEAST_RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, share, run, changed): the items
    each document leaks. ``text_key`` is a hash of the text; ``changed``
    marks a question with other numbers or names."""
    spark = docs.sparkSession
    ship(spark)
    texts = benchmark.select(_as_text("item_id"), text_col().alias("__text")).withColumn("item_key", F.xxhash64("__text"))
    items = stage(texts.mapInPandas(lambda it: _benchmark_windows(it, width, least_words), ITEMS), "benchmark")
    # widths 1 to ``width`` of each layer
    counts = items.groupBy("layer", "width").count().collect()
    widths = sorted((r["layer"], r["width"]) for r in counts)
    bits = _bitmap_bits(sum(r["count"] for r in counts))
    bitmap = spark.sparkContext.broadcast(_bitmap(items, bits))
    texts = docs.select(_as_text("doc_id"), text_col().alias("__text"))
    hits = (texts.withColumn("text_key", F.xxhash64("__text"))
            .mapInPandas(lambda it: _document_windows(it, bitmap, bits, widths, width, least_words),
                         "doc_id string, text_key long, layer int, d_at int, hash long, width int, d_said array<string>"))
    hits = stage(hits, "hits")
    met = _met(hits, items, key_windows(items, least_share, least_run))
    groups = (met.groupBy("doc_id", "text_key", "item_id", "item_key", "layer", "diagonal", "width", "i_windows")
              .agg(F.collect_set(F.struct("i_at", "i_said", "d_said")).alias("found")))
    checked = groups.select("doc_id", "text_key", "item_id", "width", "i_windows", "found").mapInPandas(
        lambda it: _checked(it, least_share, least_run), LEAKS)
    known = checked.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "item_id")})
    return known.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("share").alias("share"), F.max("run").alias("run"),
        F.min("changed").alias("changed"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents, all columns, that leak no item."""
    bad = stage(leaks(docs, benchmark, **settings).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(text_col()) == bad["__key"]),
                     "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document that leaks: its items, and the strongest."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share"),
        F.max("run").alias("run"), F.min("changed").alias("changed"))
