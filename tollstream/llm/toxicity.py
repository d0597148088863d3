"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps look-alike letters of other scripts to Latin ones, full-width
forms to plain ones, and digits or signs that stand for letters inside a word
("1d10t") to those letters. The lexicon holds whole words and word beginnings
with a weight each, the log ratio of their document shares in the two
classes; it is learned by counting, for each entry, the training documents of
either class that have it. A hit inside an exception phrase does not count.
The score is a logistic function of the hits' weight, of the same normalised
by the text's length, and of the share of words hit.

Counting runs over at most ``most_rows`` labelled documents (lowest hashes of
the id); the lexicon has at most ``most_entries`` entries, so the automaton
every task builds has a bounded size. Scoring goes over whole texts, in one
pass without a shuffle.

Defined cases: null or empty texts have no hits and get the score of a text
without hits; without training rows of both classes the lexicon is empty and
the score is the share of label 1 (0.5 without labels); repeated rows get
equal scores.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import labelled_sample
from .shared import frame as as_frame, ship, table, text_col, training_fold

MOST_ROWS = 20_000
MOST_ENTRIES = 5_000
SHORTEST, LONGEST = 3, 10  # of word beginnings, in characters

# Letters that look like Latin ones (Cyrillic, Greek).
LOOKALIKES = dict(zip("авекмнорстухіјѕԁαβεικνορτυχ", "abekmhopctyxijsdabeikvoptux"))
# Digits and signs that stand for letters inside a word.
INSTEAD = dict(zip("013457@$!", "oieastasi"))

_FOLD = str.maketrans({**LOOKALIKES, **{chr(c): chr(c - 0xFEE0).lower() for c in range(0xFF01, 0xFF5F)},
                       "​": "", "‌": "", "‍": "", "­": ""})
_INSIDE = re.compile(r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<![^\W_])[013457@$]+(?=[^\W\d_]{2})")
_SIGNS = str.maketrans(INSTEAD)
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, look-alikes to Latin, stand-in digits and signs to letters."""
    text = text.lower().translate(_FOLD)
    for _ in range(2):  # a letter found in one step may border the next sign
        text = _INSIDE.sub(lambda m: m[0].translate(_SIGNS), text)
    return text


def _entries(words: set[str]) -> set[str]:
    """Candidate entries of a text: its words ("w|") and word beginnings."""
    out = {w + "|" for w in words if len(w) >= SHORTEST}
    for w in words:
        out.update(w[:k] for k in range(SHORTEST, min(len(w) - 1, LONGEST) + 1))
    return out


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for text, label in zip(frame["__text"], frame["label"]):
            for e in _entries(set(_WORD.findall(fold(text)))):
                seen[e][int(label > 0)] += 1
        yield as_frame([(e, *n) for e, n in seen.items()], ["entry", "clean", "toxic"])


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the logistic weights."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    logistic: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    _machine: object = None

    def __getstate__(self):
        return {**self.__dict__, "_machine": None}

    def machine(self):
        """The automaton, built once a process: entries begin at a space."""
        if self._machine is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for e, w in self.weights.items():
                found.add_word(" " + e.replace("|", " "), (len(e), w))
            for e in self.exceptions:
                found.add_word(f" {e} ", (len(e) + 1, None))
            found.make_automaton()
            self._machine = found
        return self._machine

    def features(self, text: str) -> list[float]:
        """Weight of the hits, the same per 100 words, share of words hit (logs)."""
        words = _WORD.findall(fold(text))
        if not words or not (self.weights or self.exceptions):
            return [0.0, 0.0, 0.0]
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, w) in self.machine().iter(f" {' '.join(words)} "):
            at = end - size
            if w is None:
                excused.append((at, end))
            elif w > best.get(at, 0.0):
                best[at] = w  # of the entries that begin at a word, the strongest
        if excused:  # hits inside any phrase: by the furthest end of the phrases that begin before
            excused.sort()
            begins, reach = [a for a, _ in excused], list(accumulate((b for _, b in excused), max))
            best = {at: w for at, w in best.items()
                    if not ((k := bisect_right(begins, at)) and at < reach[k - 1])}
        total = sum(best.values())
        return [float(np.log1p(total)), float(np.log1p(100 * total / len(words))),
                float(np.log1p(100 * len(best) / len(words)))]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.logistic[0] + x @ np.array(self.logistic[1:])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def choose_entries(counts: pd.DataFrame, toxic: int, clean: int, least_share: float, least_weight: float,
                   most_entries: int) -> dict[str, float]:
    """Entries with their log ratios. A word beginning is left out where a
    shorter entry says as much, or where it mostly occurs as one whole word
    that is an entry itself."""
    c = counts[counts["toxic"] >= max(3, least_share * toxic)].copy()
    c["weight"] = np.log((c["toxic"] + 0.5) / (toxic + 1)) - np.log((c["clean"] + 0.5) / (clean + 1))
    c = c[c["weight"] >= least_weight].sort_values(["toxic", "weight", "entry"], ascending=[False, False, True])
    c = c.head(20 * most_entries)
    stats = {e: (t, w) for e, t, w in zip(c["entry"], c["toxic"], c["weight"])}
    whole: dict[str, int] = defaultdict(int)
    for e, (t, _) in stats.items():
        if e.endswith("|"):
            for k in range(SHORTEST, len(e)):
                whole[e[:k]] = max(whole[e[:k]], t)
    kept: dict[str, float] = {}
    for e in sorted(stats, key=lambda e: (e.endswith("|"), len(e), e)):
        t, w = stats[e]
        stem = e.rstrip("|")
        if not e.endswith("|") and whole[e] >= 0.8 * t:
            continue
        shorter = [kept[stem[:k]] for k in range(SHORTEST, len(stem) + 1) if stem[:k] in kept]
        if shorter and max(shorter) >= w - 0.3:
            continue
        kept[e] = float(w)
    best = sorted(kept, key=lambda e: (-stats[e][0] * kept[e], e))[:most_entries]
    return {e: kept[e] for e in best}


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    ridge = penalty * np.eye(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", exceptions: tuple[str, ...] = (),
        most_rows: int = MOST_ROWS, most_entries: int = MOST_ENTRIES, least_share: float = 0.004,
        least_weight: float = 2.5) -> Lexicon:
    """The lexicon and its logistic weights. ``exceptions``: phrases of
    lower-case words in which no hit counts; phrases of a hit and the word
    before or after it that occur in clean training documents but in no
    toxic one join them."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, most_rows)
    n = sample.agg(F.sum((F.col("label") > 0).cast("int")), F.sum((F.col("label") <= 0).cast("int"))).first()
    toxic, clean = (n[0] or 0), (n[1] or 0)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.5
        edge = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return Lexicon(exceptions=exceptions, logistic=(edge, 0.0, 0.0, 0.0))
    counts = (sample.mapInPandas(_counted, "entry string, clean long, toxic long")
              .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .where(F.col("toxic") >= max(3, least_share * toxic))
              .where((F.col("toxic") + 0.5) / (toxic + 1) >= np.exp(least_weight) * (F.col("clean") + 0.5) / (clean + 1))
              .orderBy(F.desc("toxic"), "entry").limit(20 * most_entries).toPandas())
    found = Lexicon(choose_entries(counts, toxic, clean, least_share, least_weight, most_entries), exceptions)

    def context(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, y in zip(frame["__text"], frame["label"]):
                w = _WORD.findall(fold(text))
                hit = [x + "|" in found.weights or any(x[:k] in found.weights for k in range(SHORTEST, LONGEST + 1))
                       for x in w]
                rows += [(" ".join(w[a:a + 2]), int(y > 0)) for a in
                         {k for i, h in enumerate(hit) if h for k in (i - 1, i) if 0 <= k < len(w) - 1}]
            yield as_frame(rows, ["phrase", "toxic"])

    excused = (sample.mapInPandas(context, "phrase string, toxic int").groupBy("phrase")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
               .where("toxic = 0 and n >= 3").orderBy(F.desc("n"), "phrase").limit(most_entries))
    found.exceptions = tuple(dict.fromkeys([*exceptions, *[r["phrase"] for r in excused.collect()]]))

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "x": [found.features(t) for t in frame["__text"]]})

    rows = sample.mapInPandas(measured, "label double, x array<double>").toPandas()
    x, y = np.array(rows["x"].tolist(), dtype=float), rows["label"].to_numpy()
    order = np.lexsort((*x.T, y))
    found.logistic = fit_logistic(x[order], y[order])
    return found


def score(docs: DataFrame, lexicon: Lexicon, column: str = "score") -> DataFrame:
    """The documents, all columns, and the score of their text; a column of
    the name ``column`` is replaced."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series(own.score(np.array([own.features(t) for t in texts], dtype=float).reshape(-1, 3)))

    return docs.withColumn(column, of(text_col()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: predicted 1 from a score of 0.5 on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, lexicon).select(
        "doc_id", F.coalesce(~training_fold(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
