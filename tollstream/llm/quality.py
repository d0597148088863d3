"""Text quality: a regularised quadratic discriminant over text statistics.

Each text gives a vector of statistics (shares of character kinds, lengths,
repetition), transformed by log or logit so that classes look normal. Per
class: mean, covariance shrunk to the pooled covariance and then to its
diagonal, and the covariance's Cholesky factor, computed once. A text's score
is the posterior from the difference of the two log densities (Mahalanobis
lengths by the inverse of the factor, log determinants, priors).

The model is fitted on at most ``most_rows`` labelled rows (those with the
smallest hash of the id); what reaches the driver is one vector a row.

Defined cases: null or empty texts have a vector too and get a score; rows
labelled null are not learned from; without two rows of each class the score
is the share of label 1 (0.5 without labels); repeated rows get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import release_memory, ship, table, text_col, training_fold

MOST_ROWS = 20_000

_KIND = np.zeros(256, np.int64)  # byte -> kind
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             b" ", b"\n", b".", b",", b"!?", b"|<>{}[]()=/\\:;\"'_-@", b"*#$%&~^+`"), start=1):
    _KIND[list(_chars)] = _k
KINDS = 11


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, linear in its length."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, weights=by_byte, minlength=KINDS)
    words = text.split()
    n, w = max(1, len(raw)), max(1, len(words))
    seen = Counter(words)
    lines = text.split("\n")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    endings = sum(1 for x in lines if x.rstrip().endswith((".", "!", "?", ":")))

    def logit(part: float, of: float) -> float:
        return float(np.log((part + 0.5) / (of - part + 0.5)))

    top = max(seen.values()) if seen else 0
    repeated_lines = len(lines) - len(set(lines))
    triples = len(set(zip(words, words[1:], words[2:])))
    return [float(np.log1p(len(words))),
            logit(kinds[2], n), logit(kinds[3], n), logit(kinds[8], w) if kinds[8] <= w else 5.0,
            logit(kinds[9], n), logit(kinds[10], n), logit(kinds[5], n), logit(kinds[6], n), logit(kinds[7], n),
            logit(kinds[0], n), float(np.log1p(sizes.mean())), float(np.log1p(sizes.std())),
            logit(len(seen), w), logit(top, w), logit(triples, max(1, len(words) - 2)),
            logit(repeated_lines, len(lines)), logit(endings, len(lines))]


WIDTH = 17


@dataclass
class Discriminant:
    """Class priors, means and Cholesky factors; ``prior`` alone if a class
    is missing."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: np.ndarray | None = None
    factors: np.ndarray | None = None  # lower triangular, one a class

    @cached_property
    def inverses(self) -> list[np.ndarray]:
        """Of the factors, lower triangular too: solved once, not a batch."""
        return [np.tril(np.linalg.solve(low, np.eye(len(low)))) for low in self.factors]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None or not len(x):
            return np.full(len(x), self.prior)
        z = (x - self.center) / self.scale
        density = []
        for mean, low, inverse in zip(self.means, self.factors, self.inverses):
            y = inverse @ (z - mean).T
            density.append(-0.5 * (y ** 2).sum(axis=0) - np.log(np.diag(low)).sum())
        gap = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def fit_discriminant(x: np.ndarray, label: np.ndarray, to_pooled: float = 0.2, to_diagonal: float = 0.05) -> Discriminant:
    """``to_pooled`` and ``to_diagonal`` are the shrinkage weights."""
    prior = float(label.mean()) if len(label) else 0.5
    if min((label == 0).sum(), (label == 1).sum()) < 2:
        return Discriminant(prior)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    groups = [z[label == k] for k in (0, 1)]
    means = np.stack([g.mean(axis=0) for g in groups])
    own = [np.cov(g, rowvar=False) for g in groups]
    pooled = sum(c * len(g) for c, g in zip(own, groups)) / len(z)
    factors = []
    for c in own:
        c = (1 - to_pooled) * c + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + 1e-3 * np.eye(c.shape[0])
        factors.append(np.linalg.cholesky(c))
    return Discriminant(prior, center, scale, means, np.stack(factors))


def _vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"label": frame["label"], "x": [statistics(t) for t in frame["__text"]]})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int) -> DataFrame:
    """(__text, label) of at most ``most_rows`` documents of the training
    fold: those whose ids hash lowest, and of rows with equal ids the text that
    hashes lowest. Bounded, so it may be broadcast."""
    chosen = (labels.where(training_fold(F.col("doc_id")) & F.col(label).isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows))
    rows = docs.select("doc_id", text_col().alias("__text")).join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.xxhash64("__text").alias("hash"), "__text")).alias("first")
    return rows.groupBy("doc_id", "label").agg(first).select(F.col("first")["__text"].alias("__text"), "label")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS) -> Discriminant:
    ship(docs.sparkSession)
    rows = (labelled_sample(docs, labels, label, most_rows)
            .mapInPandas(_vectors, "label double, x array<double>").toPandas())
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), WIDTH)
    order = np.lexsort((*x.T, rows["label"].to_numpy()))  # task order must not show in the sums
    return fit_discriminant(x[order], rows["label"].to_numpy()[order])


def score_of(spark: SparkSession, model: Discriminant, text: Column) -> Column:
    """The score of a text column's values."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), WIDTH)
        release_memory()
        return pd.Series(shared.value.score(x))

    return of(text)


def score(docs: DataFrame, model: Discriminant, column: str = "score") -> DataFrame:
    """The documents, all columns, and the score of their text in ``column``
    (replaced if there is one)."""
    return docs.withColumn(column, score_of(docs.sparkSession, model, text_col()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: predicted 1 from a score of 0.3 on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(~training_fold(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
