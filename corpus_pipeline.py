"""A training corpus from ``documents``: five stages over the text operators.

Each stage takes (spark, docs, sf_dir), works on all documents its
predecessor kept, and returns a DataFrame that is written as Parquet and read
again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstream.llm import decontaminate, packing, pii, quality, simhash
from tollstream.llm.shared import stage, table, text_col
from tollstream.llm.tokens import tokenizer_path

QUALITY_FROM = 0.3
SIMHASH_WORDS, SIMHASH_BITS = 3, 2


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least QUALITY_FROM."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_of(spark, model, text_col()) >= QUALITY_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id."""
    return simhash.keep_first(docs, SIMHASH_WORDS, SIMHASH_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; n_chars is the new text's."""
    out = pii.replace(docs, pii.KEY, counted=None)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in training sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", surrogates),
    ("packing", packed),
]

# SimHash components, the discriminant and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
