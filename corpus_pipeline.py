"""From raw documents to packed training sequences: five stages, each over all that its predecessor kept.

A null text is an empty one; it fails the quality rules. A row with a null id is judged, cut from no one's passages, cleaned and
packed like others. Rows that repeat an id are rows of their own until near duplicates go, where one row of an id stays. Other
columns, whatever their names, go through all stages but the last. An empty table gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm import packing, pii, quality, repeats, simhash
from feedloom.session import cut, tune


def _with_text(docs: DataFrame, done: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs``, the text and its length taken from the column ``text`` of ``done``."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weighed rules find bad."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words and more that an earlier document has; the rest stays as it is, white space and lines too."""
    done = repeats.remove_repeats(docs, rest=True)
    return _with_text(docs, done.withColumn("_new", F.when(F.col("n_removed") > 0, F.col("rest")).otherwise(F.col("text"))), "_new")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the terms that give it away."""
    return _with_text(docs, pii.sanitise(docs), "clean")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every text in bins, with its words; no bin holds two documents of one source or two copies."""
    return packing.pack(docs, words=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

# Expectation-maximisation, components and best fit are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, the result of each cut off from the plan before."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(tune(spark), docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
