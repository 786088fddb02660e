"""Keyed set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def added(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.join(old.select(*keys).distinct(), list(keys), "left_anti")


def removed(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return added(old, new, keys)


def common(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.join(old.select(*keys).distinct(), list(keys), "left_semi")


def set_algebra(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, class): added, removed or common, in one pass over both sides."""
    side = lambda df, n: df.select(*keys).distinct().withColumn("_s", F.lit(n))
    both = side(new, 1).unionByName(side(old, 2)).groupBy(*keys).agg(F.sum("_s").alias("_s"))
    return both.withColumn(
        "class", F.when(F.col("_s") == 1, "added").when(F.col("_s") == 2, "removed").otherwise("common")
    ).drop("_s")


def remaining(all_: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys that are not done; done keys that no longer exist do not matter."""
    return all_.select(*keys).distinct().join(done.select(*keys).distinct(), list(keys), "left_anti")
