"""Register of queries: name, Spark form, and the same query as SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder as attributes, read only when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def scratch(t: Tables, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None):
    """Decorator: register ``fn(tables)`` under ``name`` with its SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(tune(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
