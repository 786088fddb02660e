"""The failure ledger over a stream of outcomes.

State per (type, rubric, entry) is four fields, however many outcomes a key has: a batch of a key is folded row by row in
event-time order and never kept. A key has state only while it has failures: a success clears it, and with ``forget`` a timer
clears a key that has had no outcome for so long. Outcomes that come later than the watermark are dropped by Spark; within a
batch they are put in order, across batches they count in arrival order. The batch form (``operators.state.ledger_update``)
sorts everything by event time, so both agree when no outcome is overtaken by one of a later batch.

The stored ledger is a table kept by key (``sources.keyed``): a batch writes the buckets of the keys it touches.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.fixed import QUARANTINE_AT, QUARANTINE_UNTIL
from ..operators.state import LEDGER_SCHEMA, ledger_update
from ..sources.keyed import BUCKETS, KeyedTable

KEYS = ["type", "rubric_version", "entry_id"]
STATE = "attempts int, first_failed_at timestamp, last_failed_at timestamp, error_kind string"
OUTPUT = (
    "type string, rubric_version string, entry_id string, attempt_count int, first_failed_at timestamp, "
    "last_failed_at timestamp, last_error_kind string, next_retry_after timestamp"
)
WAIT_DAYS = {1: 0, 2: 7, 3: 28}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Ledger(StatefulProcessor):
    """Folds the outcomes of a key; ``forget`` is the time without outcomes after which a key's failures are let go."""

    def __init__(self, forget: timedelta | None):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("failures", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts, first, last, kind = self.state.get() if self.state.exists() else (0, None, None, None)
        latest = None
        for batch in rows:
            # a batch is one Arrow slice of the key's new rows
            for row in batch.sort_values(["ts", "event_id"]).itertuples(index=False):
                at = row.ts.to_pydatetime()
                latest = at if latest is None else max(latest, at)
                if row.ok:
                    attempts, first, last, kind = 0, None, None, None
                else:
                    attempts, first, last, kind = attempts + 1, first or at, at, row.error_kind
        if self.forget is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if attempts == 0:
            self.state.clear()
        else:
            self.state.update((attempts, first, last, kind))
            if self.forget is not None:
                self.handle.registerTimer(int((latest + self.forget - datetime(1970, 1, 1)) / timedelta(milliseconds=1)))
        yield self._row(key, attempts, first, last, kind)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield self._row(key, 0, None, None, None)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, attempts: int, first, last, kind) -> pd.DataFrame:
        if attempts >= QUARANTINE_AT:
            retry = pd.Timestamp(QUARANTINE_UNTIL).as_unit("us")
        else:
            retry = None if last is None else pd.Timestamp(last) + pd.Timedelta(days=WAIT_DAYS[attempts])
        out = dict(zip(KEYS, key)) | {
            "attempt_count": attempts, "first_failed_at": first, "last_failed_at": last, "last_error_kind": kind, "next_retry_after": retry,
        }
        return pd.DataFrame({c: pd.Series([v], dtype="object") for c, v in out.items()})


def ledger_stream(outcomes: DataFrame, *, delay: str = "1 day", forget: timedelta | None = None) -> DataFrame:
    """Stream of ledger rows: the current state of every key that a batch touches or forgets.

    ``outcomes`` has the key columns, ok, ts, event_id and error_kind. A cleared key comes out with ``attempt_count`` 0; the
    sink drops it. The session needs the RocksDB state store (``use_state_store``).
    """
    rows = outcomes.withWatermark("ts", delay).select(*KEYS, "ok", "ts", "event_id", "error_kind")
    return rows.groupBy(*KEYS).transformWithStateInPandas(
        Ledger(forget), outputStructType=OUTPUT, outputMode="update", timeMode="None" if forget is None else "EventTime")


def use_state_store(spark: SparkSession) -> SparkSession:
    """Choose the state store that keyed state with timers needs; before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def ledger_table(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> KeyedTable:
    """The stored ledger, one row for each key with open failures."""
    return KeyedTable(spark, folder, LEDGER_SCHEMA, KEYS, buckets)


def upsert_ledger(folder: str, buckets: int = BUCKETS):
    """``foreachBatch`` writer: put a batch of ledger rows into the ledger at ``folder``, without the cleared keys."""

    def write(batch: DataFrame, number: int) -> None:
        put = lambda old, new: old.join(new.select(*KEYS), KEYS, "left_anti").unionByName(new.filter(F.col("attempt_count") > 0))
        ledger_table(batch.sparkSession, folder, buckets).change(batch, put, writer="upsert", name=f"batch-{number}")

    return write


def merge_outcomes(folder: str, buckets: int = BUCKETS):
    """``foreachBatch`` writer that works on the outcomes themselves, with the batch form of the ledger.

    The choice where one key may bring a great part of a batch: counts are aggregated before the
    shuffle and hot keys are split, which keyed streaming state cannot do.
    """

    def write(batch: DataFrame, number: int) -> None:
        ledger_table(batch.sparkSession, folder, buckets).change(batch, ledger_update, writer="merge", name=f"batch-{number}")

    return write
