"""Incremental state as tables: failure ledger, checkpoint, result cache, frontier, snapshots.

A state table is a parquet directory per version and a log that names the versions in turn.
A run writes a new version and then its name into the log, so a lost run changes nothing
and no reader ever finds the table gone. Tables that change by key are kept in buckets instead
(``sources.keyed``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixed import QUARANTINE_AT, QUARANTINE_UNTIL
from ..functions.values import col
from ..sources import versions
from ..sources.keyed import KeyedTable
from ..sources.tables import empty_frame
from ..sources.versions import StateConflict
from .relational import first_per_key, skew_join, with_position

LEDGER_KEYS = ("type", "rubric_version", "entry_id")


# --- failure ledger ---------------------------------------------------------------------------


def next_retry(attempts: Column | str, failed_at: Column | str) -> Column:
    """At once after the first failure, 7 days after the second, 28 after the third, then never."""
    n, at = col(attempts), col(failed_at).cast("timestamp")
    return (
        F.when(n >= QUARANTINE_AT, F.to_timestamp(F.lit(QUARANTINE_UNTIL)))
        .when(n == 3, at + F.expr("interval 28 days"))
        .when(n == 2, at + F.expr("interval 7 days"))
        .otherwise(at)
    )


def open_failures(outcomes: DataFrame, keys: Sequence[str], *, ok: str = "ok", at: str = "ts", tie: str = "event_id") -> DataFrame:
    """Failures since the last success of their key.

    The last success per key is a small aggregate; hot keys are salted for the join back.
    """
    when = F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"))
    last = outcomes.filter(F.col(ok)).groupBy(*keys).agg(F.max(when).alias("_last_ok"))
    failed = outcomes.filter(~F.col(ok))
    joined = skew_join(failed, last, keys, "left", spread=[tie])
    return joined.filter(F.col("_last_ok").isNull() | (when > F.col("_last_ok"))).drop("_last_ok")


def ledger_update(
    ledger: DataFrame, outcomes: DataFrame, keys: Sequence[str] = LEDGER_KEYS, *, ok: str = "ok", at: str = "ts",
    tie: str = "event_id", kind: str = "error_kind",
) -> DataFrame:
    """Ledger after a batch of outcomes: a success clears the key, every failure after it counts one attempt."""
    cleared = outcomes.filter(F.col(ok)).select(*keys).distinct()
    order = F.struct(at, tie)
    fresh = open_failures(outcomes, keys, ok=ok, at=at, tie=tie).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"), F.max(at).alias("_last"), F.max_by(kind, order).alias("_kind")
    )
    old = ledger.join(cleared, list(keys), "left_anti")
    both = old.join(fresh, list(keys), "full_outer")
    n = F.coalesce("attempt_count", F.lit(0)) + F.coalesce("_n", F.lit(0))
    return both.select(
        *keys,
        n.cast("int").alias("attempt_count"),
        F.coalesce("first_failed_at", "_first").alias("first_failed_at"),
        F.coalesce("_last", "last_failed_at").alias("last_failed_at"),
        F.coalesce("_kind", "last_error_kind").alias("last_error_kind"),
    ).withColumn("next_retry_after", next_retry("attempt_count", "last_failed_at"))


LEDGER_SCHEMA = (
    "type string, rubric_version string, entry_id string, attempt_count int, first_failed_at timestamp, "
    "last_failed_at timestamp, last_error_kind string, next_retry_after timestamp"
)


def is_quarantined(attempts: Column | str = "attempt_count") -> Column:
    return F.coalesce(col(attempts) >= QUARANTINE_AT, F.lit(False))


def retry_allowed(as_of: str, attempts: Column | str = "attempt_count", retry_after: Column | str = "next_retry_after") -> Column:
    """False in quarantine and before the retry time; an unreadable time allows the retry."""
    at = col(retry_after).try_cast("timestamp")
    return ~is_quarantined(attempts) & (at.isNull() | (at <= F.to_timestamp(F.lit(as_of))))


def current_version(state: DataFrame, versions: DataFrame, on: Sequence[str] = ("type", "rubric_version")) -> DataFrame:
    """Only state of the current rubric of each type; other types are not touched."""
    return state.join(versions.select(*on).distinct(), list(on), "left_semi")


# --- checkpoint -------------------------------------------------------------------------------


def checkpoint_state(all_ids: DataFrame, completed: DataFrame, quarantined: DataFrame, key: str = "entry_id") -> DataFrame:
    """(key, state) of the current ids: completed, quarantined or remaining."""
    ids = all_ids.select(key).distinct()
    mark = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    joined = ids.join(mark(completed, "_c"), key, "left").join(mark(quarantined, "_q"), key, "left")
    state = F.when(F.col("_c"), "completed").when(F.col("_q"), "quarantined").otherwise("remaining")
    return joined.select(key, state.alias("state"))


def mark_completed(completed: DataFrame, done: DataFrame, keys: Sequence[str] = LEDGER_KEYS) -> DataFrame:
    """Add finished keys; marking one twice changes nothing."""
    return completed.select(*keys).unionByName(done.select(*keys)).dropDuplicates(list(keys))


# --- cache ------------------------------------------------------------------------------------


def cache_upsert(cache: DataFrame, rows: DataFrame, *, key: str = "cache_key", at: str = "evaluated_at", tie: str | None = None) -> DataFrame:
    """Newest row per key of the stored and the new rows."""
    order = [F.desc(at), *([F.desc(tie)] if tie else [])]
    return first_per_key(cache.unionByName(rows), [key], order)


def cache_purge(cache: DataFrame, as_of: str, expires: str = "expires_at") -> DataFrame:
    return cache.filter(F.col(expires).isNull() | (F.col(expires) >= F.to_timestamp(F.lit(as_of))))


# --- frontier and stop rule ----------------------------------------------------------------------


def frontier(pending: DataFrame, found: DataFrame, processed: DataFrame, *, link: str = "link", order: Sequence[str] = ("page", "pos")) -> DataFrame:
    """(link, order): links still to visit, each at the first place it was seen."""
    place = F.struct(*order)
    rows = pending.select(link, *order).unionByName(found.select(link, *order))
    firsts = rows.groupBy(link).agg(F.min(place).alias("_at")).select(link, "_at.*")
    return firsts.join(processed.select(link).distinct(), link, "left_anti")


def cut_after_known(feed: DataFrame, known: Column, run: int = 10, *, pos: str = "pos", block: int = 10_000) -> DataFrame:
    """New rows of an ordered feed before ``run`` known rows in a row.

    ``pos`` is dense (see ``with_position``). Each block of positions also gets the ``run - 1``
    rows before it, so blocks are looked at independently instead of in one long window.
    """
    from pyspark.sql import Window

    p = F.col(pos)
    marked = feed.withColumn("_known", known.cast("int"))
    blocks = F.array_distinct(F.array(F.floor(p / block), F.floor((p + (run - 1)) / block)))
    spread = marked.select(pos, "_known", F.explode(blocks).alias("_block"))
    w = Window.partitionBy("_block").orderBy(pos).rowsBetween(-(run - 1), 0)
    ends = spread.withColumn("_sum", F.sum("_known").over(w)).filter(F.col("_sum") == run)
    stop = ends.agg(F.min(pos).alias("_stop")).scalar()
    return marked.filter((F.col("_known") == 0) & (stop.isNull() | (p < stop))).drop("_known")


def numbered_feed(feed: DataFrame, order: Sequence[Column]) -> DataFrame:
    return with_position(feed, order)


# --- change gate and batches --------------------------------------------------------------------


def change_gate(groups: DataFrame, stored: DataFrame, key: str, stamp: str) -> DataFrame:
    """(key, path): reuse where the stored time stamp is the same, else rescan."""
    old = stored.select(key, F.col(stamp).alias("_old"))
    joined = groups.join(old, key, "left")
    same = F.coalesce(F.col("_old") == F.col(stamp), F.lit(False))
    return joined.withColumn("path", F.when(same, "reuse").otherwise("rescan")).drop("_old")


def batch_log(items: DataFrame, returned: DataFrame, order: Sequence[Column], *, key: str = "entry_id", size: int = 50) -> DataFrame:
    """(batch, n, succeeded, failed) of items worked on in order in batches of ``size``."""
    ids = returned.select(key).distinct().withColumn("_ok", F.lit(1))
    placed = with_position(items, order).withColumn("batch", F.floor(F.col("pos") / size))
    joined = placed.join(ids, key, "left")
    return joined.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.count("_ok").alias("succeeded"), (F.count(F.lit(1)) - F.count("_ok")).alias("failed")
    )


# --- versioned state tables ------------------------------------------------------------------------


def current_state(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """(number, name) of the current version; (0, None) before the first write."""
    number, said = versions.latest(spark, folder)
    return number, said.get("version")


def read_state(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Current version of a state table; empty before the first write."""
    _, version = current_state(spark, folder)
    if version is None:
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{version}")


def write_state(df: DataFrame, folder: str, version: str, after: int | None = None) -> None:
    """Write a version, then name it in the log. Older versions stay readable.

    Data of the same version left by a lost run is replaced; writing the current version again changes nothing. ``after``
    is the number of the state that ``df`` was made from: if another run has named a version since, this one is not named
    (``StateConflict``). Without it the version replaces whatever is there.
    """
    spark, base = df.sparkSession, folder.rstrip("/")
    if current_state(spark, folder)[1] == version:
        return
    df.write.mode("overwrite").parquet(f"{base}/{version}")
    point_to(spark, folder, version, after)


def update_state(spark: SparkSession, folder: str, version: str, schema: str, fn: Callable[[DataFrame], DataFrame], tries: int = 8) -> None:
    """Write ``fn(current rows)`` as the next version; asked again where another run was faster."""
    for i in range(tries):
        number, current = current_state(spark, folder)
        if current == version:
            return
        try:
            return write_state(fn(read_state(spark, folder, schema)), folder, version, after=number)
        except StateConflict:
            if i + 1 == tries:
                raise


def point_to(spark: SparkSession, folder: str, version: str, after: int | None = None) -> None:
    """Name a version in the log, which makes it the current one; one small file, written after the data.

    Of two runs that name a version at the same time both are in the log, unless one says ``after`` which number it follows.
    """
    while True:
        number = current_state(spark, folder)[0] if after is None else after
        if versions.commit(spark, folder, number + 1, {"version": version}):
            return
        if after is not None:
            raise StateConflict(f"{folder} has a version after {after} already")


def drop_versions(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete the data of all but the last ``keep`` versions; their names, oldest first. The log stays."""
    if keep < 1:
        raise ValueError("the current version has to stay")
    numbers = versions.entries(spark, folder)
    names = list(dict.fromkeys(versions.entry(spark, folder, n)["version"] for n in reversed(numbers)))
    dropped = []
    for name in reversed(names[keep:]):
        fs, path = versions._hadoop(spark, f"{folder.rstrip('/')}/{name}")
        if fs.delete(path, True):
            dropped.append(name)
    return dropped


def rotate_snapshot(new: DataFrame, folder: str, version: str, schema: str, fallback: DataFrame | None = None) -> DataFrame:
    """The baseline to compare with (the stored one, else ``fallback``); then store the new one."""
    spark = new.sparkSession
    _, current = current_state(spark, folder)
    baseline = fallback if current is None and fallback is not None else read_state(spark, folder, schema)
    write_state(new, folder, version)
    return baseline


def rotate_keyed(new: DataFrame, table: KeyedTable, version: str, fallback: DataFrame | None = None) -> DataFrame:
    """As ``rotate_snapshot`` for a snapshot kept by key: the baseline to compare with, after the new one is stored.

    Baseline and ``table.read()`` lie in the same buckets, so they are compared without a shuffle.
    """
    before = table.head()
    table.replace(new, writer="rotate", name=version)
    return fallback if before.number == 0 and fallback is not None else table.read(before)
