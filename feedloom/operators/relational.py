"""Join, top-k and position helpers that keep one hot key from landing in one task."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut

# A key is hot from this many rows on, and is split into pieces of about this many rows. Every such key is split; there
# are at most (number of rows) / HOT_ROWS of them, a million for 10 ** 12 rows, so their list stays small.
HOT_ROWS = 1_000_000
NULL_PIECES = 1 << 20
_MAKES_ROWS = re.compile(r"\b(Generate|MapIn|FlatMap|Expand|LogicalRDD)")


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """(keys, _pieces): all keys with ``min_rows`` rows or more."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hot_n")).filter(F.col("_hot_n") >= min_rows)
    return counts.select(*keys, F.ceil(F.col("_hot_n") / min_rows).cast("int").alias("_pieces"))


def _bytes(size: str) -> int:
    """Bytes of a size setting such as 10485760b, 64m or -1."""
    units = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    s = size.strip().lower().removesuffix("b") or "0"
    return int(s[:-1]) * units[s[-1]] if s[-1] in units else int(s)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is under the session's broadcast limit and can be trusted.

    Behind an explode or a Python function the estimate leaves out how many rows are made, so such a frame never counts
    as small; elsewhere no operator makes more than the estimate says.
    """
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        size = int(plan.stats().sizeInBytes().toString())
    except AttributeError:  # a remote session does not tell
        return False
    return size <= limit and not _MAKES_ROWS.search(plan.toString())


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    spread: Sequence[str] | None = None,
    min_rows: int = HOT_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join many ``left`` rows to few ``right`` rows per key; hot left keys are salted.

    A ``right`` whose checked size is under the broadcast limit needs no shuffle and no salt;
    Spark then broadcasts it by itself. Salting is for the others, and needed since ``right`` is
    often an aggregate on the join key, where the run-time skew split does not reach. The salt is a hash of ``spread`` (a unique
    column, by default all left columns), so a retried task gives the same salt.
    In a chain of joins pass the first frame as ``hot_from``: key counts then read only its
    key columns and not the joins made so far.
    """
    keys = list(keys)
    if fits_broadcast(right):
        return left.join(right, keys, how)
    hot = F.broadcast(hot_keys(left if hot_from is None else hot_from, keys, min_rows))
    spread = list(spread or left.columns)
    no_key = F.lit(False)  # such rows match nothing; they are spread as well
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    pieces = F.coalesce("_pieces", F.when(no_key, NULL_PIECES), F.lit(1))
    lhs = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), pieces).cast("int")).drop("_pieces")
    every_piece = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    rhs = right.join(hot, keys, "left").withColumn("_salt", every_piece).drop("_pieces")
    return lhs.join(rhs, [*keys, "_salt"], how).drop("_salt")


def exploded_keys(df: DataFrame, keys: Mapping[str, str], keep: Sequence[str | Column]) -> DataFrame:
    """(keep, _kind, _key): a row for each key that a row has; ``keys`` maps a kind to its column. Null keys are left out.

    So "the same address or the same id" is one join and one shuffle of the rows, not one for each key.
    """
    entries = F.array(*[F.struct(F.lit(kind).alias("_kind"), F.col(c).cast("string").alias("_key")) for kind, c in keys.items()])
    rows = df.select(*keep, F.explode(F.filter(entries, lambda e: e["_key"].isNotNull())).alias("_e"))
    return rows.select(*rows.columns[:-1], "_e.*")


def lookup_join(left: DataFrame, table: DataFrame, keys: Sequence[str], *, min_rows: int = HOT_ROWS) -> DataFrame:
    """Left join to a table that lies in buckets of the keys, with one row for each key: only ``left`` is shuffled.

    A salt would move the table as well, so hot keys of ``left`` go another way: their rows of the table, one for each hot key,
    are broadcast. Rows without a key meet nothing and are not moved.
    """
    keys = list(keys)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    named, lost = left.filter(~no_key), left.filter(no_key)
    hot = cut(hot_keys(named, keys, min_rows).select(*keys))
    if hot.isEmpty():
        met = named.join(table, keys, "left")
    else:
        hot = F.broadcast(hot)
        cold = named.join(hot, keys, "left_anti").join(table, keys, "left")
        met = cold.unionByName(named.join(hot, keys, "left_semi").join(F.broadcast(table.join(hot, keys, "left_semi")), keys, "left"))
    return met.unionByName(lost, allowMissingColumns=True)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn") -> DataFrame:
    """First ``k`` rows of each key. Spark keeps at most ``k`` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1, "_rn").drop("_rn")


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key, null keys left out; partial counts are made before the shuffle."""
    return df.filter(F.expr(" and ".join(f"`{k}` is not null" for k in keys))).groupBy(*keys).agg(
        F.count(F.lit(1)).alias(name)
    )


def with_key_count(
    df: DataFrame, keys: Sequence[str], name: str = "n", *, spread: Sequence[str] | None = None, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the number of rows with the same key (0 for a null key); no whole-group window."""
    joined = skew_join(df, key_counts(df, keys, name), keys, "left", spread=spread, min_rows=min_rows)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str = "before") -> DataFrame:
    """Sum of ``value`` over the earlier rows of the key, also for a key that fills many partitions.

    Rows are range-partitioned by key and order, so a huge key is spread out. Each partition
    sums its own rows and adds what earlier partitions hold of the key.
    """
    by = [*keys, *order]
    laid = cut(
        df.withColumn("_v", value).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner = before(Window.partitionBy("_part", *keys).orderBy(*order))
    outer = before(Window.partitionBy(*keys).orderBy("_part"))  # at most one row per partition
    parts = laid.groupBy("_part", *keys).agg(F.sum("_v").alias("_s"))
    carry = parts.select("_part", *keys, F.coalesce(F.sum("_s").over(outer), F.lit(0)).alias("_carry"))
    own = laid.withColumn(name, F.coalesce(F.sum("_v").over(inner), F.lit(0)))
    return own.join(carry, ["_part", *keys]).withColumn(name, F.col(name) + F.col("_carry")).drop("_part", "_v", "_carry")


def with_position(df: DataFrame, order: Sequence[Column], name: str = "pos", partitions: int | None = None) -> DataFrame:
    """Dense global position (from 0) in a total order, without a one-task window.

    Rows are range-partitioned and sorted, the layout is written once, and each
    partition is shifted by the sizes of those before it (one small row per partition).
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    laid = cut(ranged.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part, inner = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    laid = laid.withColumn("_part", part).withColumn("_inner", inner)
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        laid.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + F.col("_inner"))
        .drop("_mid", "_part", "_inner", "_start")
    )
