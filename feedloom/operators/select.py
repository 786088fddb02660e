"""Rankings, quotas, layered and greedy picks, work queues."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.scores import DAY_MICROS, as_of_column
from ..functions.values import first_rule
from .relational import first_per_key, top_per_key, with_position


def catalog_order(score: str = "final_score", health: str = "health_mean", stars: str = "stars", order: str = "_ord") -> list[Column]:
    """Best score, then health, then stars (unknown last), then input order."""
    zero = F.lit(0.0)
    return [
        F.coalesce(F.col(score), zero).desc(),
        F.coalesce(F.col(health), zero).desc(),
        F.col(stars).desc_nulls_last(),
        F.col(order).asc(),
    ]


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Global rank from 1 without a one-task window."""
    return with_position(df, order, "_pos").withColumn(name, F.col("_pos") + 1).drop("_pos")


def top_by_type(df: DataFrame, type_: str, order: Sequence[Column], k: int) -> DataFrame:
    return top_per_key(df, [type_], order, k, "rank")


def top_fresh(
    df: DataFrame, order: Sequence[Column], k: int = 5, *, type_: str = "type", label: str = "freshness_label",
    bundled: str = "bundled_in", bundled_type: str = "skill",
) -> DataFrame:
    """Top rows per type, without abandoned ones and without skills that come in a bundle."""
    alive = F.coalesce(F.col(label), F.lit("active")) != "abandoned"
    free = ~((F.col(type_) == bundled_type) & F.col(bundled).isNotNull())
    return top_per_key(df.filter(alive & free), [type_], order, k, "rank")


def top_kept(df: DataFrame, order: Sequence[Column], k: int = 8, *, type_: str = "type", wanted: str = "plugin", decision: str = "decision") -> DataFrame:
    """First rows of one type that are not rejected."""
    ok = (F.col(type_) == wanted) & (F.lower(F.coalesce(F.col(decision), F.lit(""))) != "reject")
    return df.filter(ok).orderBy(*order).limit(k)


def quota_expr(category: str, type_: str, quotas: Mapping[str, Mapping[str, int]] | None = None) -> Column:
    quotas = fixed.QUOTAS if quotas is None else quotas
    rules = [
        ((F.col(category) == c) & (F.col(type_) == t), n) for c, per_type in quotas.items() for t, n in per_type.items()
    ]
    return first_rule(rules, 1)


def within_quota(
    df: DataFrame, order: Sequence[Column], *, category: str = "category", type_: str = "type",
    quotas: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Best rows per category and type, as many as the quota of the pair.

    First cut to the largest quota (which Spark does before the shuffle), then to each one's own.
    """
    table = fixed.QUOTAS if quotas is None else quotas
    most = max(n for per_type in table.values() for n in per_type.values())
    best = top_per_key(df, [category, type_], order, most, "rank")
    return best.filter(F.col("rank") <= quota_expr(category, type_, table))


def layered(
    df: DataFrame, layers: Mapping[str, Column], order: Sequence[Column], slots: Sequence[str], slot_ok: Column, *, key: str = "id",
) -> DataFrame:
    """Rows of the first layer they meet, and for each uncovered slot the best other row ("gap_fill").

    An id counts once, in its first row.
    """
    tiered = df.withColumn("tier", first_rule([(cond, name) for name, cond in layers.items()])).withColumn("_has", F.col("tier").isNotNull())
    picked = first_per_key(tiered.filter("_has"), [key], [F.asc("_ord")])
    covered = picked.select(*slots).distinct()
    free = df.filter(slot_ok).join(picked.select(key), key, "left_anti")
    # the best row per slot first: one row per slot then meets the covered slots
    gap = first_per_key(free, list(slots), order).join(covered, list(slots), "left_anti").withColumn("tier", F.lit("gap_fill"))
    return picked.drop("_has").unionByName(gap)


def stratified_sample(df: DataFrame, order: Sequence[Column], per_type: int, extra: Mapping[str, Column], *, type_: str = "type", types: Sequence[str]) -> DataFrame:
    """Top rows per type plus one made row per type; ``extra`` gives its columns from the type."""
    best = top_per_key(df.filter(F.col(type_).isin(*types)), [type_], order, per_type, "_rank").drop("_rank")
    made = df.sparkSession.createDataFrame([(t,) for t in types], f"`{type_}` string").withColumns(dict(extra))
    return best.unionByName(made.select(best.columns))


def trending(df: DataFrame, repo: str, order: Sequence[Column], k: int = 20) -> DataFrame:
    """First rows by rank, one per repository."""
    return first_per_key(df, [repo], order).orderBy(*order).limit(k)


def browse(df: DataFrame, order: Sequence[Column], *, where: Column | None = None, page: int = 0, size: int = 50) -> DataFrame:
    """One page of a filtered, sorted listing."""
    out = df if where is None else df.filter(where)
    return out.orderBy(*order).offset(page * size).limit(size)


def recrawl_queue(
    entries: DataFrame, state: DataFrame, as_of: str, *, key: str = "id", type_: str = "type", added: str = "added_at",
    label: str = "freshness_label", queued: str = "last_queued_at", threshold_days: int = 365, cooldown_days: int = 30,
    limit: int = 500, types: Sequence[str] = fixed.LIFECYCLE_TYPES, legacy: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(queue, new state): old enough rows that were not queued lately, stalest first.

    The state takes up the rows kept; with ``legacy`` all eligible ones, also those cut off.
    """
    now = as_of_column(as_of)
    rank = F.when(F.col(label) == "abandoned", 0).when(F.col(label) == "stale", 1).when(
        F.coalesce(F.col(label), F.lit("active")) == "active", 2
    ).otherwise(3)
    joined = entries.join(state.select(key, type_, F.col(queued).alias("_queued")), [key, type_], "left")
    # both limits compare the full time span, so "exactly n days" already counts
    age = F.unix_micros(now) - F.unix_micros(F.col(added).try_cast("timestamp"))
    wait = F.unix_micros(now) - F.unix_micros(F.col("_queued").try_cast("timestamp"))
    eligible = joined.filter(
        F.col(type_).isin(*types) & (age >= threshold_days * DAY_MICROS) & (wait.isNull() | (wait >= cooldown_days * DAY_MICROS))
    ).withColumn("priority", rank)
    queue = eligible.orderBy("priority", key).limit(limit).drop("_queued")
    taken = (eligible if legacy else queue).select(key, type_, F.lit(as_of).alias(queued))
    kept = state.select(key, type_, queued).join(taken, [key, type_], "left_anti")
    return queue, kept.unionByName(taken.withColumn(queued, F.col(queued).cast(state.schema[queued].dataType)))


def probe_list(df: DataFrame, limit: int, *, source: str = "source", last: str = "mcp.so", stars: str = "stars", name: str = "name", order: str = "_ord") -> DataFrame:
    """First rows to look at: seed rows last, most stars first, then by name."""
    by = [
        F.when(F.col(source) == last, 1).otherwise(0).asc(),
        F.col(stars).desc_nulls_last(),
        F.lower(F.coalesce(F.col(name), F.lit(""))).asc(),
        F.col(order).asc(),
    ]
    return df.orderBy(*by).limit(limit)


# --- greedy featured picks ------------------------------------------------------------------


def _walk(caps: Sequence[int], scene: str, key: str):
    """Ordered walk over the bounded candidates."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        count: dict = {}
        for batch in batches:
            keep = []
            for number, place, name in zip(batch["pass"], batch[scene], batch[key]):
                ok = count.get((number, place), 0) < caps[number] and name not in seen
                keep.append(ok)
                if ok:
                    seen.add(name)
                    count[(number, place)] = count.get((number, place), 0) + 1
            yield batch.loc[keep]

    return run


def featured(
    passes: Sequence[tuple[DataFrame, int]], scenes: Sequence[str], *, scene: str = "scene", key: str = "key", order: str = "_ord",
) -> DataFrame:
    """Greedy picks over ordered passes with a cap per scene and one shared set of seen keys.

    ``passes`` are (rows, cap per scene); ``order`` is a unique ascending rank within a pass. A row
    refused because its scene is full does not mark its key.

    Of one scene and key only the first row can be picked, and a scene passes over at most as many
    rows as there are picks in all. So the first ``cap + all picks`` rows of each scene decide the
    result exactly; that is a fixed number of rows, which is walked in order.
    """
    most = sum(cap for _, cap in passes) * len(scenes)
    candidates = []
    for number, (rows, cap) in enumerate(passes):
        # a limit of one for each scene and key, which cuts the rows before they are shuffled
        firsts = top_per_key(rows.filter(F.col(scene).isin(*scenes)).select(scene, key, order), [scene, key], [F.asc(order)], 1, "_rank").drop("_rank")
        best = top_per_key(firsts, [scene], [F.asc(order)], cap + most, "_rank").drop("_rank")
        candidates.append(best.select(F.lit(number).alias("pass"), scene, key, order))
    bounded = reduce(DataFrame.unionByName, candidates)
    walk = _walk([cap for _, cap in passes], scene, key)
    return bounded.repartition(1).sortWithinPartitions("pass", order).mapInPandas(walk, bounded.schema)
