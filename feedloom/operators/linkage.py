"""Record linkage: identity keys, one winner per key, donor fields, greedy de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, urls
from ..functions.values import col, empty_as_null, first_rule
from ..session import cut
from .relational import first_per_key, skew_join

# --- identity keys -------------------------------------------------------------------------


def source_tier(
    url: Column | str,
    *,
    host: str = urls.GITHUB,
    registry: str = fixed.REGISTRY_URL,
    mirrors: Sequence[str] = fixed.KNOWN_MIRRORS,
    top_owner: str = fixed.TOP_OWNER,
    official: Sequence[str] = fixed.OFFICIAL_OWNERS,
    anchor: str = "#skill=",
) -> Column:
    """How far an address is preferred: 1000, 900, 800, 500, 200 or 100."""
    u = col(url)
    slug = urls.owner_repo(u, host)
    owner = F.split_part(slug, F.lit("/"), F.lit(1))
    return first_rule(
        [
            (u.rlike(registry), 900),
            (slug.isNull(), 100),
            (slug.isin(*mirrors), 200),
            (owner == top_owner, 1000),
            (owner.isin(*official), 900),
            (u.contains(anchor), 800),
        ],
        500,
    )


def skill_name(url: Column | str, name: Column | str) -> Column:
    """Name after ``#skill=``, else the path below ``/skills/``, else the entry's name."""
    u = col(url)
    anchor = F.regexp_extract(u, r"#skill=([^&]+)", 1)
    path = F.regexp_extract(u, r"/tree/[^/]+/skills/([^?#]+)", 1)
    return F.lower(
        F.when(F.length(anchor) > 0, anchor)
        .when(F.length(path) > 0, F.regexp_replace(path, "/+$", ""))
        .otherwise(F.coalesce(col(name), F.lit("")))
    )


def skill_key(url: Column | str, name: Column | str, *, host: str = urls.GITHUB) -> Column:
    """``skill|owner/repo|name``; known mirrors count as their upstream."""
    slug = urls.owner_repo(url, host)
    slug = F.when(slug.isin(*fixed.KNOWN_MIRRORS), F.lit(fixed.MIRROR_UPSTREAM)).otherwise(slug)
    skill = skill_name(url, name)
    return F.when(slug.isNotNull() & (F.length(skill) > 0), F.concat_ws("|", F.lit("skill"), slug, skill))


def server_key(url: Column | str, *, host: str = urls.GITHUB, registry: str = fixed.REGISTRY_URL) -> Column:
    """Repository root or sub-path of a server, or its registry name; never the owner alone."""
    u = col(url)
    # read "+" as it stands: only percent escapes are decoded
    raw = F.replace(F.regexp_extract(u, registry, 1), F.lit("+"), F.lit("%2B"))
    name = F.lower(F.trim(F.try_url_decode(raw)))
    repo = F.regexp_extract(name, r"^io\.github\.([^/]+/[^/]+)$", 1)
    slug = urls.owner_repo(u, host)
    sub = F.regexp_extract(u, r"/(?:tree|blob)/[^/]+/(.+?)(?:[?#]|$)", 1)
    sub = F.lower(F.regexp_replace(sub, "/+$", ""))
    return (
        F.when(F.length(repo) > 0, F.concat(F.lit("repo|"), repo, F.lit("|")))
        .when(F.length(name) > 0, F.concat(F.lit("registry|"), name, F.lit("|")))
        .when(u.rlike(registry), F.lit(None).cast("string"))
        .when(slug.isNotNull(), F.concat(F.lit("repo|"), slug, F.lit("|"), sub))
    )


def rule_key(url: Column | str, *, host: str = urls.GITHUB, repos: Sequence[str] = fixed.RULE_REPOS) -> Column:
    """``rule|slug`` for the mirrored rule repositories, null elsewhere."""
    slug = F.regexp_extract(
        col(url), r"/(?:tree|blob)/[^/]+/rules/(?:global_rules/|windsurfrules/)?([^/?#]+)", 1
    )
    slug = F.lower(F.trim(slug))
    return F.when(urls.owner_repo(url, host).isin(*repos) & (F.length(slug) > 0), F.concat(F.lit("rule|"), slug))


def plugin_key(repo: Column | str, name: Column | str) -> Column:
    repo, name = empty_as_null(repo), empty_as_null(name)
    return F.when(repo.isNotNull() & name.isNotNull(), F.concat_ws("|", F.lit("plugin"), repo, name))


def identity_key(type_: str = "type", url: str = "source_url", name: str = "name", install: str = "install") -> Column:
    """The key of an entry by its type; null means the entry links to nothing."""
    t = F.col(type_)
    return (
        F.when(t == "skill", skill_key(url, name))
        .when(t == "mcp", server_key(url))
        .when(t == "rule", rule_key(url))
        .when(t == "plugin", plugin_key(f"{install}.marketplace_repo", f"{install}.plugin_name"))
    )


def identity_rank(type_: str = "type", url: str = "source_url", priority: str = "source_priority") -> Column:
    """Ascending rank of an entry among those with its key (input order is added by the caller)."""
    t, u = F.col(type_), F.col(url)
    tier = source_tier(u)
    slug = urls.owner_repo(u)
    special = (
        F.when(t == "mcp", u.rlike(fixed.REGISTRY_URL).cast("int"))
        .when(t == "rule", F.when(slug == fixed.RULE_REPOS[0], 0).when(slug == fixed.RULE_REPOS[1], 1).otherwise(2))
        .otherwise(0)
    )
    preferred = F.when(t == "plugin", F.coalesce(F.col(priority), tier)).otherwise(tier)
    return F.struct(F.coalesce(special, F.lit(0)).alias("special"), (-preferred).cast("long").alias("preferred"))


# --- collapse ------------------------------------------------------------------------------


def collapse(df: DataFrame, key: str, order: Sequence[Column], every_row_keyed: bool = False) -> DataFrame:
    """Best row per key; rows without a key pass through and are not shuffled.

    Say ``every_row_keyed`` where that is known: the rows are then read once and not twice.
    """
    if every_row_keyed:  # no null test either: a pushed-down test would work the key out twice
        return first_per_key(df, [key], order)
    keyed = first_per_key(df.filter(F.col(key).isNotNull()), [key], order)
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def collapse_with_donors(
    df: DataFrame,
    key: str,
    rank: Sequence[str],
    scalars: Mapping[str, str] | None = None,
    lists: Sequence[str] = (),
    *,
    only: Mapping[str, Column] | None = None,
    every_row_keyed: bool = False,
) -> DataFrame:
    """Best row per key, its empty fields filled by the next rows that have them.

    ``rank`` names ascending columns, the last one unique. ``scalars`` maps a field to its
    kind (see ``empty_as_null``); ``lists`` become ordered unions. ``only`` limits a field to
    keys whose rows meet a condition (such as one type); elsewhere the winner's own value stays.
    Everything is an aggregate with partial results before the shuffle, so a huge key stays cheap.
    """
    scalars, only = dict(scalars or {}), dict(only or {})
    order = F.struct(*[F.col(c) for c in rank])
    keyed = df if every_row_keyed else df.filter(F.col(key).isNotNull())
    own = [c for c in df.columns if c != key]
    aggs = [F.min_by(F.struct(*own), order).alias("_winner")]
    for name, kind in scalars.items():
        value = empty_as_null(name, kind)
        aggs.append(F.min_by(value, F.when(value.isNotNull(), order)).alias(f"_d_{name}"))
    out = keyed.groupBy(key).agg(*aggs).select(key, "_winner.*", *[f"_d_{n}" for n in scalars])
    filled = {}
    for name in scalars:
        donor = F.coalesce(F.col(f"_d_{name}"), F.col(name))
        filled[name] = F.when(only[name], donor).otherwise(F.col(name)) if name in only else donor
    for name in lists:
        rows = keyed.filter(only[name]) if name in only else keyed
        items = rows.select(key, order.alias("_o"), F.posexplode(name).alias("_p", "_item"))
        first = items.groupBy(key, "_item").agg(F.min(F.struct("_o", "_p")).alias("_at"))
        merged = first.groupBy(key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "_item"))), lambda s: s["_item"]).alias(f"_d_{name}")
        )
        out = out.join(merged, key, "left")
        filled[name] = F.coalesce(f"_d_{name}", name)
    out = out.withColumns(filled).select(*df.columns)
    return out if every_row_keyed else out.unionByName(df.filter(F.col(key).isNull()))


def rejects_by_first_seen(df: DataFrame, key: str, order: str, reason: str = "duplicate id") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with reason): the first row per key stays.

    The rejected rows are found by the unique ``order`` of the kept ones, so a key with very many
    rows never meets in one task.
    """
    kept = first_per_key(df, [key], [F.asc(order)])
    rejected = df.join(kept.select(order), order, "left_anti").withColumn("reason", F.lit(reason))
    return kept, rejected


# --- greedy de-duplication over several keys -------------------------------------------------


def _follow(pointers: DataFrame, ends: DataFrame, order: str) -> DataFrame:
    """Rows whose chain of pointers ends in a kept row, with ``_odd``: whether they are an odd number of steps away.

    Every step doubles the length that a pointer spans, so a chain of n rows takes log2(n) steps.
    """
    hops = cut(pointers.select(order, "_to", F.lit(True).alias("_odd")))
    while True:
        onward = hops.select(F.col(order).alias("_to"), F.col("_to").alias("_far"), F.col("_odd").alias("_more"))
        hops = cut(hops.join(onward, "_to", "left").select(
            order, F.coalesce("_far", "_to").alias("_to"),
            F.when(F.col("_more"), ~F.col("_odd")).otherwise(F.col("_odd")).alias("_odd"), F.col("_far").isNotNull().alias("_moved")))
        if hops.filter("_moved").isEmpty():
            return hops.join(ends.select(F.col(order).alias("_to")), "_to", "left_semi").select(order, "_odd")


def greedy_first_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep a row only if no earlier kept row has one of its keys; dropped rows block nothing.

    Each round keeps every row that is first among the remaining in all its keys and drops the rows that clash with
    those; that is the ordered greedy result (Blelloch, Fineman, Shun, SPAA 2012). A row with a single earlier rival
    among the remaining is kept exactly if that one is not, so chains of such rows are decided in the same round by
    following their pointers. Each round makes progress, so it ends.
    """
    rest = cut(df.select(order, *[F.col(k).cast("string").alias(k) for k in keys]))
    kept: list[DataFrame] = []
    while not kept or not rest.isEmpty():
        marked = rest
        chained = bool(kept)  # the first round decides nearly all rows, so pointers are for what it leaves
        for i, k in enumerate(keys):
            # rows are matched on the unique order column, never on the possibly hot key
            least = rest.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min(order).alias("_least"))
            marked = marked.join(least.select(F.col("_least").alias(order), F.lit(True).alias(f"_f{i}")), order, "left")
            if chained:
                later = skew_join(rest.filter(F.col(k).isNotNull()), least, [k], "inner", spread=[order])
                second = later.filter(F.col(order) > F.col("_least")).groupBy(k).agg(F.min(order).alias(order), F.min("_least").alias(f"_p{i}"))
                marked = marked.join(second.select(order, f"_p{i}"), order, "left")
            else:
                marked = marked.withColumn(f"_p{i}", F.lit(None).cast(df.schema[order].dataType))
        free = [F.col(k).isNull() | F.coalesce(f"_f{i}", F.lit(False)) for i, k in enumerate(keys)]
        known = [f | F.col(f"_p{i}").isNotNull() for i, f in enumerate(free)]
        rivals = F.array_distinct(F.array_compact(F.array(*[F.col(f"_p{i}") for i in range(len(keys))])))
        marked = cut(marked.select(
            order, *keys, reduce(lambda a, b: a & b, free).alias("_ok"),
            F.when(reduce(lambda a, b: a & b, known) & (F.size(rivals) == 1), F.get(rivals, F.lit(0))).alias("_to")))
        winners, rest = marked.filter("_ok"), marked.filter("not _ok")
        if chained:
            decided = _follow(rest.filter("_to is not null"), winners, order)
            winners = cut(winners.unionByName(rest.join(decided.filter("not _odd"), order, "left_semi")))
            rest = rest.join(decided, order, "left_anti")
        kept.append(winners.select(order))
        for k in keys:
            taken = winners.select(k).filter(F.col(k).isNotNull())
            rest = skew_join(rest, taken, [k], "left_anti", spread=[order])
        rest = cut(rest.select(order, *keys))
    return df.join(reduce(DataFrame.unionByName, kept), order, "left_semi")


def dedup_report(before: DataFrame, after: DataFrame, type_: str = "type", alarm_over: float = 50.0) -> DataFrame:
    """Rows per type before and after, the share dropped, and an alarm over a limit."""
    b = before.groupBy(type_).agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy(type_).agg(F.count(F.lit(1)).alias("n_after"))
    drop = (F.lit(1.0) - F.col("n_after") / F.col("n_before")) * 100.0
    return (
        b.join(a, type_, "full_outer")
        .na.fill(0, ["n_before", "n_after"])
        .withColumn("drop_pct", F.when(F.col("n_before") > 0, drop).otherwise(0.0))
        .withColumn("alarm", F.col("drop_pct") > alarm_over)
    )
