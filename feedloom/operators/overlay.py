"""Overlays, lookups and snapshot comparison: joins that decide which value wins.

Tables keyed by entry id are unique per id, so those joins cannot skew. Where many rows
share the looked-up key (repository, address, content), the lookup side is first reduced
to one row per key and hot keys of the other side are salted by ``skew_join``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.values import col, empty_as_null, first_rule
from ..session import cut
from ..sources.keyed import KeyedTable
from .linkage import greedy_first_wins
from .patterns import least_containment
from .relational import HOT_ROWS, exploded_keys, first_per_key, lookup_join, skew_join, with_position


def _side(df: DataFrame, key: str, fields: Sequence[str], prefix: str = "_old_") -> DataFrame:
    return df.select(key, *[F.col(f).alias(prefix + f) for f in fields])


def union_per_key(df: DataFrame, key: str, items: str, order: str, latest_first: bool = False) -> DataFrame:
    """(key, items): distinct items of all rows of a key, in row order (or from the last row) then list order."""
    flat = df.select(key, F.col(order).alias("_o"), F.posexplode(items).alias("_p", "_i"))
    place = F.struct("_o", -F.col("_p")) if latest_first else F.struct("_o", "_p")
    at = F.max(place) if latest_first else F.min(place)
    firsts = flat.groupBy(key, "_i").agg(at.alias("_at"))
    placed = F.sort_array(F.collect_list(F.struct("_at", "_i")), asc=not latest_first)
    return firsts.groupBy(key).agg(F.transform(placed, lambda s: s["_i"]).alias(items))


# --- hand-made rows over the catalog (C1) -----------------------------------------------------


def _match(entries: DataFrame, extra: DataFrame, key: str, url: str, order: str) -> DataFrame:
    """``extra`` rows with ``_target``: the entry of the same id, else the last one with the same address."""
    ids = entries.filter(F.col(key).isNotNull()).select(key, F.col(key).alias("_by_id")).distinct()
    urls = entries.filter(F.col(url).isNotNull()).groupBy(url).agg(F.max_by(key, order).alias("_by_url"))
    hit = skew_join(extra.join(ids, key, "left"), urls, [url], "left", spread=[order], hot_from=extra)
    return hit.withColumn("_target", F.coalesce("_by_id", "_by_url")).drop("_by_id", "_by_url")


def _merge_lists(entries: DataFrame, hits: DataFrame, key: str, order: str, lead: str, trail: str) -> DataFrame:
    hits = hits.withColumnRenamed(key, "_extra_id").withColumnRenamed("_target", key)
    # a later row goes in front of earlier ones in the leading list, behind them in the trailing one
    first = union_per_key(hits, key, lead, order, latest_first=True).withColumnRenamed(lead, "_lead")
    last = union_per_key(hits, key, trail, order).withColumnRenamed(trail, "_trail")
    none = F.array().cast("array<string>")
    joined = entries.join(first, key, "left").join(last, key, "left")
    return joined.withColumns({
        lead: F.array_distinct(F.concat(F.coalesce("_lead", none), F.coalesce(lead, none))),
        trail: F.array_distinct(F.concat(F.coalesce(trail, none), F.coalesce("_trail", none))),
    }).select(entries.columns)


def overlay_curated(
    entries: DataFrame, curated: DataFrame, *, key: str = "id", url: str = "url_key", order: str = "_ord",
    lead: str = "tech_stack", trail: str = "tags",
) -> DataFrame:
    """Merge the lists of hand-made rows into their entries and append the rows without one.

    ``curated`` has the columns of ``entries``. A row matches by id, else by address.
    Unmatched rows are appended once; later ones that clash with an appended row merge into it.
    """
    hits = cut(_match(entries, curated, key, url, order))  # read for both lists and for the rows without an entry
    merged = _merge_lists(entries, hits.filter("_target is not null"), key, order, lead, trail)
    new = hits.filter("_target is null").drop("_target").select(entries.columns)
    kept = cut(greedy_first_wins(new, [key, url], order))
    late = new.join(kept.select(order), order, "left_anti")
    appended = _merge_lists(kept, _match(kept, late, key, url, order), key, order, lead, trail)
    return merged.unionByName(appended)


# --- history onto new rows (C2-C5, C8, C9) --------------------------------------------------


def overlay_prior(new: DataFrame, old: DataFrame, *, key: str = "id", value: str, stamps: Sequence[str]) -> DataFrame:
    """Where ``value`` (a struct) is absent, take over only ``stamps`` from the old one and keep it all aside."""
    prior = old.filter(F.col(value).isNotNull()).select(key, F.col(value).alias("_prior"))
    joined = new.join(prior, key, "left")
    take = F.col(value).isNull() & F.col("_prior").isNotNull()
    fields = new.select(f"{value}.*").columns
    partial = F.struct(*[
        (F.col(f"_prior.{f}") if f in stamps else F.lit(None).cast(new.schema[value].dataType[f].dataType)).alias(f)
        for f in fields
    ])
    return joined.withColumn(f"prior_{value}", F.when(take, F.col("_prior"))).withColumn(
        value, F.when(take, partial).otherwise(F.col(value))
    ).drop("_prior")


def keep_fields(new: DataFrame, old: DataFrame, fields: Mapping[str, str], *, key: str = "id") -> DataFrame:
    """Per field: the new value unless it is empty, else the old one. ``fields`` maps name to kind."""
    joined = new.join(_side(old, key, list(fields)), key, "left")
    filled = {
        f: F.coalesce(empty_as_null(f, kind), empty_as_null(f"_old_{f}", kind), F.col(f)) for f, kind in fields.items()
    }
    return joined.withColumns(filled).select(new.columns)


def backfill(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """First non-empty of the target itself and the other columns, in order."""
    return df.withColumn(target, F.coalesce(*[empty_as_null(c) if dict(df.dtypes)[c] == "string" else F.col(c)
                                              for c in (target, *sources)]))


def first_seen(
    new: DataFrame, prior: DataFrame, today: str, *, key: str = "id", type_: str = "type", url: str = "url_key",
    added: str = "added_at", order: str = "_ord", types: Sequence[str] = fixed.LIFECYCLE_TYPES, min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Date an entry was first listed: the earliest listed date by (type, id), else (type, address), else today.

    "Earliest" is by list order of ``prior``. Other types carry no date.
    """
    dated = prior.filter(F.col(type_).isin(*types) & F.col(added).isNotNull())
    by_id = dated.filter(F.col(key).isNotNull()).groupBy(type_, key).agg(F.min_by(added, order).alias("_id_date"))
    by_url = dated.filter(F.col(url).isNotNull()).groupBy(type_, url).agg(F.min_by(added, order).alias("_url_date"))
    joined = new.drop(added).join(by_id, [type_, key], "left")
    joined = skew_join(joined, by_url, [type_, url], "left", spread=[key], min_rows=min_rows, hot_from=new)
    date = F.coalesce("_id_date", "_url_date", F.lit(today))
    return joined.withColumn(added, F.when(F.col(type_).isin(*types), date)).drop("_id_date", "_url_date")


def backfill_first_seen(added: str, pushed: str, synced: str, today: str) -> Column:
    """The date itself, else the earlier of last push and last sync, else today."""
    day = lambda c: F.date_format(col(c), "yyyy-MM-dd")
    return F.coalesce(F.col(added), F.least(day(pushed), day(synced)), F.lit(today))


def fallback_result(
    entries: DataFrame, new: DataFrame, old: DataFrame, *, key: str = "id", value: str, synthetic: Column,
) -> DataFrame:
    """This run's value, else the last one, else a stand-in; ``provenance`` tells which."""
    n = new.select(key, F.col(value).alias("_new"))
    o = old.select(key, F.col(value).alias("_old"))
    joined = entries.join(n, key, "left").join(o, key, "left")
    return joined.withColumns({
        "provenance": F.when(F.col("_new").isNotNull(), "new").when(F.col("_old").isNotNull(), "old").otherwise("synth"),
        value: F.coalesce("_new", "_old", synthetic),
    }).drop("_new", "_old")


def restore_side_effects(
    new: DataFrame, old: DataFrame, fields: Sequence[str], *, key: str = "id", text: str = "description",
    original: str = "description_original",
) -> DataFrame:
    """Old non-null fields win; the text only where the old row had replaced it before."""
    old_fields = list(dict.fromkeys([*fields, original, text]))
    joined = new.join(_side(old, key, old_fields), key, "left")
    out = {f: F.coalesce(F.col(f"_old_{f}"), F.col(f)) for f in fields}
    rewritten = (F.length(f"_old_{original}") > 0) & (F.length(f"_old_{text}") > 0)
    out[text] = F.when(rewritten, F.col(f"_old_{text}")).otherwise(F.col(text))
    return joined.withColumns(out).select(new.columns)


# --- cross-type resolution (C6, C7) ----------------------------------------------------------


def resolve_members(
    groups: DataFrame, members: DataFrame, *, group: str = "plugin_id", names: str = "namespaces", repo: str = "repo",
    member: str = "id", namespace: str = "namespace", tail: str = "tail", member_repo: str = "repo", order: str = "_ord",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """(group, pos, name, member, strategy): which member each listed name of a group means.

    Tried in order: the member's namespace, its id, its id with ``-`` for ``:``, and the last
    part of its address, first within the group's own repository and then anywhere. The first three
    agree in their text with ``-`` for ``:`` and are looked up together, so a name is one row in each of three
    lookups, and never a row for each try.
    """
    plain = lambda c: F.replace(c, F.lit(":"), F.lit("-"))
    entry = lambda kind, text: F.struct(F.lit(kind).alias("_kind"), text.cast("string").alias("_text"))
    known = F.array(entry("namespace", F.col(namespace)), entry("id", F.col(member)))
    called = members.select(F.col(member).alias("member"), F.col(order).alias("_o"), F.explode(known).alias("_e")).select("member", "_o", "_e.*")
    called = first_per_key(called.filter(F.col("_text").isNotNull()), ["_kind", "_text"], [F.asc("_o")])
    # a list holds the few texts that differ in ":" and "-" only
    called = called.groupBy(plain(F.col("_text")).alias("_plain")).agg(F.collect_list(F.struct("_kind", "_text", "member")).alias("_called"))
    # a blank repository of a member is none; it is found by its tail alone
    places = F.explode(F.array(F.col(member_repo).cast("string"), F.lit(""))).alias("_repo")
    tails = members.select(F.col(member).alias("member"), F.col(order).alias("_o"), F.col(tail).cast("string").alias("_short"), places)
    tails = first_per_key(tails.filter(F.col("_short").isNotNull() & F.col("_repo").isNotNull()), ["_short", "_repo"], [F.asc("_o")]).drop("_o")

    flat = cut(groups.select(group, F.col(repo).cast("string").alias("_repo"), F.posexplode(names).alias("pos", "name")))  # its keys are counted and joined
    short = F.regexp_extract("name", "^[^:]*:(.*)$", 1)
    flat = flat.withColumns({"_plain": plain(F.col("name")), "_short": F.when(F.length(short) > 0, short)})
    look_up = lambda asked, table, keys: skew_join(asked, table, keys, "left", spread=[group, "pos"], min_rows=min_rows, hot_from=flat)
    called_by = lambda kind, text: F.get(F.filter("_called", lambda x: (x["_kind"] == kind) & (x["_text"] == text)), F.lit(0))["member"]
    hit = lambda rank, strategy, m: F.when(m.isNotNull(), F.struct(F.lit(rank).alias("rank"), F.lit(strategy).alias("strategy"), m.alias("member")))
    slug = F.when(F.col("name").contains(":"), F.col("_plain"))
    by_name = F.coalesce(hit(0, "namespace", called_by("namespace", F.col("name"))), hit(1, "id", called_by("id", F.col("name"))), hit(2, "slug", called_by("id", slug)))
    met = look_up(flat, called, ["_plain"]).select(group, "pos", "name", "_short", "_repo", by_name.alias("_hit"))
    same_repo, anywhere = tails.withColumnRenamed("member", "_own"), tails.filter("_repo = ''").select("_short", F.col("member").alias("_any"))
    met = look_up(met, same_repo, ["_short", "_repo"]).withColumn("_hit", F.coalesce("_hit", hit(3, "same_repo", F.col("_own"))))
    met = look_up(met.drop("_own", "_repo"), anywhere, ["_short"]).withColumn("_hit", F.coalesce("_hit", hit(4, "tail", F.col("_any"))))
    best = first_per_key(met.select(group, "pos", "name", "_hit"), [group, "pos"], [F.col("_hit.rank").asc_nulls_last()])
    return best.select(group, "pos", "name", "_hit.member", F.coalesce("_hit.strategy", F.lit("orphan")).alias("strategy"))


def aligned_members(resolved: DataFrame, group: str = "plugin_id") -> DataFrame:
    """Members of a group as a list in the order of its names; null where nothing was found."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "member")))
    return resolved.groupBy(group).agg(F.transform(pairs, lambda p: p["member"]).alias("members"))


def owner_of_member(resolved: DataFrame, groups: DataFrame, group: str = "plugin_id", order: str = "_ord") -> DataFrame:
    """(member, group): the last group in list order that claims a member."""
    hits = resolved.filter(F.col("member").isNotNull()).join(groups.select(group, order), group)
    return hits.groupBy("member").agg(F.max_by(group, order).alias(group))


# --- result cache and incremental work (C10-C13) ---------------------------------------------


def split_by_cache(
    asked: DataFrame, cache: DataFrame | KeyedTable, as_of: str, *, key: str = "cache_key", expires: str = "expires_at",
    spread: Sequence[str] | None = None, min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Asked rows with ``hit`` and the cached columns of the live row of their key.

    ``cache`` has one row per key; where it is a table kept by that key, it is read in its buckets and not shuffled. A hit
    keeps the asking row's own id.
    """
    kept = isinstance(cache, KeyedTable)
    cache = cache.read() if kept else cache
    live = cache.filter(F.col(expires).isNull() | (F.col(expires) >= F.to_timestamp(F.lit(as_of))))
    keep = [c for c in live.columns if c not in asked.columns or c == key]
    live = live.select(*keep, F.lit(True).alias("hit"))
    if kept:
        out = lookup_join(asked, live, [key], min_rows=min_rows)
    else:
        out = skew_join(asked, live, [key], "left", spread=spread, min_rows=min_rows)
    return out.withColumn("hit", F.coalesce("hit", F.lit(False)))


def latest_cached(
    cache: DataFrame, as_of: str, *, keys: Sequence[str] = ("entry_id", "rubric_version"), at: str = "evaluated_at",
    cache_key: str = "cache_key", expires: str = "expires_at",
) -> DataFrame:
    """Newest cached row per entry and rubric, dropped if that one has expired."""
    newest = first_per_key(cache, list(keys), [F.desc(at), F.asc(cache_key)])
    return newest.filter(F.col(expires).isNull() | (F.col(expires) >= F.to_timestamp(F.lit(as_of))))


def reuse_or_evaluate(
    entries: DataFrame, unstable: DataFrame | None, cached: DataFrame, *, derived: Column, key: str = "id",
    diff_key: str = "raw_id",
) -> DataFrame:
    """``path`` is reuse for derived rows that did not change and have a cached result, else evaluate.

    Without a diff (first run) everything is evaluated.
    """
    if unstable is None:
        return entries.withColumn("path", F.lit("evaluate"))
    changed = unstable.select(F.col(unstable.columns[0]).alias(diff_key)).distinct().withColumn("_changed", F.lit(True))
    have = cached.select(F.col(cached.columns[0]).alias(key)).distinct().withColumn("_cached", F.lit(True))
    joined = skew_join(entries, changed, [diff_key], "left", spread=[key]).join(have, key, "left")
    reuse = derived & F.col("_changed").isNull() & F.col("_cached").isNotNull()
    return joined.withColumn("path", F.when(reuse, "reuse").otherwise("evaluate")).drop("_changed", "_cached")


def ledger_gate(entries: DataFrame, ledger: DataFrame, as_of: str, *, key: str = "entry_id") -> DataFrame:
    """``gate``: quarantined from four failures on, deferred until the retry time, else eligible."""
    state = ledger.select(key, F.col("attempt_count").alias("_n"), F.col("next_retry_after").alias("_next"))
    joined = entries.join(state, key, "left")
    return joined.withColumn(
        "gate",
        F.when(F.col("_n") >= fixed.QUARANTINE_AT, "quarantined")
        .when(F.col("_next").try_cast("timestamp") > F.to_timestamp(F.lit(as_of)), "deferred")
        .otherwise("eligible"),
    ).drop("_n", "_next")


# --- merges and membership (C14-C22) ----------------------------------------------------------


def verify_membership(
    df: DataFrame, manifests: DataFrame, *, repo: str = "repo", name: str = "plugin_name", market: str = "market_name",
    listed: str = "plugin_names", min_rows: int = HOT_ROWS, spread: Sequence[str] | None = None,
) -> DataFrame:
    """``market_name`` where well formed, and ``verified`` where the manifest of the repository lists the name."""
    good = F.trim(F.col(market))
    m = manifests.select(repo, F.when(good.rlike(r"^[A-Za-z0-9._-]+$"), good).alias(market), listed)
    # manifests are few rows that make many: dealt out before, and the names are not gathered before they are dealt too
    pairs = m.filter(F.col(market).isNotNull()).select(repo, listed).repartition(repo, listed)
    pairs = pairs.select(repo, F.explode(listed).alias("_l")).select(repo, F.trim("_l").alias(name)).repartition(repo, name)
    pairs = pairs.distinct().withColumn("verified", F.lit(True))
    out = skew_join(df, m.select(repo, market), [repo], "left", spread=spread, min_rows=min_rows)
    out = skew_join(out, pairs, [repo, name], "left", spread=spread, min_rows=min_rows, hot_from=df)
    return out.withColumn("verified", F.coalesce("verified", F.lit(False)))


def merge_by_priority(
    sources: Sequence[DataFrame], key: str, order: str, *, text: str = "description", second: int = 1,
    second_text: str = "description_zh", pattern: str = "[\\u4e00-\\u9fff]",
) -> DataFrame:
    """One row per key, from the first source that has it.

    Where a text of source ``second`` matches ``pattern`` and the winner's does not, it is
    kept beside it (the last one in list order, if that source has several).
    """
    ranked = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    rows = ranked[0]
    for r in ranked[1:]:
        rows = rows.unionByName(r)
    rows = rows.filter(F.length(key) > 0)
    winner = first_per_key(rows, [key], [F.asc("_src"), F.asc(order)])
    special = rows.filter((F.col("_src") == second) & F.col(text).rlike(pattern))
    other = special.groupBy(key).agg(F.max_by(text, order).alias("_other"))
    out = winner.join(other, key, "left")
    take = ~F.coalesce(F.col(text).rlike(pattern), F.lit(False))
    return out.withColumn(second_text, F.when(take, F.col("_other"))).drop("_other", "_src")


def merge_incumbent(
    new: DataFrame, existing: DataFrame, *, key: str = "id", url: str = "url_key", order: str = "_ord", min_rows: int = HOT_ROWS
) -> DataFrame:
    """Existing rows stay; a new row comes in if its address is not there yet, nor its id anywhere."""
    new, existing = cut(new), cut(existing)
    keys = {"url": url, "id": key}
    taken = exploded_keys(existing, keys, []).filter((F.col("_kind") == "id") | (F.length("_key") > 0)).distinct()
    known = skew_join(exploded_keys(new, keys, [order]), taken, ["_kind", "_key"], "inner", spread=[order], min_rows=min_rows)
    fresh = new.join(known.select(order).distinct(), order, "left_anti")
    # rows without an id are each on their own
    fresh = first_per_key(fresh.withColumn("_own", F.when(F.col(key).isNull(), F.col(order))), [key, "_own"], [F.asc(order)])
    return existing.unionByName(fresh.select(existing.columns))


def coverage(
    expected: DataFrame, catalog: DataFrame, *, type_: str = "type", slug: str = "slug", id_: str = "id",
    installs: str = "install_count", mirrors: Sequence[str] = (), mirror_type: str = "skill",
    mirror_of: str = fixed.MIRROR_UPSTREAM, order: str = "_ord",
) -> DataFrame:
    """Expected rows with status direct, mirror or missing, and the representative with most installs."""
    n = F.coalesce(F.col(installs), F.lit(0))
    best = catalog.groupBy(type_, slug).agg(
        F.min_by(id_, F.struct((-n).alias("n"), F.col(order).alias("o"))).alias("_direct"), F.max(n).alias("_installs")
    )
    mirror = catalog.filter((F.col(type_) == mirror_type) & F.col(slug).isin(*mirrors)).groupBy(type_).agg(
        F.min_by(id_, order).alias("_mirror")
    ).withColumn(slug, F.lit(mirror_of))
    out = expected.join(best, [type_, slug], "left").join(mirror, [type_, slug], "left")
    return out.withColumns({
        "status": F.when(F.col("_direct").isNotNull(), "direct").when(F.col("_mirror").isNotNull(), "mirror").otherwise("missing"),
        "representative": F.coalesce("_direct", "_mirror"),
        "installs": F.col("_installs"),
    }).drop("_direct", "_mirror", "_installs")


def reconcile(index: DataFrame, present: DataFrame, *, type_: str = "type", key: str = "id", known: Sequence[str] = fixed.TYPES) -> DataFrame:
    """Drop rows of known types whose file is not there; other rows stay as they are."""
    checkable = F.col(type_).isin(*known) & F.col(key).isNotNull()
    checkable = F.coalesce(checkable, F.lit(False))
    there = present.select(type_, key).distinct()
    return index.filter(checkable).join(there, [type_, key], "left_semi").unionByName(index.filter(~checkable))


def fan_out(
    df: DataFrame, shared: DataFrame, keys: Sequence[str], field: str, *, value: str, min_rows: int = HOT_ROWS,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Give every row the value of its group, else its own. Should a group have several values, the least one."""
    one = shared.groupBy(*keys).agg(F.min(value).alias("_shared"))
    out = skew_join(df, one, keys, "left", spread=spread, min_rows=min_rows)
    return out.withColumn(field, F.coalesce(F.col("_shared"), F.col(field))).drop("_shared")


def fill_empty_list(df: DataFrame, side: DataFrame, key: str, field: str) -> DataFrame:
    """Take a list from the side table where the own one is empty."""
    out = df.join(side.select(key, F.col(field).alias("_side")), key, "left")
    own = F.coalesce(F.size(field), F.lit(0)) > 0
    return out.withColumn(field, F.when(own | F.col("_side").isNull(), F.col(field)).otherwise(F.col("_side"))).drop("_side")


def containment_match(names: DataFrame, rows: DataFrame, *, name: str, title: str, value: str, order: str, **sizes: int) -> DataFrame:
    """Per name the value of the first row whose title equals, contains or is contained in it; blanks never match.

    Names and titles are looked for in each other by automatons over blocks of them (``patterns``); ``sizes`` are its own.
    """
    n = names.select(F.lower(F.trim(name)).alias("text")).filter(F.length("text") > 0).distinct()
    t = rows.select(F.lower(F.trim(title)).alias("text"), value, order).filter(F.length("text") > 0)
    t = t.groupBy("text").agg(F.min_by(value, order).alias(value), F.min(order).alias(order))
    n = cut(n.withColumn("number", F.monotonically_increasing_id()))
    t = cut(with_position(t, [F.asc(order), F.asc(value)], "number"))
    pairs = least_containment(n, t, of="pattern", **sizes).unionByName(least_containment(t, n, of="text", **sizes))
    best = pairs.groupBy("number").agg(F.min("least").alias("least"))
    best = n.join(best, "number").select(F.col("text").alias("_n"), F.col("least").alias("number")).join(t.select("number", value), "number").drop("number")
    keyed = names.withColumn("_n", F.lower(F.trim(name)))
    return skew_join(keyed, best, ["_n"], "left").drop("_n")


def match_either(
    df: DataFrame, rows: DataFrame, keys: Mapping[str, str], value: str, order: str, *, id_: str, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Value of the first row that agrees in any one of the keys (own column -> column of the rows)."""
    df = cut(df)
    kinds = dict(enumerate(keys))
    entries = exploded_keys(rows, {str(i): keys[own] for i, own in kinds.items()}, [F.col(value).alias("_v"), F.col(order).alias("_o")])
    one = first_per_key(entries, ["_kind", "_key"], [F.asc("_o")])
    asked = exploded_keys(df, {str(i): own for i, own in kinds.items()}, [id_])
    hits = skew_join(asked, one, ["_kind", "_key"], "inner", spread=[id_, "_kind"], min_rows=min_rows)
    best = first_per_key(hits, [id_], [F.asc("_o")]).select(id_, F.col("_v").alias(value))
    return df.join(best, id_, "left")


# --- snapshot comparison (C23, C24) ------------------------------------------------------------


def drift_diff(
    old: DataFrame, new: DataFrame, *, key: str = "id", measure: str = "install_count", threshold: float = 0.2,
    from_zero: int = 1000,
) -> DataFrame:
    """(key, class, old, new, pct): added, removed, changed or stable between two snapshots."""
    o = old.select(key, F.coalesce(F.col(measure), F.lit(0)).alias("old"), F.lit(True).alias("_o"))
    n = new.select(key, F.coalesce(F.col(measure), F.lit(0)).alias("new"), F.lit(True).alias("_n"))
    pct = F.when(F.col("old") > 0, (F.col("new") - F.col("old")) / F.col("old"))
    both = o.join(n, key, "full_outer").withColumn("_pct", pct)
    changed = F.when(F.col("old") > 0, F.abs("_pct") >= threshold).otherwise(F.col("new") >= from_zero)
    class_ = (
        F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(changed, "changed").otherwise("stable")
    )
    return both.withColumn("class", class_).select(
        key, "class", "old", "new", F.when(F.col("class") == "changed", F.bround("_pct", 4)).alias("pct")
    )


def ordered_diff(old: DataFrame, new: DataFrame, fields: Mapping[str, str], *, key: str = "id") -> DataFrame:
    """(key, class, old, new): the first differing field names the class (field -> class name)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    o = old.select(key, *[blank(f).alias(f"_o_{f}") for f in fields], F.lit(True).alias("_o"))
    n = new.select(key, *[blank(f).alias(f"_n_{f}") for f in fields], F.lit(True).alias("_n"))
    both = o.join(n, key, "full_outer")
    rules = [(F.col("_o").isNull(), F.lit("added")), (F.col("_n").isNull(), F.lit("removed"))]
    rules += [(F.col(f"_o_{f}") != F.col(f"_n_{f}"), F.lit(c)) for f, c in fields.items()]
    class_ = first_rule(rules, "stable")
    value = lambda side: first_rule([(F.col("class") == c, F.col(f"_{side}_{f}")) for f, c in fields.items()])
    return both.withColumn("class", class_).select(key, "class", value("o").alias("old"), value("n").alias("new"))


# --- flags, promotion, attributes, evidence (C25-C30) -------------------------------------------


def flag_existing(df: DataFrame, known: DataFrame, keys: Sequence[str], out: str = "existing", *, spread: Sequence[str] | None = None) -> DataFrame:
    """True where any one of the keys is among those of the known rows."""
    flag = F.lit(False)
    res = df
    for k in keys:
        seen = known.select(k).filter(F.col(k).isNotNull()).distinct().withColumn(f"_has_{k}", F.lit(True))
        res = skew_join(res, seen, [k], "left", spread=spread, hot_from=df)
        flag = flag | F.coalesce(f"_has_{k}", F.lit(False))
    return res.withColumn(out, flag).drop(*[f"_has_{k}" for k in keys])


def promote(candidates: DataFrame, index: DataFrame, curated: DataFrame, default_stack: Column, *, key: str = "id", stack: str = "tech_stack") -> DataFrame:
    """Candidates not curated yet, with their full row; an empty stack gets the default."""
    new = candidates.join(curated.select(key).distinct(), key, "left_anti")
    full = new.join(index, key)
    return full.withColumn(stack, F.when(F.size(stack) > 0, F.col(stack)).otherwise(default_stack))


def replace_thin(df: DataFrame, side: DataFrame, key: str, text: str, thin: Column) -> DataFrame:
    """Put a longer text in place of a thin one."""
    out = df.join(side.select(key, F.col(text).alias("_longer")), key, "left")
    use = thin & (F.length("_longer") > F.length(text))
    return out.withColumn(text, F.when(use, F.col("_longer")).otherwise(F.col(text))).drop("_longer")


def best_evidence(
    df: DataFrame, layout: DataFrame, hints: DataFrame, key: str, counts: Sequence[str], *, is_plugin: str = "is_plugin",
    error: str = "error", shell: str = "is_marketplace",
) -> DataFrame:
    """Counts from the file layout; 0 after an error or for a shell; else the hinted ones."""
    lay = layout.select(key, is_plugin, error, shell, *[F.col(c).alias(f"_l_{c}") for c in counts])
    hin = hints.select(key, *[F.col(c).alias(f"_h_{c}") for c in counts])
    out = df.join(lay, key, "left").join(hin, key, "left")
    use_layout = F.coalesce(is_plugin, F.lit(False)) & ~F.coalesce(shell, F.lit(False))
    nothing = F.col(error).isNotNull() | F.coalesce(shell, F.lit(False))
    zero = F.lit(0)
    return out.withColumns({
        c: F.when(use_layout, F.coalesce(f"_l_{c}", zero)).when(nothing, zero).otherwise(F.coalesce(f"_h_{c}", zero))
        for c in counts
    }).drop(*[f"_{s}_{c}" for s in "lh" for c in counts])


def choose_content(
    df: DataFrame, *, bundle: str, readme: str, description: str, shared: Column, bundle_for: Column,
) -> DataFrame:
    """``content``: bundle text, else file text, else the description; shared files get the description in front.

    ``content_from`` is null where there is nothing; those rows belong in the review queue.
    """
    use_bundle = bundle_for & F.col(bundle).isNotNull()
    main = F.when(use_bundle, F.col(bundle)).otherwise(F.col(readme))
    heading = F.when(use_bundle, "## Plugin Bundle\n").otherwise("## Repository README\n")
    said = F.length(description) > 0
    prefixed = F.concat(F.lit("## Resource Description\n"), F.col(description), F.lit("\n\n"), heading, main)
    content = F.when(main.isNotNull(), F.when(shared & said, prefixed).otherwise(main)).when(said, F.col(description))
    origin = F.when(use_bundle, "bundle").when(F.col(readme).isNotNull(), "readme").when(said, "description")
    return df.withColumn("content", content).withColumn("content_from", origin)
