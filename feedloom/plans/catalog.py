"""From feeds to the published catalog: the operators in the order of a run.

A run is: read, ``merge``, ``link_bundles``, ``evaluate_plan``, ``apply_results`` (or ``score``, where
results are plain numbers), ``publish``. State goes through ``operators.state``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed, scores, text as X, urls
from ..functions.values import first_rule
from ..operators import checks, filters, linkage, overlay, report, scoring, select, state
from ..session import cut
from ..sources import tables

ORDER = "_ord"
LAST_TIER = 1_000_000  # behind every feed
SIDE_EFFECTS = (
    "health_mean", "freshness_label", "health_signals", "description_zh", "description_original", "search_terms", "highlights",
    "install_state", "install_tags",
)


@dataclass(frozen=True)
class Merged:
    """What a merge gives: the entries, and the report of what de-duplication dropped."""

    entries: DataFrame
    report: DataFrame


def with_keys(entries: DataFrame) -> DataFrame:
    """Identity key, its rank, and the address key that types with shared addresses do not have."""
    own_url = F.when(~F.col("type").isin(*fixed.URL_SHARING_TYPES), urls.normalize_url("source_url"))
    return entries.withColumns({
        "identity": linkage.identity_key(),
        "_rank": linkage.identity_rank(),
        "url_key": F.when(F.length("source_url") > 0, own_url),
    })


def deduplicate(entries: DataFrame) -> DataFrame:
    """Identity collapse with donor fields, then the greedy pass over id and address."""
    keyed = with_keys(entries)
    of = lambda t: F.col("type") == t
    # field: kind, and the one type whose rows lend it to each other
    donors = {
        "install_count": ("number", of("skill")), "skills_sh_url": ("string", of("skill")), "skills_sh_scraped_at": ("string", of("skill")),
        "mcp_registry_status": ("string", of("mcp")), "mcp_registry_published_at": ("string", of("mcp")), "mcp_remotes": ("array", of("mcp")),
        "description_zh": ("string", of("plugin")),
    }
    lists = {c: of("plugin") for c in ("tags", "tech_stack", "highlights")}
    only = {c: cond for c, (_, cond) in donors.items()} | lists
    joined = linkage.collapse_with_donors(
        keyed, "identity", ["_rank", ORDER], {c: kind for c, (kind, _) in donors.items()}, list(lists), only=only
    )
    # the greedy rounds read the collapsed rows again and again: write them once
    collapsed = cut(joined.withColumn("_id_key", F.when(F.length("id") > 0, F.col("id"))))
    return linkage.greedy_first_wins(collapsed, ["_id_key", "url_key"], ORDER).drop("_id_key", "identity", "_rank")


def merge(feeds: Sequence[tuple[DataFrame, str]], curated: DataFrame, previous: DataFrame, today: str) -> Merged:
    """Union the feeds in tier order, de-duplicate, overlay hand-made rows and history, repair, link.

    ``feeds`` are (table, position column); ``curated`` has the same columns and an order column.
    ``previous`` is the last published catalog; its order column, if it has one, decides between
    old rows of one address, else their ids do.
    """
    raw = tables.tiered_union(feeds, ORDER)
    kept = cut(deduplicate(raw))
    report = linkage.dedup_report(raw, kept)
    kept = kept.filter(filters.complete_plugins("type", "install.marketplace_repo", "install.marketplace_verified"))
    full_key = F.when(F.length("source_url") > 0, urls.normalize_url("source_url"))
    kept = kept.withColumn("url_key", full_key)
    extra = curated.withColumn("url_key", full_key).select(kept.columns)
    merged = cut(overlay.overlay_curated(kept, extra))
    merged = merged.withColumn("_t", X.joined_text("name", "description", F.array_join("tags", " ")))
    merged = checks.repair_category(merged, F.col("_t")).drop("_t")
    old = previous.select("id", F.col("pushed_at").alias("_old_pushed"))
    merged = merged.join(old, "id", "left")
    merged = overlay.backfill(merged, "pushed_at", "_old_pushed", "mcp_registry_published_at").drop("_old_pushed")
    old_pos = F.col(f"{ORDER}.pos") if ORDER in previous.columns else F.xxhash64("id")
    dated = previous.withColumns({
        "url_key": full_key, ORDER: F.struct(F.lit(LAST_TIER).alias("tier"), old_pos.alias("pos")),
        "added_at": F.when(
            F.col("type").isin(*fixed.LIFECYCLE_TYPES), overlay.backfill_first_seen("added_at", X.parse_time("pushed_at"), X.parse_time("last_synced"), today)
        ),
    })
    cols = ["id", "type", "url_key", "added_at", ORDER]
    prior = merged.select(*cols).unionByName(dated.select(*cols))
    merged = overlay.first_seen(merged, prior, today)
    return Merged(merged, report)


def link_bundles(entries: DataFrame) -> DataFrame:
    """``bundled_in`` of skills that a plugin lists."""
    plugins = entries.filter("type = 'plugin' and size(bundle.skills_namespaces) > 0").select(
        F.col("id").alias("plugin_id"), F.col("bundle.skills_namespaces").alias("namespaces"), urls.owner_repo("source_url").alias("repo"), ORDER
    )
    tail = F.regexp_extract("source_url", r".*/skills/([^/]+)", 1)  # behind the last /skills/
    skills = entries.filter("type = 'skill'").select(
        "id", "namespace", F.when(F.length(tail) > 0, tail).alias("tail"), urls.owner_repo("source_url").alias("repo"), ORDER
    )
    owners = overlay.owner_of_member(overlay.resolve_members(plugins, skills), plugins)
    bundled = owners.select(F.col("member").alias("id"), F.col("plugin_id").alias("bundled_in"))
    return entries.join(bundled, "id", "left")


def score(entries: DataFrame, results: DataFrame, as_of: str, zero_sources: Sequence[str] = ()) -> DataFrame:
    """Signals, both health numbers, final score, decision and label of every entry.

    ``results`` has (id, quality, relevance); entries without a row are scored by health alone.
    """
    e = entries.withColumns({"repo": urls.repo_slug("source_url"), "_pushed": X.parse_time("pushed_at")})
    e = scoring.star_weight(e, zero_sources=zero_sources, spread=["id"])
    cols = scoring.health_columns(as_of, "skill", pushed_at="_pushed")
    plugin = scoring.health_columns(as_of, "plugin", pushed_at="_pushed")
    e = e.withColumns({k: F.when(F.col("type") == "plugin", plugin[k]).otherwise(c) for k, c in cols.items() if k != "manifest_completeness"})
    e = e.join(results.select("id", "quality", "relevance"), "id", "left")
    e = e.withColumn("final_score", scores.blend(F.col("quality"), F.col("health_weighted")))
    return e.withColumns({
        "decision": scores.decision("final_score", "relevance"),
        "health_mean": scores.health_mean(F.col("freshness"), F.col("popularity"), F.col("source_trust")),
        "freshness_label": scores.freshness_label("freshness"),
    }).drop("_pushed", "repo")


def evaluate_plan(entries: DataFrame, ledger: DataFrame, completed: DataFrame, cache: DataFrame, unstable: DataFrame | None, as_of: str) -> DataFrame:
    """``path`` of each entry this run: reuse, evaluate, or why it waits."""
    gated = overlay.ledger_gate(entries.withColumn("entry_id", F.col("id")), ledger, as_of)
    live = state.cache_purge(cache, as_of)
    routed = overlay.reuse_or_evaluate(
        gated.withColumn("raw_id", F.coalesce(X.id_from_listing_url("skills_sh_url", r"skills\.sh"), F.col("id"))),
        unstable, live.select("entry_id"), derived=F.length("skills_sh_url") > 0,
    )
    done = completed.select(F.col("entry_id").alias("id")).distinct().withColumn("_done", F.lit(True))
    routed = routed.join(done, "id", "left")
    path = F.when(F.col("gate") != "eligible", F.col("gate")).when(F.col("_done"), "completed").otherwise(F.col("path"))
    return routed.withColumn("path", path).drop("_done", "gate", "raw_id", "entry_id")


def apply_results(
    entries: DataFrame, results: DataFrame, previous: DataFrame, cells: DataFrame, side_effects: Sequence[str] = SIDE_EFFECTS
) -> tuple[DataFrame, DataFrame]:
    """(entries, run status): this run's result, else the last one, else health under review.

    ``results`` are nested results by ``entry_id`` (see ``scoring.flatten_result``), ``previous`` the
    last catalog, ``cells`` one row per type with what its run reports.
    """
    fresh = scoring.flatten_result(entries, results)
    new = results.select(F.col("entry_id").alias("id"), F.lit(True).alias("_new"))
    kept = [c for c in side_effects if c in fresh.columns and c in previous.columns]
    takeover = list(dict.fromkeys(["final_score", "decision", *kept, "description", "description_original"]))
    old = previous.select("id", *[(F.col(c) if c in previous.columns else F.lit(None).cast("string")).alias(f"_o_{c}") for c in takeover])
    joined = fresh.join(new, "id", "left").join(old, "id", "left")
    is_new = F.coalesce("_new", F.lit(False))
    had = F.col("_o_final_score").isNotNull()
    rewritten = ~is_new & (F.length("_o_description_original") > 0) & (F.length("_o_description") > 0)
    stand_in = scoring.health_only_result("health_mean")
    pick = lambda c, made: F.when(is_new, F.col(c)).when(had, F.col(f"_o_{c}")).otherwise(made)
    out = {
        "provenance": F.when(is_new, "new").when(had, "old").otherwise("synth"),
        "final_score": pick("final_score", stand_in["final_score"]),
        "decision": F.coalesce(pick("decision", stand_in["decision"]), F.lit("review")),
        "description": F.when(rewritten, F.col("_o_description")).otherwise(F.col("description")),
        **{c: F.when(is_new, F.col(c)).otherwise(F.coalesce(F.col(f"_o_{c}"), F.col(c))) for c in kept},
    }
    done = joined.withColumns(out).drop("_new", *[f"_o_{c}" for c in takeover])
    return done, report.run_status(done, cells)


def featured_picks(entries: DataFrame) -> DataFrame:
    """Picks per scene: servers by stars, one per repository; then skills, rules and prompts by source.

    One entry per name or repository over all of them; bundled skills are left out.
    """
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda x: F.lower(x))
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    e = entries.withColumns({"scene": X.scene(low("name"), tags, low("description"), low("category")), "_name": low("name")})
    rank_of = lambda *sources: first_rule([(F.col("source") == s, i) for i, s in enumerate(sources)], 99).cast("long")

    def rows(type_: str, where: Column, key: Column, first: Column, second: Column, name: Column) -> DataFrame:
        order = F.struct(first.alias("first"), second.alias("second"), name.alias("name"), F.col(ORDER).alias("last"))
        return e.filter((F.col("type") == type_) & where).select("scene", key.alias("key"), order.alias(ORDER), "id")

    always, zero, blank = F.lit(True), F.lit(0).cast("long"), F.lit("")
    repo = F.coalesce(urls.repo_slug("source_url"), F.col("source_url"))
    passes = [
        (rows("mcp", F.col("stars") > 0, repo, -F.col("stars"), zero, blank), 4),
        (rows("skill", F.col("bundled_in").isNull(), F.col("_name"), rank_of("curated", "anthropics-skills", "ai-agent-skills"), zero, F.col("name")), 2),
        (rows("rule", always, F.col("_name"), rank_of("curated", "rules-2.1-optimized", "awesome-cursorrules"), -F.size(tags).cast("long"), blank), 2),
        (rows("prompt", always, F.col("_name"), rank_of("curated", "wonderful-prompts", "prompts-chat"), zero, F.col("name")), 1),
    ]
    picks = select.featured(passes, [s for s, _ in fixed.SCENES], order=ORDER)
    # at most a few dozen picks come back; their place leads to their entries
    placed = picks.select("pass", "scene", F.col(f"{ORDER}.last").alias(ORDER))
    return entries.join(F.broadcast(placed), ORDER)


def search_table(entries: DataFrame) -> DataFrame:
    return filters.search_projection(entries)


def publish(entries: DataFrame, path: str, version: str, dry_run: bool = True) -> bool:
    """Write the ordered catalog, the search table and the files per type below ``path/version``, then point to them.

    Readers ask ``published`` for the folder, so a run that dies in between changes nothing for them; run again under
    the same version it replaces what it left. Nothing is written for an empty run.
    """
    spark, path = entries.sparkSession, path.rstrip("/")
    if state.current_state(spark, path)[1] == version:
        return True
    folder = f"{path}/{version}"
    kept = cut(scoring.drop_rejects(entries, dry_run=dry_run))  # four tables are written from it
    order = select.catalog_order()

    def write(df: DataFrame) -> None:
        tables.write_json(df, f"{folder}/index", order)
        tables.write_json(search_table(df), f"{folder}/search")
        tables.publish_partitions(df, f"{folder}/types", order=order)
        documents = tables.entry_documents(df).repartitionByRange("type", "file_id")
        documents.write.mode("overwrite").partitionBy("type").json(f"{folder}/entries")
        state.point_to(spark, path, version)

    return tables.publish_if_rows(kept, write)


def published(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that is current; None before the first."""
    version = state.current_state(spark, path)[1]
    return None if version is None else f"{path.rstrip('/')}/{version}"
