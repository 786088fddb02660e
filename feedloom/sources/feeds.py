"""Nested feeds: registry pages, prompt lists, install snapshots, marketplaces, result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed, jsons, scores, text as X
from ..functions.values import col, empty_as_null, folded_union
from ..operators.filters import active_and_latest
from ..operators.relational import first_per_key
from ..session import cut
from .tables import empty_frame, path_exists, read_json_table

# --- registry snapshot (A4) --------------------------------------------------------------------

REGISTRY_DDL = (
    "servers array<struct<server:struct<name:string,title:string,description:string,version:string,websiteUrl:string,"
    "repository:struct<source:string,url:string,subfolder:string>,"
    "packages:array<struct<registryType:string,identifier:string,version:string>>,"
    "remotes:array<struct<type:string,url:string>>>,"
    "_meta:map<string,struct<status:string,isLatest:boolean,publishedAt:string>>>>, metadata struct<nextCursor:string>"
)


def registry_rows(pages: DataFrame, meta_key: str) -> DataFrame:
    """One row per listed server with its status, whether it is the latest, and when it was published."""
    rows = pages.select(F.explode("servers").alias("s"))
    meta = F.try_element_at("s._meta", F.lit(meta_key))
    return rows.select("s.server.*", meta["status"].alias("status"), meta["isLatest"].alias("is_latest"), meta["publishedAt"].alias("published_at"))


def registry_entries(rows: DataFrame, base_url: str, today: str) -> DataFrame:
    """Registry rows as catalog entries."""
    name = F.coalesce(F.col("name"), F.lit(""))
    repo_url = F.regexp_replace(F.col("repository.url"), "/+$", "")
    sub = F.regexp_replace(F.coalesce(F.col("repository.subfolder"), F.lit("")), "^/+|/+$", "")
    hosted = (F.lower("repository.source") == "github") & (F.length(repo_url) > 0)
    # a blank becomes + in form encoding; in a path it is %20
    encoded = F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))
    url = F.when(
        F.coalesce(hosted, F.lit(False)), F.when(F.length(sub) > 0, F.concat(repo_url, F.lit("/tree/HEAD/"), sub)).otherwise(repo_url)
    ).otherwise(F.concat(F.lit(base_url + "/"), encoded))
    pkg = F.get("packages", F.lit(0))
    return rows.select(
        X.hashed_id(name).alias("id"),
        F.coalesce(empty_as_null("title"), name).alias("name"),
        F.lit("mcp").alias("type"),
        F.coalesce("description", F.lit("")).alias("description"),
        url.alias("source_url"),
        F.lit("tooling").alias("category"),
        F.struct(
            F.lit("manual").alias("method"),
            F.lower(pkg["registryType"]).alias("registry_type"), pkg["identifier"].alias("identifier"), pkg["version"].alias("version"),
            jsons.package_command(pkg["registryType"], pkg["identifier"], pkg["version"]).alias("command"),
        ).alias("install"),
        jsons.filled_remotes("remotes").alias("mcp_remotes"),
        F.coalesce("version", F.lit("")).alias("version"),
        F.coalesce("status", F.lit("")).alias("mcp_registry_status"),
        F.coalesce("published_at", F.lit("")).alias("mcp_registry_published_at"),
        F.lit(today).alias("last_synced"),
        "is_latest",
    )


def active_entries(entries: DataFrame) -> DataFrame:
    return entries.filter(active_and_latest("mcp_registry_status", "is_latest"))


# --- prompt list (A5) -----------------------------------------------------------------------------


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with fields over several lines."""
    if not path_exists(spark, path):
        return empty_frame(spark, "act string, prompt string, for_devs string")
    options = {"header": True, "multiLine": True, "escape": '"', "maxCharsPerColumn": -1}
    return spark.read.options(**options).schema("act string, prompt string, for_devs string").csv(path)


def prompt_entries(rows: DataFrame, words: Sequence[str] = fixed.PROMPT_WORDS, *, act: str = "act", prompt: str = "prompt", flag: str = "for_devs",
    look: int | None = None, classify: int | None = None, say: int = 200,
) -> DataFrame:
    """Rows flagged for developers, or with one of the words in the name or the text.

    ``look`` and ``classify`` limit the characters of the text that words and category are looked for in; ``say`` is the
    length of the description.
    """
    part = lambda c, n: c if n is None else F.substring(c, 1, n)
    name, body = F.trim(F.coalesce(col(act), F.lit(""))), F.trim(F.coalesce(col(prompt), F.lit("")))
    for_devs = F.upper(F.trim(F.coalesce(col(flag).cast("string"), F.lit("")))) == "TRUE"
    about = X.has_word(F.concat_ws(" ", name, part(body, look)), words)
    kept = rows.filter((F.length(name) > 0) & (for_devs | about))
    kept = kept.withColumn("_t", X.joined_text(name, part(body, classify)))
    none = F.array().cast("array<string>")
    kept = kept.withColumn("_t", F.concat_ws(" ", "_t", F.array_join(X.extract_tags("_t"), " ")))
    out = kept.select(
        "*",
        F.concat(X.kebab(name), F.lit("-prompt")).alias("id"),
        name.alias("name"),
        F.trim(F.replace(F.substring(body, 1, say), F.lit("\n"), F.lit(" "))).alias("description"),
        F.concat(X.extract_tags("_t"), F.when(for_devs, F.array(F.lit("for-devs"))).otherwise(none)).alias("tags"),
        X.categorize("_t").alias("category"),
    )
    return out.filter(F.col("id") != "-prompt").drop("_t")


# --- install snapshot (A15) ------------------------------------------------------------------------


def install_entries(rows: DataFrame, today: str, least: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(entries, rejected): listed skills from an install count on; later rows of an id are rejected."""
    kept = rows.filter(F.coalesce("installs", F.lit(0)) >= least)
    skill = F.coalesce(empty_as_null("skillId"), empty_as_null("name") if "name" in rows.columns else F.lit(None), F.lit(""))
    url = F.regexp_replace(F.coalesce("githubUrl", F.lit("")), "/+$", "")
    listed = (F.length("owner") > 0) & (F.length("repo") > 0) & (F.length(skill) > 0)
    out = kept.select(
        X.composite_id(skill, "owner", "repo").alias("id"), skill.alias("name"), F.lit("skill").alias("type"),
        F.coalesce(empty_as_null("displayName"), skill).alias("description"),
        F.when((F.length(url) > 0) & (F.length(skill) > 0), F.concat(url, F.lit("#skill="), skill)).otherwise(url).alias("source_url"),
        F.col("installs").alias("install_count"),
        F.when(listed, F.concat_ws("/", F.lit("https://skills.sh"), "owner", "repo", skill)).otherwise("").alias("skills_sh_url"),
        F.lit(today).alias("last_synced"), "_ord",
    )
    from ..operators.linkage import rejects_by_first_seen

    return rejects_by_first_seen(cut(out), "id", "_ord")  # ids are worked out once, for kept and rejected rows


# --- marketplaces (A16, A17, A25) --------------------------------------------------------------------

MARKETPLACE_DDL = (
    "repo string, branch string, source_id string, plugins array<struct<name:string,description:string,version:string,"
    "category:string,tags:array<string>,author:variant,source:variant>>"
)


def source_address(source: Column, repo: Column, branch: Column) -> Column:
    """Address of a plugin from the shapes its source may have: object, ``github:``, URL, ``git+``, path, or nothing."""
    get = lambda path: F.try_variant_get(source, path, "string")
    kind = F.schema_of_variant(source)
    is_object, is_text = kind.startswith("OBJECT"), kind == "STRING"
    own = F.concat(F.lit("https://github.com/"), repo)
    from_repo = is_object & (get("$.source") == "github") & (F.length(get("$.repo")) > 0)
    s = F.when(is_text, get("$")).when(is_object, get("$.url"))
    sub = F.regexp_replace(F.regexp_replace(s, "^[./]+", ""), "^/+", "")
    return F.coalesce(
        F.when(from_repo, F.concat(F.lit("https://github.com/"), get("$.repo"))),
        F.when(s.startswith("github:"), F.concat(F.lit("https://github.com/"), F.substr(s, F.lit(8)))),
        F.when(s.rlike("^https?://"), s),
        F.when(s.startswith("git+"), F.substr(s, F.lit(5))),
        F.when(s.rlike(r"^(\./|/)"), F.concat(own, F.lit("/tree/"), branch, F.lit("/"), sub)),
        own,
    )


def author_name(author: Column) -> Column:
    get = lambda p: empty_as_null(F.try_variant_get(author, p, "string"))
    return F.coalesce(F.when(F.schema_of_variant(author) == "STRING", get("$")).otherwise(F.coalesce(get("$.name"), get("$.email"))), F.lit(""))


def marketplace_entries(manifests: DataFrame, own_manifests: DataFrame | None = None) -> DataFrame:
    """Plugins of marketplace manifests as entries; a missing manifest is made up from what the list says.

    ``own_manifests`` has (repo, name) and the fields of the plugin's own manifest; of several for one plugin the first counts,
    by ``place`` where there is such a column (the places a manifest is looked for), then by its fields.
    """
    p = manifests.select("repo", "branch", "source_id", F.explode("plugins").alias("p")).select("repo", "branch", "source_id", "p.*")
    p = p.withColumn("name", F.trim("name")).filter(F.length("name") > 0)
    p = p.withColumns({
        "description": F.trim(F.coalesce("description", F.lit(""))), "version": F.trim(F.coalesce("version", F.lit(""))),
        "author": author_name(F.col("author")), "source_url": source_address(F.col("source"), F.col("repo"), F.col("branch")),
    }).drop("source")
    fields = ("name", "version", "description", "author")
    if own_manifests is None:
        p = p.withColumn("_has", F.lit(False)).withColumns({f"_m_{f}": F.lit(None).cast("string") for f in fields})
    else:
        place = [c for c in ("place", *fields[1:]) if c in own_manifests.columns]
        m = first_per_key(own_manifests, ["repo", "name"], [F.asc(c) for c in place])
        m = m.select("repo", "name", *[F.col(f).alias(f"_m_{f}") for f in fields[1:]], F.lit(True).alias("_has"))
        p = p.join(m.withColumn("_m_name", F.col("name")), ["repo", "name"], "left").withColumn("_has", F.coalesce("_has", F.lit(False)))
    made = ~F.col("_has") & ((F.length("description") > 0) | (F.length("version") > 0) | (F.length("author") > 0))
    shown = [F.when(F.col("_has"), F.col(f"_m_{f}")).when(made, F.col(f)) for f in fields]
    completeness = scores.manifest_completeness(shown, F.col("_has") | made)
    p = p.withColumns({
        "manifest_completeness": completeness,
        "description": F.coalesce(empty_as_null("description"), F.trim("_m_description"), F.lit("")),
        "version": F.coalesce(empty_as_null("version"), F.trim("_m_version"), F.lit("")),
    })
    p = p.withColumn("_t", X.joined_text("name", "description"))
    p = p.withColumn("tags", folded_union("tags", X.extract_tags("_t")))
    p = p.withColumn("_t", X.joined_text("name", "description", F.array_join("tags", " "), "category"))
    return p.select(
        F.concat_ws("-", X.clean_id("source_id", r"[\s_./]+"), X.clean_id("name", r"[\s_./]+")).alias("id"), "name", F.lit("plugin").alias("type"),
        "description", "source_url", X.categorize("_t", "category").alias("category"), "tags", "version", "repo", "source_id",
        "manifest_completeness",
    )


def community_entries(rows: DataFrame, least: int = 5000, order: str = "_ord", fallback: str = "community") -> DataFrame:
    """Registry rows from a star count on, each uid once, with id ``namespace-name``."""
    starred = rows.filter(F.coalesce(F.col("stars").try_cast("bigint"), F.lit(0)) >= least).filter(F.length(F.trim("name")) > 0)
    uid = F.coalesce(F.col("uid"), F.concat_ws("::", "namespace", "name"))
    once = first_per_key(starred.withColumn("_uid", uid), ["_uid"], [F.asc(order)]).drop("_uid")
    return once.withColumns({"id": X.namespaced_id("namespace", F.trim("name"), fallback), "type": F.lit("plugin")})


# --- result files (A20) ----------------------------------------------------------------------------

ARTIFACT_DDL = (
    "type string, rubric_version string, generated_at string, succeeded array<struct<entry_id:string,evaluation:string>>, "
    "failed array<string>, skipped_quarantined array<string>, skipped_deferred array<string>"
)


def read_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per result file of a run. An unreadable file gives no row, so its type counts as failed."""
    return read_json_table(spark, folder, ARTIFACT_DDL, array_file=True)


def artifact_results(artifacts: DataFrame) -> DataFrame:
    """(type, entry_id, evaluation) of all succeeded rows that have a result."""
    rows = artifacts.select("type", F.explode("succeeded").alias("s")).select("type", "s.entry_id", F.coalesce(
        F.get_json_object("s.evaluation", "$"), "s.evaluation").alias("evaluation"))  # without the blanks of the file
    return rows.filter((F.length("entry_id") > 0) & F.col("evaluation").isNotNull())


def artifact_cells(artifacts: DataFrame, types: Sequence[str] = fixed.TYPES) -> DataFrame:
    """(type, present, failed, quarantined): one row per expected type; a type without a file has failed."""
    frame = artifacts.sparkSession.createDataFrame([(t,) for t in types], "type string")
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    have = artifacts.select("type", F.lit(True).alias("present"), n("failed").alias("failed"), n("skipped_quarantined").alias("quarantined"))
    joined = frame.join(have, "type", "left")
    return joined.na.fill(0, ["failed", "quarantined"]).na.fill(False, ["present"])
