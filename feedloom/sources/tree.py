"""File trees of repositories: roots, component classes, hooks and servers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.values import col, empty_as_null
from ..operators.relational import skew_join
from ..session import cut

NESTED_ROOTS = 5


def plugin_roots(files: DataFrame, keys: Sequence[str] = ("repo",), path: str = "path", marker: str = fixed.PLUGIN_MARKER) -> DataFrame:
    """(keys, root): folders that hold the marker file, without any dot folder on the way ("" is the top)."""
    p = F.col(path)
    root = F.when(p == marker, F.lit("")).when(p.endswith("/" + marker), F.substring(p, F.lit(1), F.length(p) - len(marker) - 1))
    return files.select(*keys, root.alias("root")).filter(
        F.col("root").isNotNull() & ~F.col("root").rlike(r"(^|/)\.")
    ).distinct()


def folders_above(path: Column | str) -> Column:
    """Every folder above a file, from the top ("") down."""
    parts = F.split(col(path), "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def deepest_root(files: DataFrame, roots: DataFrame, keys: Sequence[str] = ("repo",), path: str = "path") -> DataFrame:
    """(keys, path, root): each file with the deepest root above it.

    The folders above a file are looked up among the roots, so "is a prefix of" is an equi-join.
    """
    up = files.select(*keys, path, F.explode(folders_above(path)).alias("root"))
    hit = skew_join(up, roots.select(*keys, "root"), [*keys, "root"], "left_semi", spread=[path, "root"])
    # a root above a file is the beginning of its path
    return hit.groupBy(*keys, path).agg(F.max(F.length("root")).alias("_n")).select(*keys, path, F.substring(F.col(path), F.lit(1), F.col("_n")).alias("root"))


def component_class(path: Column | str, root: Column | str, allowed: Sequence[str] = fixed.COMPONENT_DOT_DIRS) -> Column:
    """skill, agent or command by where a file lies below its root; null for other files.

    Files below dot folders that are not allowed belong to nothing.
    """
    p, r = col(path), col(root)
    rel = F.when(r == "", p).otherwise(F.substr(p, F.length(r) + 2))
    parts = F.split(rel, "/")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    hidden = F.exists(folders, lambda s: s.startswith(".") & ~s.isin(*allowed))
    within = lambda *names: F.arrays_overlap(parts, F.array(*map(F.lit, names)))
    return F.when(hidden, None).when(p.endswith("SKILL.md") & within("skills"), "skill").when(
        p.endswith(".md") & within("agents", ".agents"), "agent"
    ).when(p.endswith(".md") & within("commands", ".commands"), "command")


def layouts(files: DataFrame, targets: DataFrame, keys: Sequence[str] = ("repo",), path: str = "path", nested: int = NESTED_ROOTS) -> DataFrame:
    """(keys, root, is_plugin, is_marketplace, skills, agents, commands) of the asked roots.

    A root is a marketplace when it has a ``plugins`` folder and either no marker of its own or at
    least ``nested`` plugins below that folder; its own files are then not counted.
    """
    keys = list(keys)
    files = cut(files.select(*keys, path))  # read for roots, for counts and for folders
    roots = cut(plugin_roots(files, keys, path))
    owned = deepest_root(files, roots, keys, path).withColumn("class", component_class(path, "root"))
    counts = owned.groupBy(*keys, "root").agg(
        *[F.count_if(F.col("class") == c).alias(c + "s") for c in ("skill", "agent", "command")]
    )
    # files and roots below "<folder>/plugins/", counted per folder
    below = lambda c: F.transform(
        F.filter(folders_above(c), lambda f: (f == "plugins") | f.endswith("/plugins")),
        lambda f: F.regexp_replace(f, "(^|/)plugins$", ""),
    )
    has_folder = files.select(*keys, F.explode(F.array_distinct(below(path))).alias("root")).groupBy(*keys, "root").agg(
        F.lit(True).alias("_folder")
    )
    inner = roots.select(*keys, F.explode(F.array_distinct(below(F.concat("root", F.lit("/x"))))).alias("root")).groupBy(*keys, "root").agg(
        F.count(F.lit(1)).alias("_nested")
    )
    on = [*keys, "root"]
    out = targets.select(*on).distinct().join(roots.withColumn("is_plugin", F.lit(True)), on, "left")
    out = out.join(has_folder, on, "left").join(inner, on, "left").join(counts, on, "left")
    own = F.coalesce("is_plugin", F.lit(False))
    market = F.coalesce("_folder", F.lit(False)) & (~own | (F.coalesce("_nested", F.lit(0)) >= nested))
    shown = lambda c: F.when(own & ~market, F.coalesce(c, F.lit(0))).otherwise(F.lit(0))
    return out.select(*on, own.alias("is_plugin"), market.alias("is_marketplace"), *[shown(c).alias(c) for c in ("skills", "agents", "commands")])


# --- names (A25) and facts (A19) ---------------------------------------------------------------------


def skill_name_of_path(path: Column | str, root: Column | str) -> Column:
    """Folder below ``skills`` at the root, else the folder that holds the file."""
    p, r = col(path), col(root)
    rel = F.when((r != "") & F.startswith(p, F.concat(r, F.lit("/"))), F.substr(p, F.length(r) + 2)).otherwise(p)
    parts = F.split(rel, "/")
    return F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "skills"), F.get(parts, F.lit(1))).when(
        F.size(parts) >= 2, F.element_at(parts, -2)
    ).otherwise("unknown")


def plugin_name(repo: Column | str, root: Column | str, manifest_name: Column | str) -> Column:
    """Last part of the root; at the top the manifest's name, else the repository's."""
    named = empty_as_null(F.trim(col(manifest_name)))
    top = F.coalesce(named, F.element_at(F.split(col(repo), "/"), -1))
    return F.when(F.length(col(root)) > 0, F.element_at(F.split(col(root), "/"), -1)).otherwise(top)


def namespace(plugin: Column | str, skill: Column | str) -> Column:
    return F.concat(col(plugin), F.lit(":"), col(skill))


def hook_facts(raw: Column | str) -> Column:
    """Struct (events, entries): sorted hook events that list something, and how much in all."""
    hooks = F.from_json(F.get_json_object(col(raw), "$.hooks"), "map<string,string>")
    count = lambda v: F.json_array_length(v)
    listed = F.map_filter(hooks, lambda k, v: count(v).isNotNull())
    total = F.aggregate(F.map_values(listed), F.lit(0), lambda acc, v: acc + count(v))
    return F.struct(
        F.coalesce(F.array_sort(F.map_keys(listed)), F.array().cast("array<string>")).alias("events"),
        F.coalesce(total, F.lit(0)).alias("entries"),
    )


def server_names(manifest: Column | str, servers_file: Column | str, field: str = "mcpServers") -> Column:
    """Sorted names of the servers in the manifest and in the servers file (with or without the outer field)."""
    none = F.array().cast("array<string>")
    keys = lambda c: F.coalesce(F.json_object_keys(c), none)
    inner = F.get_json_object(col(manifest), f"$.{field}")
    other = F.get_json_object(col(servers_file), f"$.{field}")
    return F.array_sort(F.array_union(keys(inner), keys(F.coalesce(other, F.when(other.isNull(), col(servers_file))))))


# --- listed and present (A24) --------------------------------------------------------------------------


def with_file(listed: DataFrame, files: DataFrame, *, name: str, path: str = "path", folder: str = "skills", file: str = "SKILL.md", depth: int | None = None) -> DataFrame:
    """Listed rows whose ``folder/<name>/.../file`` is in the tree; ``depth`` fixes the number of path parts."""
    parts = F.split(F.col(path), "/")
    ok = (F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == folder) & (F.upper(F.element_at(parts, -1)) == file.upper())
    if depth is not None:
        ok = ok & (F.size(parts) == depth)
    there = files.filter(ok).select(F.get(parts, F.lit(1)).alias(name)).distinct()
    return listed.join(there, name, "left_semi")
