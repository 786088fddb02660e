"""Filters, predicates and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, urls
from ..functions.text import has_word
from ..functions.values import col, empty_as_null, first_rule
from .relational import HOT_ROWS, hot_keys


def drop_listed_urls(df: DataFrame, skip: DataFrame, *, key: str, url: str, skip_url: str) -> DataFrame:
    """Drop rows whose address equals or lies below a listed one.

    Every address above the candidate's own is looked up, so containment is an equi-join; the rows
    found are then dropped by their unique key.
    """
    listed = skip.select(urls.normalize_skip_url(skip_url).alias("_p")).filter(F.length("_p") > 0)
    above = df.select(key, F.explode(urls.path_prefixes(urls.normalize_skip_url(url))).alias("_p"))
    hit = above.join(listed, "_p", "left_semi").select(key)
    return df.join(hit, key, "left_anti")


def drop_listed_pairs(df: DataFrame, listed: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Drop rows whose (source, name) is listed, without case and outer blanks; a blank part never matches."""
    fold = lambda c: empty_as_null(F.lower(F.trim(F.col(c))))
    names = [f"_k{i}" for i in range(len(left))]
    marked = df.withColumns({n: fold(c) for n, c in zip(names, left)})
    other = listed.select(*[fold(c).alias(n) for n, c in zip(names, right)])
    return marked.join(other, names, "left_anti").select(df.columns)


def popular_enough(stars: Column | str, least: int = 10) -> Column:
    """Unknown stars pass, and 0 counts as unknown."""
    s = F.nullif(col(stars), F.lit(0))
    return s.isNull() | (s >= least)


def active_and_latest(status: Column | str, latest: Column | str, active: str = "active") -> Column:
    return F.coalesce((col(status) == active) & col(latest), F.lit(False))


def spam_rules(text: Column, words: Sequence[str] = fixed.SPAM_WORDS) -> list[tuple[Column, str]]:
    return [(text.contains(w), f"spam: {w}") for w in words]


def reject_reason(
    *, stars: Column, description: Column, text: Column, category: Column, known: Column,
    spam: Sequence[str] = fixed.SPAM_WORDS, off_topic: Sequence[str] = fixed.OFF_TOPIC_CATEGORIES,
) -> Column:
    """First failing rule, or null for a row that passes. ``text`` and ``category`` are in lower case."""
    return first_rule([
        (stars <= 50, "stars <= 50"),
        (F.length(description) <= 20, "description too short"),
        *spam_rules(text, spam),
        (category.isin(*off_topic), F.concat(F.lit("non-coding category: "), category)),
        (known, "duplicate with Tier 1"),
    ])


def name_reason(name: Column | str, description: Column | str) -> Column:
    """Why a name is bad, or null."""
    n, d = col(name), col(description)
    return first_rule([
        (F.length(n) < 3, "name too short"),
        (F.length(n) > 60, "name too long"),
        (n.rlike(r"(.{2,})\1+"), "repeating pattern in name"),
        (F.lower(F.trim(d)) == F.lower(F.trim(n)), "description equals name"),
    ])


def is_about_code(text: Column | str, words: Sequence[str] = fixed.PROMPT_WORDS) -> Column:
    return has_word(text, words)


def open_sources(
    files: DataFrame, sources: DataFrame, blocked: DataFrame, *, repo: str = "repo", enabled: str = "enabled",
    most_files: int = 1000,
) -> DataFrame:
    """Files of enabled, unblocked repositories with at most ``most_files`` files.

    Counts are aggregated per repository. The very large ones are over the limit anyway and are
    dropped by a short broadcast list first, so none of them meets in one task.
    """
    sizes = files.groupBy(repo).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= most_files)
    good = sources.filter(F.coalesce(F.col(enabled), F.lit(False))).select(repo).join(blocked.select(repo), repo, "left_anti")
    keep = good.distinct().join(sizes, repo).select(repo)
    huge = F.broadcast(hot_keys(files, [repo], max(HOT_ROWS, most_files + 1)).select(repo))
    return files.join(huge, repo, "left_anti").join(keep, repo, "left_semi")


def is_thin(description: Column | str, least: int = 80) -> Column:
    """Empty, cut off, or short."""
    d = F.trim(F.coalesce(col(description), F.lit("")))
    return (F.length(d) == 0) | d.rlike(r"(\.\.\.|…)$") | (F.length(d) < least)


def complete_plugins(type_: Column | str, repo: Column | str, verified: Column | str, wanted: str = "plugin") -> Column:
    """Rows of other types, and plugins with a repository and a verified flag (true or false)."""
    return (F.coalesce(col(type_), F.lit("")) != wanted) | ((F.length(col(repo)) > 0) & col(verified).isNotNull())


def has_install_config(command: Column | str, url: Column | str) -> Column:
    said = lambda c: F.coalesce(F.length(F.trim(col(c))) > 0, F.lit(False))
    return said(command) | said(url)


# --- usability (B12) -----------------------------------------------------------------------------


def front_block(text: Column | str) -> Column:
    """Text between the opening ``---`` and the next line that begins with it; null if there is none."""
    c = col(text)
    end = F.locate("\n---", c, 4)
    return F.when(F.startswith(c, F.lit("---")) & (end > 0), F.substr(c, F.lit(4), end - 4))


def _unreadable(block: str | None, load, errors: tuple[type[Exception], ...]) -> bool:
    if block is None:
        return False
    try:
        load(block)
    except errors:
        return True
    return False


def broken_front_matter(text: Column | str) -> Column:
    """True where a YAML reader cannot load the front matter. Texts without front matter are sound.

    Only the front block goes to Python, in Arrow batches, and only of texts that have one. Needs PyYAML on the executors;
    where it is missing the query fails and says so, since a guess would drop sound rows and keep broken ones.
    """

    @F.pandas_udf("boolean")
    def broken(blocks: pd.Series) -> pd.Series:
        try:
            import yaml
        except ImportError as missing:
            raise ImportError("broken_front_matter needs PyYAML on every executor") from missing
        # a value that cannot be made (a date with month 13) or is nested too deep is no more readable than a bad line
        errors = (yaml.YAMLError, ValueError, OverflowError, RecursionError)
        return blocks.map(lambda b: _unreadable(b, yaml.safe_load, errors)).astype(bool)

    block = front_block(text)
    return F.when(block.isNull(), F.lit(False)).otherwise(broken(F.coalesce(block, F.lit(""))))


def empty_stub(config: Column | str, field: str = "mcpServers") -> Column:
    """True for a server file without any command or address; unreadable files are left to the reader."""
    c = col(config)
    servers = F.from_json(F.get_json_object(c, f"$.{field}"), "map<string,struct<command:string,url:string>>")
    some = F.exists(F.map_values(servers), lambda s: has_install_config(s["command"], s["url"]))
    return F.try_parse_json(c).isNotNull() & ~F.coalesce(some, F.lit(False))


def usability_reason(
    *, type_: Column, has_file: Column, stub: Column, broken: Column, known: Sequence[str] = fixed.TYPES,
    stub_type: str = "mcp", text_types: Sequence[str] = ("prompt", "skill", "rule"),
) -> Column:
    return first_rule([
        (~F.coalesce(type_.isin(*known), F.lit(False)), "unknown_type"),
        (~has_file, "orphan_no_file"),
        ((type_ == stub_type) & stub, "mcp_empty_stub"),
        (type_.isin(*text_types) & broken, "md_yaml_broken"),
    ])


# --- projections -----------------------------------------------------------------------------------


def search_text(texts: Sequence[Column], lists: Sequence[Column]) -> Column:
    """All non-empty texts and list items with blanks between."""
    parts = [empty_as_null(c) for c in texts] + [empty_as_null(F.array_join(c, " ")) for c in lists]
    return F.concat_ws(" ", *parts)


def search_projection(df: DataFrame, fields: Sequence[str] = fixed.SEARCH_FIELDS) -> DataFrame:
    """Light search table: the fields there are, the install method and the search text."""
    have = [f for f in fields if f in df.columns]
    texts = [F.col(c) for c in ("name", "description", "description_zh") if c in df.columns]
    lists = [F.col(c) for c in ("tags", "tech_stack", "search_terms") if c in df.columns]
    method = F.col("install.method") if "install" in df.columns else F.lit(None).cast("string")
    return df.select(*have, method.alias("install_method"), search_text(texts, lists).alias("search_text"))


def card_projection(df: DataFrame, *, base: Sequence[str], by_type: Mapping[str, Sequence[str]], type_: str = "type",
                    defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Card columns; columns of one type are null on rows of other types."""
    defaults = dict(defaults or {})
    cols = [(F.coalesce(F.col(c), defaults[c]) if c in defaults else F.col(c)).alias(c) for c in base]
    for t, names in by_type.items():
        cols += [F.when(F.col(type_) == t, F.col(c)).alias(c) for c in names]
    return df.select(*cols)


def whitelist_json(df: DataFrame, keep: Sequence[str], key: str) -> DataFrame:
    """(key, json): the kept fields in order, null ones left out."""
    return df.select(key, F.to_json(F.struct(*[F.col(c) for c in keep])).alias("json"))


def recover_stars(df: DataFrame, found: DataFrame, *, key: str, stars: str, least: int = 10) -> DataFrame:
    """Read -1 as unknown, fill unknown stars from the lookup, keep rows with enough."""
    known = F.when(F.col(stars) >= 0, F.col(stars))
    joined = df.withColumn(stars, known).join(found.select(key, F.col(stars).alias("_found")), key, "left")
    return joined.withColumn(stars, F.coalesce(stars, "_found")).filter(F.col(stars) >= least).drop("_found")
