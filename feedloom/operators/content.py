"""Texts put together from many rows or parts."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.values import col, empty_as_null
from .relational import HOT_ROWS, running_sum, top_per_key, with_key_count


# --- evaluation input (K20) -------------------------------------------------------------------


def evaluation_input(
    *, name: str, type_: str, description: str, url: str, stars: str | None, tags: str | None, content: Column,
    heading: str = "## README Content",
) -> Column:
    """Header line for every field there is, a rule, and the content."""
    line = lambda label, c: F.when(F.length(c) > 0, F.concat(F.lit(f"{label}: "), c, F.lit("\n")))
    lines = [
        F.concat(F.lit("# Resource: "), F.col(name), F.lit("\n")),
        line("Type", F.col(type_)),
        line("Description", F.col(description)),
        line("Source", F.col(url)),
    ]
    if stars is not None:
        lines.append(F.when(F.col(stars).isNotNull(), F.concat(F.lit("Stars: "), F.col(stars).cast("string"), F.lit("\n"))))
    if tags is not None:
        lines.append(F.when(F.size(tags) > 0, F.concat(F.lit("Tags: "), F.array_join(tags, ", "), F.lit("\n"))))
    return F.concat(F.concat_ws("", *lines), F.lit(f"\n---\n\n{heading}\n\n"), content)


def capped(content: Column | str, cap: int | None = None, notice: str = "\n\n[content cut: {n} characters, first {cap} kept]") -> Column:
    """The content, or a word that there is none. With a ``cap`` a longer one is cut and says how long it was."""
    c = col(content)
    if cap is None:
        return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, "(no content provided)").otherwise(c)
    before, after = notice.replace("{cap}", str(cap)).split("{n}")
    said = F.concat(F.substring(c, 1, cap), F.lit(before), F.length(c).cast("string"), F.lit(after))
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, "(no content provided)").when(F.length(c) > cap, said).otherwise(c)


def with_shared_prefix(
    df: DataFrame, *, repo: str, content: str, description: str, threshold: int = 5, spread: Sequence[str] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Put the description before the content of repositories with ``threshold`` rows or more."""
    n = with_key_count(df, [repo], "_n", spread=spread, min_rows=min_rows)
    shared = (F.col("_n") >= threshold) & (F.length(description) > 0)
    text = F.concat(
        F.lit("## Resource Description\n"), F.col(description), F.lit("\n\n## Repository README\n"), F.col(content)
    )
    return n.withColumn(content, F.when(shared, text).otherwise(F.col(content))).drop("_n")


# --- bundle text (K21) ------------------------------------------------------------------------


def abbreviate(text: Column | str, limit: int) -> Column:
    """Front matter and the start of the first paragraph, or the start of the text."""
    c = col(text)
    pattern = r"(?s)^---\s*\n(.*?)\n---\s*\n"
    has = c.rlike(pattern)
    body = F.regexp_replace(c, pattern, "")
    para = F.substring(F.get(F.split(body, "\n\n"), F.lit(0)), 1, limit)
    front = F.regexp_extract(c, pattern, 1)
    return F.when(has, F.concat(F.lit("---\n"), front, F.lit("\n---\n\n"), para)).otherwise(F.substring(c, 1, limit))


def bundle_parts(
    files: DataFrame, *, bundle: str, class_: str, path: str, text: str, cap: int | None = None, full_per_class: int = 5,
    short: int = 800, always: Sequence[int] = (0,),
) -> DataFrame:
    """(bundle, class, path, part): the parts of each bundle's text in class and path order, all whole.

    With a ``cap`` a part is whole as long as the parts before it are under ``cap`` characters, for the first
    ``full_per_class`` files of each class, and in the classes of ``always`` (manifests); of the others the first
    ``short`` characters of the first paragraph stay. The size only grows, and until it reaches the cap every part is
    whole; so the running size of whole parts decides. It is worked out on sizes alone; texts are then met once.
    """
    # the join characters between parts are not counted
    heading = F.concat(F.lit("## "), F.col(path), F.lit("\n"))
    whole = F.concat(heading, F.col(text), F.lit("\n"))
    files = files.filter(F.col(text).isNotNull())
    place = [bundle, class_, path]
    if cap is None:
        return files.select(*place, whole.alias("part"))
    sized = running_sum(files.select(*place, F.length(whole).alias("_n")), [bundle], [class_, path], F.col("_n"), "_before")
    firsts = top_per_key(files.select(*place), [bundle, class_], [F.asc(path)], full_per_class, "_i")
    keep = (F.col("_before") < cap) | F.coalesce("_first", F.lit(False)) | F.col(class_).isin(*always)
    marked = sized.join(firsts.withColumn("_first", F.lit(True)).drop("_i"), place, "left").select(*place, keep.alias("_keep"))
    cut_ = F.concat(heading, abbreviate(text, short), F.lit("\n"))
    return files.join(marked, place).select(*place, F.when(F.col("_keep"), whole).otherwise(cut_).alias("part"))


def bundle_rows(parts: DataFrame, *, bundle: str, class_: str, path: str) -> DataFrame:
    """(bundle, before, part): the parts with the characters of the joined text before each, for a bundle of any size."""
    place = [bundle, class_, path]
    sizes = parts.select(*place, F.length("part").alias("_n"))
    sized = running_sum(sizes, [bundle], [class_, path], F.col("_n") + 1, "before")
    return parts.join(sized.select(*place, "before"), place).select(bundle, "before", "part")


def bundle_text(parts: DataFrame, *, bundle: str, class_: str, path: str) -> DataFrame:
    """(bundle, content): the parts joined to one text, which has to fit a row; see ``bundle_rows`` for any size."""
    ordered = F.array_sort(F.collect_list(F.struct(class_, path, "part")))
    return parts.groupBy(bundle).agg(F.array_join(F.transform(ordered, lambda p: p["part"]), "\n").alias("content"))


# --- install commands (K22) --------------------------------------------------------------------


def _lines_with_command(block: Column, lead: str, closing: str) -> Column:
    lines = F.transform(
        F.split(block, r"\r?\n"), lambda l: F.regexp_replace(F.regexp_replace(F.trim(l), lead, ""), closing, "")
    )
    return F.filter(lines, lambda l: (l != "") & l.rlike(fixed.INSTALL_COMMAND))


def install_commands(text: Column | str, manifest: Column | None = None, repo: Column | str | None = None, name: Column | str | None = None) -> Column:
    """Struct (commands, from_section, from_fence): install lines of a text, each once, in order.

    Lines come from the manifest, from install sections (up to the next heading of the same or a
    higher level), else from fenced blocks; the plain marketplace commands end the list.
    """
    none = F.array().cast("array<string>")
    c = F.coalesce(col(text), F.lit(""))
    heading = r"^(#{1,6})\s+(.+?)\s*$"
    sections = F.filter(F.split(c, r"(?m)(?=^#{1,6}\s)"), lambda s: s.rlike(r"(?m)\A" + heading))
    parts = F.transform(sections, lambda s: F.struct(
        F.length(F.regexp_extract(s, r"\A(#{1,6})\s", 1)).alias("level"),
        F.regexp_extract(s, r"\A#{1,6}\s+([^\n]+?)\s*(?:\n|\z)", 1).rlike(fixed.INSTALL_HEADING).alias("hit"),
        s.alias("body"),
    ))
    closed = 9  # deeper than any heading

    def step(got: Column, p: Column) -> Column:
        # the highest open install heading; a heading as high or higher ends it
        still = F.when(p["level"] <= got["open"], closed).otherwise(got["open"])
        open_ = F.when(p["hit"], F.least(still, p["level"])).otherwise(still)
        lines = F.when(open_ < closed, F.concat(got["lines"], _lines_with_command(p["body"], r"^[`$ ]+", r"`+$"))).otherwise(got["lines"])
        return F.struct(open_.alias("open"), lines.alias("lines"), (got["found"] | p["hit"]).alias("found"))

    walked = F.aggregate(parts, F.struct(F.lit(closed).alias("open"), none.alias("lines"), F.lit(False).alias("found")), step)
    from_sections, found = walked["lines"], walked["found"]
    fences = F.regexp_extract_all(c, F.lit(r"(?s)```[a-zA-Z]*\n(.*?)```"), 1)
    from_fences = F.flatten(F.transform(fences, lambda b: _lines_with_command(b, r"^[$ ]+", r"\s+$")))
    synthetic = none
    if repo is not None or name is not None:
        r = empty_as_null(repo) if repo is not None else F.lit(None).cast("string")
        n = empty_as_null(name) if name is not None else F.lit(None).cast("string")
        ref = F.coalesce(r, n)
        plugin = F.coalesce(n, F.element_at(F.split(r, "/"), -1))
        made = F.array(F.concat(F.lit("/plugin marketplace add "), ref), F.concat(F.lit("/plugin install "), plugin))
        synthetic = F.filter(made, lambda x: x.isNotNull())
    own = none if manifest is None else F.filter(
        F.transform(F.coalesce(manifest, none), lambda x: F.trim(x)), lambda x: x.rlike(fixed.INSTALL_COMMAND)
    )
    lines = F.when(found, from_sections).otherwise(from_fences)
    return F.struct(
        F.array_distinct(F.concat(own, lines, synthetic)).alias("commands"),
        found.alias("from_section"),
        (~found & (F.size(from_fences) > 0)).alias("from_fence"),
    )


# --- Unicode (K24) --------------------------------------------------------------------------------


def nfc(text: Column | str) -> Column:
    """Unicode NFC. Plain ASCII text, which is NFC already, is not sent to Python."""

    @F.pandas_udf("string")
    def normalize(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")

    c = col(text)
    plain = c.rlike(r"^\p{ASCII}*$")
    return F.when(plain, c).otherwise(normalize(F.when(~plain, c)))
