"""Markdown, front matter and plain texts to rows.

A text is taken apart inside its own row: sections by splitting at headings, records and lines
by exploding. So these jobs run in one pass over the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.text import kebab
from ..functions.values import col, empty_as_null, let

NEWLINE = r"\r?\n"


# --- sections and lines ------------------------------------------------------------------------


def sections(df: DataFrame, text: str, heading: str, keys: Sequence[str], *, section: str = "section", title: str = "title", trim: bool = True) -> DataFrame:
    """(keys, section, title, body): parts of a text that begin at lines matching ``heading``.

    ``heading`` is a pattern for one line whose first group is the title. Section 0 is what comes
    before the first heading and has no title.
    """
    # a line break before every heading is marked, so lookahead costs nothing on other lines
    parts = F.split(F.concat(F.lit("\n"), col(text)), rf"\n(?={heading}(?:\r?\n|$))")
    flat = df.select(*keys, F.posexplode(parts).alias(section, "_s"))
    first = F.regexp_extract("_s", r"\A([^\n]*)", 1)
    name = F.regexp_extract(first, f"^{heading}\\r?$", 1)
    is_titled = F.col(section) > 0
    body = F.when(is_titled, F.regexp_replace("_s", r"\A[^\n]*\n?", "")).otherwise(F.regexp_replace("_s", r"\A\n", ""))
    out = flat.select(*keys, section, F.when(is_titled, F.trim(name) if trim else name).alias(title), body.alias("body"))
    return out.filter((F.col(section) > 0) | (F.length("body") > 0))


def lines(df: DataFrame, text: str, keys: Sequence[str], *, pos: str = "pos", line: str = "line") -> DataFrame:
    return df.select(*keys, F.posexplode(F.split(col(text), NEWLINE)).alias(pos, line))


def records(df: DataFrame, text: str, keys: Sequence[str], *, within: str, record: str, section_pattern: str = r"##\s+(.+)") -> DataFrame:
    """(keys, section, record, name, content): records inside the sections whose title matches ``within``.

    ``record`` is the pattern of a record's first line; text before a section's first record is left out.
    """
    outer = sections(df, text, section_pattern, keys)
    wanted = outer.filter(F.col("title").rlike(within)).withColumnRenamed("title", "_section_title")
    inner = sections(wanted, "body", record, [*keys, "section"], section="record", title="name")
    return inner.filter(F.col("record") > 0).withColumnRenamed("body", "content")


# --- bullets and tables (A6-A8) ------------------------------------------------------------------

BULLET = r"^-\s+\*\*\[([^\]]+)\]\(([^)]+)\)\*\*\s*[-–—]\s*(.+)"
PLAIN_BULLET = r"^-\s+\[([^\]]+)\]\(([^)]+)\)\s*[-–—]\s*(.+)$"
TABLE_ROW = r"\|\s*\[([^\]]+)\]\(([^)]+)\)\s*\|\s*([^|]+)\|\s*([^|]*)\|"


def bullets(
    df: DataFrame, text: str, keys: Sequence[str], *, pattern: str = BULLET, heading: str = r"#{2,3}\s+(.+)",
    skip: Sequence[str] = fixed.SKIPPED_HEADINGS,
) -> DataFrame:
    """(keys, section, pos, category, name, url, description): list entries under their nearest heading."""
    parts = sections(df, text, heading, keys)
    kept = parts.filter(~F.coalesce(F.lower("title").isin(*skip), F.lit(False)))
    rows = lines(kept, "body", [*keys, "section", F.coalesce("title", F.lit("")).alias("category")])
    get = lambda i: F.trim(F.regexp_extract("line", pattern, i))
    return rows.filter(F.col("line").rlike(pattern)).select(
        *keys, "section", "pos", "category", get(1).alias("name"), get(2).alias("url"), get(3).alias("description")
    )


def table_rows(df: DataFrame, text: str, keys: Sequence[str], *, pattern: str = TABLE_ROW) -> DataFrame:
    """(keys, pos, name, url, description): rows of Markdown tables whose first cell is a link."""
    groups = [F.regexp_extract_all(col(text), F.lit(pattern), i) for i in (1, 2, 3)]
    named = df.select(*keys, *[g.alias(n) for g, n in zip(groups, ("name", "url", "description"))])
    cells = named.select(*keys, F.posexplode(F.arrays_zip("name", "url", "description")).alias("pos", "r"))
    return cells.select(*keys, "pos", *[F.trim(f"r.{n}").alias(n) for n in ("name", "url", "description")])


def listed_skills(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Plain bullets whose link ends in ``/skills/<author>-<skill>``, with the folder that names."""
    rows = bullets(df, text, keys, pattern=PLAIN_BULLET, skip=())
    slug = F.regexp_extract("url", r"/skills/([^/?#]+)$", 1)
    two = F.split(F.col("slug"), "-", 2)
    path = F.when(
        F.size(two) == 2, F.concat(F.lit("skills/"), F.get(two, F.lit(0)), F.lit("/"), F.get(two, F.lit(1)), F.lit("/"))
    ).otherwise(F.concat(F.lit("skills/"), F.col("slug"), F.lit("/")))
    return rows.withColumn("slug", slug).filter(F.length("slug") > 0).withColumn("install_path", path)


# --- anchors (A13) -----------------------------------------------------------------------------


def heading_slug(title: Column | str) -> Column:
    """Anchor of a heading: blanks become dashes one by one, other marks go."""
    c = F.regexp_replace(F.lower(col(title)), r"(?U)[^\w\- ]", "")
    return F.regexp_replace(F.replace(c, F.lit(" "), F.lit("-")), "^-+", "")


def section_by_anchor(docs: DataFrame, wanted: DataFrame, *, key: str, text: str, slug: str = "slug") -> DataFrame:
    """(key, slug, content): the first ``##`` section of a text with the wanted anchor, heading included."""
    parts = sections(docs, text, r"(##\s+.+)", [key], trim=False)
    named = parts.filter(F.col("section") > 0).select(
        key, "section", heading_slug(F.regexp_replace("title", r"^##\s+", "")).alias(slug),
        F.trim(F.concat("title", F.lit("\n"), "body")).alias("content"),
    )
    firsts = named.groupBy(key, slug).agg(F.min_by("content", "section").alias("content"))
    return wanted.select(key, slug).distinct().join(firsts, [key, slug])


# --- front matter (A11) and descriptions (A12, A23) -------------------------------------------------


def front_field(text: Column | str, name: str) -> Column:
    """Value of a key in the leading ``---`` block, without quotes; null if it is not there."""
    block = F.regexp_extract(col(text), r"(?s)\A---\s*\n(.*?)\n---", 1)
    value = F.trim(F.regexp_extract(block, rf"(?mi)^\s*{name}[ \t]*:[ \t]*(.*)$", 1))
    bare = F.regexp_replace(value, r"""^(["'])(.*)\1$""", "$2")
    return empty_as_null(bare)


def front_list(text: Column | str, name: str = "tags") -> Column:
    """List of a key written as ``[a, b]`` or ``a, b``."""
    value = F.regexp_replace(front_field(text, name), r"^\[(.*)\]$", "$1")
    items = F.transform(F.split(value, ","), lambda x: F.regexp_replace(F.trim(x), r"""^["']+|["']+$""", ""))
    return F.coalesce(F.filter(items, lambda x: x != ""), F.array().cast("array<string>"))


def body_after_front(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"(?s)\A---\s*\n.*?\n---\s*\n?", "")


def skill_texts(df: DataFrame, text: str, folder: str, keys: Sequence[str]) -> DataFrame:
    """(keys, name, description, category, tags) of files with front matter.

    The name falls back to the folder; rows without name or description are dropped.
    """
    block = F.regexp_extract(col(text), r"(?s)\A---\s*\n(.*?)\n---", 1)
    get = lambda p: empty_as_null(F.trim(F.regexp_extract(block, p, 1)))
    base = F.element_at(F.split(F.regexp_replace(col(folder), "/+$", ""), "/"), -1)
    tags = F.regexp_extract(block, r"tags:\s*\[([^\]]*)\]", 1)
    items = F.transform(F.split(tags, ","), lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), r'^"+|"+$', ""), r"^'+|'+$", ""))
    out = df.select(
        *keys,
        F.coalesce(get(r'name:\s*"?([^"\n]+)"?'), F.when(base != ".", empty_as_null(base))).alias("name"),
        get(r'description:\s*[>|]?\s*\n?\s*"?([^"\n]+)"?').alias("description"),
        F.coalesce(get(r'category:\s*"?([^"\n]+)"?'), F.lit("")).alias("category"),
        F.filter(items, lambda x: x != "").alias("tags"),
    )
    return out.filter(F.col("name").isNotNull() & F.col("description").isNotNull())


TITLE_LINE = r"(?m)^[ \t]*# ([^\n]*)$"


def _without_title(text: Column, title: Column) -> Column:
    """Text without its first title line, if that is the given title."""
    own = F.trim(F.regexp_extract(text, TITLE_LINE, 1)) == title
    cut = F.regexp_replace(text, r"(?s)\A(.*?)(?m:^)[ \t]*# [^\n]*(?:\n|\z)(.*)\z", "$1$2")
    return F.when((F.length(title) > 0) & own, cut).otherwise(text)


def body_description(body: Column | str, limit: int = 300) -> Column:
    """Title, then the first closed code block, else the prose lines; at most ``limit`` characters.

    Between fence lines a text is prose and code in turn, so a split gives both.
    """
    c = F.coalesce(col(body), F.lit(""))
    return let(F.split(c, r"(?m)^[ \t]*```[^\n]*$"), lambda parts: _said(c, parts, limit))


def _said(c: Column, parts: Column, limit: int) -> Column:
    coded = F.transform(parts, lambda p, i: F.when((i % 2 == 1) & (i < F.size(parts) - 1) & (F.length(p) > 1), i))
    first = F.get(F.array_compact(coded), F.lit(0))
    seen = F.when(first.isNotNull(), F.array_join(F.slice(parts, 1, F.coalesce(first, F.lit(0)) + 1), "\n")).otherwise(c)
    title = F.trim(F.regexp_extract(seen, TITLE_LINE, 1))
    before = F.trim(F.regexp_extract(F.array_join(F.slice(parts, 1, F.coalesce(first, F.lit(0))), "\n"), TITLE_LINE, 1))
    block = F.get(parts, first)
    code = F.when(F.length(before) > 0, block).otherwise(_without_title(block, title))
    prose = _without_title(F.array_join(F.filter(parts, lambda p, i: i % 2 == 0), "\n"), title)
    lines_ = F.filter(F.transform(F.split(prose, NEWLINE), lambda l: F.trim(l)), lambda l: (l != "") & ~l.rlike(r"^(!|\[|---)"))
    edges = r"\A\s+|\s+\z"
    text = F.when(first.isNotNull(), F.regexp_replace(code, edges, "")).otherwise(F.array_join(lines_, " "))
    said = F.when(text == "", title).when(F.length(title) > 0, F.concat(title, F.lit(": "), text)).otherwise(text)
    return F.substring(said, 1, limit)


def first_line(text: Column | str, limit: int, default: Column) -> Column:
    """First line that is not blank, a heading mark, an image, a link or a rule, else the default."""
    rows = F.transform(
        F.split(F.coalesce(col(text), F.lit("")), NEWLINE), lambda l: F.trim(F.regexp_replace(F.trim(l), "^#+|#+$", ""))
    )
    found = F.get(F.filter(rows, lambda l: (l != "") & ~l.rlike(r"^(!|\[|---)")), F.lit(0))
    return F.coalesce(F.substring(found, 1, limit), default)


# --- files as records (A22, A23) -----------------------------------------------------------------


def pretty(name: Column | str) -> Column:
    return F.initcap(F.trim(F.translate(col(name), "-_", "  ")))


def slug_of_path(path: Column | str) -> Column:
    """Folder that holds the file, or the file name itself near the root."""
    parts = F.split(col(path), "/")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -2)).otherwise(
        F.regexp_replace(F.element_at(parts, -1), r"(?i)\.md$", "")
    )


def rule_files(
    files: DataFrame, repos: DataFrame, *, path: str = "path", text: str = "text", repo: str = "repo", folder: str = "rules/",
    global_folder: str = "rules/global_rules/", markers: tuple[str, str] = ("windsurf-global", "windsurf"), label: str = "Windsurf",
    suffix: str = "", branch: str = "main",
) -> DataFrame:
    """Markdown files below a folder as entries, with date and stars of their repository (one row each in ``repos``).

    Files of the global folder are marked as such and belong to the default category.
    """
    from ..functions.text import categorize, extract_tags, joined_text
    from ..operators.relational import skew_join

    low = F.lower(F.col(path))
    kept = files.filter(low.endswith(".md") & low.startswith(folder))
    slug = slug_of_path(path)
    kept = kept.withColumns({"_slug": slug, "_global": low.startswith(global_folder), "_body": body_after_front(text)}).filter(F.length("_slug") > 0)
    named = F.coalesce(front_field(text, "name"), front_field(text, "title"), F.col("_slug"))
    said = F.coalesce(
        F.substring(front_field(text, "description"), 1, 300),
        empty_as_null(body_description("_body")),
        F.concat(F.lit("Rules for "), F.replace("_slug", F.lit("-"), F.lit(" "))),
    )
    kind = F.when(F.col("_global"), f" ({label} Global)").otherwise(f" ({label})")
    kept = kept.withColumns({"name": F.concat(pretty(named), kind), "description": said})
    kept = kept.withColumn("_t", joined_text("_slug", "description"))
    tags = F.concat(
        F.transform(front_list(text), F.lower), extract_tags("_t"),
        F.when(F.col("_global"), F.array(F.lit(markers[0]))).otherwise(F.array().cast("array<string>")), F.array(F.lit(markers[1])),
    )
    kept = kept.withColumn("tags", F.array_distinct(tags))
    kept = kept.withColumn("_t", joined_text("_slug", "description", F.array_join("tags", " ")))
    kept = kept.withColumns({
        "id": F.concat(kebab("_slug"), F.lit(suffix)),
        "category": F.when(F.col("_global"), "tooling").otherwise(
            F.coalesce(F.lower(front_field(text, "category")), categorize("_t"))
        ),
    })
    url = F.concat_ws("/", F.lit("https://github.com"), F.col(repo), F.lit(f"blob/{branch}"), F.col(path))
    raw = F.concat_ws("/", F.lit("https://raw.githubusercontent.com"), F.col(repo), F.lit(branch), F.col(path))
    rows = kept.select(
        repo, path, "id", "name", "description", "tags", "category", F.lit("rule").alias("type"), url.alias("source_url"),
        F.struct(F.lit("download_file").alias("method"), F.array(raw).alias("files")).alias("install"),
    )
    return skew_join(rows, repos.select(repo, "pushed_at", "stars"), [repo], "left", spread=[path])
