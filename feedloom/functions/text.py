"""Text columns: keyword rules, ids, cuts, dates and hashes.

Functions that test many keywords take a text that is already in lower case. Make it with
``withColumn`` first, so it is worked out once per row and not once per keyword.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, functions as F

from . import fixed
from .values import col, empty_as_null, first_rule

CJK = "[\\u4e00-\\u9fff]"


def joined_text(*parts: Column | str) -> Column:
    """Lower-case text of all parts with blanks between."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col(p), F.lit("")) for p in parts]))


def word_pattern(words: Sequence[str]) -> str:
    """One alternation that finds any of the words as a whole word, in any script."""
    return r"(?U)\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


def has_word(text: Column | str, words: Sequence[str]) -> Column:
    return col(text).rlike("(?i)" + word_pattern(words))


@lru_cache(maxsize=64)
def _keyword_automaton(words: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, w in enumerate(words):
        found.add_word(w, [*found.get(w, []), i])
    found.make_automaton()
    return found


def keyword_numbers(text: Column | str, words: Sequence[str], whole_word: bool = False) -> Column:
    """Places in ``words`` of all that stand in the text, in order: one pass over the text, whatever the number of words.

    The texts go to an automaton in Arrow batches. Words are found inside words as well, unless ``whole_word``, which is
    a pattern for each word and stays in Spark.
    """
    words = tuple(words)
    if not words:
        return F.array().cast("array<int>")
    if whole_word:
        marks = F.array(*[F.when(col(text).rlike(word_pattern([w])), F.lit(i)) for i, w in enumerate(words)])
        return F.filter(marks, lambda i: i.isNotNull())

    @F.arrow_udf("array<int>")
    def numbers(texts: pa.Array) -> pa.Array:
        found = _keyword_automaton(words)
        return pa.array([sorted({i for _, held in found.iter(t) for i in held}) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return numbers(F.coalesce(col(text), F.lit("")))


def _first(numbers: Column, values: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.array_min(numbers)) if values else F.lit(None).cast("string")


# --- K1-K5 -------------------------------------------------------------------------------------


def categorize(
    text: Column | str, upstream: Column | str | None = None, rules: Sequence[tuple[str, str]] | None = None,
    default: str = fixed.DEFAULT_CATEGORY, whole_word: bool = False,
) -> Column:
    """Category of the upstream name if that is a keyword, else of the first keyword in the lower-case text.

    Keywords are found inside words as well, unless ``whole_word``.
    """
    rules = list(fixed.CATEGORY_KEYWORDS.items()) if rules is None else list(rules)
    found = _first(keyword_numbers(text, [w for w, _ in rules], whole_word), [c for _, c in rules])
    found = F.coalesce(found, F.lit(default))
    if upstream is None:
        return found
    up = F.lower(col(upstream))
    return F.coalesce(first_rule([(up == w, c) for w, c in rules]), found)


def extract_tags(text: Column | str, rules: Mapping[str, str] | None = None, whole_word: bool = False) -> Column:
    """Tags of all keywords in the lower-case text, in rule order, each once."""
    rules = fixed.TAG_KEYWORDS if rules is None else rules
    tags = F.array(*[F.lit(tag) for tag in rules.values()])
    return F.array_distinct(F.transform(keyword_numbers(text, list(rules), whole_word), lambda i: F.get(tags, i)))


def tech_stack(text: Column | str, rules: Sequence[tuple[Sequence[str], Sequence[str]]] | None = None) -> Column:
    """Stack of the first rule with any keyword in the lower-case text; empty if there is none."""
    rules = fixed.STACK_RULES if rules is None else rules
    none = F.array().cast("array<string>")
    words = [(w, i) for i, (ws, _) in enumerate(rules) for w in ws]
    rule = F.get(F.array(*[F.lit(i) for _, i in words]), F.array_min(keyword_numbers(text, [w for w, _ in words])))
    stacks = F.array(*[F.array(*[F.lit(s) for s in stack]).cast("array<string>") for _, stack in rules])
    return F.coalesce(F.get(stacks, rule), none)


def scene(
    name: Column, tags: Column, description: Column, category: Column,
    scenes: Sequence[tuple[str, Sequence[str]]] | None = None, hints: Mapping[str, str] | None = None, look: int | None = None,
) -> Column:
    """First scene with a keyword as a tag, inside the name, or as a word in the description (its first ``look`` characters).

    Inputs are in lower case. Without a hit the category may hint at a scene.
    """
    scenes = fixed.SCENES if scenes is None else scenes
    hints = fixed.SCENE_OF_CATEGORY if hints is None else hints
    head = F.coalesce(description, F.lit(""))
    head = head if look is None else F.substring(head, 1, look)
    rules = []
    for key, words in scenes:
        listed = F.arrays_overlap(F.coalesce(tags, F.array().cast("array<string>")), F.array(*[F.lit(w) for w in words]))
        named = name.rlike("|".join(re.escape(w) for w in words))
        rules.append((listed | named | head.rlike(word_pattern(words)), key))
    return F.coalesce(first_rule(rules), first_rule([(category == c, s) for c, s in hints.items()]))


def mapped(key: Column | str, table: Mapping[str, str], default: Column) -> Column:
    """Value of a fixed map, else the default."""
    return first_rule([(col(key) == k, v) for k, v in table.items()], default)


def prefix_category(
    name: Column | str, text: Column | str, table: Mapping[str, str] | None = None, rules: Sequence[tuple[str, str]] | None = None
) -> Column:
    """Category by the part of a name before the first dash, else by keywords."""
    table = fixed.PREFIX_CATEGORY if table is None else table
    return mapped(F.split_part(col(name), F.lit("-"), F.lit(1)), table, categorize(text, rules=rules))


# --- K6, K7: ids ---------------------------------------------------------------------------------


def _trim_dashes(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "-+", "-"), "^-|-$", "")


def kebab(name: Column | str) -> Column:
    """Lower-case words with dashes between; letters of any script stay."""
    c = F.regexp_replace(F.lower(col(name)), r"(?U)[^\w\s-]", "")
    return _trim_dashes(F.regexp_replace(c, r"(?U)[\s_]+", "-"))


def clean_id(part: Column | str, breaks: str = r"[\s_]+") -> Column:
    """ASCII id part: everything else becomes a dash."""
    c = F.regexp_replace(F.trim(F.lower(F.coalesce(col(part), F.lit("")))), breaks, "-")
    return _trim_dashes(F.regexp_replace(c, "[^a-z0-9-]+", "-"))


def hashed_id(name: Column | str, fallback: str = "mcp-server") -> Column:
    """Id with the first 8 digits of the SHA-1 of the full name, so that equal-looking names differ."""
    n = F.coalesce(col(name), F.lit(""))
    base = F.coalesce(empty_as_null(clean_id(n, r"[\s_./]+")), F.lit(fallback))
    return F.concat(base, F.lit("-"), F.substring(F.sha1(n), 1, 8))


def composite_id(name: Column | str, owner: Column | str, repo: Column | str) -> Column:
    """name-owner[-repo]; the repository is left out when it equals the name."""
    n = F.coalesce(empty_as_null(clean_id(name)), F.lit("skill"))
    o = F.coalesce(empty_as_null(clean_id(owner)), F.lit("unknown"))
    r = empty_as_null(clean_id(repo))
    return F.concat_ws("-", n, o, F.when(r != n, r))


def namespaced_id(namespace: Column | str, name: Column | str, fallback: str = "community") -> Column:
    """namespace-name without a leading @, or just one of them when they are equal."""
    ns = F.regexp_replace(F.trim(F.lower(F.coalesce(col(namespace), F.lit("")))), "^@", "")
    ns = F.coalesce(empty_as_null(clean_id(ns, r"[\s_./]+")), F.lit(fallback))
    nm = F.coalesce(empty_as_null(clean_id(name, r"[\s_./]+")), F.lit("plugin"))
    return F.when(ns == nm, ns).otherwise(F.concat_ws("-", ns, nm))


def file_id(id_: Column | str) -> Column:
    """Id as a file name: no @, -- for slashes, dashes for other marks."""
    c = F.replace(F.replace(col(id_), F.lit("@"), F.lit("")), F.lit("/"), F.lit("--"))
    return F.regexp_replace(c, r"(?U)[^\w\-.]", "-")


def anchor_slug(title: Column | str) -> Column:
    """Anchor of a list entry: ASCII letters, digits and dashes."""
    c = F.replace(F.regexp_replace(F.lower(col(title)), "[^a-z0-9 -]", ""), F.lit(" "), F.lit("-"))
    return F.regexp_replace(c, "^-+|-+$", "")


def id_from_repo_url(url: Column | str, host: str = r"github\.com", mirror: str = "MCP-Mirror") -> Column:
    """owner-repo; a mirror's ``owner_repo`` repository is taken apart."""
    u = F.regexp_replace(col(url), "/+$", "")
    owner = F.regexp_extract(u, rf"^https?://{host}/([^/]+)/([^/]+)", 1)
    repo = F.regexp_extract(u, rf"^https?://{host}/([^/]+)/([^/]+)", 2)
    split = (owner == mirror) & repo.contains("_")
    inner = F.regexp_extract(repo, "^([^_]*)_(.*)$", 1)
    rest = F.regexp_extract(repo, "^([^_]*)_(.*)$", 2)
    both = F.concat(F.when(split, inner).otherwise(owner), F.lit("-"), F.when(split, rest).otherwise(repo))
    return F.when(F.length(owner) > 0, kebab(both))


def id_from_listing_url(url: Column | str, host: str = "skills.sh") -> Column:
    """Composite id back from ``https://host/owner/repo/name``; null for other addresses.

    ``host`` is a regular expression matched against the whole host.
    """
    u = col(url)
    there = F.lower(F.regexp_extract(u, r"^https?://([^/?#]+)", 1)).rlike(f"^(?:{host})$")
    path = F.regexp_extract(u, r"^https?://[^/?#]+([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    at = lambda i: F.get(parts, F.lit(i))
    return F.when(there & (F.size(parts) >= 3), composite_id(at(2), at(0), at(1)))


# --- K8: cuts and numbers ------------------------------------------------------------------------


def cut_words(text: Column | str, limit: int = 80) -> Column:
    """Cut to ``limit`` characters at a blank in the last 40 %, or after a letter beyond ASCII."""
    c = col(text)
    head = F.substring(c, 1, limit)
    last_space = F.length(head) - F.instr(F.reverse(head), " ")  # 0-based; the length itself if there is none
    has_space = F.instr(head, " ") > 0
    wide = F.substring(head, limit, 1).rlike(r"[^\x00-\x7F]")
    end = F.lit("…")
    by_word = F.concat(F.substr(head, F.lit(1), last_space), end)
    return (
        F.when(F.length(c) <= limit, c)
        .when(wide, F.concat(F.regexp_replace(head, "[。，、；：！？]+$", ""), end))
        .when(has_space & (last_space > limit * 0.6), by_word)
        .otherwise(F.concat(head, end))
    )


def cut_collapsed(text: Column | str, limit: int, missing: str = "—") -> Column:
    """One-line text of at most ``limit`` characters."""
    c = F.trim(F.regexp_replace(col(text), r"\s+", " "))
    short = F.concat(F.regexp_replace(F.substring(c, 1, max(0, limit - 1)), r"\s+$", ""), F.lit("…"))
    return F.when(F.coalesce(F.length(col(text)), F.lit(0)) == 0, missing).when(F.length(c) <= limit, c).otherwise(short)


def cut_plain(text: Column | str, limit: int, missing: str = "—") -> Column:
    c = col(text)
    cut = F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit), F.lit("...")))
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, missing).otherwise(cut)


def star_label(stars: Column | str, missing: str | None = "—") -> Column:
    """12345 as 12.3k; none as the missing mark.

    A tie (such as 1650) goes the way the binary value of stars / 1000 lies, as in printf.
    """
    s = col(stars).cast("long")
    x = s / F.lit(1000.0)
    high = x * 134217729.0 - (x * 134217729.0 - x)  # upper half of the digits, so the products are exact
    off = (high * 1000.0 - s) + (x - high) * 1000.0
    tenths, rest = F.floor(s / 100), s % 100
    up = (rest > 50) | ((rest == 50) & ((off > 0) | ((off == 0) & (tenths % 2 == 1))))
    tenths = tenths + up.cast("long")
    long = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("k"))
    return F.when(s >= 1000, long).when(s > 0, s.cast("string")).otherwise(missing)


# --- K9-K11: dates and hashes ------------------------------------------------------------------


def parse_time(text: Column | str) -> Column:
    """UTC time of a date, or of a date and time with T or a blank, Z or an offset; null if unreadable."""
    return F.trim(col(text)).try_cast("timestamp")


def iso_z(text: Column | str) -> Column:
    """Feed time as ISO with T and Z; blank is null."""
    s = F.trim(col(text))
    s = F.when(s.contains("T"), s).otherwise(F.regexp_replace(s, "^([^ ]*) ", "$1T"))
    bare = ~s.endswith("Z") & ~s.contains("+") & s.contains("T")
    return F.when(F.length(s) > 0, F.when(bare, F.concat(s, F.lit("Z"))).otherwise(s))


def content_hash(text: Column | str) -> Column:
    return F.sha2(col(text), 256)


def cache_key(
    metric: Column | str, content: Column, rubric: Column, config: Column | None = None, namespace: str | None = None
) -> Column:
    """SHA-256 of metric, content hash, rubric and, where given, configuration and name space."""
    metric = F.lit(metric) if isinstance(metric, str) else metric
    raw = F.concat_ws(":", metric, content, rubric, *([] if config is None else [config]))
    return F.sha2(raw if namespace is None else F.concat(F.lit(namespace + "|"), raw), 256)


def rubric_version(major: int, prompt: Column | str) -> Column:
    return F.concat(F.lit(f"{major}."), F.substring(F.sha2(col(prompt), 256), 1, 8))


# --- languages -----------------------------------------------------------------------------------


def has_cjk(text: Column | str) -> Column:
    return F.coalesce(col(text).rlike(CJK), F.lit(False))


def pick_description(description: Column | str, chinese: Column | str, reason: Column | str, lang: str = "en") -> Column:
    """Text to show in one language; an English page prefers the reason over a Chinese description."""
    d, z = empty_as_null(description), empty_as_null(chinese)
    if lang == "zh":
        return F.coalesce(z, d, F.lit(""))
    r = F.trim(col(reason))
    return F.when(has_cjk(description) & (F.length(r) > 0), r).otherwise(F.coalesce(d, z, F.lit("")))


# --- display columns ------------------------------------------------------------------------------

BADGES = {"active": "🟢 Active", "stale": "🟡 Stale", "abandoned": "🔴 Abandoned"}


def freshness_badge(label: Column | str, last_commit: Column | str, missing: str = "—") -> Column:
    """Shown freshness; "abandoned" without any date is only unknown."""
    known = (col(label) != "abandoned") | (F.length(col(last_commit)) > 0)
    badge = first_rule([(col(label) == k, v) for k, v in BADGES.items()], missing)
    return F.when(F.coalesce(known, F.lit(False)), badge).otherwise(missing)


def last_active(*dates: Column | str, missing: str = "—") -> Column:
    return F.coalesce(*[F.substring(empty_as_null(d), 1, 10) for d in dates], F.lit(missing))


def tag_line(tags: Column | str, count: int = 3, missing: str = "—") -> Column:
    shown = F.transform(F.slice(col(tags), 1, count), lambda t: F.concat(F.lit("`"), t, F.lit("`")))
    return F.when(F.size(col(tags)) > 0, F.array_join(shown, ", ")).otherwise(missing)
