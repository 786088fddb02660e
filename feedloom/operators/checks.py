"""Table contracts: rules as columns, violations as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.text import categorize
from ..session import cut
from .relational import HOT_ROWS, exploded_keys, skew_join


def violations(df: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """(key, violation): one row per broken rule. A rule that cannot be judged counts as broken."""
    marks = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    broken = F.filter(marks, lambda m: m.isNotNull())
    return df.select(key, F.explode(broken).alias("violation"))


def entry_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Rules of the entry contract for the columns there are."""
    c = F.col
    rules = {f"missing {f}": c(f).isNotNull() for f in fixed.REQUIRED_FIELDS if f in columns and f != "stars"}
    rules |= {f"missing {f}": F.lit(False) for f in fixed.REQUIRED_FIELDS if f not in columns}
    null_or = lambda f, ok: c(f).isNull() | ok
    extra = {
        "id": ("id format", lambda f: c(f).rlike(fixed.ID_PATTERN)),
        "type": ("type value", lambda f: c(f).isin(*fixed.TYPES)),
        "category": ("category value", lambda f: c(f).isin(*fixed.CATEGORIES)),
        "decision": ("decision value", lambda f: c(f).isin(*fixed.DECISIONS)),
        "source_url": ("source_url format", lambda f: c(f).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$")),
        "last_synced": ("last_synced format", lambda f: c(f).cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        "final_score": ("final_score range", lambda f: c(f).between(0, 100)),
        "stars": ("stars range", lambda f: c(f) >= 0),
        "install_method": ("install method value", lambda f: c(f).isin(*fixed.INSTALL_METHODS)),
        **{d: (f"{d} range", lambda f: c(f).between(1, 5)) for d in fixed.DIMENSIONS},
    }
    rules |= {name: null_or(f, ok(f)) for f, (name, ok) in extra.items() if f in columns}
    return rules


def curated_rules(columns: Sequence[str], source: str = "curated") -> dict[str, Column]:
    """Contract of hand-made rows: the entry contract, their own source name, and a date for dated types."""
    dated = F.coalesce(F.col("type").isin(*fixed.LIFECYCLE_TYPES), F.lit(False))
    has_date = F.col("added_at").isNotNull() if "added_at" in columns else F.lit(False)
    return entry_rules(columns) | {"missing added_at": ~dated | has_date, "source value": F.col("source") == source}


def curated_findings(
    curated: DataFrame, index: DataFrame, *, key: str = "id", url: str = "url_key", order: str = "_ord",
    rules: Mapping[str, Column] | None = None, min_rows: int = HOT_ROWS,
) -> DataFrame:
    """(order, finding, severity): contract errors, repeated ids (error), repeated addresses and clashes with the index (warning).

    What is known of an id or address, its first row and whether the index has it, is one row of one aggregate, and each
    curated row is joined with it once for its id and once for its address.
    """
    curated = cut(curated)
    keys = {"id": key, "address": url}
    rows = exploded_keys(curated, keys, [order])
    there = exploded_keys(index, keys, []).select(F.lit(None).cast(curated.schema[order].dataType).alias(order), "_kind", "_key")
    facts = rows.withColumn("_in", F.lit(0)).unionByName(there.withColumn("_in", F.lit(1))).groupBy("_kind", "_key").agg(
        F.min(order).alias("_first"), F.count(order).alias("_n"), F.max("_in").alias("_in"))
    met = skew_join(rows, facts.filter("_n > 0 and (_n > 1 or _in = 1)"), ["_kind", "_key"], "inner", spread=[order, "_kind"], min_rows=min_rows)
    says = lambda finding, severity: F.struct(finding.alias("finding"), F.lit(severity).alias("severity"))
    again = (F.col(order) != F.col("_first")) & (F.length("_key") > 0)
    found = F.array(
        F.when(again & (F.col("_kind") == "id"), says(F.lit("duplicate id"), "error")),
        F.when(again & (F.col("_kind") == "address"), says(F.lit("duplicate address"), "warning")),
        F.when(F.col("_in") == 1, says(F.concat("_kind", F.lit(" in index")), "warning")))
    marks = met.select(order, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("_f")).select(order, "_f.*")
    broken = violations(curated, rules or {}, order).select(order, F.col("violation").alias("finding"), F.lit("error").alias("severity"))
    return broken.unionByName(marks)


def typed_field_errors(raw: Column, fields: Mapping[str, Mapping[str, object]]) -> Column:
    """Errors of optional fields of a JSON text, by the type each value really has.

    ``fields`` maps a name to ``kind`` (count, text, list) and, for text, ``pattern`` or ``values``
    (blank text passes a pattern), and for a list the ``items`` fields every item must have as text.
    An absent field is fine. A boolean is not a count.
    """
    v = F.try_parse_json(raw)
    marks = []
    for name, spec in fields.items():
        item = F.try_variant_get(v, f"$.{name}", "variant")
        there = F.schema_of_variant(item)
        text = F.try_variant_get(v, f"$.{name}", "string")
        say = lambda cond, what: F.when(cond, F.lit(f"{name} {what}"))
        present = item.isNotNull()
        if spec["kind"] == "count":
            marks.append(say(present & (there != "BIGINT"), "must be a whole number"))
            marks.append(say((there == "BIGINT") & (F.try_variant_get(v, f"$.{name}", "long") < 0), "must not be negative"))
        elif spec["kind"] == "text":
            marks.append(say(present & (there != "STRING"), "must be text"))
            if "pattern" in spec:
                bad = (there == "STRING") & (F.length(text) > 0) & ~text.rlike(spec["pattern"])
                marks.append(say(bad, "has a bad format"))
            if "values" in spec:
                marks.append(say((there == "STRING") & ~text.isin(*spec["values"]), "has an unknown value"))
        else:
            is_list = there.startswith("ARRAY")
            marks.append(say(present & ~is_list, "must be a list"))
            items = F.try_variant_get(v, f"$.{name}", "array<variant>")
            for f in spec.get("items", ()):
                kind = lambda x, f=f: F.coalesce(F.schema_of_variant(F.try_variant_get(x, f"$.{f}", "variant")), F.lit("VOID"))
                marks.append(say(is_list & F.exists(items, lambda x: kind(x) != "STRING"), f"items need a text {f}"))
    return F.filter(F.array(*marks), lambda m: m.isNotNull())


SKILL_FIELDS = {
    "install_count": {"kind": "count"},
    "skills_sh_url": {"kind": "text", "pattern": "^https?://"},
    "skills_sh_scraped_at": {"kind": "text", "pattern": fixed.ISO_Z_PATTERN},
}
SERVER_FIELDS = {
    "mcp_registry_status": {"kind": "text", "values": fixed.REGISTRY_STATUS},
    "mcp_registry_published_at": {"kind": "text", "pattern": fixed.ISO_Z_PATTERN},
    "mcp_remotes": {"kind": "list", "items": ("type", "url")},
}


def repair_category(
    df: DataFrame, text: Column, category: str = "category", known: Sequence[str] = fixed.CATEGORIES, rules: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Work the category out again where it is not one of the known ones."""
    ok = F.coalesce(F.col(category).isin(*known), F.lit(False))
    return df.withColumn(category, F.when(ok, F.col(category)).otherwise(categorize(text, rules=rules)))


def config_violations(
    config: DataFrame, thresholds: DataFrame | None = None, *, task: str = "task", kind: str = "kind", weight: str = "weight",
) -> DataFrame:
    """(task, violation): weights of a kind that do not sum to one (zero weights aside), accept not above review."""
    sums = config.filter(F.col(weight) > 0).groupBy(task, kind).agg(F.sum(weight).alias("_s"))
    out = sums.filter(F.abs(F.col("_s") - 1.0) > 0.001).select(
        task, F.concat(F.lit("weights of "), kind, F.lit(" do not sum to 1")).alias("violation")
    )
    if thresholds is not None:
        bad = thresholds.filter(F.col("accept") <= F.col("review"))
        out = out.unionByName(bad.select(task, F.lit("accept is not above review").alias("violation")))
    return out
