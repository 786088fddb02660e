"""Score columns: quality, health signals, blend and decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import fixed
from .values import col, first_rule

DAY_MICROS = 86_400_000_000


def whole_days(later: Column, earlier: Column | str) -> Column:
    """Whole days between two timestamps, rounded down (also below zero)."""
    return F.floor((F.unix_micros(later) - F.unix_micros(col(earlier).try_cast("timestamp"))) / F.lit(DAY_MICROS))


def as_of_column(as_of: str) -> Column:
    return F.to_timestamp(F.lit(as_of))


def is_stale(as_of: str, taken_at: Column | str, days: int = 14) -> Column:
    """Whether a snapshot is more than ``days`` whole days old; one without a date is."""
    return F.coalesce(whole_days(as_of_column(as_of), taken_at) > days, F.lit(True))


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))  # both skip nulls


def freshness(pushed_at: Column | str, as_of: str) -> Column:
    """100 today, falling in a line to 0 after 365 days; 0 without a date."""
    days = whole_days(as_of_column(as_of), pushed_at)
    return F.coalesce(clamp(100.0 * (1.0 - days / 365.0)), F.lit(0.0))


def popularity(stars: Column | str) -> Column:
    """25 points per power of ten, at most 100."""
    s = col(stars)
    return F.when(s > 0, F.least(F.lit(100.0), 25.0 * F.log10(s))).otherwise(0.0)


def install_popularity(installs: Column | str) -> Column:
    """20 points per power of ten, at most 100; one install or less is 0."""
    n = col(installs)
    return F.when(n > 0, F.least(F.lit(100.0), F.log10(F.greatest(n, F.lit(1))) / 5.0 * 100.0)).otherwise(0.0)


def manifest_completeness(fields: Sequence[Column], present: Column, mode: str = "manifest") -> Column:
    """1.0 with every field, 0.7 with some, 0.3 with no manifest.

    ``present`` tells whether there is a manifest. In mode "manifest" one without any
    field still counts 0.7; in mode "feed" it counts 0.3.
    """
    have = sum((F.coalesce(F.length(F.trim(f.cast("string"))) > 0, F.lit(False)).cast("int") for f in fields), F.lit(0))
    some = F.lit(True) if mode == "manifest" else have > 0
    return F.when(present & (have == len(fields)), 1.0).when(present & some, 0.7).otherwise(0.3)


def manifest_signal(completeness: Column | str) -> Column:
    """Completeness as 0-100; unknown counts 100. Values over 1 are read as percent."""
    c = col(completeness)
    return F.coalesce(clamp(F.when(c <= 1.0, c * 100.0).otherwise(c)), F.lit(100.0))


def quality_score(scores: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Weighted 1-5 dimensions as 0-100; null unless every dimension is there."""
    if abs(sum(weights.values()) - 1.0) > 0.001:
        raise ValueError(f"weights sum to {sum(weights.values()):.4f}, not 1")
    if set(scores) != set(weights):
        raise ValueError(f"dimensions {sorted(scores)} do not match weights {sorted(weights)}")
    return sum((scores[d] / 5.0 * 100.0 * w for d, w in weights.items()), F.lit(0.0))


def health_weighted(signals: Sequence[tuple[Column, float, Column | None]]) -> Column:
    """Weighted health; the weight of left-out signals goes to the rest in proportion.

    Each signal is (value, weight, left out?); the last may be None for never.
    """
    total = sum(w for _, w, _ in signals)
    kept = F.lit(0.0)
    score = F.lit(0.0)
    for value, weight, out in signals:
        w = F.lit(float(weight)) if out is None else F.when(out, 0.0).otherwise(float(weight))
        kept = kept + w
        score = score + F.coalesce(value, F.lit(0.0)) * w
    return F.when(kept > 0, score * F.lit(total) / kept).otherwise(0.0)


def health_mean(fresh: Column, popular: Column, trust: Column) -> Column:
    """The shown health: plain mean of three signals, rounded half to even."""
    return F.bround((fresh + popular + trust) / 3.0, 0).cast("int")


def freshness_label(fresh: Column | str) -> Column:
    f = col(fresh)
    return F.when(f > 70, "active").when(f > 30, "stale").otherwise("abandoned")


def blend(quality: Column, health: Column, alpha: float = fixed.BLEND_ALPHA) -> Column:
    """alpha * quality + (1 - alpha) * health, or health alone where there is no quality."""
    return F.coalesce(F.lit(alpha) * quality + F.lit(1 - alpha) * health, health)


def decision(
    score: Column | str, relevance: Column | str, accept: float = fixed.ACCEPT_AT, review: float = fixed.REVIEW_AT
) -> Column:
    """accept / review / reject; relevance of 2 or less never gets past review (unknown counts 3)."""
    if accept <= review:
        raise ValueError("accept must be above review")
    s, r = col(score), F.coalesce(col(relevance), F.lit(3))
    return F.when((s >= accept) & (r > 2), "accept").when(s >= review, "review").otherwise("reject")


def candidate_score(stars: Column | str, keyword: Column) -> Column:
    """10 points per power of ten of stars, and 50 for a keyword."""
    s = F.greatest(F.coalesce(col(stars), F.lit(0)), F.lit(1))
    return F.log10(s) * 10.0 + F.when(keyword, 50.0).otherwise(0.0)


def call_cost(prompt_tokens: Column | str, completion_tokens: Column | str, per_1k: tuple[float, float]) -> Column:
    return col(prompt_tokens) / 1000.0 * per_1k[0] + col(completion_tokens) / 1000.0 * per_1k[1]


def weak_dimensions(scores: Mapping[str, Column], below: int = 3) -> Column:
    """Names of dimensions scored under ``below``, in the given order."""
    marks = F.array(*[F.when(c < below, F.lit(n)) for n, c in scores.items()])
    return F.filter(marks, lambda x: x.isNotNull())


def trust_of(source: Column | str, table: Mapping[str, float] | None = None, default: float | None = None) -> Column:
    """Trust of a source from the fixed table, as one ``when`` chain (15 names)."""
    table = fixed.SOURCE_TRUST if table is None else table
    default = fixed.SOURCE_TRUST_DEFAULT if default is None else default
    c = col(source)
    return first_rule(((c == name, float(v)) for name, v in table.items()), float(default))
