"""Truth tests and small value helpers shared by every operator."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used.

    For a costly value that is tested many times inside a filter: filters do not share
    common parts of their condition, and pushing them down repeats the value in each.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def empty_as_null(c: Column | str, kind: str = "string") -> Column:
    """Null, blank, 0, empty list and empty map are one class: absent.

    ``kind`` is string, number, boolean, array, map or struct.
    """
    c = col(c)
    if kind == "string":
        return F.when(F.length(c) > 0, c)
    if kind == "number":
        return F.when(c != 0, c)
    if kind == "boolean":
        return F.when(c, c)
    if kind in ("array", "map"):
        return F.when(F.size(c) > 0, c)
    return c


def first_rule(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition holds. A null condition does not hold."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(default if isinstance(default, Column) else F.lit(default))


def ordered_union(*arrays: Column | str) -> Column:
    """Distinct items of all arrays, earlier arrays first; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(col(a), empty) for a in arrays]))


def folded_union(*arrays: Column | str) -> Column:
    """``ordered_union`` after lower-casing and trimming, without blanks."""
    empty = F.array().cast("array<string>")
    parts = F.concat(*[F.coalesce(col(a), empty) for a in arrays])
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.lower(F.trim(x))), lambda x: x != ""))
