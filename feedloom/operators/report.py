"""Counts, histograms and status tables. All are aggregates with partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.values import col


def counts_with_zeros(df: DataFrame, key: str, known: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key; every known key is listed, with 0 if it has none."""
    frame = df.sparkSession.createDataFrame([(k,) for k in known], f"`{key}` string")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return frame.join(counts, key, "full_outer").na.fill(0, [name])


def totals(df: DataFrame) -> DataFrame:
    """Total and the total floored to whole hundreds."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("total"), (F.floor(n / 100) * 100).alias("approx"))


def evaluation_report(df: DataFrame, score: str, decision: str, metrics: Mapping[str, str]) -> DataFrame:
    """(section, item, value): decisions, five score buckets, mean/min/max, and metric means.

    One pass: everything is a conditional aggregate on the same scan.
    """
    s = F.col(score)
    edges = ((0, 20), (20, 40), (40, 60), (60, 80), (80, 100))
    within = lambda lo, hi: (s >= lo if lo else s < 20) & (s < hi) if lo < 80 else s >= 80
    aggs: list[tuple[str, str, Column]] = [("all", "total", F.count(F.lit(1)))]
    aggs += [("decision", d, F.count_if(F.col(decision) == d)) for d in fixed.DECISIONS]
    aggs += [("histogram", f"{lo}-{hi}", F.count_if(within(lo, hi))) for lo, hi in edges]
    aggs += [("score", f.__name__, F.coalesce(F.round(f(s), 2), F.lit(0.0))) for f in (F.mean, F.min, F.max)]
    aggs += [("metric", m, F.round(F.avg(c), 2)) for m, c in metrics.items()]
    one = df.agg(*[a.cast("double").alias(f"a{i}") for i, (_, _, a) in enumerate(aggs)])
    cells = [
        F.struct(F.lit(sec).alias("section"), F.lit(item).alias("item"), F.col(f"a{i}").alias("value"))
        for i, (sec, item, _) in enumerate(aggs)
    ]
    return one.select(F.inline(F.array(*cells)))


def category_overview(df: DataFrame, category: str = "category", type_: str | None = None, type_filter: str | None = None) -> DataFrame:
    """Rows per category, most first; a missing category is "unknown"."""
    if type_filter is not None:
        df = df.filter(F.col(type_) == type_filter)
    c = F.coalesce(F.col(category), F.lit("unknown")).alias(category)
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), category)


def cross_table(df: DataFrame, row: str, column: str, values: Sequence[str], total: str = "TOTAL") -> DataFrame:
    """Counts by row and column value with row and column totals."""
    cells = [F.count_if(F.col(column) == v).alias(str(v)) for v in values]
    label = F.when(F.grouping(row) == 1, F.lit(total)).otherwise(F.col(row))
    return df.rollup(row).agg(*cells, F.count(F.lit(1)).alias(total), label.alias("_label")).drop(row).withColumnRenamed("_label", row)


def usage_totals(df: DataFrame, cost: str, prompt: str, completion: str, hit: Column) -> DataFrame:
    """Entries, cost and token totals, and the share of hits (0 for no rows)."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("entries"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("total_cost"),
        F.coalesce(F.sum(prompt), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum(completion), F.lit(0)).alias("completion_tokens"),
        F.when(n > 0, F.count_if(hit) / n).otherwise(0.0).alias("hit_rate"),
    )


def run_status(
    entries: DataFrame, cells: DataFrame, *, type_: str = "type", provenance: str = "provenance",
) -> DataFrame:
    """Per type: succeeded, failed, quarantined, fallbacks, and ok / partial / failed.

    ``entries`` has a provenance (new, old, synth); ``cells`` has one row per type with
    ``present``, ``failed`` and ``quarantined``. Types without a cell count as failed.
    """
    p = F.col(provenance)
    seen = entries.groupBy(type_).agg(
        F.count_if(p == "new").alias("succeeded"),
        F.count_if(p == "old").alias("fallback_old"),
        F.count_if(p == "synth").alias("fallback_synth"),
    )
    out = seen.join(cells, type_, "full_outer").na.fill(
        0, ["succeeded", "fallback_old", "fallback_synth", "failed", "quarantined"]
    )
    back = F.col("fallback_old") + F.col("fallback_synth")
    status = (
        F.when(~F.coalesce(F.col("present"), F.lit(False)), "failed").when(back > 0, "partial").otherwise("ok")
    )
    return out.withColumns({"fallback": back, "status": status}).drop("present")


def content_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(entry_count, digest) of a set of rows, whatever their order.

    Row hashes are added up in four lanes, so no task ever holds all of them.
    """
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]), 256)
    lanes = [F.conv(F.substr(row, F.lit(1 + 12 * i), F.lit(12)), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = df.select(*[lane.alias(f"l{i}") for i, lane in enumerate(lanes)]).agg(
        F.count(F.lit(1)).alias("entry_count"), *[F.sum(f"l{i}").cast("decimal(38,0)").alias(f"l{i}") for i in range(4)]
    )
    text = F.concat_ws("-", F.col("entry_count").cast("string"), *[F.coalesce(F.col(f"l{i}").cast("string"), F.lit("0")) for i in range(4)])
    return sums.select("entry_count", F.sha2(text, 256).alias("digest"))


def drop_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias(reason)).agg(F.count(F.lit(1)).alias("n"))


def has_share(df: DataFrame, present: Column, threshold: float = 0.3) -> DataFrame:
    """One row: the share of rows that hold, and whether it reaches the threshold (false for no rows)."""
    share = F.coalesce(F.avg(present.cast("double")), F.lit(0.0))
    return df.agg(share.alias("share"), F.count(F.lit(1)).alias("_n")).select(
        "share", ((F.col("_n") > 0) & (F.col("share") >= threshold)).alias("enough")
    )


def status_rollup(df: DataFrame, type_: str = "type", status: str = "status", total: str = "ALL") -> DataFrame:
    """Counts by type and status, per type, and over all."""
    name = lambda c: F.when(F.grouping(c) == 1, total).otherwise(F.col(c))
    return (
        df.rollup(type_, status)
        .agg(F.count(F.lit(1)).alias("n"), name(type_).alias("_t"), name(status).alias("_s"))
        .select(F.col("_t").alias(type_), F.col("_s").alias(status), "n")
    )
