"""Scoring and governance over tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import fixed, scores
from ..functions.values import first_rule
from .relational import HOT_ROWS, with_key_count


def task_config(spark: SparkSession) -> DataFrame:
    """(task, kind, name, weight) of the five scoring tasks; a fixed table of under 50 rows."""
    rows = [
        (task, "dimension", name, w)
        for task, ws in fixed.TASK_DIMENSION_WEIGHTS.items()
        for name, w in zip(fixed.DIMENSIONS, ws)
        if w is not None
    ] + [
        (task, "signal", name, w)
        for task, ws in fixed.TASK_SIGNAL_WEIGHTS.items()
        for name, w in zip(fixed.SIGNALS, ws)
        if w is not None
    ]
    return spark.createDataFrame(rows, "task string, kind string, name string, weight double")


def weighted_scores(scores_: DataFrame, config: DataFrame, keys: Sequence[str], task: str = "task") -> DataFrame:
    """Quality per row from (keys, task, name, score) rows and a weight table.

    The score is null when a configured dimension is missing.
    """
    dims = config.filter(F.col("kind") == "dimension") if "kind" in config.columns else config
    wanted = dims.groupBy(task).agg(F.count(F.lit(1)).alias("_wanted"))
    weights = dims.select(task, "name", "weight").join(wanted, task)
    total = F.sum(F.col("score") / 5.0 * 100.0 * F.col("weight"))
    out = scores_.join(weights, [task, "name"]).groupBy(*keys, task, "_wanted").agg(
        total.alias("quality"), F.count(F.lit(1)).alias("_got")
    )
    return out.withColumn("quality", F.when(F.col("_got") == F.col("_wanted"), F.col("quality"))).drop("_got", "_wanted")


def inject_signal(
    config: DataFrame, signal: str = "install_popularity", weight: float = fixed.INSTALL_SIGNAL_WEIGHT,
    *, task: str = "task", name: str = "name", w: str = "weight",
) -> DataFrame:
    """Add one signal to every task and scale the others so that all still sum to one.

    A task that names the signal already keeps its own weights.
    """
    per_task = Window.partitionBy(task)
    has = F.max((F.col(name) == signal).cast("int")).over(per_task) == 1
    total = F.sum(w).over(per_task)
    scaled = F.when((F.lit(weight) > 0) & (total > 0), F.col(w) * F.lit(1.0 - weight) / total).otherwise(F.col(w))
    base = config.select(task, name, F.when(has, F.col(w)).otherwise(scaled).alias(w), has.alias("_has"))
    new = base.filter(~F.col("_has")).select(task).distinct().select(
        task, F.lit(signal).alias(name), F.lit(float(weight)).alias(w)
    )
    return base.drop("_has").unionByName(new)


def route_task(df: DataFrame, type_: str = "type", out: str = "task") -> DataFrame:
    """Task of a row by its type; unknown types go to the skill task."""
    rules = ((F.col(type_) == t, task) for t, task in fixed.TYPE_TO_TASK.items())
    return df.withColumn(out, first_rule(rules, "skill"))


def glob_pattern(glob: str) -> str:
    """Anchored regular expression of a shell pattern (``*`` and ``?``)."""
    special = {"*": ".*", "?": "."}
    return "^(?s)" + "".join(special.get(c, c if c.isalnum() else "\\" + c) for c in glob) + "$"


def star_weight(
    df: DataFrame,
    *,
    stars: str = "stars",
    source: str = "source",
    repo: str = "repo",
    zero_sources: Sequence[str] = (),
    threshold: int = 5,
    spread: Sequence[str] | None = None,
    min_rows: int = HOT_ROWS,
    out: str = "star_weight",
) -> DataFrame:
    """0 without stars, for listed sources, and for repositories with ``threshold`` rows or more; else 1."""
    counted = with_key_count(df, [repo], "_repo_n", spread=spread, min_rows=min_rows)
    noisy = F.lit(False)
    for g in zero_sources:
        noisy = noisy | F.coalesce(F.col(source).rlike(glob_pattern(g)), F.lit(False))
    weight = (
        F.when(F.coalesce(F.col(stars), F.lit(0)) == 0, 0.0)
        .when(noisy, 0.0)
        .when(F.col("_repo_n") >= threshold, 0.0)
        .otherwise(1.0)
    )
    return counted.withColumn(out, weight).drop("_repo_n")


def health_columns(
    as_of: str,
    task: str,
    *,
    pushed_at: str = "pushed_at",
    stars: str = "stars",
    source: str = "source",
    installs: str = "install_count",
    completeness: str = "manifest_completeness",
    weight_of_stars: str = "star_weight",
    type_: str = "type",
    install_weight: float = fixed.INSTALL_SIGNAL_WEIGHT,
) -> dict[str, Column]:
    """All signals of an entry and its weighted health for one task."""
    weights = {n: w for n, w in zip(fixed.SIGNALS, fixed.TASK_SIGNAL_WEIGHTS[task]) if w is not None}
    total = sum(weights.values())
    weights = {n: w * (1.0 - install_weight) / total for n, w in weights.items()}
    weights["install_popularity"] = install_weight
    values = {
        "freshness": scores.freshness(pushed_at, as_of),
        "popularity": scores.popularity(stars),
        "source_trust": scores.trust_of(F.coalesce(F.col(source), F.lit(""))),
        "install_popularity": scores.install_popularity(installs),
        "manifest_completeness": scores.manifest_signal(completeness),
    }
    out_if = {
        "freshness": F.col(pushed_at).isNull(),
        "popularity": F.col(weight_of_stars) == 0.0,
        "install_popularity": F.coalesce(F.col(installs), F.lit(0)) <= 0,
        "manifest_completeness": F.coalesce(F.col(type_) != "plugin", F.lit(True)) | F.col(completeness).isNull(),
    }
    signals = [(values[n], w, out_if.get(n)) for n, w in weights.items()]
    return {**values, "health_weighted": scores.health_weighted(signals)}


def govern(
    df: DataFrame,
    dimensions: Mapping[str, str],
    *,
    score: str = "final_score",
    decision: str = "decision",
    health_only: bool = False,
) -> DataFrame:
    """Defaults of rows without an evaluation (0, review), and the weak dimensions of the others."""
    if health_only:
        return (
            df.withColumn(score, F.lit(0.0))
            .withColumn(decision, F.lit("review"))
            .withColumn("weak_dims", F.array().cast("array<string>"))
        )
    done = F.col(score).isNotNull()
    weak = scores.weak_dimensions({n: F.col(c) for n, c in dimensions.items()})
    return (
        df.withColumn("weak_dims", F.when(done, weak).otherwise(F.array().cast("array<string>")))
        .withColumn(decision, F.when(done, F.coalesce(F.col(decision), F.lit("review"))).otherwise("review"))
        .withColumn(score, F.coalesce(F.col(score), F.lit(0.0)))
    )


def drop_rejects(
    df: DataFrame, *, decision: str = "decision", source: str = "source", dry_run: bool = True,
    strict_source: str | None = fixed.REGISTRY_SOURCE,
) -> DataFrame:
    """Drop rejected rows unless in a dry run; one source must even be accepted to stay."""
    out = df if dry_run else df.filter(F.coalesce(F.col(decision), F.lit("review")) != "reject")
    if strict_source is not None:
        strict = F.coalesce(F.col(source), F.lit("")) == strict_source
        out = out.filter(~strict | (F.coalesce(F.col(decision), F.lit("")) == "accept"))
    return out


def flatten_result(
    entries: DataFrame,
    results: DataFrame,
    *,
    key: str = "id",
) -> DataFrame:
    """Put an evaluation result (struct columns metrics, enrichment, health, scores) onto its entry.

    Metrics become plain scores, numbers are rounded half to even, enrichment only replaces
    where it says something, and a server without an installability result is unknown.
    Entries without a result keep what they have.
    """
    r = results.select(F.col("entry_id").alias(key), F.struct(*[c for c in results.columns if c != "entry_id"]).alias("_r"))
    j = entries.join(r, key, "left")
    has = F.col("_r").isNotNull()
    e = "_r.enrichment"
    filled = lambda c: F.size(F.col(c)) > 0
    said = lambda c: F.length(F.col(c)) > 0
    mean = scores.health_mean(F.col("_r.health.freshness"), F.col("_r.health.popularity"), F.col("_r.health.source_trust"))
    new = {
        "scores": F.when(has, F.transform_values("_r.metrics", lambda k, v: v["score"])),
        "final_score": F.when(has, F.bround("_r.final_score", 0).cast("double")).otherwise(F.col("final_score")),
        "decision": F.when(has, F.coalesce("_r.decision", F.lit("review"))).otherwise(F.col("decision")),
        "tags": F.when(filled(f"{e}.tags"), F.col(f"{e}.tags")).otherwise(F.col("tags")),
        "tech_stack": F.when(filled(f"{e}.tech_stack"), F.col(f"{e}.tech_stack")).otherwise(F.col("tech_stack")),
        "description_original": F.when(said(f"{e}.summary"), F.col("description")),
        "description": F.when(said(f"{e}.summary"), F.col(f"{e}.summary")).otherwise(F.col("description")),
        "description_zh": F.when(said(f"{e}.summary_zh"), F.col(f"{e}.summary_zh")).otherwise(F.col("description_zh")),
        "health_mean": F.when(F.col("_r.health").isNotNull(), mean),
        "freshness_label": F.when(F.col("_r.health").isNotNull(), scores.freshness_label("_r.health.freshness")),
        "health_signals": F.when(F.col("_r.health").isNotNull(), F.struct(*[
            F.bround(F.col(f"_r.health.{f}"), 0).cast("int").alias(f) for f in results.schema["health"].dataType.fieldNames()
        ])),
        "install_state": F.when(
            has & (F.col("type") == "mcp"), F.coalesce("_r.installability.state", F.lit("unknown"))
        ),
        "install_tags": F.when(
            has & (F.col("type") == "mcp"),
            F.when(F.col("_r.installability").isNull(), F.array(F.lit("insufficient_evidence"))).otherwise(
                F.col("_r.installability.tags")
            ),
        ),
    }
    return j.withColumns(new).drop("_r")


def health_only_result(health_score: Column | str) -> Column:
    """Stand-in evaluation of an entry that was never evaluated: its health, under review."""
    return F.struct(
        F.coalesce(F.expr("try_cast(`%s` as double)" % health_score) if isinstance(health_score, str)
                   else health_score.try_cast("double"), F.lit(0.0)).alias("final_score"),
        F.lit("review").alias("decision"),
        F.lit("health_only_synthesized").alias("evaluation_mode"),
    )
