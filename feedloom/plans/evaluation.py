"""From answers of an evaluator to scored results, per entry and without state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, jsons, scores
from ..functions.values import first_rule
from ..operators import scoring

ANSWER_DDL = (
    "metrics map<string,struct<score:int,evidence:array<string>,missing:array<string>,suggestion:string>>, "
    "enrichment struct<summary:string,summary_zh:string,tags:array<string>,tech_stack:array<string>,highlights:array<string>>, "
    "mcp_installability struct<mcp_schema_valid:boolean,mcp_install_state:string,mcp_validation_tags:array<string>,"
    "mcp_installability_reason:string>"
)


def weights_of(task: str) -> dict[str, float]:
    return {d: w for d, w in zip(fixed.DIMENSIONS, fixed.TASK_DIMENSION_WEIGHTS[task]) if w is not None}


def _per_task(value) -> Column:
    return first_rule([(F.col("task") == t, value(t)) for t in fixed.TASK_DIMENSION_WEIGHTS])


def parse_answers(answers: DataFrame, *, key: str = "entry_id", type_: str = "type", text: str = "text") -> DataFrame:
    """(key, type, task, accepted, metrics, enrichment, installability, quality, relevance).

    The answer's JSON is found in its text and normalised. An answer without every metric of its task is
    not accepted and has no quality. Enrichment may be missing; servers without an installability answer
    are unknown.
    """
    routed = scoring.route_task(answers.select(key, type_, text), type_)
    found = routed.withColumn("_a", F.from_json(jsons.recover_object(text), ANSWER_DDL))
    clamped = F.transform_values("_a.metrics", lambda k, v: v.withField("score", jsons.clamp_score(v["score"])))
    # a metric without a score counts as missing
    found = found.withColumn("metrics", F.map_filter(clamped, lambda k, v: v["score"].isNotNull()))
    score = lambda d: F.try_element_at("metrics", F.lit(d))["score"]
    install = F.col("_a.mcp_installability")
    unknown = F.struct(
        F.lit(False).alias("schema_valid"), F.lit("unknown").alias("state"),
        F.array(F.lit("insufficient_evidence")).alias("tags"), F.lit("no installability answer").alias("reason"),
    )
    said = jsons.normalize_installability(install["mcp_validation_tags"], install["mcp_installability_reason"])
    given = F.struct(
        install["mcp_schema_valid"].alias("schema_valid"), install["mcp_install_state"].alias("state"),
        said["tags"].alias("tags"), said["reason"].alias("reason"),
    )
    accepted = _per_task(lambda t: jsons.accept_result(F.col("metrics"), list(weights_of(t))))
    quality = _per_task(lambda t: scores.quality_score({d: score(d) for d in weights_of(t)}, weights_of(t)))
    return found.select(
        key, type_, "task", accepted.alias("accepted"), "metrics",
        F.when(F.col("_a.enrichment").isNotNull(), jsons.normalize_enrichment("_a.enrichment")).alias("enrichment"),
        F.when(F.col(type_) == "mcp", F.when(install.isNull(), unknown).otherwise(given)).alias("installability"),
        F.when(accepted, quality).alias("quality"),
        score("coding_relevance").alias("relevance"),
    )


def skipped(parsed: DataFrame) -> DataFrame:
    """Rows whose answer was not accepted; they go to the failure ledger."""
    return parsed.filter(~F.col("accepted"))
