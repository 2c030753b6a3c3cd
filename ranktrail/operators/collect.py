"""Recording a run: from parsed responses to rows of run, run_story and error."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import __version__
from ..functions.payload import json_fields, splice, to_report
from ..schema import CODE, DEFAULT_RULESET, JSON_NULL_MARKER, RANKINGS, status_name
from ..sources.responses import RESPONSE_FIELDS, attach_responses


def assemble_run(
    rankings: DataFrame, ruleset_id: str = DEFAULT_RULESET, version: str = __version__
) -> DataFrame:
    """One run row from the rows of its lists."""
    lists = [
        F.max(F.when(F.col("id") == name, F.col("payload"))).alias(name) for name in RANKINGS
    ]
    return (
        rankings.groupBy("ts_run")
        .agg(*lists, F.max("ts_end").alias("ts_end"))
        .withColumn("extversion", F.lit(version))
        .withColumn("ruleset_id", F.lit(ruleset_id))
    )


def run_errors(rankings: DataFrame) -> DataFrame:
    """Error rows of lists that did not arrive, or only after a retry.

    A NULL retry count is not "other than 0".
    """
    report = to_report([F.col(c) for c in ("id", "url", "payload", *RESPONSE_FIELDS)])
    return rankings.filter(F.col("payload").isNull() | (F.col("retries") != 0)).select(
        "ts_run",
        F.lit("run").alias("error_source"),
        F.col("id").alias("source_id"),
        report.alias("report"),
    )


#: Members of an item payload that recording reads.
RECORDED_FIELDS = {"deleted": "string", "score": "int", "descendants": "bigint"}


def outcome_code(payload: Column, deleted: Column, otherwise: Column) -> Column:
    """Status after a fetch: what came back overrides what was expected."""
    return (
        F.when(deleted == "true", CODE["deleted"])
        .when(payload == JSON_NULL_MARKER, CODE["missing"])
        .when(payload.isNull(), CODE["failed"])
        .otherwise(otherwise)
    )


def fetch_outcomes(candidates: DataFrame, responses: DataFrame) -> DataFrame:
    """Candidates with what came back, as codes; records and errors both derive from it.

    ``candidates`` needs ts_run, story_id and new_code and is unique on the first two,
    so the landed responses are joined to it directly.
    """
    wanted = candidates.select("ts_run", "story_id", "new_code")
    attached = json_fields(attach_responses(wanted, responses), "payload", **RECORDED_FIELDS)
    return attached.select(
        "ts_run",
        "story_id",
        outcome_code(F.col("payload"), F.col("deleted"), F.col("new_code")).alias("code"),
        "score",
        "descendants",
        "url",
        "payload",
        *RESPONSE_FIELDS,
    )


def record_run_story(outcomes: DataFrame) -> DataFrame:
    """Rows to append to ``run_story``."""
    return outcomes.select(
        "ts_run",
        "story_id",
        status_name("code").alias("status"),
        "score",
        "descendants",
        F.col("ts_end").alias("ts_payload"),
    )


def run_story_errors(outcomes: DataFrame) -> DataFrame:
    """Error rows of fetches that ended deleted or worse, or needed a retry.

    Missing and failed stories rank below deleted, so they appear only when retried.
    """
    head = [F.col("story_id").alias("id"), F.col("url")]
    report = splice(head, "payload", F.col("payload"), [F.col(c) for c in RESPONSE_FIELDS])
    return outcomes.filter((F.col("code") >= CODE["deleted"]) | (F.col("retries") != 0)).select(
        "ts_run",
        F.lit("run_story").alias("error_source"),
        F.col("story_id").cast("string").alias("source_id"),
        report.alias("report"),
    )
