"""The classification and report of the first table layout.

There runs are numbered (``id`` / ``run_id``), and ``run_story`` stores the ranks and a
``success`` flag.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import SECOND, micros_between
from ..schema import CODE, LEGACY_HOT_RANKBUMP, RANKINGS, status_code, status_name
from .ranks import RANK_COLUMNS, stories_ranks


@dataclass(frozen=True)
class LegacyRuleset:
    """Thresholds of the early rule; ages in seconds."""

    new_repeat: int
    hot_repeat: int
    hot_rank: int
    tepid_rank: int
    tepid_age: float
    cooling_repeat: int
    cooling_age: float
    cold_repeat: int
    cold_age: float
    frozen_age: float
    hot_rankbump: int = LEGACY_HOT_RANKBUMP


def _last_records(run: DataFrame, run_story: DataFrame) -> DataFrame:
    """Latest record per story with its lifetime count in that status, in one aggregation."""
    rows = run_story.select("story_id", "run_id", status_code().alias("code"), *RANK_COLUMNS)
    counts = [F.expr(f"count_if(code = {c}) AS _n{c}") for c in CODE.values()]
    latest = rows.groupBy("story_id").agg(
        F.max("run_id").alias("last_run_id"),
        F.max_by("code", "run_id").alias("last_code"),
        *[F.max_by(c, "run_id").alias(f"last_{c}") for c in RANK_COLUMNS],
        *counts,
    )
    repeat = " ".join(f"WHEN {c} THEN _n{c}" for c in CODE.values())
    return (
        latest.withColumn("last_status_repeat", F.expr(f"CASE last_code {repeat} END"))
        .drop(*[f"_n{c}" for c in CODE.values()])
        .join(
            run.select(F.col("id").alias("last_run_id"), F.col("ts_run").alias("last_ts_run")),
            "last_run_id",
        )
    )


def classify_rankbump(
    run: DataFrame, run_story: DataFrame, rules: LegacyRuleset, run_id: int | None = None
) -> DataFrame:
    """Status of every story under the early rule.

    It looks at the *last* ranks, and makes a story hot when it climbed by more than
    ``hot_rankbump`` places. The age is only known for stories ranked in this run, so an
    unranked story is never due.
    """
    if run_id is None:
        run_id = run.agg(F.max("id")).first()[0]
    ranks = stories_ranks(run.filter(F.col("id") == run_id))
    last = _last_records(run, run_story.filter(F.col("run_id") < run_id))
    last_top, last_best, last_new = (F.col(f"last_{c}") for c in RANK_COLUMNS)
    top, best, _ = (F.col(c) for c in RANK_COLUMNS)
    status, repeat = F.col("last_code"), F.col("last_status_repeat")

    def still(name: str, times: int) -> Column:
        return (status == CODE[name]) & (repeat < times)

    def climbed(before: Column, now: Column) -> Column:
        return (before - now) > rules.hot_rankbump

    code = (
        F.when(status.isNull() | still("new", rules.new_repeat), CODE["new"])
        .when(
            (status == CODE["new"])
            | (last_top <= rules.hot_rank)
            | (last_best <= rules.hot_rank)
            | climbed(last_top, top)
            | climbed(last_best, best)
            | still("hot", rules.hot_repeat),
            CODE["hot"],
        )
        .when(
            (last_top <= rules.tepid_rank)
            | (last_best <= rules.tepid_rank)
            | (last_new <= rules.tepid_rank),
            CODE["tepid"],
        )
        .when(
            (status < CODE["cooling"]) | still("cooling", rules.cooling_repeat), CODE["cooling"]
        )
        .when(
            (status < CODE["cold"])
            | still("cold", rules.cold_repeat)
            | (status == CODE["missing"]),
            CODE["cold"],
        )
        .otherwise(CODE["frozen"])
    )
    return (
        ranks.join(last, "story_id", "full_outer")
        .withColumn("code", code)
        .select(
            F.lit(run_id).cast("bigint").alias("run_id"),
            "story_id",
            *RANK_COLUMNS,
            status_name("code").alias("status"),
            micros_between(F.col("ts_run"), F.col("last_ts_run")).alias("last_age_micros"),
        )
    )


def filter_rankbump(classified: DataFrame, rules: LegacyRuleset) -> DataFrame:
    """Stories due under the early rule: no promotion, no daily window."""
    status, age = F.col("status"), F.col("last_age_micros")

    def waited(name: str, seconds: float) -> Column:
        return (status == name) & (age >= int(seconds * SECOND))

    return classified.filter(
        status.isin("new", "hot")
        | waited("tepid", rules.tepid_age)
        | waited("cooling", rules.cooling_age)
        | waited("cold", rules.cold_age)
        | waited("frozen", rules.frozen_age)
    )


def stats_run_story_legacy(run: DataFrame, run_story: DataFrame) -> DataFrame:
    """Per run: listed and recorded stories per list, status counts, failures, retries.

    Records are reduced to a row per run before they meet the runs. A run without
    records keeps one row, which counts as one, and as one without a score.
    """
    no_score = F.count_if(F.col("score").isNull())
    counts = run_story.groupBy(F.col("run_id").alias("id")).agg(
        *[F.count(c).alias(f"{n}_recorded") for n, c in zip(RANKINGS, RANK_COLUMNS)],
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in LEGACY_COUNTED],
        (F.count_if(~F.col("success")) - no_score).alias("retried_count"),
        no_score.alias("fail_count"),
        F.count("*").alias("total_count"),
        F.max("ts_payload").alias("_end"),
    )
    rows = run.select("id", "ts_run", *[_size(n).alias(f"{n}_count") for n in RANKINGS])
    zero_if_empty = [f"{n}_recorded" for n in RANKINGS] + [f"{s}_count" for s in LEGACY_COUNTED]
    return rows.join(counts, "id", "left").select(
        F.col("id").alias("run_id"),
        *[f"{n}_count" for n in RANKINGS],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in zero_if_empty],
        F.coalesce("retried_count", F.lit(-1)).alias("retried_count"),
        F.coalesce("fail_count", F.lit(1)).alias("fail_count"),
        F.coalesce("total_count", F.lit(1)).alias("total_count"),
        "ts_run",
        micros_between(F.col("_end"), F.col("ts_run")).alias("fetch_micros"),
    )


LEGACY_COUNTED = ("new", "hot", "tepid", "cooling", "cold", "frozen", "missing")


def _size(name: str) -> Column:
    return F.when(F.size(name) > 0, F.size(name))
