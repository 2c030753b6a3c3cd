"""Reports over the recorded tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import __version__
from ..functions.payload import json_fields
from ..functions.times import micros_between
from ..schema import RANKINGS
from ..sources.tables import before, run_time
from .ordered import neighbours
from .ranks import RANK_COLUMNS, landed_ranks, stories_ranks, with_few_ranks

#: Statuses with a count column, in report order.
COUNTED = ("new", "hot", "tepid", "cooling", "cold", "frozen", "deleted", "missing", "failed")

_TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def stats_run(run: DataFrame, as_of: Column | None = None) -> DataFrame:
    """First and last run, active span and UTC offset of the session, as one row."""
    now = F.current_timestamp() if as_of is None else as_of
    return run.agg(F.min("ts_run").alias("first"), F.max("ts_run").alias("last")).select(
        F.date_format(now, _TIME_TEXT).alias("pointage"),
        F.current_database().alias("database"),
        _utc_offset(F.col("last")).alias("diff_utc_seconds"),
        F.date_format("first", _TIME_TEXT).alias("min_ts_utc"),
        F.date_format("last", _TIME_TEXT).alias("max_ts_utc"),
        F.lit(__version__).alias("extversion"),
        micros_between(F.col("last"), F.col("first")).alias("active_micros"),
    )


def _utc_offset(ts: Column) -> Column:
    instant = ts.cast("timestamp")
    wall = F.to_utc_timestamp(instant, F.current_timezone())
    return ((F.unix_micros(instant) - F.unix_micros(wall)) / 1_000_000).cast("bigint")


def _status_counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in COUNTED]


def _story_errors(error: DataFrame) -> DataFrame:
    """Errors of story fetches, keyed like ``run_story``.

    The source is tested before its ID is read as a number: run errors carry names.
    """
    return error.filter(F.col("error_source") == "run_story").select(
        "ts_run",
        F.col("source_id").try_cast("bigint").alias("story_id"),
        (F.get_json_object("report", "$.retries").try_cast("int") > 0).alias("retried"),
    )


def stats_run_story(run_story: DataFrame, error: DataFrame) -> DataFrame:
    """Per run: records in each status, retried fetches, total and fetch duration.

    The three list columns are placeholders without a value, kept for their place in the
    report; :func:`stats_run_story_coverage` fills them.
    """
    rows = run_story.select("ts_run", "story_id", "status", "ts_payload")
    return (
        rows.join(_story_errors(error), ["ts_run", "story_id"], "left")
        .groupBy("ts_run")
        .agg(
            *_status_counts(),
            F.count_if("retried").alias("retried_count"),
            F.count("*").alias("total_count"),
            F.max("ts_payload").alias("_end"),
        )
        .select(
            "ts_run",
            *[F.lit(None).cast("string").alias(n) for n in RANKINGS],
            *COUNTED,
            "retried_count",
            "total_count",
            micros_between(F.col("_end"), F.col("ts_run")).alias("fetch_micros"),
        )
    )


def stats_run_story_coverage(
    run: DataFrame, run_story: DataFrame, error: DataFrame
) -> DataFrame:
    """The same with "recorded/listed" per list, for every run.

    A list that was not collected shows as "error". A run without records keeps one row,
    whose total counts that row. Everything per story is joined on (ts_run, story_id) and
    reduced to a row per run before the run's lists come in.
    """
    listed = run.select("ts_run", *[_listed(n).alias(f"_{n}_listed") for n in RANKINGS])
    return covered(listed, run_counts(stories_ranks(run), run_story, error))


def landed_coverage(rankings: DataFrame, run_story: DataFrame, error: DataFrame) -> DataFrame:
    """:func:`stats_run_story_coverage` from parsed lists: places and sizes are read off the lists as
    they landed, so no run's lists are put together first and every aggregation is by hash."""
    return covered(list_sizes(rankings), run_counts(landed_ranks(rankings), run_story, error))


def list_sizes(rankings: DataFrame) -> DataFrame:
    """Per run the size of each parsed list, NULL where it was not collected."""
    size = F.size("payload")
    sizes = [F.max(F.when((F.col("id") == n) & (size > 0), size)).alias(f"_{n}_listed") for n in RANKINGS]
    return rankings.groupBy("ts_run").agg(*sizes)


def run_counts(ranks: DataFrame, run_story: DataFrame, error: DataFrame) -> DataFrame:
    """Per run with records: additive counts, and the time of the last response."""
    return (
        run_story.select("ts_run", "story_id", "status", "ts_payload")
        .join(ranks, ["ts_run", "story_id"], "left")
        .join(_story_errors(error), ["ts_run", "story_id"], "left")
        .groupBy("ts_run")
        .agg(
            *[F.count(c).alias(f"_{n}") for n, c in zip(RANKINGS, RANK_COLUMNS)],
            *_status_counts(),
            F.count_if("retried").alias("retried_count"),
            F.count("*").alias("total_count"),
            F.max("ts_payload").alias("_end"),
        )
    )


def covered(listed: DataFrame, counts: DataFrame) -> DataFrame:
    """The report from the sizes of the lists and the counts, each a row per run."""
    joined = listed.join(counts, "ts_run", "left")

    def coverage(name: str) -> Column:
        size = F.coalesce(F.col(f"_{name}_listed").cast("string"), F.lit("error"))
        recorded = F.coalesce(F.col(f"_{name}"), F.lit(0)).cast("string")
        return F.concat_ws("/", recorded, size)

    return joined.select(
        "ts_run",
        *[coverage(n).alias(n) for n in RANKINGS],
        *[F.coalesce(s, F.lit(0)).alias(s) for s in (*COUNTED, "retried_count")],
        F.coalesce("total_count", F.lit(1)).alias("total_count"),
        micros_between(F.col("_end"), F.col("ts_run")).alias("fetch_micros"),
    )


def _listed(name: str) -> Column:
    size = F.size(name)
    return F.when(size > 0, size)


def diagnose_errors(run: DataFrame, run_story: DataFrame, error: DataFrame) -> DataFrame:
    """Errors with the story's status, score and ranks, and the parsed report.

    Errors are rare, so their ranks are read off the lists.
    """
    number = F.col("source_id").try_cast("bigint")
    # IDs match as text: "07" is not story 7
    same = (F.col("error_source") == "run_story") & (number.cast("string") == F.col("source_id"))
    of_story = F.when(same, number)
    errors = with_few_ranks(error.withColumn("story_id", of_story), run)
    recorded = run_story.select("ts_run", "story_id", "status", "score")
    # their story's ranks are only shown if it was recorded
    fields = {
        "ts_end": run.schema["ts_run"].dataType.simpleString(),
        "duration": "decimal(38,18)",
        "retries": "int",
        "batch_failrate": "decimal(38,18)",
        "url": "string",
        "payload": "string",
    }
    ranked = json_fields(errors, "report", **fields).join(
        recorded.withColumn("_recorded", F.lit(True)), ["ts_run", "story_id"], "left"
    )

    def shown(rank: str) -> Column:
        value = F.when(F.col("_recorded"), F.col(rank)).cast("string")
        return F.coalesce(value, F.lit("*"))

    return ranked.select(
        "ts_run",
        "error_source",
        "source_id",
        "status",
        F.concat_ws("/", *[shown(c) for c in RANK_COLUMNS]).alias("rankings"),
        "score",
        *fields,
    )


def run_ruptures(run: DataFrame, seconds: float = 7 * 60) -> DataFrame:
    """Runs whose gap to the previous or next run exceeds a threshold."""
    limit = int(seconds * 1_000_000)
    gaps = neighbours(run.select("ts_run")).filter(
        (micros_between(F.col("ts_run"), F.col("previous")) > limit)
        | (micros_between(F.col("next"), F.col("ts_run")) > limit)
    )
    return run.join(gaps.select("ts_run"), "ts_run", "left_semi").withColumn(
        "rupture", F.lit(True)
    )


def missing_runs_at(run: DataFrame, before_ts) -> DataFrame:
    """Up to the last run before a time: runs, highest id, and ids without a run.

    ``run`` needs an ``id`` that counts cycles. See :func:`with_cycle_id`.
    """
    earlier = before(run, before_ts)
    last = earlier.agg(F.max("id")).scalar()
    return (
        run.select("id", "ts_run")
        .filter(F.col("id") <= last)
        .agg(
            F.count("*").alias("nb_run"),
            F.max("id").alias("max_id"),
            (F.max("id") - F.count("*")).alias("missing_run"),
            F.max("ts_run").alias("max_ts_run"),
        )
    )


def with_cycle_id(run: DataFrame, start, seconds: int) -> DataFrame:
    """Number runs by the cycle they fall in, counted from 1 at ``start``."""
    elapsed = micros_between(F.col("ts_run"), run_time(run, start))
    return run.withColumn("id", F.floor(elapsed / (seconds * 1_000_000)) + 1)


def retry_profile(responses: DataFrame) -> DataFrame:
    """Per retry count: fetches, durations and time from run start to the last answer."""
    return responses.groupBy("retries").agg(
        F.max(micros_between(F.col("ts_end"), F.col("ts_run"))).alias("total_micros"),
        F.avg("duration").alias("avg_duration"),
        F.max("duration").alias("max_duration"),
        F.min("duration").alias("min_duration"),
        F.count("*").alias("count"),
    )
