"""Last recorded state of each story."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COUNT_COLUMNS, STATUSES, status_code, status_name
from ..sources.tables import before, up_to
from .ordered import latest_before
from .ranks import RANK_COLUMNS, in_known_runs, with_few_ranks


def story_state(run_story: DataFrame) -> DataFrame:
    """Latest record of each story and how often it was recorded in each status.

    One aggregation on story_id with fixed-width buffers: it is combined before the
    shuffle, so a story with very many records costs no more than any other after it.
    """
    code = status_code().alias("code")
    records = run_story.select("story_id", "ts_run", "score", code)
    return records.groupBy("story_id").agg(
        F.max("ts_run").alias("last_ts"),
        F.max_by("code", "ts_run").alias("last_code"),
        F.max_by("score", "ts_run").alias("last_score"),
        *[F.expr(f"count_if(code = {c}) AS n_{s}") for c, s in enumerate(STATUSES)],
        F.expr("count_if(code IS NULL) AS n_none"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """State over the union of the records behind several states.

    Lets a cycle fold its few new records into a stored state instead of reading
    the whole history again.
    """
    union = states[0]
    for other in states[1:]:
        union = union.unionByName(other)
    return union.groupBy("story_id").agg(
        F.max("last_ts").alias("last_ts"),
        F.max_by("last_code", "last_ts").alias("last_code"),
        F.max_by("last_score", "last_ts").alias("last_score"),
        *[F.sum(c).alias(c) for c in COUNT_COLUMNS],
    )


def status_repeat() -> Column:
    """How often a story was recorded in its last status (over its lifetime)."""
    arms = " ".join(f"WHEN {code} THEN n_{status}" for code, status in enumerate(STATUSES))
    return F.expr(f"CAST(CASE last_code {arms} ELSE n_none END AS INT)")


def stories_status(run: DataFrame, run_story: DataFrame, as_of=None) -> DataFrame:
    """Latest record of each story up to ``as_of``, with its ranks in that run.

    A story whose latest record belongs to a run that is not in ``run`` is left out.
    """
    records = run_story if as_of is None else up_to(run_story, as_of)
    state = story_state(records).select(
        F.col("last_ts").alias("ts_run"),
        "story_id",
        status_name("last_code").alias("status"),
        F.col("last_score").alias("score"),
        status_repeat().alias("status_repeat"),
    )
    return with_few_ranks(state, run).select(
        "ts_run", "story_id", *RANK_COLUMNS, "status", "score", "status_repeat"
    )


def last_state(run: DataFrame, run_story: DataFrame, ts_run) -> DataFrame:
    """What classification at ``ts_run`` sees of the past: the state strictly before it."""
    return known_state(before(run, ts_run), story_state(before(run_story, ts_run)))


def known_state(run: DataFrame | None, state: DataFrame) -> DataFrame:
    """A state as classification reads it; ``run`` None: all its runs are known to be recorded."""
    state = state.select(
        "story_id",
        F.col("last_ts").alias("ts_run"),
        F.col("last_code"),
        F.col("last_score"),
        status_repeat().alias("last_status_repeat"),
    )
    if run is not None:
        state = in_known_runs(state, run)
    return state.withColumnRenamed("ts_run", "last_ts_run")


def last_recorded_run(run_story: DataFrame, ts_run) -> DataFrame:
    """Greatest recorded run strictly before ``ts_run``, as one row."""
    return before(run_story, ts_run).agg(F.max("ts_run").alias("last_ts_run"))


def last_recorded_runs(run: DataFrame, run_story: DataFrame) -> DataFrame:
    """The same for every run at once."""
    return latest_before(run.select("ts_run"), run_story.select("ts_run")).withColumnRenamed(
        "latest", "last_ts_run"
    )
