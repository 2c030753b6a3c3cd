"""Rule-driven status of every known or newly ranked story."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import check_time_window, is_older
from ..ruleset import Ruleset
from ..schema import CODE, status_name
from ..sources.tables import before, run_time, up_to
from .ranks import RANK_COLUMNS, ranks_at
from .status import known_state, last_state

TOP, BEST, NEW = RANK_COLUMNS


def new_code(rules: Ruleset) -> Column:
    """Code of the next status. First matching line wins.

    Reads the current ranks and last_code / last_status_repeat. Statuses are ordered:
    "better than cold" is a smaller code. A NULL rank or status matches nothing.
    """
    last, repeat = F.col("last_code"), F.col("last_status_repeat")
    top, best, new = (F.col(c) for c in RANK_COLUMNS)

    def better_than(status: str) -> Column:
        return last < CODE[status]

    def still(status: str, times: int) -> Column:
        return (last == CODE[status]) & (repeat < times)

    unreachable = last.isin(CODE["failed"], CODE["missing"])
    return (
        F.when(last.isNull() | still("new", rules.new_repeat), CODE["new"])
        .when(
            better_than("hot")
            | (top <= rules.hot_rank)
            | (best <= rules.hot_rank)
            | still("hot", rules.hot_repeat),
            CODE["hot"],
        )
        .when(
            (top <= rules.tepid_rank)
            | (best <= rules.tepid_rank)
            | (new <= rules.tepid_rank)
            | (unreachable & (repeat < rules.failed_repeat)),
            CODE["tepid"],
        )
        .when(better_than("cooling") | still("cooling", rules.cooling_repeat), CODE["cooling"])
        .when(better_than("cold") | still("cold", rules.cold_repeat), CODE["cold"])
        .when(last <= CODE["frozen"], CODE["frozen"])
        .otherwise(CODE["unexpected"])
    )


def is_due(rules: Ruleset) -> Column:
    """Whether a story with ``new_code`` should be measured in this run."""
    code, now, then = F.col("new_code"), F.col("ts_run"), F.col("last_ts_run")

    def waited(status: str, age: float) -> Column:
        return (code == CODE[status]) & is_older(now, then, age)

    return (
        (code <= CODE["hot"])
        | (code < F.col("last_code"))
        | waited("tepid", rules.tepid_age)
        | waited("cooling", rules.cooling_age)
        | waited("cold", rules.cold_age)
        | (
            code.isin(CODE["unknown"], CODE["frozen"])
            & is_older(now, then, rules.frozen_age)
            & check_time_window(now, then, rules.frozen_window)
        )
    )


def latest_run(run: DataFrame):
    """Timestamp of the last run, or None. One scalar, so later filters can prune."""
    return run.agg(F.max("ts_run")).first()[0]


def classify_stories(
    run: DataFrame,
    run_story: DataFrame | None,
    rules: Ruleset,
    ts_run=None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Status and fetch decision of every story, seen from one run.

    Joins the ranks of the run with the last state strictly before it; both sides have
    one row per story, so the full join on story_id cannot be skewed. ``ts_run=None``
    means the latest run. ``state`` (see ``story_state``) replaces reading
    ``run_story``; it must hold records before the run only. With no earlier record
    every ranked story is new; with no run at all the result is empty.
    """
    return decode(classify_codes(run, run_story, rules, ts_run, state))


def classify_codes(run, run_story, rules, ts_run=None, state=None, recorded=False) -> DataFrame:
    """:func:`classify_stories` with statuses still as codes.

    ``recorded`` says that every run the state refers to is recorded, so that ``run`` need hold no
    earlier ones.
    """
    if ts_run is None:
        ts_run = latest_run(run)
    if ts_run is None:  # no run at all: any time gives a typed, empty result
        ts_run = datetime(1970, 1, 1)
    ranks = ranks_at(run, ts_run)
    if state is None:
        last = last_state(run, run_story, ts_run)
    else:
        last = known_state(None if recorded else before(run, ts_run), state)
    return (
        ranks.join(last, "story_id", "full_outer")
        .withColumn("ts_run", run_time(run, ts_run))
        .withColumn("new_code", new_code(rules))
        .withColumn("fetch_now", is_due(rules))
        .select(
            "ts_run",
            "story_id",
            *RANK_COLUMNS,
            "last_score",
            "last_code",
            "last_status_repeat",
            "last_ts_run",
            "new_code",
            "fetch_now",
        )
    )


def decode(classified: DataFrame) -> DataFrame:
    """Replace status codes by names."""
    names = {"last_code": "last_status", "new_code": "new_status"}
    return classified.select(
        *[
            status_name(c).alias(names[c]) if c in names else F.col(c)
            for c in classified.columns
        ]
    )


def fetch_candidates(classified: DataFrame) -> DataFrame:
    return classified.filter("fetch_now")


def status_transitions(classified: DataFrame) -> DataFrame:
    """How many stories moved from which status to which, ranked or not, due or not."""
    unranked = F.col(TOP).isNull() & F.col(BEST).isNull() & F.col(NEW).isNull()
    return (
        classified.withColumn("allranksnull", unranked)
        .groupBy("fetch_now", "allranksnull", "last_status", "new_status")
        .agg(F.count("*").alias("count"))
    )


def classify_reconcile(classified: DataFrame, recorded: DataFrame, as_of=None) -> DataFrame:
    """Number of classified stories, and of distinct stories recorded up to ``as_of``.

    The two belong together for ``as_of`` the classified run; None counts every record.
    """
    known = recorded if as_of is None else up_to(recorded, as_of)
    return classified.agg(F.count("*").alias("count")).unionAll(
        known.agg(F.count_distinct("story_id").alias("count"))
    )
