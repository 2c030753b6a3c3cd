"""One collection cycle over landed responses."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.classify import classify_codes, fetch_candidates
from ..operators.collect import (
    assemble_run,
    fetch_outcomes,
    record_run_story,
    run_errors,
    run_story_errors,
)
from ..ruleset import Ruleset
from ..schema import RUN
from ..session import shared_dir
from ..sources.responses import parse_rankings
from ..sources.tables import DAY_COLUMN, at


@dataclass(frozen=True)
class Cycle:
    """What a cycle adds to the stored tables."""

    run: DataFrame
    run_story: DataFrame
    error: DataFrame


def run_cycle(
    rankings_raw: DataFrame,
    items_raw: DataFrame,
    run: DataFrame,
    run_story: DataFrame | None,
    rules: Ruleset,
    ts_run=None,
    state: DataFrame | None = None,
    runs: DataFrame | None = None,
) -> Cycle:
    """Record the lists of one run, decide what to fetch, and record what came back.

    ``run`` and ``run_story`` are the tables before the cycle (a ``state`` may stand in
    for the latter). The IDs to fetch never leave the executors: candidates are joined to
    the landed responses. ``runs`` is the schedule, which names a run even if all its lists failed;
    known stories that are due are fetched in it all the same. What was fetched is written once to the shared folder, and both
    outputs read it, so the classification is not computed twice.
    """
    if ts_run is None:
        known = rankings_raw.select("ts_run")
        known = known if runs is None else known.unionAll(runs.select("ts_run"))
        ts_run = known.agg(F.max("ts_run")).first()[0]
    scheduled = None if runs is None else at(runs.select("ts_run"), ts_run)
    rankings = parse_rankings(at(rankings_raw, ts_run), runs=scheduled)
    new_run = assemble_run(rankings, rules.name)
    day = {DAY_COLUMN} & set(run.columns)
    recorded = run.select(*RUN.names, *day)
    current = new_run.select(*RUN.names, *[F.to_date("ts_run").alias(d) for d in day])
    classified = classify_codes(
        recorded.unionByName(current), run_story, rules, ts_run, state=state
    )
    outcomes = fetch_outcomes(fetch_candidates(classified), at(items_raw, ts_run))
    spark = run.sparkSession
    path = shared_dir(spark, "outcomes")
    outcomes.write.parquet(path)
    outcomes = spark.read.parquet(path)
    return Cycle(
        run=new_run.select(*RUN.names),
        run_story=record_run_story(outcomes),
        error=run_errors(rankings).unionByName(run_story_errors(outcomes)),
    )
