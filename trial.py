"""Times operators on made-up tables of the documented production size, or a share of it.

    TRIAL_SHARE=1 python trial.py     25.6 million records, 104,124 runs, three lists of 500

Not a registered query: a trial of size, whose rows mean nothing. Prints one JSON line.
"""

import json
import os
import tempfile
import time
from datetime import timedelta

from pyspark.sql import functions as F

from ranktrail.operators.classify import classify_stories, latest_run
from ranktrail.operators.maintenance import merge_instances, rewrite_stale_unknown
from ranktrail.operators.ranks import stories_ranks
from ranktrail.operators.reports import diagnose_errors, stats_run_story, stats_run_story_coverage
from ranktrail.operators.status import stories_status
from ranktrail.plans import snapshots
from ranktrail.ruleset import builtin_rules, load_ruleset
from ranktrail.schema import ERROR, RUN, RUN_STORY, STATUSES
from ranktrail.session import get_spark
from ranktrail.sources.histories import append_histories, story_history
from ranktrail.sources.tables import read_table, write_table

SHARE = float(os.environ.get("TRIAL_SHARE", "0.01"))
RUNS, PER_RUN, LIST = max(600, int(104_124 * SHARE)), 246, 500
STORIES = max(2_000, int(324_081 * SHARE))


def made_up(spark, folder: str) -> None:
    """Runs every five minutes; a story at most once in a run's records."""
    when = F.timestamp_micros(F.lit(1_640_995_200_000_000) + F.col("r") * 300_000_000).cast("timestamp_ntz")
    run = spark.range(RUNS).withColumnRenamed("id", "r")

    def listed(salt: int):
        places = F.sequence(F.lit(1), F.lit(LIST))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.col("r") / 50, i, F.lit(salt)), F.lit(STORIES)))

    run = run.select(
        when.alias("ts_run"), listed(1).alias("topstories"), listed(2).alias("beststories"),
        listed(3).alias("newstories"), when.alias("ts_end"), F.lit("t").alias("extversion"),
        F.lit("trial").alias("ruleset_id"),
    )
    write_table(run.select(*RUN.names), f"{folder}/run")
    rows = spark.range(RUNS * PER_RUN).select(
        F.expr(f"id div {PER_RUN}").alias("r"), F.expr(f"id % {PER_RUN}").alias("k")
    )
    story = F.pmod(F.col("r") * 31 + F.col("k") * (STORIES // PER_RUN), F.lit(STORIES))
    code = F.pmod(F.xxhash64("r", "k"), F.lit(len(STATUSES))).cast("int")
    records = rows.select(
        when.alias("ts_run"), story.alias("story_id"),
        F.element_at(F.array(*[F.lit(s) for s in STATUSES]), code + 1).alias("status"),
        F.col("k").cast("int").alias("score"), F.col("k").alias("descendants"), when.alias("ts_payload"),
    )
    write_table(records.select(*RUN_STORY.names), f"{folder}/run_story")
    errors = records.filter(F.col("score") < 12).select(
        "ts_run", F.lit("run_story").alias("error_source"), F.col("story_id").cast("string").alias("source_id"),
        F.format_string('{"url":"u","retries":%d,"duration":1}', F.col("score") % 3).alias("report"),
    )
    write_table(errors, f"{folder}/error")


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "trial", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="trial-")
    made_up(spark, folder)
    run, run_story, error = (
        read_table(spark, f"{folder}/{n}", s) for n, s in (("run", RUN), ("run_story", RUN_STORY), ("error", ERROR))
    )
    rules = load_ruleset(builtin_rules(spark), "production_default")
    last = latest_run(run)
    past = last - timedelta(days=1)
    times = {}

    def timed(name, action):
        start = time.perf_counter()
        found = action()
        if hasattr(found, "write"):
            found.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 2)

    timed("classify_stories", lambda: classify_stories(run, run_story, rules, last))
    timed("stories_status", lambda: stories_status(run, run_story))
    timed("stories_ranks", lambda: stories_ranks(run))
    timed("stats_run_story", lambda: stats_run_story(run_story, error))
    timed("stats_run_story_coverage", lambda: stats_run_story_coverage(run, run_story, error))
    timed("diagnose_errors", lambda: diagnose_errors(run, run_story, error))
    timed("merge_instances", lambda: merge_instances("run_story", [run_story.select(*RUN_STORY.names)] * 3))
    timed("append_histories", lambda: append_histories(run, run_story, f"{folder}/histories"))
    timed("story_history", lambda: story_history(spark, f"{folder}/histories", 7))
    timed("classify_past_run", lambda: classify_stories(run, run_story, rules, past))
    states = f"{folder}/snapshots"
    timed("daily_snapshots", lambda: snapshots.extend_snapshots(run_story, states))
    timed("classify_past_run_by_snapshot", lambda: snapshots.classify_as_of(run, run_story, rules, past, states))
    timed("rewrite_stale_unknown", lambda: rewrite_stale_unknown(run, f"{folder}/run_story"))
    print(json.dumps({"share": SHARE, "records": RUNS * PER_RUN, "runs": RUNS, "seconds": times}))


if __name__ == "__main__":
    main()
