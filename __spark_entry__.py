
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from ranktrail.functions.times import calendar_age_micros, check_time_window  # noqa: E402
from ranktrail.operators import (  # noqa: E402
    classify,
    collect,
    export,
    legacy,
    maintenance,
    ranks,
    report_state,
    reports,
    status,
)
from ranktrail.plans.cycle import run_cycle  # noqa: E402
from ranktrail.plans import snapshots  # noqa: E402
from ranktrail.plans.replay import replay_history  # noqa: E402
from ranktrail.ruleset import load_ruleset  # noqa: E402
from ranktrail.schema import RANKINGS, RUN_STORY  # noqa: E402
from ranktrail.session import shared_dir  # noqa: E402
from ranktrail.sources import histories, responses  # noqa: E402
from ranktrail.sources.samples import Samples, sample_rules, samples  # noqa: E402
from ranktrail.sources.tables import at, before, read_table, write_table  # noqa: E402
from ranktrail.streaming import live, stories  # noqa: E402

SMALL = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}

try:  # the package for training-data pipelines may be absent
    import corpus_pipeline
    from ranktrail.llm import queries as llm_queries
except ImportError:
    llm_queries = None


def _query(function: Callable[[Samples], DataFrame]) -> Callable[[Samples], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(samples(spark, sf_dir))

    _registered[function.__name__] = run
    return function


def entry(spark: SparkSession) -> DataFrame:
    """Status and fetch decision of every story, seen from the latest run."""
    return _registered["classify_stories"](spark, SMALL)


def queries() -> dict[str, Query]:
    if llm_queries is None:
        return dict(_registered)
    return _registered | llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return oracle.oracle_sql()
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.oracle_sql() | llm_queries.SQL | own


def _rules(s: Samples, name: str = "bench"):
    return load_ruleset(sample_rules(s.spark), name)


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as comma-separated text, so that any engine's rows compare equal."""
    text = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in columns}
    return df.withColumns(text)


def _without_day(df: DataFrame) -> DataFrame:
    return df.drop("run_date")


# --- collecting -------------------------------------------------------------------------


def _parsed(s):
    return responses.parse_rankings(s.rankings_raw, runs=s.run)


@_query
def parse_rankings(s):
    return _as_text(_parsed(s), "payload")


@_query
def parse_items(s):
    return responses.parse_items(ranks.stories_ranks(s.run), s.items_raw)


@_query
def extract_item_fields(s):
    return _as_text(responses.extract_item_fields(s.items_raw), "kids")


@_query
def assemble_run(s):
    return _as_text(collect.assemble_run(_parsed(s), "bench"), *RANKINGS)


@_query
def run_errors(s):
    return collect.run_errors(_parsed(s))


def _outcomes(s):
    classified = classify.classify_codes(s.run, s.run_story, _rules(s))
    latest = at(s.items_raw, classify.latest_run(s.run))
    return collect.fetch_outcomes(classify.fetch_candidates(classified), latest)


@_query
def record_run_story(s):
    return collect.record_run_story(_outcomes(s))


@_query
def run_story_errors(s):
    return collect.run_story_errors(_outcomes(s))


def _cycle(s, hour=None):
    """The cycle of the last run, or of the last one at an hour of the day."""
    known = s.run if hour is None else s.run.filter(F.hour("ts_run") == hour)
    ts_run = classify.latest_run(known)
    return run_cycle(
        s.rankings_raw,
        s.items_raw,
        before(s.run, ts_run),
        before(s.run_story, ts_run),
        _rules(s),
        ts_run,
        runs=s.run,
    )


@_query
def run_cycle_story(s):
    return _cycle(s).run_story


@_query
def run_cycle_errors(s):
    return _cycle(s).error


@_query
def run_cycle_failed_list(s):
    return _cycle(s, hour=5).error


@_query
def run_cycle_retried_list(s):
    return _cycle(s, hour=9).error


# --- ranks and states ---------------------------------------------------------------------


@_query
def stories_ranks(s):
    return ranks.stories_ranks(s.run)


@_query
def rebuild_run_arrays(s):
    return _as_text(ranks.rebuild_run_arrays(ranks.stories_ranks(s.run)), *RANKINGS)


@_query
def story_timeline(s):
    return ranks.story_timeline(s.run, s.run_story)


@_query
def story_history(s):
    """The timeline of one story, looked up in the layout by story."""
    path = shared_dir(s.spark, "histories")
    histories.append_histories(s.run, s.run_story, path, shelves=8)
    story_id = s.run_story.agg(F.min("story_id")).first()[0]
    return histories.story_history(s.spark, path, story_id, shelves=8)


@_query
def data_cube(s):
    return ranks.data_cube(s.run, s.run_story)


@_query
def top_n_from_json(s):
    return ranks.top_n_from_json(s.rankings_raw)


@_query
def max_item_id(s):
    return ranks.max_item_id(s.run, s.run_story)


@_query
def stories_status(s):
    return status.stories_status(s.run, s.run_story)


@_query
def last_recorded_run(s):
    return status.last_recorded_runs(s.run, s.run_story)


@_query
def check_window(s):
    latest = s.run.agg(F.max("ts_run")).scalar()
    inside = check_time_window(latest, F.col("ts_payload"), 43_200)
    return s.run_story.select("ts_run", "story_id", inside.alias("inside"))


@_query
def calendar_age(s):
    now = F.lit("2024-03-01 00:10:00").cast("timestamp_ntz")
    age = calendar_age_micros(now, F.col("ts_payload"))
    return s.run_story.select("ts_run", "story_id", age.alias("age_micros"))


# --- classification ------------------------------------------------------------------------


def _classified(s, rules="bench"):
    return classify.classify_stories(s.run, s.run_story, _rules(s, rules))


@_query
def classify_stories(s):
    return _classified(s)


@_query
def classify_stories_window(s):
    return _classified(s, "bench_window")


@_query
def fetch_candidates(s):
    return classify.fetch_candidates(_classified(s))


@_query
def status_transitions(s):
    return classify.status_transitions(_classified(s))


@_query
def classify_reconcile(s):
    middle = classify.latest_run(s.run.filter("ts_run < timestamp_ntz '2024-01-16'"))
    classified = classify.classify_stories(s.run, s.run_story, _rules(s), middle)
    return classify.classify_reconcile(classified, s.run_story, as_of=middle)


@_query
def classify_stories_snapshot(s):
    """A run in the middle of history, from the snapshot of the day before."""
    folder = shared_dir(s.spark, "snapshots")
    middle = classify.latest_run(s.run.filter("ts_run < timestamp_ntz '2024-01-16'"))
    snapshots.extend_snapshots(before(s.run_story, middle), folder)
    return snapshots.classify_as_of(s.run, s.run_story, _rules(s), middle, folder)


def _legacy_rules(s):
    r = _rules(s)
    shared = {f: getattr(r, f) for f in legacy.LegacyRuleset.__dataclass_fields__ if hasattr(r, f)}
    return legacy.LegacyRuleset(**shared, hot_rankbump=2)


@_query
def classify_rankbump(s):
    return legacy.classify_rankbump(s.run_numbered, s.run_story_numbered, _legacy_rules(s))


@_query
def filter_rankbump(s):
    return legacy.filter_rankbump(classify_rankbump(s), _legacy_rules(s))


# --- reports ---------------------------------------------------------------------------------


@_query
def stats_run(s):
    return reports.stats_run(s.run).drop("pointage", "database", "extversion")


@_query
def stats_run_story(s):
    return reports.stats_run_story(s.run_story, s.error)


@_query
def stats_run_story_coverage(s):
    return reports.landed_coverage(_parsed(s), s.run_story, s.error)


def _reported(s):
    """The counts of all runs, stored by two batches."""
    folder = shared_dir(s.spark, "report")
    middle = classify.latest_run(s.run.filter("ts_run < timestamp_ntz '2024-01-16'"))
    after = F.col("ts_run") > F.lit(middle).cast("timestamp_ntz")
    for batch, part in enumerate((~after, after)):
        tables = (_parsed(s), s.run_story, s.error)
        report_state.update_report(*[t.filter(part) for t in tables], folder, batch)
    return folder


@_query
def coverage_report(s):
    return report_state.coverage_report(s.spark, _reported(s))


@_query
def story_report(s):
    return report_state.story_report(s.spark, _reported(s))


@_query
def stats_run_story_legacy(s):
    return legacy.stats_run_story_legacy(s.run_numbered, s.run_story_numbered)


@_query
def diagnose_errors(s):
    found = reports.diagnose_errors(s.run, s.run_story, s.error)
    return found.withColumns({c: F.col(c).cast("double") for c in ("duration", "batch_failrate")})


@_query
def run_ruptures(s):
    found = reports.run_ruptures(s.run, seconds=90 * 60)
    return _as_text(found.select("ts_run", *RANKINGS, "ts_end", "rupture"), *RANKINGS)


@_query
def missing_runs_at(s):
    numbered = reports.with_cycle_id(s.run, "2024-01-01 00:00:00", 3600)
    return reports.missing_runs_at(numbered, "2024-01-20 10:50:00")


@_query
def retry_profile(s):
    return reports.retry_profile(s.items_raw)


# --- whole tables ------------------------------------------------------------------------------


@_query
def mark_stale_unknown(s):
    return _without_day(maintenance.mark_stale_unknown(s.run, s.run_story))


@_query
def rewrite_stale_unknown(s):
    """The same on a stored table, by rewriting the days that change."""
    path = shared_dir(s.spark, "restated-table")
    write_table(s.run_story.select(*RUN_STORY.names), path)
    maintenance.rewrite_stale_unknown(s.run, path)
    return _without_day(read_table(s.spark, path, RUN_STORY))


def _migrated(s):
    spark = s.spark
    return maintenance.migrate_v015(
        {
            "run": s.run.drop("extversion", "ruleset_id"),
            "run_story": s.run_story,
            "story": s.run_story.select(F.col("story_id").alias("id"), "status").distinct(),
            "error": s.error.withColumnsRenamed(
                {"error_source": "object", "source_id": "object_id"}
            ),
            "ruleset": spark.createDataFrame([("production",), ("own",)], "id string"),
            "rule": sample_rules(spark).withColumnRenamed("id", "rule"),
        }
    )


@_query
def migrate_v015_run(s):
    return _as_text(_migrated(s)["run"], *RANKINGS)


@_query
def migrate_v015_run_story(s):
    return _migrated(s)["run_story"]


@_query
def migrate_v015_error(s):
    return _migrated(s)["error"]


@_query
def migrate_v015_story(s):
    return _migrated(s)["story"]


def _exported(s, table):
    path = shared_dir(s.spark, "export")
    maintenance.export_tables(
        {"run": s.run, "run_story": s.run_story, "error": s.error, "rules": sample_rules(s.spark)},
        path,
    )
    return _without_day(read_table(s.spark, f"{path}/{table}"))


@_query
def export_tables(s):
    return _exported(s, "run_story")


@_query
def export_error(s):
    return _exported(s, "error")


@_query
def export_run(s):
    return _as_text(_exported(s, "run"), *RANKINGS)


@_query
def export_changed(s):
    """An export of the first half, brought up to date."""
    path = shared_dir(s.spark, "export-changed")
    tables = {"run": s.run, "run_story": s.run_story, "error": s.error}
    early = F.col("ts_run") < F.lit("2024-01-16").cast("timestamp_ntz")
    export.export_changed({n: t.filter(early) for n, t in tables.items()}, path)
    export.export_changed(tables, path)
    return _without_day(read_table(s.spark, f"{path}/run_story", RUN_STORY))


def _instances(s):
    """The records, and a second collection that saw some of them later and scored higher."""
    first = s.run_story.select(*RUN_STORY.names)
    later = F.when(
        F.col("descendants") == 1, F.col("ts_run") + F.expr("INTERVAL 30 MINUTE")
    ).otherwise(F.col("ts_run"))
    score = (F.col("score") + F.col("descendants")).cast("int")
    return [first, first.withColumns({"ts_run": later, "score": score})]


@_query
def merge_instances(s):
    return maintenance.merge_instances("run_story", _instances(s))


@_query
def merge_errors(s):
    """Three collections of errors: some, the same ones with less in the report, and others later."""
    columns = ("ts_run", "error_source", "source_id", "report")
    first = s.error.select(*columns).filter(F.hour("ts_run") % 2 == 0)
    second = s.error.select(*columns).withColumn("report", F.lit("{}"))
    third = s.error.select(*columns).withColumn("ts_run", F.col("ts_run") + F.expr("INTERVAL 30 MINUTE"))
    return maintenance.merge_instances("error", [first, second, second.unionAll(third)])


@_query
def merge_conflicts(s):
    return maintenance.merge_conflicts("run_story", _instances(s))


# --- many cycles -------------------------------------------------------------------------------


@_query
def replay_runs(s):
    return replay_history(s.rankings_raw, s.items_raw, _rules(s), runs=s.run).run_story


@_query
def replay_runs_window(s):
    return replay_history(
        s.rankings_raw, s.items_raw, _rules(s, "bench_window"), runs=s.run
    ).run_story


@_query
def replay_errors(s):
    return replay_history(s.rankings_raw, s.items_raw, _rules(s), runs=s.run).error


@_query
def stream_cycle(s):
    """Land the lists in four time slices and let the stream handle each as it arrives."""
    folder = shared_dir(s.spark, "stream")
    landing, out = f"{folder}/landing", f"{folder}/out"
    first, last = s.run.agg(F.min("ts_run"), F.max("ts_run")).first()
    edges = [first + (last - first) * i / 4 for i in range(4)]
    for i, low in enumerate(edges):
        slice_ = s.rankings_raw.filter(F.col("ts_run") >= F.lit(low).cast("timestamp_ntz"))
        if i + 1 < len(edges):
            slice_ = slice_.filter(F.col("ts_run") < F.lit(edges[i + 1]).cast("timestamp_ntz"))
        # a run's lists belong in one file
        _without_day(slice_).repartition("ts_run").write.mode("append").json(landing)
        query = live.stream_cycle(
            s.spark, landing, lambda: s.items_raw, _rules(s), out, schedule=lambda: s.run
        )
        query.awaitTermination()
    return live.collected(s.spark, out).run_story


@_query
def stream_stories(s):
    """Land lists and responses in four time slices; state per story decides who is looked at."""
    folder = shared_dir(s.spark, "stories")
    first, last = s.run.agg(F.min("ts_run"), F.max("ts_run")).first()
    edges = [first + (last - first) * i / 4 for i in range(4)]
    landed = {"plan": s.run.select("ts_run"), "items": s.items_raw, "lists": s.rankings_raw}
    streams = {}
    for i, low in enumerate(edges):
        for name, table in landed.items():
            slice_ = table.filter(F.col("ts_run") >= F.lit(low).cast("timestamp_ntz"))
            if i + 1 < len(edges):
                slice_ = slice_.filter(F.col("ts_run") < F.lit(edges[i + 1]).cast("timestamp_ntz"))
            slice_ = _without_day(slice_) if "run_date" in slice_.columns else slice_
            slice_.write.mode("append").parquet(f"{folder}/{name}")
            streams[name] = s.spark.readStream.schema(slice_.schema).parquet(f"{folder}/{name}")
        query = stories.stream_stories(
            streams["lists"], streams["items"], _rules(s), f"{folder}/out", streams["plan"], shards=8
        )
        query.awaitTermination()
    return stories.collected_stories(
        s.spark, s.rankings_raw, s.items_raw, _rules(s), f"{folder}/out", runs=s.run
    ).run_story


for _new, _name in (
    ("run_cycle_story", "run_cycle"),
    ("check_window", "check_time_window"),
    ("replay_runs", "replay_history"),
    ("replay_runs_window", "replay_history_window"),
):
    _registered[_name] = _registered.pop(_new)
