from conftest import START, at, rows
from pyspark.sql import functions as F

from ranktrail import schema
from ranktrail.operators.legacy import stats_run_story_legacy
from ranktrail.operators.reports import (
    diagnose_errors,
    missing_runs_at,
    retry_profile,
    run_ruptures,
    stats_run,
    stats_run_story,
    stats_run_story_coverage,
    with_cycle_id,
)


def errors(spark, *some):
    return spark.createDataFrame(list(some), schema.ERROR)


def test_stats_run(runs):
    run = runs((START, None, None, None), (at(90), None, None, None))
    got = stats_run(run, F.lit("2024-02-01 10:00:00").cast("timestamp")).first()
    assert tuple(got) == (
        "2024-02-01 10:00:00", "default", 0, "2024-01-10 00:00:00", "2024-01-10 01:30:00", "0.1.0",
        90 * 60_000_000,
    )
    assert stats_run(runs()).first().min_ts_utc is None


def test_stats_run_story(spark, records):
    story = records(
        (START, 1, "new"), (START, 2, "new"), (START, 3, "unknown"), (START, 4, None), (at(5), 1, "hot"),
    )
    error = errors(
        spark,
        (START, "run_story", "1", '{"retries":1}'),
        (START, "run_story", "2", '{"retries":0}'),
        (START, "run_story", "3", '{"retries":null}'),
        (START, "run", "topstories", '{"retries":5}'),
    )
    first, second = stats_run_story(story, error).orderBy("ts_run").collect()
    assert (first.new, first.hot, first.retried_count, first.total_count) == (2, 0, 1, 4)
    assert (second.hot, second.retried_count, second.fetch_micros) == (1, 0, 0)


def test_coverage(spark, runs, records):
    run = runs((START, [1, 2, 3], None, []), (at(5), [9], None, [1]))
    story = records((START, 1, "new"), (START, 7, "hot"), (at(9), 1, "hot"))
    got = stats_run_story_coverage(run, story, errors(spark)).orderBy("ts_run").collect()
    shown = [(r.topstories, r.beststories, r.newstories, r.new, r.total_count) for r in got]
    # the second run has no records: its own row counts once
    assert shown == [("1/3", "0/error", "0/error", 1, 2), ("0/1", "0/error", "0/1", 0, 1)]


def test_legacy_counts(spark, runs):
    run = runs((START, [1, 2], None, None), (at(5), [1], None, None)).withColumn(
        "id", F.when(F.col("ts_run") == F.lit(str(START)).cast("timestamp_ntz"), 1).otherwise(2)
    )
    story = spark.createDataFrame(
        [(1, 1, 1, None, None, "new", 5, 0, START, True), (1, 2, 2, None, None, "missing", None, 0, START, False),
         (1, 3, None, None, None, "hot", 4, 0, START, False)],
        "run_id bigint, story_id bigint, topstories_rank int, beststories_rank int, "
        "newstories_rank int, status string, score int, descendants bigint, "
        "ts_payload timestamp_ntz, success boolean",
    )
    first, second = stats_run_story_legacy(run, story).orderBy("run_id").collect()
    assert (first.topstories_count, first.topstories_recorded, first.beststories_count) == (2, 2, None)
    assert (first.fail_count, first.retried_count, first.total_count) == (1, 1, 3)
    assert (second.fail_count, second.retried_count, second.total_count) == (1, -1, 1)


def test_diagnose(spark, runs, records):
    run = runs((START, [5, 6], None, [6]))
    story = records((START, 6, "failed", 3))
    report = '{"url":"item/6","retries":1,"duration":0.5,"ts_end":"2024-01-10T00:00:07","batch_failrate":0.1,"payload":{"a":[1]}}'
    error = errors(
        spark,
        (START, "run_story", "6", report),
        (START, "run_story", "5", '{"retries":"x"}'),  # ranked, but not recorded
        (START, "run", "topstories", None),
        (at(5), "run_story", "6", "{}"),  # its run is missing
    )
    got = rows(diagnose_errors(run, story, error), "source_id", "status", "rankings", "score", "retries", "url", "payload")
    assert got == [
        ("5", None, "*/*/*", None, None, None, None),
        ("6", "failed", "2/*/1", 3, 1, "item/6", '{"a":[1]}'),
        ("topstories", None, "*/*/*", None, None, None, None),
    ]
    one = diagnose_errors(run, story, error).filter("source_id = '6'").first()
    assert (float(one.duration), str(one.ts_end)) == (0.5, "2024-01-10 00:00:07")


def test_ruptures(runs):
    run = runs(*[(at(m), [m], None, None) for m in (0, 5, 12, 13, 2000, 2005)])
    # exactly seven minutes is no rupture
    assert [r[0] for r in rows(run_ruptures(run), "topstories")] == [[13], [2000]]
    assert rows(run_ruptures(runs((START, None, None, None)))) == []


def test_missing_runs(runs):
    run = with_cycle_id(runs(*[(at(m), None, None, None) for m in (0, 5, 15, 40)]), START, 300)
    assert [r[0] for r in rows(run, "id")] == [1, 2, 4, 9]
    assert rows(missing_runs_at(run, at(16))) == [(3, 4, 1, at(15))]
    assert rows(missing_runs_at(run, START)) == [(0, None, None, None)]


def test_retry_profile(spark):
    raw = spark.createDataFrame(
        [(START, i, "u", None, at(i), float(i), 1, r, 0.0) for i, r in ((1, 0), (3, 0), (5, 2), (6, None))],
        schema.ITEMS_RAW,
    )
    assert rows(retry_profile(raw)) == [
        (None, 360_000_000, 6.0, 6.0, 6.0, 1),
        (0, 180_000_000, 2.0, 3.0, 1.0, 2),
        (2, 300_000_000, 5.0, 5.0, 5.0, 1),
    ]
