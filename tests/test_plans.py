"""What the physical plans may and may not contain."""

import re

import pytest
from conftest import SMALL, rules

import __spark_entry__ as entry
from ranktrail.operators.classify import classify_stories, latest_run
from ranktrail.operators.maintenance import merge_conflicts, merge_instances
from ranktrail.operators.status import story_state
from ranktrail.schema import RUN_STORY
from ranktrail.sources.samples import samples

#: Their neighbour search orders a summary with one row per hour.
ONE_ROW_PER_HOUR = {"run_ruptures", "last_recorded_run"}


def plan_of(df) -> str:
    """The plan as adaptive execution left it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(entry._registered) - {"stream_cycle", "stream_stories"}))
def test_no_cross_joins_and_no_single_task_windows(spark, name):
    df = entry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    if name not in ONE_ROW_PER_HOUR:
        assert not re.search(r"Window \[[^\n]*\], \[[^\]]*(ASC|DESC)[^\]]*\]\n\s*.*SinglePartition", plan)
        assert "windowspecdefinition(ts_run" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python anywhere


def test_classification_reads_what_it_needs(spark):
    s = samples(spark, SMALL)
    df = classify_stories(s.run, s.run_story, rules(), latest_run(s.run))
    plan = plan_of(df)
    scans = re.findall(r"FileScan parquet.*", plan)
    assert len(scans) == 3
    assert all("run_date" in re.search(r"PartitionFilters: \[(.*?)\]", s)[1] for s in scans)
    assert "EqualTo(ts_run" in plan and "LessThan(ts_run" in plan
    assert not any("ts_payload" in re.search(r"ReadSchema: (.*)", s)[1] for s in scans)
    assert "SortAggregate" not in plan and "Window" not in plan


def test_state_is_one_hash_aggregation(spark):
    plan = plan_of(story_state(samples(spark, SMALL).run_story))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_sample_events_are_all_used(spark):
    s = samples(spark, SMALL)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    assert s.base.agg({"n": "sum"}).first()[0] == events.count()
    listed = s.run.selectExpr("sum(size(topstories))").first()[0]
    assert listed == s.base.filter("clicks > 0").count()


def test_records_are_merged_without_sorting(spark):
    s = samples(spark, SMALL)
    instances = [s.run_story.select(*RUN_STORY.names)] * 2
    for merge in (merge_instances, merge_conflicts):
        plan = plan_of(merge("run_story", instances))
        assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
