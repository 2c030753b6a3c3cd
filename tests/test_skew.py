"""One story and one run hold a third of all rows each; results stay whole."""

import pytest
from conftest import START, at, rows

from ranktrail import schema
from ranktrail.operators.ranks import in_known_runs, story_timeline
from ranktrail.operators.reports import stats_run_story
from ranktrail.operators.status import stories_status

RUNS, STORIES = 2_000, 2_000


@pytest.fixture(scope="module")
def hot(spark):
    run = spark.createDataFrame(
        [(at(5 * i), [i % 50, 7], [3], None, None, "v", "r") for i in range(RUNS)], schema.RUN
    )
    hot_story = [(at(5 * i), 7, "hot", i, 0, START) for i in range(RUNS)]
    hot_run = [(at(0), 100 + i, "new", i, 0, START) for i in range(STORIES)]
    others = [(at(5 * (i % RUNS)), 10_000 + i, "cold", i, 0, START) for i in range(2_000)]
    story = spark.createDataFrame(hot_story + hot_run + others, schema.RUN_STORY)
    return run, story


@pytest.fixture
def small_tasks(spark):
    """Make the planner treat kilobytes as it would treat gigabytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_run_is_split(spark, hot, small_tasks):
    run, story = hot
    kept = in_known_runs(story.repartition(8), run)
    assert len(kept.collect()) == story.count()
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isSkew=true" in plan or "skew=true" in plan.lower()


def test_results_do_not_depend_on_the_strategy(spark, hot, request):
    run, story = hot
    error = spark.createDataFrame(
        [(at(0), "run_story", str(100 + i), '{"retries":1}') for i in range(1_000)], schema.ERROR
    )

    def results():
        return [
            rows(stories_status(run, story)),
            rows(story_timeline(run, story)),
            rows(stats_run_story(story, error)),
        ]

    plain = results()
    request.getfixturevalue("small_tasks")
    assert results() == plain
    assert max(r[-3] for r in plain[2]) == 1_000  # every retried story of the hot run counts
