import random
from datetime import timedelta

import pytest
from conftest import at, rows, rules
from test_replay import CASES, ERROR_KEY, SHORT, land, landed, uneven

from ranktrail import schema
from ranktrail.plans.replay import replay_history
from ranktrail.schema import ITEMS_RAW, RANKINGS_RAW
from ranktrail.sources.responses import read_rankings
from ranktrail.streaming import stories


def run_stream(spark, folder, settings=SHORT, shards=3, schedule=None):
    items = spark.readStream.schema(ITEMS_RAW).json(str(folder / "items"))
    lists = read_rankings(spark, str(folder / "landing"), stream=True)
    query = stories.stream_stories(lists, items, settings, str(folder / "out"), schedule, shards)
    query.awaitTermination()
    return query


def land_items(items, folder, times):
    items.filter(items.ts_run.isin(times)).coalesce(1).write.mode("append").json(str(folder / "items"))


@pytest.mark.parametrize("case", CASES)
def test_equals_replay(spark, tmp_path, case):
    settings, step = CASES[case]
    times = uneven(14, case, step)
    lists, items = landed(spark, case, times)
    for part in (times[:6], times[6:7], times[7:]):
        land_items(items, tmp_path, part)
        land(lists, tmp_path, part)
        run_stream(spark, tmp_path, settings)
    got = stories.collected_stories(spark, lists, items, settings, str(tmp_path / "out"))
    want = replay_history(lists, items, settings)
    assert rows(got.run_story, *schema.RUN_STORY.names) == rows(want.run_story)
    assert rows(got.run, *schema.RUN.names) == rows(want.run, *schema.RUN.names)
    assert rows(got.error, *ERROR_KEY) == rows(want.error, *ERROR_KEY)
    assert rows(got.state, *want.state.columns) == rows(want.state)


def test_early_responses_wait_and_late_runs_are_told(spark, tmp_path):
    times = uneven(7, 8)
    lists, items = landed(spark, 8, times)
    kept = [t for t in times if t != times[2]]
    land_items(items, tmp_path, times)
    land(lists, tmp_path, kept[:4])
    run_stream(spark, tmp_path)
    land(lists, tmp_path, [times[2], kept[3]])  # one late, one already recorded
    run_stream(spark, tmp_path)
    land(lists, tmp_path, kept[4:])
    run_stream(spark, tmp_path)
    out = str(tmp_path / "out")
    want = replay_history(lists.filter(lists.ts_run.isin(kept)), items, SHORT)
    got = stories.collected_stories(spark, lists, items, SHORT, out)
    assert rows(got.run_story) == rows(want.run_story)
    assert rows(got.run, *schema.RUN.names) == rows(want.run, *schema.RUN.names)
    assert rows(stories.late_run_times(spark, out)) == [(times[2],), (kept[3],)]


def test_a_batch_looks_at_ranked_and_due_stories_only(spark, tmp_path):
    """Many stories are known and none of them is due: runs with two ranked stories look at two."""
    ids = list(range(400))
    settings = rules(new_repeat=1, hot_repeat=1, cooling_repeat=1, cold_repeat=1, tepid_age=86_400.0,
                     cooling_age=86_400.0, cold_age=86_400.0, hot_rank=0, tepid_rank=0)
    draw = random.Random(1)
    first = [at(5 * i) for i in range(3)]
    later = [at(60 + 5 * i) for i in range(4)]
    some = {t: draw.sample(ids, 2) for t in later}
    lists = [(t, "topstories", "u", str(some.get(t, ids)), t, 0.5, 1, 0, 0.0) for t in first + later]
    lists = spark.createDataFrame(lists, RANKINGS_RAW)
    items = [(t, s, "u", '{"score":1,"descendants":0}', t + timedelta(seconds=1), 0.5, 1, 0, 0.0)
             for t in first + later for s in some.get(t, ids)]
    items = spark.createDataFrame(items, ITEMS_RAW)
    out = str(tmp_path / "out")
    land_items(items, tmp_path, first)
    land(lists, tmp_path, first)
    run_stream(spark, tmp_path, settings)
    seen = stories.stories_touched(spark, out)
    assert seen == len(ids)
    for t in later:
        land_items(items, tmp_path, [t])
        land(lists, tmp_path, [t])
        progress = run_stream(spark, tmp_path, settings).recentProgress
        now = stories.stories_touched(spark, out)
        assert now - seen <= 2
        seen = now
        written = sum(p["stateOperators"][0]["numRowsUpdated"] for p in progress)
        assert written < 20  # of more than 400 entries
    got = stories.collected_stories(spark, lists, items, settings, out)
    assert rows(got.run_story) == rows(replay_history(lists, items, settings).run_story)


def test_scheduled_runs_without_responses(spark, tmp_path):
    times = uneven(8, 11)
    lists, items = landed(spark, 11, times)
    gone = [times[3], times[6]]
    some = lists.filter(~lists.ts_run.isin(gone))
    plan = spark.createDataFrame([(t,) for t in times], "ts_run timestamp_ntz")
    want = replay_history(some, items, SHORT, runs=plan)
    for part in (times[:4], times[4:]):
        land_items(items, tmp_path, part)
        plan.filter(plan.ts_run.isin(part)).coalesce(1).write.mode("append").json(str(tmp_path / "plan"))
        land(some, tmp_path, part)
        schedule = spark.readStream.schema("ts_run timestamp_ntz").json(str(tmp_path / "plan"))
        run_stream(spark, tmp_path, schedule=schedule)
    got = stories.collected_stories(spark, some, items, SHORT, str(tmp_path / "out"), runs=plan)
    assert rows(got.run_story) == rows(want.run_story)
    assert rows(got.error, *ERROR_KEY) == rows(want.error, *ERROR_KEY)
