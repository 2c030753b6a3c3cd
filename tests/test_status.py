import random

from conftest import START, at, rows

from ranktrail.operators.ordered import latest_before, neighbours
from ranktrail.operators.status import (
    last_recorded_run,
    last_recorded_runs,
    merge_states,
    stories_status,
    story_state,
)
from ranktrail.schema import STATUSES


def some_history(seed, stories=12, times=40):
    rng = random.Random(seed)
    return [
        (at(5 * t), s, rng.choice([*STATUSES, None]), rng.randrange(100))
        for t in range(times)
        for s in range(stories)
        if rng.random() < 0.4
    ]


def test_equals_a_plain_fold(runs, records):
    history = some_history(1)
    run = runs(*[(at(5 * t), [1, 2, 3], [3, 4], None) for t in range(40)])
    seen, last = {}, {}
    for ts, story, status, score in sorted(history, key=lambda h: h[0]):
        seen[story, status] = seen.get((story, status), 0) + 1
        last[story] = (ts, story, status, score, seen[story, status])
    columns = ["ts_run", "story_id", "status", "score", "status_repeat"]
    assert sorted(rows(stories_status(run, records(*history)), *columns), key=str) == sorted(
        last.values(), key=str
    )


def test_repeat_counts_the_lifetime_not_a_streak(runs, records):
    run = runs(*[(at(i), [1], None, None) for i in range(4)])
    story = records((at(0), 1, "hot"), (at(1), 1, "tepid"), (at(2), 1, "hot"), (at(3), 1, "hot"))
    assert rows(stories_status(run, story)) == [(at(3), 1, 1, None, None, "hot", None, 3)]
    assert rows(stories_status(run, story, as_of=at(1)), "status", "status_repeat") == [("tepid", 1)]


def test_latest_record_without_run_hides_the_story(runs, records):
    run = runs((START, [1], None, None))
    story = records((START, 1, "new"), (at(1), 1, "hot"), (START, 2, "new"))
    assert [r[1] for r in rows(stories_status(run, story))] == [2]


def test_states_merge(spark, records):
    history = some_history(2)
    whole = story_state(records(*history))
    early = [h for h in history if h[0] < at(60)]
    late = [h for h in history if h[0] >= at(60)]
    merged = merge_states(story_state(records(*early)), story_state(records(*late)))
    assert rows(merged, *whole.columns) == rows(whole)


def test_neighbours_cross_buckets_and_gaps(spark):
    minutes = [0, 3, 4, 61, 62, 500, 1441, 4000, 4001]
    df = spark.createDataFrame([(at(m),) for m in minutes], "ts_run timestamp_ntz")
    want = [
        (at(m), at(minutes[i - 1]) if i else None, at(minutes[i + 1]) if i + 1 < len(minutes) else None)
        for i, m in enumerate(minutes)
    ]
    for width in (60, 3600, 86_400, 10**7):
        assert rows(neighbours(df, width)) == want


def test_latest_before_is_strict(spark):
    points = [0, 5, 10, 1500, 3000]
    seen = [5, 7, 10, 2999]
    make = lambda ms: spark.createDataFrame([(at(m),) for m in ms], "ts_run timestamp_ntz")
    want = [(at(p), max([at(s) for s in seen if s < p], default=None)) for p in points]
    for width in (600, 86_400):
        assert rows(latest_before(make(points), make(seen), width)) == want


def test_last_recorded_run(runs, records):
    run = runs(*[(at(i), [1], None, None) for i in range(3)])
    story = records((at(0), 1, "new"), (at(0), 2, "new"))
    assert rows(last_recorded_run(story, at(0))) == [(None,)]
    assert rows(last_recorded_run(story, at(2))) == [(at(0),)]
    assert rows(last_recorded_runs(run, story)) == [(at(0), None), (at(1), at(0)), (at(2), at(0))]
