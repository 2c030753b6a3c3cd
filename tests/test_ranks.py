from conftest import START, at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ranktrail.operators.ranks import (
    RANK_COLUMNS,
    data_cube,
    max_item_id,
    rebuild_run_arrays,
    stories_ranks,
    story_timeline,
    top_n_from_json,
    with_few_ranks,
    with_ranks,
)
from ranktrail.schema import RANKINGS, RANKINGS_RAW

ids = st.lists(st.integers(1, 30), unique=True, max_size=12).map(lambda x: x or None)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(ids, ids, ids).filter(any), min_size=1, max_size=6))
def test_ranks_and_lists_round_trip(runs, lists):
    run = runs(*[(at(i), *three) for i, three in enumerate(lists)])
    back = rebuild_run_arrays(stories_ranks(run))
    assert rows(back, "ts_run", *RANKINGS) == rows(run, "ts_run", *RANKINGS)


def test_null_empty_and_repeated_ids(runs):
    run = runs((START, None, [], [7, 8, 7]), (at(1), None, None, None))
    assert rows(stories_ranks(run)) == [(START, 7, None, None, 1), (START, 8, None, None, 2)]


def test_story_in_all_lists(runs):
    run = runs((START, [1, 2], [3, 2], [4, 5, 2]))
    assert (START, 2, 2, 2, 3) in rows(stories_ranks(run))


def test_selected_runs(runs):
    run = runs((START, [1], None, None), (at(5), [2], None, None), (at(10), [3], None, None))
    assert [r[1] for r in rows(stories_ranks(run, [at(5), at(10)]))] == [2, 3]
    assert [r[1] for r in rows(stories_ranks(run, run.filter("topstories[0] = 1")))] == [1]
    assert rows(stories_ranks(run, [])) == []


def test_timeline_of_one_story_equals_its_part_of_all(runs, records):
    run = runs((START, [1, 2], [2], None), (at(5), [2], [9, 1], [1]))
    story = records((START, 1, "new", 5), (at(5), 1, "hot", 6), (at(5), 2, "new", 1), (at(9), 1, "hot"))
    both = rows(story_timeline(run, story).filter("story_id = 1"))
    assert rows(story_timeline(run, story, 1)) == both
    # the record at minute 9 has no run
    assert both == [
        ("2024-01-10 00:00:00", 1, 1, None, None, "new", 5, None),
        ("2024-01-10 00:05:00", 1, None, 2, 1, "hot", 6, None),
    ]


def test_cube_keeps_both_sides(runs, records):
    run = runs((START, [1], None, None))
    story = records((START, 2, "hot", 3), (at(5), 1, "new", 4))
    got = rows(data_cube(run, story), "ts_run", "story_id", "topstories_rank", "ranks_ts_run", "status")
    assert got == [
        (START, 1, 1, START, None),
        (START, 2, None, None, "hot"),
        (at(5), 1, None, None, "new"),
    ]


def test_top_n(spark):
    responses = spark.createDataFrame(
        [(START, "best", "u", "[5,3,9]", None, None, None, 0, None), (START, "bad", "u", "{", *[None] * 5)],
        RANKINGS_RAW,
    )
    assert rows(top_n_from_json(responses, below=3)) == [(START, "best", 1, 5), (START, "best", 2, 3)]


def test_max_item_id(runs, records):
    run = runs((START, None, [4, 11], [2]))
    assert rows(max_item_id(run, records((START, 9, "new")))) == [(11,)]
    assert rows(max_item_id(run, records((START, 19, "new")))) == [(19,)]


def test_both_lookups_agree(runs, records):
    run = runs((START, [1, 2, 1], [2], None), (at(5), None, [9, 1], []))
    story = records(*[(t, s, "hot") for t in (START, at(5), at(9)) for s in (1, 2, 9, 10)])
    columns = ["ts_run", "story_id", *RANK_COLUMNS]
    assert rows(with_few_ranks(story, run), *columns) == rows(with_ranks(story, run), *columns)
    assert with_few_ranks(story, run).count() == 8
