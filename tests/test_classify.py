from datetime import timedelta

import pytest
from conftest import START, at, rows, rules

from ranktrail.operators.classify import (
    classify_reconcile,
    classify_stories,
    fetch_candidates,
    status_transitions,
)
from ranktrail.operators.status import story_state
from ranktrail.schema import STATUSES

ORDER = {s: i for i, s in enumerate(STATUSES)}
#: Record counts "below" and "at" each threshold must differ per status.
RULES = rules(
    new_repeat=2, hot_repeat=2, cooling_repeat=2, cold_repeat=2, failed_repeat=2,
    hot_rank=60, tepid_rank=200,
)
BANDS = ["none", "top_hot", "best_hot", "top_tepid", "best_tepid", "new_hot", "new_tepid", "beyond"]


def expected(status, repeat, band):
    """The rule table of the documentation, line by line."""
    if status is None or (status == "new" and repeat < 2):
        return "new"
    if status == "new" or band in ("top_hot", "best_hot") or (status == "hot" and repeat < 2):
        return "hot"
    if band in ("top_tepid", "best_tepid", "new_hot", "new_tepid"):
        return "tepid"
    if status in ("failed", "missing") and repeat < 2:
        return "tepid"
    if status in ("hot", "tepid") or (status == "cooling" and repeat < 2):
        return "cooling"
    if status == "cooling" or (status == "cold" and repeat < 2):
        return "cold"
    return "frozen" if status in ("cold", "unknown", "frozen") else "unexpected"


def test_truth_table(runs, records):
    """Every status, one record or two, every kind of rank."""
    cases = [
        (status, repeat, band)
        for status in (None, *STATUSES)
        for repeat in (1, 2)
        for band in BANDS
    ]
    story = dict(enumerate(cases, start=1))
    by_band = {b: [i for i, c in story.items() if c[2] == b] for b in BANDS}
    filler = iter(range(10_000, 20_000))

    def ranked(hot, tepid, beyond):
        def upto(ids, size):
            return ids + [next(filler) for _ in range(size - len(ids))]

        return upto(upto(upto(hot, 60) + tepid, 200) + beyond, 300)

    top = ranked(by_band["top_hot"], by_band["top_tepid"], by_band["beyond"])
    best = ranked(by_band["best_hot"], by_band["best_tepid"], by_band["beyond"])
    new = ranked(by_band["new_hot"], by_band["new_tepid"], by_band["beyond"])
    run = runs((at(0), None, None, None), (at(5), None, None, None), (at(10), top, best, new))
    history = [
        (at(5 * k), i, status)
        for i, (status, repeat, _) in story.items()
        if status is not None
        for k in range(2 - repeat, 2)
    ]
    got = classify_stories(run, records(*history), RULES).filter("story_id < 10000").collect()
    found = {r.story_id: r for r in got}
    for i, (status, repeat, band) in story.items():
        if status is None and band == "none":
            assert i not in found
            continue
        row = found[i]
        want = expected(status, repeat, band)
        assert (row.last_status, row.new_status) == (status, want), (status, repeat, band)
        # five minutes after the last record only these are due
        due = want in ("new", "hot") or (status is not None and ORDER[want] < ORDER[status])
        assert row.fetch_now is due, (status, repeat, band)


@pytest.mark.parametrize(
    "status, minutes, due",
    [
        ("tepid", 59 - 1 / 60, False),  # becomes cooling
        ("tepid", 59, True),
        ("cooling", 58, False),
        ("cooling", 59, True),
        ("cold", 359, False),
        ("cold", 360, True),
        ("frozen", 7 * 1440 - 1, False),
        ("frozen", 7 * 1440, True),
        ("unknown", 7 * 1440 - 1, False),
        ("unknown", 7 * 1440, True),
    ],
)
def test_ages(runs, records, status, minutes, due):
    r = rules(cooling_repeat=5, cold_repeat=5)
    run = runs((START, None, None, None), (at(minutes), [99], None, None))
    got = classify_stories(run, records((START, 1, status)), r).filter("story_id = 1")
    assert got.first().fetch_now is due


def test_tepid_age(runs, records):
    run = runs((START, None, None, None), (at(18), [8, 9, 1], None, None), (at(19), [8, 9, 1], None, None))
    story = records((START, 1, "tepid"))
    for minutes, due in ((18, False), (19, True)):
        row = classify_stories(run, story, rules(), at(minutes)).filter("story_id = 1").first()
        assert (row.new_status, row.fetch_now) == ("tepid", due)


@pytest.mark.parametrize("seconds, due", [(-1, False), (0, True), (599, True), (600, False)])
def test_frozen_window(runs, records, seconds, due):
    now = START + timedelta(days=8, seconds=seconds)
    run = runs((START, None, None, None), (now, [99], None, None))
    got = classify_stories(run, records((START, 1, "frozen")), rules(frozen_window=600))
    assert got.filter("story_id = 1").first().fetch_now is due


def test_deleted_story(runs, records):
    """Off the lists it is unexpected and never due; ranked again it is fetched."""
    run = runs((START, None, None, None), (at(5), [1], None, None))
    story = records((START, 1, "deleted"), (START, 2, "deleted"))
    got = {r.story_id: (r.new_status, r.fetch_now) for r in classify_stories(run, story, rules()).collect()}
    assert got == {1: ("hot", True), 2: ("unexpected", False)}


def test_no_run_at_all(runs, records):
    got = classify_stories(runs(), records(), rules())
    assert got.collect() == []
    assert dict(got.dtypes)["ts_run"] == "timestamp_ntz"


def test_first_run(runs, records):
    run = runs((START, [1, 2], [3], None), (at(5), [4], None, None))
    got = classify_stories(run, records((at(5), 4, "new")), rules(), START)
    assert [(r.story_id, r.new_status, r.fetch_now) for r in got.orderBy("story_id").collect()] == [
        (i, "new", True) for i in (1, 2, 3)
    ]


def test_run_without_a_row_still_classifies_the_past(runs, records):
    run = runs((START, [1], None, None))
    got = classify_stories(run, records((START, 1, "new")), rules(), at(5)).collect()
    assert [(r.ts_run, r.story_id, r.topstories_rank, r.new_status) for r in got] == [
        (at(5), 1, None, "new")
    ]


def test_state_replaces_history(runs, records):
    run = runs(*[(at(5 * i), [1, 2], [3], [4]) for i in range(4)])
    story = records((at(0), 1, "new"), (at(5), 1, "new"), (at(10), 2, "cold"), (at(10), 9, "frozen"))
    direct = classify_stories(run, story, rules(), at(15))
    folded = classify_stories(run, None, rules(), at(15), state=story_state(story))
    assert rows(folded) == rows(direct)


def test_summaries(runs, records):
    run = runs((START, None, None, None), (at(5), [1, 2], None, None))
    story = records((START, 1, "new"), (START, 3, "frozen"))
    classified = classify_stories(run, story, rules())
    assert rows(fetch_candidates(classified), "story_id") == [(1,), (2,)]
    assert rows(status_transitions(classified)) == [
        (False, True, "frozen", "frozen", 1),
        (True, False, None, "new", 1),
        (True, False, "new", "new", 1),
    ]
    assert [r[0] for r in classify_reconcile(classified, story).collect()] == [3, 2]
