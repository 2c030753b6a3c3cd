import json
from datetime import timedelta

import pytest
from conftest import START, at, rows, rules
from pyspark.sql import functions as F

from ranktrail import schema
from ranktrail.functions.payload import id_list
from ranktrail.operators.collect import (
    assemble_run,
    fetch_outcomes,
    record_run_story,
    run_errors,
    run_story_errors,
)
from ranktrail.operators.ranks import stories_ranks
from ranktrail.plans.cycle import run_cycle
from ranktrail.schema import ITEMS_RAW, RANKINGS_RAW
from ranktrail.sources.responses import (
    extract_item_fields,
    parse_items,
    parse_rankings,
    read_items,
    read_rankings,
)

END = START + timedelta(seconds=2)


@pytest.fixture
def lists(spark):
    def make(*some):
        """Rows of (ts_run, id, payload, retries)."""
        full = [(t, i, "u", p, END, 0.5, 1, r, 0.0) for t, i, p, r in some]
        return spark.createDataFrame(full, RANKINGS_RAW)

    return make


@pytest.fixture
def items(spark):
    def make(*some):
        """Rows of (ts_run, id, payload, retries)."""
        full = [(t, i, "u", p, END, 0.5, 1, r, 0.0) for t, i, p, r in some]
        return spark.createDataFrame(full, ITEMS_RAW)

    return make


def test_lists_keep_order_and_failures_keep_a_row(lists):
    raw = lists(
        (START, "topstories", "[3,1,2]", 0), (START, "beststories", "[]", 0),
        (at(5), "topstories", None, None), (at(5), "newstories", "not json", 0),
    )
    got = rows(parse_rankings(raw), "ts_run", "id", "url", "payload")
    assert got == [
        (START, "beststories", "beststories.json", None),
        (START, "newstories", "newstories.json", None),
        (START, "topstories", "topstories.json", [3, 1, 2]),
        (at(5), "beststories", "beststories.json", None),
        (at(5), "newstories", "newstories.json", None),
        (at(5), "topstories", "topstories.json", None),
    ]
    assert [r[1] for r in rows(parse_rankings(raw, ["topstories", "topstories"]))] == ["topstories"] * 2


def test_run_row(lists):
    raw = lists((START, "topstories", "[3,1,2]", 0), (START, "newstories", "[9]", 2))
    got = assemble_run(parse_rankings(raw), "mine", "9.9").first()
    assert tuple(got) == (START, [3, 1, 2], None, [9], END, "9.9", "mine")


def test_list_errors(lists):
    raw = lists(
        (START, "topstories", "[3]", 0), (START, "beststories", "[4]", 2),
        (START, "newstories", "[]", None),
    )
    got = rows(run_errors(parse_rankings(raw)))
    assert [(r[1], r[2]) for r in got] == [("run", "beststories"), ("run", "newstories")]
    report = json.loads(got[0][3])
    assert list(report) == [
        "id", "url", "payload", "ts_end", "duration", "batch", "retries", "batch_failrate",
    ]
    assert (report["payload"], report["retries"]) == ([4], 2)
    assert report["ts_end"] == "2024-01-10T00:00:02.000000"
    assert json.loads(got[1][3])["payload"] is None


def test_item_payload_states(spark, items):
    raw = items(
        (START, 1, '{"score":5,"descendants":2}', 0), (START, 2, "null", 0), (START, 3, None, None),
    )
    wanted = spark.createDataFrame(
        [(START, i) for i in (1, 1, 2, 3, 4)], "ts_run timestamp_ntz, story_id bigint"
    )
    got = rows(parse_items(wanted, raw), "id", "url", "payload", "retries")
    assert got == [
        (1, "item/1.json", '{"score":5,"descendants":2}', 0),
        (2, "item/2.json", '"json_null"', 0),
        (3, "item/3.json", None, None),
        (4, "item/4.json", None, None),
    ]


def test_item_fields(items):
    raw = items((START, 1, '{"id":1,"by":"a","kids":[2,3],"score":7,"time":9,"title":"t"}', 0), (START, 2, "null", 0))
    one, two = extract_item_fields(raw).orderBy("story_id").collect()
    assert (one.score, one.by, one.kids, one.title, one.url, one.parent) == (7, "a", [2, 3], "t", None, None)
    assert (two.story_id, two.score, two.by) == (2, None, None)


@pytest.fixture
def outcomes(spark, items):
    candidates = spark.createDataFrame(
        [(START, i, 1) for i in range(1, 9)], "ts_run timestamp_ntz, story_id bigint, new_code int"
    )
    return fetch_outcomes(
        candidates,
        items(
            (START, 1, '{"score":5,"descendants":2}', 0),
            (START, 2, "null", 0),
            (START, 3, None, None),
            (START, 4, '{"deleted":true,"score":1}', 0),
            (START, 5, '{"descendants":2}', 2),
            (START, 6, None, 2),
            (START, 7, '{"score":"many","deleted":false}', 0),
        ),
    )


def test_outcome_overrides_status(outcomes):
    assert rows(record_run_story(outcomes)) == [
        (START, 1, "hot", 5, 2, END),
        (START, 2, "missing", None, None, END),
        (START, 3, "failed", None, None, END),
        (START, 4, "deleted", 1, None, END),
        (START, 5, "hot", None, 2, END),
        (START, 6, "failed", None, None, END),
        (START, 7, "hot", None, None, END),
        (START, 8, "failed", None, None, None),
    ]


def test_story_errors(outcomes):
    """Deleted or retried; a failed fetch without a retry count is not logged."""
    got = rows(run_story_errors(outcomes))
    assert [(r[1], r[2]) for r in got] == [("run_story", s) for s in "456"]
    assert json.loads(got[0][3])["payload"] == {"deleted": True, "score": 1}
    assert json.loads(got[2][3])["payload"] is None


def test_cycle(runs, records, lists, items):
    run = runs((START, [1], None, None))
    raw = lists(
        (START, "topstories", "[1]", 0),
        (at(5), "topstories", "[2,1]", 0),
        (at(5), "newstories", None, None),
    )
    responses = items((at(5), 1, '{"score":4}', 0), (START, 2, '{"score":9}', 0))
    got = run_cycle(raw, responses, run, records((START, 1, "new"), (START, 3, "hot")), rules())
    assert [(r.ts_run, r.topstories, r.ruleset_id) for r in got.run.collect()] == [(at(5), [2, 1], "test")]
    assert rows(got.run_story, "story_id", "status", "score") == [
        (1, "new", 4), (2, "failed", None), (3, "failed", None),
    ]
    assert rows(got.error, "error_source", "source_id") == [("run", "beststories"), ("run", "newstories")]


def test_landed_files(spark, lists, items, tmp_path):
    raw = lists((START, "topstories", "[1]", 0))
    raw.write.json(str(tmp_path / "lists"))
    assert rows(read_rankings(spark, str(tmp_path / "lists"))) == rows(raw)
    raw = items((START, 1, '{"score":4}', 0), (START, 2, None, None))
    raw.write.json(str(tmp_path / "items"))
    assert rows(read_items(spark, str(tmp_path / "items"))) == rows(raw)


def test_ids_may_be_text_and_neighbours_keep_their_ranks(spark):
    df = spark.createDataFrame(
        [('[1,"2",3]',), ("[1,2.5,3]",), ("[]",), ("nonsense",), (None,), ('[1,null,{"a":1},4]',)],
        "payload string",
    )
    got = [r[0] for r in df.select(id_list(df.payload)).collect()]
    assert got == [[1, 2, 3], [1, None, 3], None, None, None, [1, None, None, 4]]
    run = spark.createDataFrame([(START, [1, None, 3], None, None, None, "v", "r")], schema.RUN)
    assert rows(stories_ranks(run), "story_id", "topstories_rank") == [(1, 1), (3, 3)]


def test_scheduled_run_without_any_response(spark):
    raw = spark.createDataFrame(
        [(START, "topstories", "u", "[1]", START, 0.5, 1, 0, 0.0)], schema.RANKINGS_RAW
    )
    plan = spark.createDataFrame([(START,), (at(5),)], "ts_run timestamp_ntz")
    parsed = parse_rankings(raw, runs=plan)
    assert parsed.count() == 6
    assert [r.ts_run for r in assemble_run(parsed).collect() if r.topstories is None] == [at(5)]
    assert run_errors(parsed).filter(F.col("ts_run") == at(5)).count() == 3
