"""Layouts beside the tables by day: snapshots of the state, histories by story, rewritten days."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import START, at, rows, rules
from pyspark.sql import functions as F

from ranktrail import schema
from ranktrail.operators.classify import classify_stories
from ranktrail.operators.export import export_changed
from ranktrail.operators.maintenance import mark_stale_unknown, merge_instances, rewrite_stale_unknown
from ranktrail.operators.ranks import story_timeline
from ranktrail.operators.status import story_state
from ranktrail.plans import snapshots
from ranktrail.schema import STATUSES
from ranktrail.sources.histories import append_histories, story_history
from ranktrail.sources.tables import before, read_table, write_table

DAYS = 5


@pytest.fixture
def history(runs, records):
    """Runs at 6:00 and 18:00 of five days, with records of some of thirty stories."""
    draw = random.Random(3)
    times = [START + timedelta(days=d, hours=h) for d in range(DAYS) for h in (6, 18)]
    run = runs(*[(t, draw.sample(range(30), 6), None, draw.sample(range(30), 3)) for t in times])
    found = [(t, s, draw.choice(STATUSES), draw.randrange(9)) for t in times for s in draw.sample(range(30), 12)]
    return run, records(*found), times


def stored(df, path, table_schema):
    write_table(df, str(path))
    return read_table(df.sparkSession, str(path), table_schema)


def day_folders(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(path).glob("run_date=*")}


def test_snapshots_grow_day_by_day_and_give_every_past_state(spark, history, tmp_path):
    run, run_story, times = history
    table = stored(run_story, tmp_path / "run_story", schema.RUN_STORY)
    folder = str(tmp_path / "snapshots")
    first = START.date()
    assert snapshots.extend_snapshots(table, folder, first + timedelta(days=1)) == [first, first + timedelta(days=1)]
    assert snapshots.extend_snapshots(table, folder) == [first + timedelta(days=d) for d in (2, 3)]
    assert snapshots.extend_snapshots(table, folder) == []
    for t in (times[0], times[3], times[4], times[-1], times[-1] + timedelta(days=9)):
        want = story_state(before(run_story, t))
        assert rows(snapshots.state_before(table, folder, t), *want.columns) == rows(want)
    for t in (times[3], times[8]):
        got = snapshots.classify_as_of(run, table, rules(), t, folder)
        assert rows(got) == rows(classify_stories(run, run_story, rules(), t))
    gone = snapshots.thin_snapshots(spark, folder, date(2100, 1, 1), every=3)
    assert len(gone) == 2 and len(snapshots.snapshot_days(spark, folder)) == 2
    want = story_state(before(run_story, times[7]))
    assert rows(snapshots.state_before(table, folder, times[7]), *want.columns) == rows(want)
    assert snapshots.drop_snapshots(spark, folder, first) and not snapshots.snapshot_days(spark, folder)


def test_a_past_run_reads_one_snapshot_and_its_own_day(spark, history, tmp_path):
    """Earlier days and older snapshots are made unreadable."""
    run, run_story, times = history
    want = rows(classify_stories(run, run_story, rules(), times[7]))
    table = stored(run_story, tmp_path / "run_story", schema.RUN_STORY)
    folder = tmp_path / "snapshots"
    snapshots.extend_snapshots(table, str(folder))
    today, newest = f"run_date={times[7].date()}", f"day={times[5].date()}"
    spoiled = [f for f in (tmp_path / "run_story").glob("run_date=*/*.parquet") if f.parent.name != today]
    spoiled += [f for f in folder.glob("day=*/*.parquet") if f.parent.name != newest]
    assert len(spoiled) > 5
    for file in spoiled:
        file.write_bytes(b"unreadable")
    again = read_table(spark, str(tmp_path / "run_story"), schema.RUN_STORY)
    assert rows(snapshots.classify_as_of(run, again, rules(), times[7], str(folder))) == want


def test_half_written_snapshot_does_not_count(spark, history, tmp_path):
    _, run_story, times = history
    folder = tmp_path / "snapshots"
    snapshots.extend_snapshots(run_story, str(folder))
    last = max(folder.glob("day=*"))
    (last / "_SUCCESS").unlink()
    assert date.fromisoformat(last.name[4:]) not in snapshots.snapshot_days(spark, str(folder))
    want = story_state(before(run_story, times[-1]))
    assert rows(snapshots.state_before(run_story, str(folder), times[-1]), *want.columns) == rows(want)
    assert snapshots.extend_snapshots(run_story, str(folder)) == [date.fromisoformat(last.name[4:])]


def test_history_of_a_story_opens_its_shelf_only(spark, history, tmp_path):
    run, run_story, times = history
    path = str(tmp_path / "histories")
    for day in range(DAYS):  # as a daily job would
        part = run_story.filter((run_story.ts_run >= START + timedelta(days=day))
                                & (run_story.ts_run < START + timedelta(days=day + 1)))
        append_histories(run, part, path, shelves=8)
    wanted = story_timeline(run, run_story).collect()
    for story_id in (0, 7, 29, 1000):
        got = story_history(spark, path, story_id, shelves=8)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            (tuple(r) for r in wanted if r.story_id == story_id), key=str
        )
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "shelf" in plan
    shelf = {f.parent.name for f in Path(path).glob("shelf=*/*.parquet")}
    assert len(shelf) == 8
    mine = spark.sql("SELECT pmod(xxhash64(7L), 8) AS s").first().s
    for file in Path(path).glob("shelf=*/*.parquet"):
        if file.parent.name != f"shelf={mine}":
            file.write_bytes(b"unreadable")
    assert story_history(spark, path, 7, shelves=8).count() == sum(r.story_id == 7 for r in wanted)


def test_rewriting_touches_only_days_that_change(spark, history, tmp_path):
    run, run_story, times = history
    path = tmp_path / "run_story"
    table = stored(run_story, path, schema.RUN_STORY)
    want = rows(mark_stale_unknown(run, run_story), *schema.RUN_STORY.names)
    files = day_folders(path)
    changed = rewrite_stale_unknown(run, str(path))
    again = read_table(spark, str(path), schema.RUN_STORY)
    assert rows(again, *schema.RUN_STORY.names) == want
    after = day_folders(path)
    assert {d for d in files if files[d] != after[d]} == {f"run_date={d}" for d in changed}
    assert 0 < len(changed) < DAYS
    assert rewrite_stale_unknown(run, str(path)) == []  # nothing is left to change
    assert day_folders(path) == after
    assert table.columns == again.columns


def test_merging_three_instances_of_runs_and_errors(spark, runs, tmp_path):
    a = runs((at(0), [1], None, None), (at(5), [2], None, None))
    b = runs((at(5), [9], None, None), (at(10), [3], None, None), (at(20), None, None, None))
    c = runs((at(0), [8], None, None), (at(10), [8], None, None), (at(15), [4], None, None))
    got = merge_instances("run", [a, b, c])
    assert rows(got, "ts_run", "topstories") == rows(
        spark.createDataFrame([(at(0), [1]), (at(5), [2]), (at(10), [3]), (at(15), [4]), (at(20), None)],
                              "ts_run timestamp_ntz, topstories array<bigint>")
    )
    assert got.columns == a.columns
    one = [(START, "run", "x", "1"), (START, "run_story", "5", "1")]
    two = [(START, "run", "x", "2"), (START, "run", "y", "2")]
    errors = [spark.createDataFrame(r, schema.ERROR) for r in (one, two, two + one)]
    assert rows(merge_instances("error", errors), "source_id", "report") == [("5", "1"), ("x", "1"), ("y", "2")]


def test_export_writes_only_days_that_changed(spark, history, tmp_path):
    run, run_story, times = history
    path, errors = str(tmp_path / "export"), spark.createDataFrame([(times[0], "run", "x", "1")], schema.ERROR)
    first = export_changed({"run": run, "run_story": run_story, "error": errors}, path)
    every = [START.date() + timedelta(days=d) for d in range(DAYS)]
    assert first == {"run": every, "run_story": every, "error": every[:1]}
    files = {n: day_folders(tmp_path / "export" / n) for n in first}
    again = run_story.repartition(3)  # the same rows in another order
    assert export_changed({"run": run, "run_story": again, "error": errors}, path) == {n: [] for n in first}
    assert {n: day_folders(tmp_path / "export" / n) for n in first} == files
    # one score changed on one day, one null for another column's, and a day left out
    less = run_story.filter(run_story.ts_run < times[-2])
    other = less.withColumn("score", F.when(less.ts_run == times[2], F.col("score") + 1).otherwise(F.col("score")))
    assert export_changed({"run_story": other}, path) == {"run_story": [every[1], every[-1]]}
    got = read_table(spark, f"{path}/run_story", schema.RUN_STORY)
    assert rows(got, *schema.RUN_STORY.names) == rows(other, *schema.RUN_STORY.names)
    after = day_folders(tmp_path / "export" / "run_story")
    assert {d for d in after if after[d] != files["run_story"][d]} == {f"run_date={every[1]}"}
    bare = less.withColumns({"score": F.lit(None).cast("int"), "descendants": F.lit(None).cast("long")})
    swapped = bare.withColumn("score", F.lit(3))
    export_changed({"run_story": bare.withColumn("descendants", F.lit(3).cast("long"))}, path)
    assert len(export_changed({"run_story": swapped}, path)["run_story"]) == DAYS - 1
    assert export_changed({"run_story": run_story.limit(0)}, path) == {"run_story": every[:-1]}
    assert read_table(spark, f"{path}/run_story", schema.RUN_STORY).count() == 0
