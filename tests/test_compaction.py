from conftest import rows
from test_replay import ERROR_KEY, SHORT, land, landed, run_stream, uneven

from ranktrail import schema
from ranktrail.plans.replay import replay_history
from ranktrail.streaming import compaction
from ranktrail.streaming.live import collected, late_runs


def same(spark, out, want):
    got = collected(spark, str(out))
    assert rows(got.run, *schema.RUN.names) == rows(want.run, *schema.RUN.names)
    assert rows(got.run_story, *schema.RUN_STORY.names) == rows(want.run_story)
    assert rows(got.error, *ERROR_KEY) == rows(want.error, *ERROR_KEY)


def test_rows_are_the_same_before_while_and_after(spark, tmp_path, monkeypatch):
    times = uneven(6, 7)
    lists, items = landed(spark, 7, times)
    out = tmp_path / "out"
    assert compaction.compact(spark, str(out)) == -1  # nothing there yet
    for t in times[:3]:
        land(lists, tmp_path, [t])
        run_stream(spark, items, tmp_path)
    want = replay_history(lists.filter(lists.ts_run.isin(times[:3])), items, SHORT)
    same(spark, out, want)

    # a compaction that fails after some tables: no reader sees its part
    whole, seen = compaction.write_table, []

    def failing(df, path, mode):
        whole(df, path, mode)
        seen.append(path)
        same(spark, out, want)
        if len(seen) == 2:
            raise OSError("lost")

    monkeypatch.setattr(compaction, "write_table", failing)
    try:
        compaction.compact(spark, str(out))
    except OSError:
        pass
    monkeypatch.setattr(compaction, "write_table", whole)
    assert compaction.manifest(spark, str(out)) == (0, -1)
    same(spark, out, want)

    # run again: two batches in, the newest stays as it is, and nothing is removed yet
    assert compaction.compact(spark, str(out)) == 1
    assert compaction.manifest(spark, str(out)) == (1, 1)
    assert compaction.compact(spark, str(out)) == 1
    same(spark, out, want)
    assert len(list((out / "run").glob("batch=*"))) == 3
    days = {p.name for p in (out / "compact/part=1/run").glob("run_date=*")}
    assert days == {f"run_date={t.date()}" for t in times[:2]}

    # the stream goes on over it, tells late runs, and the next compaction removes the first one's batches
    for t in times[3:]:
        land(lists, tmp_path, [t])
        run_stream(spark, items, tmp_path)
    land(lists, tmp_path, [times[0]])
    run_stream(spark, items, tmp_path)
    assert {r.reason for r in late_runs(spark, str(out)).collect()} == {"run already recorded"}
    want = replay_history(lists, items, SHORT)
    same(spark, out, want)
    assert compaction.compact(spark, str(out)) == 5
    assert sorted(p.name for p in (out / "run").glob("batch=*"))[0] == "batch=2"
    same(spark, out, want)
