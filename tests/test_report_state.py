from pathlib import Path

from conftest import START, at, rows

from ranktrail import schema
from ranktrail.operators.collect import assemble_run
from ranktrail.operators.report_state import coverage_report, story_report, update_report
from ranktrail.operators.reports import landed_coverage, stats_run_story, stats_run_story_coverage
from ranktrail.sources.responses import parse_rankings

DAY = 1440


def tables(spark, records):
    def listed(t, name, payload):
        return t, name, "u", payload, t, 0.5, 1, 0, 0.0

    lists = [listed(at(0), "topstories", "[1,2,1]"), listed(at(0), "newstories", "[]"),
             listed(at(5), "topstories", "[2,x,3]"), listed(at(DAY), "beststories", "[3,1]"),
             listed(at(DAY + 5), "topstories", None)]
    records = records((at(0), 1, "new", 1), (at(0), 9, "hot", 2), (at(5), 2, "failed"), (at(5), 3, "new", 3),
                      (at(DAY), 1, "hot", 4))
    report = '{"retries":%s}'
    errors = [(at(0), "run_story", "1", report % 2), (at(5), "run_story", "2", report % 0),
              (at(DAY), "run_story", "1", report % 1), (START, "run", "topstories", report % 3)]
    return (
        parse_rankings(spark.createDataFrame(lists, schema.RANKINGS_RAW)),
        records,
        spark.createDataFrame(errors, schema.ERROR),
    )


def test_coverage_off_the_landed_lists(spark, records):
    rankings, records, errors = tables(spark, records)
    want = stats_run_story_coverage(assemble_run(rankings), records, errors)
    got = landed_coverage(rankings, records, errors)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_batches_add_up_to_the_whole_report(spark, records, tmp_path):
    rankings, records, errors = tables(spark, records)
    folder = str(tmp_path / "report")
    early = "ts_run < timestamp_ntz '2024-01-11'"
    for batch, part in ((0, early), (1, f"NOT {early}"), (1, f"NOT {early}")):  # the last one twice
        update_report(*[t.filter(part) for t in (rankings, records, errors)], folder, batch)
    whole = stats_run_story_coverage(assemble_run(rankings), records, errors)
    assert rows(coverage_report(spark, folder)) == rows(whole)
    stories = stats_run_story(records, errors)
    assert story_report(spark, folder).columns == stories.columns
    assert rows(story_report(spark, folder)) == rows(stories)
    # a late record of an old run adds to it
    more = spark.createDataFrame([(at(5), 7, "cold", 1, 0, at(6))], schema.RUN_STORY)
    update_report(rankings.limit(0), more, errors.limit(0), folder, 2)
    both = records.unionByName(more.select(*records.columns))
    assert rows(coverage_report(spark, folder)) == rows(
        stats_run_story_coverage(assemble_run(rankings), both, errors)
    )


def test_a_range_opens_its_days_only(spark, records, tmp_path):
    rankings, records, errors = tables(spark, records)
    folder = tmp_path / "report"
    update_report(rankings, records, errors, str(folder), 0)
    want = [r for r in rows(coverage_report(spark, str(folder))) if r[0] >= at(DAY)]
    spoiled = list(Path(folder).glob("batch=0/run_date=2024-01-10/*.parquet"))
    assert spoiled
    for file in spoiled:
        file.write_bytes(b"unreadable")
    assert rows(coverage_report(spark, str(folder), low=at(DAY))) == want and len(want) == 2
