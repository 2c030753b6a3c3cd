import pytest
from conftest import START, at, rows
from pyspark.sql import functions as F

from ranktrail import schema
from ranktrail.operators.maintenance import (
    export_tables,
    mark_stale_unknown,
    merge_conflicts,
    merge_instances,
    migrate_v015,
)
from ranktrail.ruleset import builtin_rules, builtin_rulesets, rules_table
from ranktrail.sources.tables import between, read_table, write_table


def old_tables(spark, runs, records, status="hot"):
    return {
        "run": runs((START, [1], None, None)).drop("extversion", "ruleset_id"),
        "run_story": records((START, 1, status)),
        "story": spark.createDataFrame([(1, "cold")], schema.STORY),
        "error": spark.createDataFrame(
            [(START, "run", "topstories", "{}")],
            "ts_run timestamp_ntz, object string, object_id string, report string",
        ),
        "ruleset": builtin_rulesets(spark).union(
            spark.createDataFrame([("production",), ("own",)], "id string")
        ),
        "rule": builtin_rules(spark)
        .union(rules_table(spark, {"own": "{}"}))
        .withColumnRenamed("id", "rule"),
    }


def test_migration(spark, runs, records):
    new = migrate_v015(old_tables(spark, runs, records))
    assert rows(new["run"]) == [(START, [1], None, None, START, "0.1.5", "unknown")]
    assert rows(new["error"]) == [(START, "run", "topstories", "{}")]
    assert rows(new["story"]) == [(1, "cold")]
    assert rows(new["ruleset"]) == [("own",)]
    assert rows(new["rules"]) == [("own", "run_story_param", "jsonb", "{}")]
    for name in ("run", "run_story", "story", "error", "ruleset", "rules"):
        assert new[name].columns == getattr(schema, name.upper()).names


def test_migration_refuses_unknown_values(spark, runs, records):
    new = migrate_v015(old_tables(spark, runs, records, status="lukewarm"))
    with pytest.raises(Exception, match="lukewarm"):
        new["run_story"].collect()
    old = old_tables(spark, runs, records, status=None)
    old["error"] = old["error"].withColumn("object", F.lit("elsewhere"))
    assert rows(migrate_v015(old)["run_story"], "status") == [(None,)]
    with pytest.raises(Exception, match="elsewhere"):
        migrate_v015(old)["error"].collect()


def test_export(spark, runs, records, tmp_path):
    tables = {
        "run": runs((START, [1], None, None)),
        "run_story": records((START, 1, "new"), (at(2000), 1, "hot")),
        "rules": builtin_rules(spark).union(rules_table(spark, {"own": "{}"})),
    }
    assert export_tables(tables, str(tmp_path)) == ["run", "run_story", "rules"]
    back = read_table(spark, str(tmp_path / "run_story"))
    assert rows(back.drop("run_date")) == rows(tables["run_story"])
    assert len(list((tmp_path / "run_story").glob("run_date=*"))) == 2
    assert rows(spark.read.parquet(str(tmp_path / "rules")), "ruleset_id") == [("own",)]
    with pytest.raises(Exception, match="already exists"):
        export_tables(tables, str(tmp_path))


def test_merge(records):
    a = records((START, 1, "new", 5), (START, 2, "new", 5))
    b = records((START, 1, "hot", 9), (at(5), 2, "hot", 7), (START, 2, "new", 5))
    want = [(START, 1, "new", 5), (START, 2, "new", 5), (at(5), 2, "hot", 7)]
    assert rows(merge_instances("run_story", [a, b]), "ts_run", "story_id", "status", "score") == want
    assert rows(merge_conflicts("run_story", [a, b])) == [(START, 1, 2, 2)]
    assert rows(merge_instances("run_story", [b, a]), "score") == [(5,), (7,), (9,)]
    assert rows(merge_conflicts("run_story", [a, a])) == []


def test_merge_runs_with_lists(runs):
    a, b = runs((START, [1], None, None)), runs((START, [2], None, None), (at(5), [3], None, None))
    assert [r[0] for r in rows(merge_instances("run", [a, b]), "topstories")] == [[1], [3]]
    assert rows(merge_conflicts("run", [a, b]), "ts_run") == [(START,)]


def test_mark_stale(runs, records):
    run = runs((START, [1, 2], None, None), (at(5), [2], None, None))
    story = records((START, 1, "hot"), (START, 2, "hot"), (START, 3, "cold"), (at(5), 3, "cold"))
    got = rows(mark_stale_unknown(run, story), "ts_run", "story_id", "status")
    assert got == [
        (START, 1, "unknown"), (START, 2, "hot"), (START, 3, "cold"), (at(5), 3, "unknown"),
    ]
    aged = rows(mark_stale_unknown(run, story, min_age=300), "story_id", "status")
    assert aged == [(1, "unknown"), (2, "hot"), (3, "cold"), (3, "cold")]


def test_day_directories_prune(spark, records, tmp_path):
    path = str(tmp_path / "t")
    write_table(records(*[(at(1440 * d), 1, "new") for d in range(5)]), path)
    table = between(read_table(spark, path), at(1440), at(2 * 1440))
    assert table.count() == 2
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
