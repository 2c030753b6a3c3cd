import pytest
from conftest import rows

from ranktrail import schema
from ranktrail.functions.times import duration_seconds
from ranktrail.ruleset import (
    RulesetError,
    builtin_rules,
    builtin_rulesets,
    load_ruleset,
    rules_table,
)


def test_table_columns():
    assert schema.RUN.names == [
        "ts_run", "topstories", "beststories", "newstories", "ts_end", "extversion", "ruleset_id",
    ]
    assert schema.RUN_STORY.names == [
        "ts_run", "story_id", "status", "score", "descendants", "ts_payload",
    ]
    assert schema.ERROR.names == ["ts_run", "error_source", "source_id", "report"]
    assert schema.STORY.names == ["id", "status"]
    assert schema.RULESET.names == ["id"]
    assert schema.RULES.names == ["ruleset_id", "id", "type_val", "val"]


def test_status_codes_round_trip(spark):
    df = spark.createDataFrame([(s,) for s in (*schema.STATUSES, None, "odd")], "status string")
    df = df.withColumn("code", schema.status_code()).withColumn("back", schema.status_name("code"))
    got = {r.status: (r.code, r.back) for r in df.collect()}
    assert got == {
        **{s: (i, s) for i, s in enumerate(schema.STATUSES)},
        None: (None, None),
        "odd": (None, None),
    }


def test_builtin_rulesets(spark):
    assert rows(builtin_rulesets(spark)) == [("debug",), ("production_default",)]
    found = load_ruleset(builtin_rules(spark))
    assert found.name == "production_default"
    assert (found.new_repeat, found.cold_repeat, found.frozen_window) == (12, 2, 600)
    assert (found.tepid_age, found.frozen_age) == (19 * 60, 7 * 86400)
    assert load_ruleset(builtin_rules(spark), "debug").frozen_age == 60


def test_ruleset_errors(spark):
    table = builtin_rules(spark)
    with pytest.raises(RulesetError, match="no rule"):
        load_ruleset(table, "absent")
    with pytest.raises(RulesetError, match="more than one"):
        load_ruleset(table.union(table))
    with pytest.raises(RulesetError, match="is NULL"):
        load_ruleset(rules_table(spark, {"broken": None}), "broken")
    incomplete = schema.BUILTIN_RULESETS["debug"].replace('"failed_repeat":4,', "")
    with pytest.raises(RulesetError, match="failed_repeat"):
        load_ruleset(rules_table(spark, {"broken": incomplete}), "broken")
    unreadable = schema.BUILTIN_RULESETS["debug"].replace("1 minute", "a while")
    with pytest.raises(RulesetError, match="tepid_age"):
        load_ruleset(rules_table(spark, {"broken": unreadable}), "broken")
    outside = schema.BUILTIN_RULESETS["debug"].replace('window":0', 'window":86400')
    with pytest.raises(ValueError, match="86399"):
        load_ruleset(rules_table(spark, {"broken": outside}), "broken")


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("19 minute", 1140),
        ("6 hours", 21600),
        ("7 day", 604800),
        ("1 month 2 days", 32 * 86400),
        ("1 year", 360 * 86400),
        ("01:30:00", 5400),
        ("1 day 02:00", 93600),
        ("1.5 hours", 5400),
    ],
)
def test_durations(text, seconds):
    assert duration_seconds(text) == seconds


@pytest.mark.parametrize("text", ["", "soon", "3", "3 apples", "1 minute soon"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        duration_seconds(text)
