from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import _age
from ranktrail.functions.times import (
    DAY,
    calendar_age_micros,
    check_time_window,
    is_older,
    micros_between,
)
from ranktrail.plans.replay import _calendar_age

EPOCH = datetime(1970, 1, 1)


def pairs():
    base = [
        datetime(2023, 1, 31, 5),
        datetime(2024, 1, 31, 23, 59, 59, 999_999),
        datetime(2024, 2, 29),
        datetime(2024, 12, 31, 12),
        datetime(2023, 3, 1),
    ]
    for old in base:
        for days in [0, 1, 27, 28, 29, 30, 31, 32, 45, 59, 60, 61, 180, 366, 400]:
            for hours in [0, 3, 13, 23.999]:
                yield old, old + timedelta(days=days, hours=hours)


def frame(spark, data):
    return spark.createDataFrame(data, "old timestamp_ntz, new timestamp_ntz")


def test_calendar_age_equals_duckdb(spark):
    data = list(pairs())
    df = frame(spark, data).withColumn("age", calendar_age_micros(F.col("new"), F.col("old")))
    con = duckdb.connect()
    con.execute("CREATE TABLE p (old TIMESTAMP, new TIMESTAMP)")
    con.executemany("INSERT INTO p VALUES (?, ?)", data)
    want = dict(
        ((o, n), a) for o, n, a in con.execute(f"SELECT old, new, {_age('new', 'old')} FROM p").fetchall()
    )
    for row in df.collect():
        assert row.age == want[row.old, row.new]
        micros = [(t - EPOCH) // timedelta(microseconds=1) for t in (row.new, row.old)]
        assert _calendar_age(*micros) == row.age


def test_calendar_age_runs_ahead_by_less_than_four_days(spark):
    """The replay's search relies on this."""
    for old, new in pairs():
        new_us, old_us = ((t - EPOCH) // timedelta(microseconds=1) for t in (new, old))
        assert _calendar_age(new_us, old_us) < new_us - old_us + 4 * DAY


def test_reversed_age_is_negated(spark):
    df = frame(spark, [(datetime(2024, 3, 1), datetime(2024, 1, 31))])
    forward = calendar_age_micros(F.col("old"), F.col("new"))
    backward = calendar_age_micros(F.col("new"), F.col("old"))
    row = df.select(forward.alias("f"), backward.alias("b")).first()
    assert row.f == (30 + 1) * DAY and row.b == -row.f


def test_plain_and_calendar_age_decide_alike_up_to_28_days(spark):
    df = frame(spark, list(pairs()))
    for days in (1, 7, 27, 28):
        calendar = calendar_age_micros(F.col("new"), F.col("old")) >= days * DAY
        plain = is_older(F.col("new"), F.col("old"), days * 86400)
        assert df.filter(calendar != plain).count() == 0


def test_long_threshold_uses_calendar_months(spark):
    old = datetime(2024, 1, 31)
    df = frame(spark, [(old, datetime(2024, 2, 29)), (old, datetime(2024, 3, 1))])
    month = is_older(F.col("new"), F.col("old"), 30 * 86400)
    # 29 days; then 30 days later a month and a day have passed
    assert [r[0] for r in df.orderBy("new").select(month).collect()] == [False, True]


@pytest.mark.parametrize(
    "new, inside",
    [
        (datetime(2024, 1, 8, 12, 0, 0), True),
        (datetime(2024, 1, 8, 12, 9, 59), True),
        (datetime(2024, 1, 8, 12, 10, 0), False),
        (datetime(2024, 1, 8, 11, 59, 59), False),
        (datetime(2024, 1, 9, 0, 0, 0), False),
    ],
)
def test_window_is_one_sided(spark, new, inside):
    df = frame(spark, [(datetime(2024, 1, 1, 12), new)])
    assert df.select(check_time_window(F.col("new"), F.col("old"), 600)).first()[0] is inside


def test_window_wraps_at_midnight(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 23, 55), datetime(2024, 1, 9, 0, 4))])
    assert df.select(check_time_window(F.col("new"), F.col("old"), 600)).first()[0] is True


def test_window_off_nulls_and_reversed(spark):
    df = frame(spark, [(None, datetime(2024, 1, 1)), (datetime(2024, 1, 2), datetime(2024, 1, 1))])
    got = df.orderBy("old").select(
        check_time_window(F.col("new"), F.col("old"), 0),
        check_time_window(F.col("new"), F.col("old"), 1),
    )
    assert [tuple(r) for r in got.collect()] == [(True, False), (True, True)]


@pytest.mark.parametrize("window", [-1, 86400])
def test_window_out_of_range(window):
    with pytest.raises(ValueError):
        check_time_window(F.lit(None), F.lit(None), window)


def test_works_on_zoned_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-02 00:00:01' AS new, TIMESTAMP'2024-01-01' AS old")
    assert df.select(micros_between(F.col("new"), F.col("old"))).first()[0] == DAY + 1_000_000
