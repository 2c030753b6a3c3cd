"""Daily snapshots of the story state, so that the past can be classified without reading it whole.

A snapshot holds the state of every story at the end of a day, in a directory of its own:
``folder``/day=2024-01-16. The next one is the last one merged with the records of its day, so keeping the
chain up to date reads one snapshot and the new days. The state before any run is the last snapshot
before its day and the records in between. Older snapshots may be thinned out: what lies between
two of them is read from the records instead.
"""

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import classify_codes, decode
from ..operators.status import merge_states, story_state
from ..ruleset import Ruleset
from ..schema import RUN_STORY, STORY_STATE
from ..session import remove
from ..sources.tables import before, between

_DAY = "day="


def snapshot_days(spark: SparkSession, folder: str) -> list[date]:
    """Days with a complete snapshot: those whose write has left its success marker."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    days = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith(_DAY) and files.exists(marker):
            days.append(date.fromisoformat(name.removeprefix(_DAY)))
    return sorted(days)


def read_snapshot(spark: SparkSession, folder: str, day: date) -> DataFrame:
    return spark.read.schema(STORY_STATE).parquet(f"{folder}/{_DAY}{day}")


def _start(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def _records(run_story: DataFrame, first: date | None, last: date) -> DataFrame:
    """Records of whole days, both included; directories of other days are not opened."""
    low = None if first is None else _start(first)
    return between(run_story, low, _start(last + timedelta(days=1)) - timedelta(microseconds=1))


def extend_snapshots(run_story: DataFrame, folder: str, through: date | None = None) -> list[date]:
    """Write the snapshots that are missing up to ``through`` and return their days.

    Every day with records after the last snapshot gets one; ``through`` None: up to the day before the last
    record, which is complete. A day is written once it is whole, and one that was left half-written is
    written again. The driver handles a date per day.
    """
    spark = run_story.sparkSession
    known = snapshot_days(spark, folder)
    newest = known[-1] if known else None
    fresh = run_story if newest is None else between(run_story, _start(newest + timedelta(days=1)), None)
    days = [r.day for r in fresh.select(F.to_date("ts_run").alias("day")).distinct().orderBy("day").collect()]
    if through is None:
        days = days[:-1]
    else:
        days = [d for d in days if d <= through]
    for day in days:
        state = story_state(_records(run_story, day, day).select(*RUN_STORY.names))
        if newest is not None:
            state = merge_states(read_snapshot(spark, folder, newest), state)
        state.select(*STORY_STATE.names).write.mode("overwrite").parquet(f"{folder}/{_DAY}{day}")
        newest = day
    return days


def drop_snapshots(spark: SparkSession, folder: str, since: date) -> list[date]:
    """Remove the snapshots from a day on, whose records have changed; ``extend_snapshots`` renews them."""
    gone = [day for day in snapshot_days(spark, folder) if day >= since]
    for day in reversed(gone):  # from the end, so that the chain stays whole if this is interrupted
        remove(spark, f"{folder}/{_DAY}{day}")
    return gone


def thin_snapshots(spark: SparkSession, folder: str, older_than: date, every: int = 7) -> list[date]:
    """Of the snapshots before a day keep each ``every``-th; returns the days removed."""
    old = [day for day in snapshot_days(spark, folder) if day < older_than]
    gone = [day for i, day in enumerate(reversed(old)) if i % every]
    remove(spark, *[f"{folder}/{_DAY}{day}" for day in gone])
    return sorted(gone)


def state_before(run_story: DataFrame, folder: str, ts_run: datetime) -> DataFrame:
    """The state strictly before a run: a snapshot and the records since, or all earlier records."""
    spark = run_story.sparkSession
    earlier = [day for day in snapshot_days(spark, folder) if day < ts_run.date()]
    if not earlier:
        return story_state(before(run_story, ts_run))
    since = before(between(run_story, _start(earlier[-1] + timedelta(days=1)), None), ts_run)
    return merge_states(read_snapshot(spark, folder, earlier[-1]), story_state(since))


def classify_as_of(
    run: DataFrame, run_story: DataFrame, rules: Ruleset, ts_run: datetime, folder: str
) -> DataFrame:
    """``classify_stories`` at any run, from the last snapshot before its day and the records since."""
    return decode(classify_codes(run, None, rules, ts_run, state_before(run_story, folder, ts_run)))
