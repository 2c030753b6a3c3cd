"""Reports per run kept up to date by batch, instead of made anew from all records.

A batch of records, with the errors of their fetches and the lists that landed with them, is reduced
to a row of additive counts per run and stored under its number, by day. The report adds up what the
batches hold for a run. A batch that is repeated overwrites its own rows; one that brings further
records of an old run adds to it. The rows of a story's fetch and its error belong to one batch.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import micros_between
from ..schema import RANKINGS
from ..sources.tables import DAY_COLUMN, between, write_table
from .ranks import landed_ranks
from .reports import COUNTED, covered, list_sizes, run_counts

_SUMS = (*[f"_{n}" for n in RANKINGS], *COUNTED, "retried_count", "total_count")
_SIZES = tuple(f"_{n}_listed" for n in RANKINGS)
_SCHEMA = (
    "ts_run timestamp_ntz, "
    + ", ".join(f"{c} bigint" for c in _SUMS)
    + ", _end timestamp_ntz, "
    + ", ".join(f"{c} int" for c in _SIZES)
    + f", batch bigint, {DAY_COLUMN} date"
)


def update_report(
    rankings: DataFrame, run_story: DataFrame, error: DataFrame, folder: str, batch: int
) -> None:
    """Store a batch's counts: parsed lists, records and errors of the runs it brings.

    The lists may also have come with an earlier batch; ranks are taken from those given.
    """
    counts = run_counts(landed_ranks(rankings), run_story, error)
    rows = counts.join(list_sizes(rankings), "ts_run", "full_outer")
    write_table(rows, f"{folder}/batch={batch}", mode="overwrite")


def _added_up(spark: SparkSession, folder: str, low=None, high=None) -> DataFrame:
    rows = between(spark.read.schema(_SCHEMA).parquet(folder), low, high)
    largest = [F.max(c).alias(c) for c in ("_end", *_SIZES)]
    return rows.groupBy("ts_run").agg(*[F.sum(c).alias(c) for c in _SUMS], *largest)


def coverage_report(spark: SparkSession, folder: str, low=None, high=None) -> DataFrame:
    """``stats_run_story_coverage`` of all runs, or of those in a closed range of times."""
    rows = _added_up(spark, folder, low, high)
    return covered(rows.select("ts_run", *_SIZES), rows.drop(*_SIZES))


def story_report(spark: SparkSession, folder: str, low=None, high=None) -> DataFrame:
    """``stats_run_story`` likewise: runs with records only."""
    rows = _added_up(spark, folder, low, high).filter(F.col("total_count") > 0)
    return rows.select(
        "ts_run",
        *[F.lit(None).cast("string").alias(n) for n in RANKINGS],
        *COUNTED,
        "retried_count",
        "total_count",
        micros_between(F.col("_end"), F.col("ts_run")).alias("fetch_micros"),
    )
