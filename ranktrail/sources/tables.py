"""Stored tables: parquet, one directory per day of ``ts_run``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ..functions.times import moment

DAY_COLUMN = "run_date"


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a table with a ``ts_run`` column, partitioned by its day.

    Rebalancing keeps a day in few files, yet splits a day that is too large for
    one task. Rows are ordered by time within a file, so its statistics prune.
    """
    (
        df.withColumn(DAY_COLUMN, F.to_date("ts_run"))
        .hint("rebalance", DAY_COLUMN)
        .sortWithinPartitions(DAY_COLUMN, "ts_run")
        .write.mode(mode)
        .partitionBy(DAY_COLUMN)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a stored table; with a schema also one nothing was written to yet."""
    if schema is None:
        return spark.read.parquet(path)
    with_day = StructType([*schema.fields]).add(DAY_COLUMN, DateType())
    return spark.read.schema(with_day).parquet(path)


def up_to(df: DataFrame, ts_run) -> DataFrame:
    """Rows of runs up to and including ``ts_run``; skips later day directories."""
    return between(df, None, ts_run)


def before(df: DataFrame, ts_run) -> DataFrame:
    """Rows of runs strictly before ``ts_run``."""
    return up_to(df, ts_run).filter(F.col("ts_run") < run_time(df, ts_run))


def at(df: DataFrame, ts_run) -> DataFrame:
    """Rows of one run; reads its day only."""
    return _compare(df, "__eq__", ts_run)


def between(df: DataFrame, low, high) -> DataFrame:
    """Rows of runs in a closed range; an end that is None is open."""
    if low is not None:
        df = _compare(df, "__ge__", low)
    if high is not None:
        df = _compare(df, "__le__", high)
    return df


def _compare(df: DataFrame, operator: str, value) -> DataFrame:
    """Filter on the run time, and alike on its day where the table is stored by day."""
    limit = run_time(df, value)
    df = df.filter(getattr(F.col("ts_run"), operator)(limit))
    if DAY_COLUMN in df.columns:
        df = df.filter(getattr(F.col(DAY_COLUMN), operator)(F.to_date(limit)))
    return df


def run_time(df: DataFrame, value) -> Column:
    return moment(value, df.schema["ts_run"].dataType)
