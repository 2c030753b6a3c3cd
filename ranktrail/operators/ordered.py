"""Neighbours in time over a whole table, without one task seeing all of it.

A window ordered over everything would pull every row into one partition. Here rows
are cut into buckets of time (an hour by default); a window works within a bucket, and
what it needs from other buckets comes from a summary with one row per bucket: at most
one per hour covered (8,766 a year), however many rows there are.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def _bucket(seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col("ts_run").cast("timestamp")) / (seconds * 1_000_000))


def neighbours(runs: DataFrame, bucket_seconds: int = 3_600) -> DataFrame:
    """Previous and next timestamp of every distinct ``ts_run``."""
    rows = runs.select("ts_run", _bucket(bucket_seconds).alias(_BUCKET))
    within = W.partitionBy(_BUCKET).orderBy("ts_run")
    across = W.orderBy(_BUCKET)  # one row per bucket
    edges = (
        rows.groupBy(_BUCKET)
        .agg(F.min("ts_run").alias("_first"), F.max("ts_run").alias("_last"))
        .select(
            _BUCKET,
            F.lag("_last").over(across).alias("_before"),
            F.lead("_first").over(across).alias("_after"),
        )
    )
    return (
        rows.withColumn("_lag", F.lag("ts_run").over(within))
        .withColumn("_lead", F.lead("ts_run").over(within))
        .join(edges, _BUCKET)
        .select(
            "ts_run",
            F.coalesce("_lag", "_before").alias("previous"),
            F.coalesce("_lead", "_after").alias("next"),
        )
    )


def latest_before(
    points: DataFrame, recorded: DataFrame, bucket_seconds: int = 3_600
) -> DataFrame:
    """For every ``ts_run`` of ``points`` the greatest strictly earlier one in ``recorded``."""
    # a timestamp once per side first: many records share one run
    marks = points.select("ts_run", F.lit(True).alias("_point")).unionAll(
        recorded.select("ts_run", F.lit(False))
    )
    rows = (
        marks.groupBy("ts_run")
        .agg(F.bool_or("_point").alias("_point"), (~F.bool_and("_point")).alias("_recorded"))
        .withColumn(_BUCKET, _bucket(bucket_seconds))
    )
    seen = F.when(F.col("_recorded"), F.col("ts_run"))
    within = (
        W.partitionBy(_BUCKET).orderBy("ts_run").rowsBetween(W.unboundedPreceding, -1)
    )
    across = W.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy(_BUCKET)
        .agg(F.max(seen).alias("_last"))
        .select(_BUCKET, F.max("_last").over(across).alias("_before"))
    )
    return (
        rows.withColumn("_within", F.max(seen).over(within))
        .join(carried, _BUCKET)
        .filter("_point")
        .select("ts_run", F.coalesce("_within", "_before").alias("latest"))
    )
