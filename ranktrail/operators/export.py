"""Repeated exports that write only the days that have changed.

Every day of a table has a digest: its number of rows and the sum of their hashes, which does not
depend on order. The digests of the last export lie beside it. A day whose digest is another, or that
had none, is written over; a day without rows any more is removed. Digests are stored last, so an export
that fails before is made up for by the next one.
"""

import os
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove
from ..sources.tables import DAY_COLUMN

EXPORTED = ("error", "run", "run_story")
_DIGEST = f"{DAY_COLUMN} date, rows bigint, hashes decimal(38,0)"


def day_digests(df: DataFrame) -> DataFrame:
    """(run_date, rows, hashes) by one hash aggregation; a row per day."""
    values = [F.col(f"`{c}`") for c in df.columns if c != DAY_COLUMN]
    # a null leaves a hash as it is, so the places of nulls are hashed too
    row = F.xxhash64(*values, *[v.isNull() for v in values])
    return (
        df.select(F.to_date("ts_run").alias(DAY_COLUMN), row.cast("decimal(38,0)").alias("h"))
        .groupBy(DAY_COLUMN)
        .agg(F.count("*").alias("rows"), F.sum("h").cast("decimal(38,0)").alias("hashes"))
    )


def _stored_digests(df: DataFrame, path: str) -> dict[date, tuple]:
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return {}
    return {r[0]: (r[1], r[2]) for r in spark.read.schema(_DIGEST).parquet(path).collect()}


def export_changed(tables: dict[str, DataFrame], path: str) -> dict[str, list[date]]:
    """Bring the export of error, run and run_story at ``path`` up to date; returns the days touched.

    The driver handles a digest per day. The first export writes every day.
    """
    touched = {}
    for name in EXPORTED:
        if name not in tables:
            continue
        df = tables[name].drop(DAY_COLUMN)
        target, digests = os.path.join(path, name), os.path.join(path, "_digests", name)
        before = _stored_digests(df, digests)
        after = {r[0]: (r[1], r[2]) for r in day_digests(df).collect()}
        changed = sorted(d for d in after if before.get(d) != after[d])
        gone = sorted(d for d in before if d not in after)
        if changed:
            days = df.withColumn(DAY_COLUMN, F.to_date("ts_run")).filter(F.col(DAY_COLUMN).isin(changed))
            (
                days.hint("rebalance", DAY_COLUMN)
                .sortWithinPartitions(DAY_COLUMN, "ts_run")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(DAY_COLUMN)
                .parquet(target)
            )
        remove(df.sparkSession, *[f"{target}/{DAY_COLUMN}={day}" for day in gone])
        if changed or gone:
            rows = [(d, *values) for d, values in after.items()]
            fresh = df.sparkSession.createDataFrame(rows, _DIGEST)
            fresh.coalesce(1).write.mode("overwrite").parquet(digests)
        touched[name] = changed + gone
    return touched
