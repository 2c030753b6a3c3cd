"""Whole-table work: migrating, exporting and merging collections, flagging stale stories."""

import os
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import is_older
from ..schema import (
    KEYS,
    MIGRATED_RULESET,
    MIGRATED_VERSION,
    MIGRATION_BUILTINS,
    RANKINGS,
    RUN_STORY,
    checked_error_source,
    checked_status,
    status_code,
    status_name,
)
from ..session import shared_dir
from ..sources.tables import DAY_COLUMN, read_table, run_time, write_table
from .classify import latest_run
from .ranks import ranks_at

Tables = dict[str, DataFrame]


def migrate_v015(old: Tables) -> Tables:
    """Reshape the tables of the 0.1.5 layout.

    Expects run, run_story, story, error, ruleset and rule; returns run, run_story, story,
    error, ruleset and rules. Rulesets that ship with the software are not carried over,
    and an unknown status or error source fails the query.
    """
    own = ~F.col("ruleset_id").isin(*MIGRATION_BUILTINS)
    return {
        "run": old["run"].select(
            "ts_run",
            *RANKINGS,
            "ts_end",
            F.lit(MIGRATED_VERSION).alias("extversion"),
            F.lit(MIGRATED_RULESET).alias("ruleset_id"),
        ),
        "run_story": old["run_story"].select(
            "ts_run",
            "story_id",
            checked_status(F.col("status")).alias("status"),
            "score",
            "descendants",
            "ts_payload",
        ),
        "story": old["story"].select("id", checked_status(F.col("status")).alias("status")),
        "error": old["error"].select(
            "ts_run",
            checked_error_source(F.col("object")).alias("error_source"),
            F.col("object_id").alias("source_id"),
            "report",
        ),
        "ruleset": old["ruleset"].filter(~F.col("id").isin(*MIGRATION_BUILTINS)).select("id"),
        "rules": old["rule"]
        .filter(own)
        .select("ruleset_id", F.col("rule").alias("id"), "type_val", "val"),
    }


def export_tables(tables: Tables, path: str) -> list[str]:
    """Write error, run and run_story whole, and the rulesets users added, as parquet.

    Returns the names written. Tables with a ``ts_run`` are partitioned by day.
    """
    written = []
    for name in ("error", "run", "run_story"):
        if name in tables:
            write_table(tables[name], os.path.join(path, name), mode="errorifexists")
            written.append(name)
    for name, key in (("ruleset", "id"), ("rules", "ruleset_id")):
        if name in tables:
            own = tables[name].filter(~F.col(key).isin(*MIGRATION_BUILTINS))
            own.write.mode("errorifexists").parquet(os.path.join(path, name))
            written.append(name)
    return written


def _stacked(instances: list[DataFrame]) -> DataFrame:
    parts = [df.withColumn("instance", F.lit(i)) for i, df in enumerate(instances)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def merge_instances(table: str, instances: list[DataFrame]) -> DataFrame:
    """Union of one table from several instances, one row per key.

    Of rows with one key, that of the earliest instance in the list stays; a key is unique within
    an instance. Records are fixed-width (the status as its code), so one hash aggregation,
    combined before the shuffle, picks each column from the earliest instance. Of tables with text
    or lists only the keys are aggregated, to the instance that owns each; then every instance gives
    the rows it owns. So each is read twice, however many there are.
    """
    key = KEYS[table]
    columns = instances[0].columns
    if table == "run_story":
        rows = _stacked(instances).withColumn("status", status_code())
        # min_by passes over no null: a null of the earliest instance stays
        picked = {c: F.min_by(c, "instance").alias(c) for c in columns if c not in key}
        merged = rows.groupBy(*key).agg(*picked.values())
        return merged.withColumn("status", status_name("status")).select(*columns)
    owners = _stacked([df.select(*key) for df in instances])
    owners = owners.groupBy(*key).agg(F.min("instance").alias("instance"))
    path = shared_dir(owners.sparkSession, "owners")
    owners.write.partitionBy("instance").parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in owners.schema}
    stored = owners.sparkSession.read.schema(", ".join(f"{c} {k}" for c, k in kinds.items())).parquet(path)
    merged = None
    for i, df in enumerate(instances):
        owned = stored.filter(F.col("instance") == i).drop("instance")
        part = df.join(owned, list(key), "left_semi").select(*columns)
        merged = part if merged is None else merged.unionByName(part)
    return merged


def merge_conflicts(table: str, instances: list[DataFrame]) -> DataFrame:
    """Keys whose copies differ, with the number of copies and of instances holding one.

    Copies of a column differ if its least and greatest values do, or if some are null. Text and
    lists are compared by two hashes, so every buffer has a fixed width.
    """
    key = KEYS[table]
    rows = _stacked(instances)
    values = [c for c in instances[0].columns if c not in key]
    fixed = {c for c, kind in instances[0].dtypes if not kind.startswith(("string", "array"))}
    compared = []
    for c in values:
        compared += [c] if c in fixed else [F.xxhash64(c), F.hash(c)]
    named = [F.expr(c).alias(f"v{i}") if isinstance(c, str) else c.alias(f"v{i}")
             for i, c in enumerate(compared)]
    absent = [F.col(c).isNull().cast("int").alias(f"n{i}") for i, c in enumerate(values)]
    names = [f"v{i}" for i in range(len(named))] + [f"n{i}" for i in range(len(absent))]
    held = [F.max(F.when(F.col("instance") == i, 1).otherwise(0)) for i in range(len(instances))]
    total = held[0]
    for h in held[1:]:
        total = total + h
    differs = F.lit(False)
    for n in names:
        differs = differs | F.coalesce(F.col(f"low_{n}") != F.col(f"high_{n}"), F.lit(False))
    return (
        rows.select(*key, "instance", *named, *absent)
        .groupBy(*key)
        .agg(
            F.count("*").alias("copies"),
            total.alias("instances"),
            *[F.min(n).alias(f"low_{n}") for n in names],
            *[F.max(n).alias(f"high_{n}") for n in names],
        )
        .filter(differs)
        .select(*key, "copies", "instances")
    )


def mark_stale_unknown(
    run: DataFrame, run_story: DataFrame, ts_run=None, min_age: float | None = None
) -> DataFrame:
    """``run_story`` with status unknown on the last record of stories no longer ranked.

    ``min_age`` (seconds) leaves out records younger than that at the run. Returns the
    new table: the last time of each unranked story is joined back on the key.
    """
    if ts_run is None:
        ts_run = latest_run(run)
    return _marked(run_story, _stale(run, run_story, ts_run, min_age))


def _stale(run: DataFrame, run_story: DataFrame, ts_run, min_age: float | None) -> DataFrame:
    """(ts_run, story_id) of the last records of stories not ranked at the run."""
    stale = (
        run_story.groupBy("story_id")
        .agg(F.max("ts_run").alias("ts_run"))
        .join(ranks_at(run, ts_run).select("story_id"), "story_id", "left_anti")
    )
    if min_age is not None:
        stale = stale.filter(is_older(run_time(run, ts_run), F.col("ts_run"), min_age))
    return stale.select("ts_run", "story_id")


def _marked(run_story: DataFrame, stale: DataFrame) -> DataFrame:
    marked = run_story.join(
        stale.withColumn("_stale", F.lit(True)), ["ts_run", "story_id"], "left"
    )
    status = F.when(F.col("_stale"), F.lit("unknown")).otherwise(F.col("status"))
    return marked.withColumn("status", status).select(*run_story.columns)


def rewrite_stale_unknown(
    run: DataFrame, path: str, ts_run=None, min_age: float | None = None
) -> list[date]:
    """:func:`mark_stale_unknown` on a stored table, in place; returns the days rewritten.

    Only days that hold a last record whose status changes are written, first to the shared
    folder and from there over the old ones. Spark exchanges whole day directories when the write is
    committed, so a job that fails before leaves the table as it was; run again, it does what is left.
    Days already marked and all other days keep their files.
    """
    spark = run.sparkSession
    if ts_run is None:
        ts_run = latest_run(run)
    records = read_table(spark, path, RUN_STORY)
    stale_path, staged = shared_dir(spark, "stale"), shared_dir(spark, "restated")
    keys = _stale(run, records, ts_run, min_age).withColumn("status", F.lit("unknown"))
    # a last record that is marked already is no change
    same = records.select("ts_run", "story_id", "status")
    changed = keys.join(same, ["ts_run", "story_id", "status"], "left_anti").drop("status")
    changed.write.parquet(stale_path)
    stale = spark.read.schema("story_id bigint, ts_run timestamp_ntz").parquet(stale_path)
    day = F.to_date("ts_run")
    days = [r.day for r in stale.select(day.alias("day")).distinct().orderBy("day").collect()]
    if not days:
        return []
    write_table(_marked(records.filter(F.col(DAY_COLUMN).isin(days)).drop(DAY_COLUMN), stale), staged)
    (
        read_table(spark, staged, RUN_STORY)
        .hint("rebalance", DAY_COLUMN)
        .sortWithinPartitions(DAY_COLUMN, "ts_run")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_COLUMN)
        .parquet(path)
    )
    return days
