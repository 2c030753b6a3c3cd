"""The live cycle as a Structured Streaming job.

Each micro-batch holds the landed lists of one or more new runs. They are folded into the
state the previous batch left, and everything a batch produces goes to directories of its
own that a repeated batch overwrites, so a restart neither loses nor doubles rows:

    run/batch=N  blocks/batch=N  error/batch=N  state/batch=N  late/batch=N  progress/batch=N

A batch reads the responses of its own days, and the state and progress of the batch before it.
A batch of a single run, the usual one, is classified by joins alone; several runs are replayed.
The state has a row per story ever seen; states older than the last two are removed. Many
small batches leave many small files, which ``compaction.compact`` gathers by day, also while the
stream runs.

Statuses depend on order. Responses of a run that is older than the last recorded one, or
recorded already, are set aside in ``late`` with the reason.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from ..operators.classify import classify_codes, fetch_candidates
from ..operators.collect import assemble_run, fetch_outcomes, run_errors, run_story_errors
from ..operators.status import merge_states, story_state
from ..plans.replay import (
    BLOCK_RUNS,
    Replay,
    block_errors,
    block_records,
    cycle_block,
    read_blocks,
    replay_blocks,
)
from ..ruleset import Ruleset
from ..schema import ERROR, RANKINGS_RAW, RUN, STORY_STATE
from ..session import remove
from ..sources.responses import parse_rankings, read_rankings
from ..sources.tables import at, between, run_time
from .compaction import stream_table


_PROGRESS = "last_ts timestamp_ntz"


def _read(spark: SparkSession, out: str, table: str, schema: StructType) -> DataFrame:
    with_batch = StructType([*schema.fields]).add("batch", LongType())
    return spark.read.schema(with_batch).parquet(f"{out}/{table}")


def stream_cycle(
    spark: SparkSession,
    landing: str,
    items: Callable[[], DataFrame],
    rules: Ruleset,
    out: str,
    files_per_batch: int | None = None,
    block_runs: int = BLOCK_RUNS,
    interval: str | None = None,
    schedule: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the job on a folder of landed list responses (JSON lines).

    All rows of a run must land in one file; what lands later goes to ``late``. ``items`` returns
    the landed item responses as known at the time of the call, stored by day (``write_table``).
    ``schedule`` returns the planned runs (ts_run): those up to a batch's last run that left no
    response are recorded with it, all lists failed. ``interval`` ("5 minutes") keeps the job running;
    without it the query ends once everything landed has been handled. The checkpoint
    lives under ``out``: batch numbers and output belong together.
    """
    source = read_rankings(spark, landing, stream=True, files_per_batch=files_per_batch)

    def handle(batch: DataFrame, number: int) -> None:
        planned = None if schedule is None else schedule()
        _handle(batch, number, items(), rules, out, block_runs, planned)

    writer = (
        source.writeStream.option("checkpointLocation", f"{out}/_checkpoint")
        .foreachBatch(handle)
        .queryName("ranktrail_cycle")
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _handle(
    batch: DataFrame,
    number: int,
    items: DataFrame,
    rules: Ruleset,
    out: str,
    block_runs: int,
    schedule: DataFrame | None = None,
) -> None:
    spark = batch.sparkSession

    def write(df: DataFrame, table: str) -> str:
        path = f"{out}/{table}/batch={number}"
        df.write.mode("overwrite").parquet(path)
        return path

    new, state, last = batch, None, None
    if number > 0:
        progress = spark.read.schema(_PROGRESS).parquet(f"{out}/progress/batch={number - 1}")
        last = progress.first()["last_ts"]
        state = spark.read.schema(STORY_STATE).parquet(f"{out}/state/batch={number - 1}")
    if last is not None:
        newest = run_time(batch, last)
        new, behind = batch.filter(F.col("ts_run") > newest), batch.filter(F.col("ts_run") <= newest)
        if not behind.isEmpty():  # rare: only then the runs so far are looked at
            runs = stream_table(spark, out, "run", before_batch=number).select("ts_run")
            recorded = runs.withColumn("known", F.lit(True))
            reason = F.when(F.col("known"), "run already recorded").otherwise("later run recorded")
            late = behind.join(recorded, "ts_run", "left").withColumn("reason", reason)
            write(late.select(*RANKINGS_RAW.names, "reason"), "late")
    planned = None
    if schedule is not None:
        planned = between(schedule.select("ts_run"), None, new.agg(F.max("ts_run")).scalar())
        if last is not None:
            planned = planned.filter(F.col("ts_run") > run_time(planned, last))
    rankings = parse_rankings(new, runs=planned)
    runs = spark.read.schema(RUN).parquet(
        write(assemble_run(rankings, rules.name).select(*RUN.names), "run")
    )
    carried = F.lit(None if last is None else str(last)).cast("timestamp_ntz")
    write(runs.agg(F.coalesce(F.max("ts_run"), carried).alias("last_ts")), "progress")
    errors = run_errors(rankings)
    blocks = f"{out}/blocks/batch={number}"
    low, high = runs.agg(F.min("ts_run"), F.max("ts_run")).first()
    if low is not None and low == high and state is not None:
        classified = classify_codes(runs, None, rules, low, state, recorded=True)
        outcomes = spark.read.parquet(
            write(fetch_outcomes(fetch_candidates(classified), at(items, low)), "outcomes")
        )
        cycle_block(outcomes).write.mode("overwrite").partitionBy("kind").parquet(f"{blocks}/block=0")
        records = block_records(read_blocks(spark, blocks))
        after = merge_states(state, story_state(records))
        errors = errors.unionByName(run_story_errors(outcomes))
    elif low is not None:
        after = replay_blocks(runs, items, rules, state, blocks, block_runs)
        own = between(items, low, high)
        errors = errors.unionByName(block_errors(read_blocks(spark, blocks), own))
    else:
        after = state
    if after is None:
        after = spark.createDataFrame([], STORY_STATE)
    write(after.select(*STORY_STATE.names), "state")
    write(errors.select(*ERROR.names), "error")
    remove(spark, f"{out}/state/batch={number - 2}", f"{out}/outcomes/batch={number}")


def collected(spark: SparkSession, out: str) -> Replay:
    """Tables a stream has produced so far."""
    states = _read(spark, out, "state", STORY_STATE)
    newest = states.agg(F.max("batch")).scalar()
    return Replay(
        run=stream_table(spark, out, "run"),
        run_story=stream_table(spark, out, "run_story"),
        error=stream_table(spark, out, "error"),
        state=states.filter(F.col("batch") == newest).drop("batch"),
    )


def late_runs(spark: SparkSession, out: str) -> DataFrame:
    """Responses that arrived after their run or a later one was recorded, with the reason.

    Fails with path-not-found as long as there are none.
    """
    with_reason = StructType([*RANKINGS_RAW.fields]).add("reason", StringType())
    return _read(spark, out, "late", with_reason).drop("batch")
