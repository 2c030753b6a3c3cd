"""A second layout of the records: by story, so that one story's history is a look-up.

Tables stored by day answer questions about a run. A story has rows on every day, so its history would
open every file. Here the rows, with the ranks the story had, lie in directories by hash of the story;
within a file they are in order of story and time, with small row groups and a Bloom filter on
the story. A look-up opens one directory and skips the row groups without the story.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import RANK_COLUMNS, with_ranks
from ..schema import RUN_STORY

SHELVES = 256  # directories; about a story's share of the files a look-up opens
SHELF_COLUMN = "shelf"

_SCHEMA = (
    "ts_run timestamp_ntz, story_id bigint, status string, score int, descendants bigint, "
    f"ts_payload timestamp_ntz, {', '.join(f'{c} int' for c in RANK_COLUMNS)}"
)


def _shelf(story_id, shelves: int):
    return F.pmod(F.xxhash64(story_id), F.lit(shelves)).cast("int")


def append_histories(
    run: DataFrame, run_story: DataFrame, path: str, shelves: int = SHELVES, row_group_bytes: int = 1 << 20
) -> None:
    """Add records with their ranks, such as those of a new day. ``shelves`` is fixed for a path.

    Rebalancing keeps a shelf's rows in few files, and splits a shelf that is too large for a task.
    """
    rows = with_ranks(run_story.select(*RUN_STORY.names), run)
    columns = [c.split()[0] for c in _SCHEMA.split(", ")]
    (
        rows.select(*columns, _shelf(F.col("story_id"), shelves).alias(SHELF_COLUMN))
        .hint("rebalance", SHELF_COLUMN)
        .sortWithinPartitions(SHELF_COLUMN, "story_id", "ts_run")
        .write.mode("append")
        .option("parquet.bloom.filter.enabled#story_id", "true")
        .option("parquet.block.size", row_group_bytes)
        .partitionBy(SHELF_COLUMN)
        .parquet(path)
    )


def read_histories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_SCHEMA}, {SHELF_COLUMN} int").parquet(path)


def story_history(spark: SparkSession, path: str, story_id: int, shelves: int = SHELVES) -> DataFrame:
    """``story_timeline`` of one story from its shelf alone."""
    shelf = spark.range(1).select(_shelf(F.lit(story_id).cast("bigint"), shelves)).first()[0]
    rows = read_histories(spark, path).filter((F.col(SHELF_COLUMN) == shelf) & (F.col("story_id") == story_id))
    return rows.select(
        F.date_format("ts_run", "yyyy-MM-dd HH:mm:ss").alias("ts_run"),
        "story_id",
        *RANK_COLUMNS,
        "status",
        "score",
        "descendants",
    )
