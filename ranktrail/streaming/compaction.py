"""Compaction of what a stream has written, batch by batch, into tables by day.

    compact/part=G/run  compact/part=G/run_story  compact/part=G/error   by day
    compact/manifest/G-N                                                 an empty file

A compaction writes the rows of finished batches that no earlier one holds as a new part, and then
creates the file ``G-N``, in one step: from now on parts 1 to G hold all batches up to N. Readers take the
newest such file, its parts, and the batches after N, so they see every row once: before, while and after a
compaction runs. A part left half-written by a failure has no file and is written again. The folders of
compacted batches are removed one compaction later, when readers of the file before are gone.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..plans.replay import block_records, read_blocks
from ..schema import ERROR, RUN, RUN_STORY
from ..session import remove
from ..sources.tables import DAY_COLUMN, read_table, write_table

_TABLES = {"run": RUN, "run_story": RUN_STORY, "error": ERROR}
_BATCHED = ("run", "blocks", "error", "progress")


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []


def manifest(spark: SparkSession, out: str) -> tuple[int, int]:
    """Number of parts in force and the last batch they hold; (0, -1) before the first compaction."""
    found = [tuple(map(int, name.split("-"))) for name in _names(spark, f"{out}/compact/manifest")]
    return max(found, default=(0, -1))


def _batches(spark: SparkSession, out: str, table: str) -> list[int]:
    names = _names(spark, f"{out}/{table}")
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def batch_rows(spark: SparkSession, out: str, table: str, after: int, through: int | None = None) -> DataFrame:
    """Rows of the batches after one, up to another: of ``run``, ``run_story`` or ``error``."""
    if table == "run_story":
        rows = read_blocks(spark, f"{out}/blocks", "batch")
    else:
        with_batch = StructType([*_TABLES[table].fields]).add("batch", LongType())
        rows = spark.read.schema(with_batch).parquet(f"{out}/{table}")
    rows = rows.filter(F.col("batch") > after)
    if through is not None:
        rows = rows.filter(F.col("batch") <= through)
    return block_records(rows) if table == "run_story" else rows.select(*_TABLES[table].names)


def stream_table(spark: SparkSession, out: str, table: str, before_batch: int | None = None) -> DataFrame:
    """A whole table of the stream: the parts in force and the batches after them."""
    parts, last = manifest(spark, out)
    through = None if before_batch is None else before_batch - 1
    rows = batch_rows(spark, out, table, last, through)
    for part in range(1, parts + 1):
        whole = read_table(spark, f"{out}/compact/part={part}/{table}", _TABLES[table])
        rows = rows.unionByName(whole.drop(DAY_COLUMN))
    return rows


def compact(spark: SparkSession, out: str) -> int:
    """Compact the batches finished since the last time; returns the last batch that parts now hold.

    The newest batch is left alone: a restart may write it once more.
    """
    parts, last = manifest(spark, out)
    through = max(_batches(spark, out, "progress"), default=0) - 1
    if through <= last:
        return last
    part = parts + 1
    for table in _TABLES:
        rows = batch_rows(spark, out, table, last, through)
        write_table(rows, f"{out}/compact/part={part}/{table}", mode="overwrite")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/compact/manifest/{part}-{through}")
    files = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.createNewFile(marker):
        raise RuntimeError("another compaction has finished meanwhile")
    for table in _BATCHED:  # those of the part before
        gone = [b for b in _batches(spark, out, table) if b <= last]
        remove(spark, *[f"{out}/{table}/batch={b}" for b in gone])
    return through
