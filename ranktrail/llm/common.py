"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.session import shared_dir

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed
# and carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
MOST_BLOCKS = 1 << 14  # broadcast blocks of 32,768 doc_ids, 4 kB each; with more, ids are joined by a shuffle


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def words(text: Column) -> Column:
    """All words of a text in order; an empty array where there are none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def whole_rows(df: DataFrame) -> Column:
    """All columns as one struct, so that no name among them meets one of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row_")


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col("row_").getField(c).alias(c) for c in columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_listed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """With ``t_``: whether the row's doc_id is one of the distinct longs ``t_`` of ``ids``; false for a null.

    The ids are sent as bitmaps over blocks of neighbouring ids, 2 MB for 16 million documents. Ids so far
    apart that their blocks are too many are met by a join instead, which shuffles the rows.
    """
    block, place = F.bitmap_bucket_number("t_"), F.bitmap_bit_position("t_")
    blocks = ids.groupBy(block.alias("block_")).agg(F.bitmap_construct_agg(place).alias("bits_"))
    blocks = stored(blocks, "id-blocks")
    id_ = F.col("doc_id").cast("long")
    if blocks.count() > MOST_BLOCKS:
        joined = docs.join(ids.hint("merge"), id_ == F.col("t_"), "left")
        return joined.select(*docs.columns, F.col("t_").isNotNull().alias("t_"))
    joined = docs.join(F.broadcast(blocks), F.bitmap_bucket_number(id_) == F.col("block_"), "left")
    place = F.bitmap_bit_position(id_)
    byte = F.hex(F.substring("bits_", F.floor(place / 8).cast("int") + 1, F.lit(1)))
    bit = F.getbit(F.conv(byte, 16, 10).cast("int"), (place % 8).cast("int"))
    return joined.select(*docs.columns, F.coalesce(bit == 1, F.lit(False)).alias("t_"))
