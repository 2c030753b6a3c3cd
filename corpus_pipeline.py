"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm import bestfit, minhash, mixing, quality, runindex
from ranktrail.llm.common import documents, stored, whole_rows

PASSAGE_BYTES = 250  # what counts as a repeated passage: 50 words of this corpus are longer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject; no column of the others changes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality.text_verdicts(docs, labels).filter("kept").select("th")
    rows = docs.select(whole_rows(docs), F.xxhash64("text").alias("h_"))
    # the verdicts grow with the documents, so no small input is joined in another way
    return rows.join(kept.hint("merge"), F.col("h_") == F.col("th"), "semi").select("row_.*")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return minhash.distinct_documents(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that repeat anywhere out of the texts."""
    return runindex.without_repeats(docs, PASSAGE_BYTES)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources meet their target weights."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the pieces of all documents into sequences; one row per piece."""
    return bestfit.pack_best_fit(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("best-fit packing", best_fit_packing),
]
# Near duplicates, byte matches and token ids have no SQL form; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
