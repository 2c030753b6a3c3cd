"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on spans of a bounded sample of
labelled documents. Each task then labels every byte of its texts and pools the probabilities of a
document; nothing is shuffled and no text leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktrail.llm import bytegru
from ranktrail.llm.common import documents, stored, unpacked, whole_rows
from ranktrail.llm.textbytes import byte_chunks

TRAIN_DOCS = 400  # labelled documents of each language that the network learns from
TRAIN_SPANS = 8  # spans of each of them, spread over its whole text
MOST_LANGS = 256  # languages learned, those with most documents first: outputs of the network
STEPS = 200
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; one without doc_id is among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _cut_spans(spans: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                data = text.as_py().encode()
                n = -(-len(data) // bytegru.SPAN)
                for k in sorted({i * n // spans for i in range(spans)}):
                    langs.append(lang)
                    parts.append(data[k * bytegru.SPAN : (k + 1) * bytegru.SPAN])
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(langs, pa.string()), "span": pa.array(parts, pa.binary())}
            )

    return cut


def training_spans(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(lang, span): spans of the labelled documents to learn from, at most ``train_docs`` a language.

    A language's documents are first thinned by hash to about twice that number, so that no
    window orders a large group.
    """
    known = docs.select("doc_id", "text", "lang")
    known = known.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & _lettered(F.col("text")))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGS).withColumnRenamed("lang", "l_")
    sizes = stored(sizes, "languages")  # a row for every output of the network
    chance = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_003)) / 1_000_003
    thinned = known.join(F.broadcast(sizes), F.col("lang") == F.col("l_"))
    thinned = thinned.filter(chance * F.col("n") < 2 * train_docs)
    thinned = stored(thinned.select("lang", "text", F.xxhash64("doc_id").alias("h")), "thinned")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = thinned.withColumn("r", rank).filter(F.col("r") <= train_docs).select("lang", "text")
    return chosen.mapInArrow(_cut_spans(TRAIN_SPANS), "lang string, span binary")


def trained(spans: pa.Table, steps: int = STEPS) -> tuple[list[str], bytegru.Weights | None]:
    """Languages in order and the network's weights; none without spans."""
    rows = sorted(zip(spans["lang"].to_pylist(), spans["span"].to_pylist(), strict=True))
    langs = sorted({lang for lang, _ in rows})
    if not rows:
        return [], None
    length = np.array([len(s) for _, s in rows])
    data = np.frombuffer(b"".join(s for _, s in rows), np.uint8)
    label = np.searchsorted(np.array(langs), np.array([lang for lang, _ in rows]))
    start = np.cumsum(length) - length
    return langs, bytegru.train(data, start, length, label, len(langs), steps=steps)


def _predict(langs: list[str], weights: bytegru.Weights | None):
    names = np.array([*langs, UNKNOWN], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(len(batch), len(langs))
            score = np.zeros(len(batch))
            if weights is not None:
                for low, high, data, offsets in byte_chunks(batch["text_"], 1_000_000):
                    found = bytegru.pooled(weights, data, offsets)
                    best[low:high], score[low:high] = found.argmax(1), found.max(1)
            lettered = batch["lettered_"].to_numpy(zero_copy_only=False).astype(bool)
            best[~lettered], score[~lettered] = len(langs), 0
            columns = {name: batch[name] for name in batch.schema.names if name not in ("text_", "lettered_")}
            columns["lang_pred"] = pa.array(names[best], pa.string())
            columns["score"] = pa.array(np.clip(np.round(score, 4), 0, 1), pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return predict


def identify_languages(docs: DataFrame, train_docs: int = TRAIN_DOCS, steps: int = STEPS) -> DataFrame:
    """All columns of the documents with held_out, lang_pred and score.

    Only text and lang of documents that are not held out, have a lang and a letter are learned from. A
    text without a letter, or null, is ``und`` with score 0, and so is every text where nothing could be
    learned. A document without doc_id counts as held out. Repeated rows are predicted each; equal
    probabilities go to the first language by name. Languages beyond MOST_LANGS are not learned. The whole
    text counts, however long. Columns named like results are replaced. An empty table gives no rows.
    """
    langs, weights = trained(training_spans(docs, train_docs).toArrow(), steps)
    results = ("held_out", "lang_pred", "score")
    own = [c for c in docs.columns if c not in results]
    text = F.col("text")
    rows = docs.select(
        whole_rows(docs.select(*[F.col(f"`{c}`") for c in own])),
        held_out(F.col("doc_id")).alias("held_out"),
        text.alias("text_"),
        _lettered(text).alias("lettered_"),
    )
    kind = rows.schema["row_"].dataType.simpleString()
    found = rows.mapInArrow(
        _predict(langs, weights), f"row_ {kind}, held_out boolean, lang_pred string, score double"
    )
    return found.select(*unpacked(own), *results)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the documents' texts are read once, as what the network sees
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")
