"""Quality rules: counts per document and a hashed n-gram log-likelihood ratio, all in SQL
functions.

One- and two-word grams are hashed into buckets and counted, over trusted documents and over the whole
corpus. A document's score is the mean log ratio of the two smoothed multinomials over its grams.
Every document labelled good is trusted, and every gram counts. Trusted documents are dealt to two folds
by hash of their text; a text is scored with the trusted counts of the other fold, so a trusted document
is judged like any other. The threshold is a low quantile, found exactly, of the scores that trusted
documents get this way. The number of buckets grows with the trusted grams, so that a bucket holds about
as many different ones in a large corpus as in a small one. Ratios are whole millionths, so a sum does
not depend on order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import SPACES, documents, stored, unpacked, whole_rows, with_listed, word_count, words

TRUSTED_ROWS = None  # trusted labels used: all
GRAMS_PER_BUCKET = 1024  # trusted grams for each bucket; the number is a power of two
LEAST_BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 24  # bounds the table of ratios that is broadcast: two ints a bucket
PACKED = 10  # binary digits of the number of buckets whose ratios make one row
SCALES = (1e2, 1e5, 1e8)  # ever finer bins of scores, between which a rank is sought
SMOOTHING = 1.0  # trusted grams by which a bucket's expected and seen numbers are both raised
QUANTILE = 0.01  # of the trusted documents' own scores: the threshold
LEAST_WORDS = 20
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def _slide(a: Column, by: int) -> Column:
    """Hashes of the pairs of a value and the one ``by`` places further on."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, by + 1, n), lambda x, y: F.xxhash64(x, y))


def _with_grams(docs: DataFrame) -> DataFrame:
    """With ``ones_`` and ``twos_``: hashes of the words, and of the pairs of neighbouring words."""
    hashed = docs.withColumn("ones_", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
    return hashed.withColumn("twos_", _slide(F.col("ones_"), 1))


def _bucket(gram: Column, buckets: int) -> Column:
    return gram.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(2))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur at least twice in the document."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(s: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            beside = [F.get(s, j - 1)["h"], F.get(s, j + 1)["h"]]
            return F.coalesce(x["h"] == beside[0], F.lit(False)) | F.coalesce(x["h"] == beside[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    starts = F.element_at(F.transform(F.array(placed), twins), 1)
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, i: F.struct(
            i.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total")
        ),
        lambda acc: acc["total"],
    )


def trusted_ids(labels: DataFrame, rows: int | None = TRUSTED_ROWS) -> DataFrame:
    """Distinct doc_ids labelled good; if a caller wants only ``rows`` of them, those of lowest hash."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    ids = good.select(F.col("doc_id").cast("long").alias("t_")).distinct()
    return ids if rows is None else ids.orderBy(F.xxhash64("t_"), "t_").limit(rows)


def bucket_count(docs: DataFrame, trusted: DataFrame) -> int:
    """Buckets for the grams of the trusted documents: a power of two within fixed bounds."""
    grams = F.greatest(2 * word_count(F.col("text")) - 1, F.lit(0))
    known = with_listed(docs.select("doc_id", "text"), trusted).filter("t_")
    total = known.agg(F.sum(grams)).first()[0] or 0
    wanted = 1 << max(0, (total // GRAMS_PER_BUCKET - 1)).bit_length()
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, wanted))


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """(b, t0, t1, r): grams by bucket, trusted ones of either fold and those of all documents."""
    marked = with_listed(docs.select("doc_id", "text"), trusted)
    group = F.when(~F.col("t_"), -1).otherwise(_fold(F.col("text"))).alias("f")
    grams = _with_grams(marked.select("text", group)).select("f", F.concat("ones_", "twos_").alias("grams_"))
    grams = grams.select("f", F.explode_outer("grams_").alias("g")).filter(F.col("g").isNotNull())
    counts = grams.groupBy(_bucket(F.col("g"), buckets).alias("b")).agg(
        F.sum((F.col("f") == 0).cast("long")).alias("t0"),
        F.sum((F.col("f") == 1).cast("long")).alias("t1"),
        F.count("*").alias("r"),
    )
    return stored(counts, "gram-counts")


def gram_ratios(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """(row, ratios): millionths of the log ratio, for texts of either fold in turn, by bucket.

    A row holds 2 ** PACKED buckets that follow each other; those without grams are 0. Without
    trusted documents every ratio is 0.
    """
    counts = gram_counts(docs, trusted, buckets)
    t0, t1, r = (n or 0 for n in counts.agg(F.sum("t0"), F.sum("t1"), F.sum("r")).first())

    def ratio(t: str, total: int) -> Column:
        expected = F.col("r") * F.lit(total / max(1, r))
        return F.rint(1e6 * F.log((F.col(t) + SMOOTHING) / (expected + SMOOTHING))).cast("int")

    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    pair = F.array(ratio("t1", t1), ratio("t0", t0))
    pairs = every.join(counts, "b", "left").select(
        "b", F.when(F.col("r").isNull(), F.array(F.lit(0), F.lit(0))).otherwise(pair).alias("pair")
    )
    rows = pairs.groupBy(F.shiftright("b", PACKED).alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("b", "pair"))).alias("pairs")
    )
    return stored(rows.select("row", F.flatten("pairs.pair").alias("ratios")), "gram-ratios")


def text_scores(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """(th, score, n, t): mean ratio of the grams of every text by its hash, words and trust.

    Sums count every copy of a text, so their quotient is that of one copy. Texts without words are left
    out. The ratios, two ints for each of MOST_BUCKETS at most, are broadcast; the sums of a text are
    made in the task that reads it, and no gram is shuffled.
    """
    ratios = gram_ratios(docs, trusted, buckets)
    text = F.col("text")
    # what the text itself gives comes before the explosion: behind it, it would be made per gram
    grams = _with_grams(docs.select("text")).select(
        F.xxhash64(text).alias("th"),
        _fold(text).cast("int").alias("f"),
        F.size("ones_").alias("n"),
        F.concat("ones_", "twos_").alias("grams_"),
    )
    # outer: else the planner tests the array's size first, and makes all hashes a second time for it
    rows = grams.select("th", "f", "n", F.explode_outer("grams_").alias("g"))
    rows = rows.withColumn("b", _bucket(F.col("g"), buckets)).withColumn("row", F.shiftright("b", PACKED))
    rows = rows.join(F.broadcast(ratios), "row")
    place = 2 * F.col("b").bitwiseAND(F.lit((1 << PACKED) - 1)) + F.col("f")
    sums = rows.groupBy("th").agg(
        F.sum(F.get("ratios", place).cast("long")).alias("total"),
        F.count("*").alias("grams"),
        F.max("n").alias("n"),
    )
    known = with_listed(docs.select("doc_id", F.xxhash64(text).alias("k_")), trusted)
    known = known.filter("t_").select("k_").distinct()
    score = F.col("total") / F.col("grams") / 1e6
    marked = sums.join(known, F.col("th") == F.col("k_"), "left")
    marked = marked.select("th", score.alias("score"), "n", F.col("k_").isNotNull().alias("t"))
    return stored(marked, "text-scores")


def quality_threshold(scores: DataFrame, quantile: float = QUANTILE) -> float:
    """The quantile of the scores of trusted texts long enough for the base rules; 0 without any.

    Exact, between neighbours by proportion. The scores are counted by bins, then those of the bin
    sought by finer ones; bins are few, so only counts reach the driver.
    """
    known = scores.filter(F.col("t") & (F.col("n") >= LEAST_WORDS)).select("score")
    place = quantile * max(0, known.count() - 1)
    ranks, found = [math.floor(place), math.ceil(place)], []
    for scale in (*SCALES, None):
        key = F.col("score") if scale is None else F.floor(F.col("score") * scale)
        seen, start, found = 0, 0, []
        for bin_, n in sorted(map(tuple, known.groupBy(key.alias("bin")).count().collect())):
            here = [bin_ for rank in ranks if seen <= rank < seen + n]
            start = seen if here and not found else start
            found += here
            seen += n
        if not found:
            return 0.0
        known = known.filter(key.between(*found))
        ranks = [rank - start for rank in ranks]
    low, high = found
    return low + (high - low) * (place - math.floor(place))


RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept",
)


def text_verdicts(
    docs: DataFrame, labels: DataFrame, trusted_rows: int | None = TRUSTED_ROWS, quantile: float = QUANTILE
) -> DataFrame:
    """(th, and RESULTS): counts and verdict of every different text by its hash, as a written table.

    Written, since a filter on the verdict would else be pushed down to where the words are hashed, and
    repeat that for each of its parts.
    """
    trusted = stored(trusted_ids(labels, trusted_rows), "trusted")
    buckets = bucket_count(docs, trusted)
    scores = text_scores(docs, trusted, buckets)
    threshold = quality_threshold(scores, quantile)
    text = F.coalesce(F.col("text"), F.lit(""))
    grams = _with_grams(docs.select(F.xxhash64("text").alias("h_"), text.alias("text")))
    # windows are compared only where half of one occurs twice
    halves = grams.withColumn("fours_", _slide(F.col("twos_"), 2))
    twice = F.size(F.array_distinct("fours_")) < F.size("fours_")
    eights = F.when(twice, _slide(F.col("fours_"), 4)).otherwise(F.array().cast("array<bigint>"))
    counted = halves.withColumn("eights_", eights)
    twice = F.size(F.array_distinct("eights_")) < F.size("eights_")
    length = F.char_length("text")
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counted = counted.select(
        "h_",
        F.size("ones_").cast("long").alias("n_words"),
        F.char_length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (length - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines_"),  # two steps, so that lines are cut once; only their number is shuffled
        F.when(twice, _repeat_words(F.col("eights_"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    copies = (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    counted = counted.withColumn("n_dup_lines", copies).groupBy("h_").agg(*[F.max(c).alias(c) for c in counts])
    counted = stored(counted, "text-counts")
    judged = counted.join(scores.select("th", "score"), F.col("h_") == F.col("th"), "left")
    score = F.coalesce("score", F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~failed & (score >= F.lit(threshold))
    judged = judged.select(
        F.col("h_").alias("th"), *counts, score.alias("score"), failed.alias("base_failed"), kept.alias("kept")
    )
    return stored(judged, "text-verdicts")


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    trusted_rows: int | None = TRUSTED_ROWS,
    quantile: float = QUANTILE,
    columns: list[str] | None = None,
) -> DataFrame:
    """The documents' columns with counts, the score and the verdict ``kept``.

    ``columns``: those to return, if not all; the others, texts above all, are not shuffled then.
    Null text counts as empty: no words, which fails the base rules; its score is 0. Repeated
    rows are judged each; a null doc_id is never trusted; without trusted labels every score is
    0 and passes. Columns named like results are replaced. An empty table gives no rows.
    """
    verdicts = text_verdicts(docs, labels, trusted_rows, quantile)
    own = [c for c in columns or docs.columns if c not in RESULTS]
    given = docs.select(whole_rows(docs.select(*[F.col(f"`{c}`") for c in own])), F.xxhash64("text").alias("h_"))
    judged = given.join(verdicts, F.col("h_") == F.col("th"))
    return judged.select(*unpacked(own), *RESULTS)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(documents(spark, sf_dir), labels, columns=["doc_id"]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )
