"""Mixing of sources to target weights by Pareto order sampling.

Each document of a source is expected a number of times that grows with its length class. The
whole part of that number is taken for certain; the rest is its inclusion probability in one
Pareto sample per source. The sample takes documents in order as long as the source's target has
room for them; one more document then fills the gap that is left as closely as any can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktrail.llm.common import documents, stored, unpacked, whole_rows, word_count

MOST_COPIES = 3
CELLS = 4096  # slices of the sampling order in which words are first summed


def targets(sized: DataFrame, weights: tuple[int, ...], most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target): weights by code point order, excess shared again.

    A source stops at ``most`` times its size. Ordered by size over weight, the sources that stop
    come first, and one stops if its share of what the earlier ones leave reaches its limit; so
    one ordered pass replaces repeated sharing. The windows run over one row per source.
    """
    named = [F.col("source").isNull(), F.col("source")]
    number = F.row_number().over(Window.orderBy(*named))
    each = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(number - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    size = F.col("source_size").cast("double")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), *named)
    everything = Window.partitionBy()
    stopped = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(everything) - most * F.coalesce(stopped, F.lit(0))
    shared = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", each)
        .withColumns(
            {
                "place": F.row_number().over(order),
                "left": left.cast("double"),
                "others": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
            }
        )
        .withColumn("stops", F.col("left") * F.col("weight") >= most * size * F.col("others"))
    )
    free = F.min(F.when(~F.col("stops"), F.struct("place", F.col("left") / F.col("others"))))
    share = free.over(everything)["col2"]
    target = F.when(F.col("stops"), most * size).otherwise(share * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def measured(docs: DataFrame) -> DataFrame:
    """Whole rows with what their draw depends on: size, length class and a uniform number."""
    sized = docs.select(
        whole_rows(docs),
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
    )
    key = F.concat_ws("\x1f", F.col("doc_id"), F.col("source"), F.col("size"))
    digest = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double")
    return sized.withColumns(
        {
            "class": F.length(F.bin(F.col("size") + 1)),
            # from the row's own content, so that reruns agree
            "u": (digest + 0.5) / float(1 << 48),
        }
    )


def draw_plan(sized: DataFrame, weights: tuple[int, ...], most: int = MOST_COPIES) -> DataFrame:
    """What decides every row's copies, by (source, class): at most a row per binary digit.

    ``end`` and ``cut`` tell where a source's Pareto sample ends: rows of earlier cells are
    drawn, and those of that cell up to the cut; ``fill`` names one row more. A null end draws all.
    """
    aims = targets(sized, weights, most)
    cells = sized.groupBy("source", "class").agg(F.sum("size").alias("words"))
    cells = cells.join(aims, cells["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    larger = Window.partitionBy("source").orderBy(F.desc("class"))
    above = F.sum("words").over(larger.rowsBetween(Window.unboundedPreceding, -1))
    tried = cells.withColumns(
        {
            "left": F.col("target") - most * F.coalesce(above, F.lit(0)),
            "rest": F.sum(F.col("words") * F.col("class")).over(
                larger.rowsBetween(0, Window.unboundedFollowing)
            ),
        }
    ).withColumn(
        "full", (F.col("rest") > 0) & (F.col("left") * F.col("class") >= most * F.col("rest"))
    )
    open_ = (F.col("rest") > 0) & ~F.col("full")
    free = F.max(F.when(open_, F.struct("class", F.col("left") / F.col("rest")))).over(
        Window.partitionBy("source")
    )
    copies = F.when(F.col("full"), float(most)).otherwise(
        F.coalesce(free["col2"] * F.col("class"), F.lit(1.0))  # only texts without words: as is
    )
    expected = stored(
        tried.select("source", "class", "source_size", "target", copies.alias("expected")),
        "mix-expected",
    )
    ranked = _ranked(sized.select("doc_id", "source", "size", "class", "u"), expected)
    slices = ranked.groupBy("source", "cell").agg(
        F.first("target").alias("target"),
        F.sum(F.col("size") * F.floor("expected")).alias("sure"),
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0)).alias("words"),
    )
    whole = Window.partitionBy("source")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        F.col("source").alias("s"),
        "cell",
        "words",
        (F.col("target") - F.sum("sure").over(whole)).alias("room"),
        F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("earlier"),
    )
    ends = slices.filter(
        (F.col("earlier") <= F.col("room")) & (F.col("earlier") + F.col("words") > F.col("room"))
    )
    ends = stored(ends, "mix-ends")
    # only the slice in which a source's sample ends is put in order
    edge = ranked.filter(F.col("rank").isNotNull()).join(
        ends.withColumnRenamed("cell", "end"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("end")),
    )
    before = F.sum("size").over(
        Window.partitionBy("source")
        .orderBy("rank", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    size, room = F.col("size"), F.col("room")
    fits = F.col("earlier") + F.coalesce(before, F.lit(0)) + size <= room
    key = F.struct("rank", "doc_id", "size")
    cuts = (
        edge.withColumns({"fits": fits, "key": key})
        .groupBy(F.col("source").alias("s"), "end")
        .agg(
            F.max(F.when(F.col("fits"), F.col("key"))).alias("cut"),
            (
                F.first("room")
                - (F.first("earlier") + F.coalesce(F.sum(F.when(F.col("fits"), size)), F.lit(0)))
            ).alias("gap"),
        )
    )
    cuts = stored(cuts, "mix-cuts")
    left = ranked.filter(F.col("rank").isNotNull()).join(cuts, F.col("source").eqNullSafe(F.col("s")))
    left = left.filter(
        (F.col("cell") > F.col("end"))
        | ((F.col("cell") == F.col("end")) & (F.col("cut").isNull() | (key > F.col("cut"))))
    )
    miss = F.abs(F.col("gap") - size).alias("miss")
    fills = (
        left.filter(miss < F.col("gap"))
        .groupBy(F.col("s").alias("f"))
        .agg(F.min(F.struct(miss, "rank", "doc_id", "size")).alias("best"))
        .select("f", F.struct(*[F.col("best")[c].alias(c) for c in ("rank", "doc_id", "size")]).alias("fill"))
    )
    ends = expected.join(cuts, expected["source"].eqNullSafe(cuts["s"]), "left")
    ends = ends.join(fills, F.col("source").eqNullSafe(F.col("f")), "left")
    return stored(ends.drop("s", "f", "gap"), "mix-plan")


def _ranked(sized: DataFrame, per_class: DataFrame) -> DataFrame:
    """Each row's expected copies and its place in its source's sampling order."""
    per = per_class.withColumnsRenamed({"source": "s_", "class": "c_"})
    part = F.col("expected") - F.floor("expected")
    odds = F.col("u") / (1 - F.col("u"))
    return (
        sized.join(per, F.col("source").eqNullSafe(F.col("s_")) & (F.col("class") == F.col("c_")))
        .drop("s_", "c_")
        .withColumn("rank", F.when(part > 0, odds / (part / (1 - part))))
        .withColumn(
            "cell",
            F.floor(F.coalesce(F.col("rank") / (1 + F.col("rank")), F.lit(0.0)) * CELLS),
        )
    )


def copies_of(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size``, ``target``, ``expected`` and ``copies`` to measured rows."""
    key = F.struct("rank", "doc_id", "size")
    drawn = F.col("rank").isNotNull() & (
        F.col("end").isNull()
        | (F.col("cell") < F.col("end"))
        | ((F.col("cell") == F.col("end")) & F.col("cut").isNotNull() & (key <= F.col("cut")))
        | key.eqNullSafe(F.col("fill"))
    )
    copies = F.floor("expected") + F.when(drawn, 1).otherwise(0)
    return _ranked(sized, plan).withColumn("copies", copies.cast("long")).drop("cell", "end", "cut", "fill")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES):
    """The mixed corpus: every document as many times as it is taken, columns as they were.

    Sources weigh ``weights`` repeating, in code point order with null last, and share the words
    of all documents; none goes above ``most`` times its own words. The copies expected of a
    document grow with its length class (binary digits of its size plus one) and make up the
    source's target. Null text has no words; a null source is a source of its own; rows with
    equal doc_id, source and size fare alike at a cut. An empty table gives no rows.
    """
    sized = measured(docs)
    plan = draw_plan(stored(_light(sized), "mix-sizes"), weights, most)
    mixed = copies_of(sized, plan).filter(F.col("copies") > 0)
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select("row_", times.alias("time")).select(unpacked(docs.columns))


def _light(sized: DataFrame) -> DataFrame:
    return sized.select("doc_id", "source", "size", "class", "u")


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stored(_light(measured(documents(spark, sf_dir))), "mix-sizes")
    mixed = copies_of(sized, draw_plan(sized, (1, 2, 3)))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
        "expected",
    )


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), m AS (
  SELECT *, length(bin(size + 1)) AS class,
    (CAST('0x' || substr(md5(concat_ws(chr(31), doc_id, source, size)), 1, 12) AS BIGINT) + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM sized
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM m GROUP BY source
), o AS (
  SELECT *, row_number() OVER w AS place,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (w ROWS BETWEEN
      UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS remain,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
  FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size,
    CASE WHEN remain * weight >= 3 * source_size::DOUBLE * others THEN 3 * source_size::DOUBLE
    ELSE (SELECT arg_min(remain / others, place) FROM o
          WHERE remain * weight < 3 * source_size::DOUBLE * others) * weight END AS target
  FROM o
), c AS (
  SELECT source, class, sum(size)::BIGINT AS words FROM m GROUP BY ALL
), d AS (
  SELECT c.source, class, source_size, target,
    target - 3 * coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS remain,
    (sum(words * class) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rest
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW w AS (PARTITION BY c.source ORDER BY class DESC)
), e AS (
  SELECT source, class, source_size, target,
    CASE WHEN rest > 0 AND remain * class >= 3 * rest THEN 3.0::DOUBLE
    ELSE coalesce((arg_max(remain / rest, class) FILTER (WHERE rest > 0 AND remain * class < 3 * rest)
          OVER (PARTITION BY source)) * class, 1.0::DOUBLE) END AS expected
  FROM d
), r AS (
  SELECT m.*, e.source_size, e.target, e.expected, expected - floor(expected) AS part,
    CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS rank
  FROM m JOIN e ON m.source IS NOT DISTINCT FROM e.source AND m.class = e.class
), f AS (
  SELECT *, target - sum(size * floor(expected)) OVER (PARTITION BY source) AS room,
    coalesce(sum(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source
      ORDER BY rank NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
      AS reach
  FROM r
), p AS (
  SELECT *, rank IS NOT NULL AND reach <= room AS fits,
    room - coalesce(sum(size) FILTER (WHERE rank IS NOT NULL AND reach <= room)
      OVER (PARTITION BY source), 0) AS gap
  FROM f
), x AS (
  SELECT *, CAST(floor(expected) + CASE WHEN fits THEN 1 WHEN rank IS NOT NULL AND abs(gap - size) < gap
    AND row_number() OVER (PARTITION BY source, fits OR rank IS NULL
      ORDER BY abs(gap - size), rank, doc_id, size) = 1 THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM p
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  copies * size AS taken, source, copies, expected
FROM x
"""
