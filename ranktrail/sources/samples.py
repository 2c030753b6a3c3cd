"""Sample collections derived from an ``events`` table.

One run is one hour, one story is one user. Every 37th hour has no run; its events belong to the
next hour's. The base, a row per (run, story), is aggregated from all events once and written to
the shared folder; ``run_story``, ``error`` and the story responses are projections of it.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import RANK_COLUMNS, stories_ranks
from ..ruleset import rules_table
from ..schema import STATUSES
from ..session import shared_dir
from .tables import read_table, write_table

#: Which stories of a run its sample lists hold, and in which order.
LISTED = {
    "topstories": ("clicks > 0", ["n DESC", "story_id"]),
    "beststories": ("purchases > 0", ["cents DESC", "story_id"]),
    "newstories": ("signups > 0", ["last_ev DESC"]),
}

#: A story answers requests for this many hours after activity.
ECHO_HOURS = 8

#: Small lists need small thresholds.
BENCH_RULES = """{"new_repeat": 2, "hot_repeat": 3, "hot_rank": 2, "tepid_rank": 5,
"tepid_age": "19 minute", "cooling_repeat": 4, "cooling_age": "59 minute",
"cold_repeat": 4, "cold_age": "6 hour", "failed_repeat": 4, "frozen_age": "7 day",
"frozen_window": 0}"""

#: Variant that reaches the frozen arm: due after 6 hours, within half a day.
WINDOW_RULES = BENCH_RULES.replace('"7 day"', '"6 hour"').replace(
    '"frozen_window": 0', '"frozen_window": 43200'
)


def sample_rules(spark: SparkSession) -> DataFrame:
    return rules_table(spark, {"bench": BENCH_RULES, "bench_window": WINDOW_RULES})


def _ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def activity(events: DataFrame) -> DataFrame:
    """Events per (run, user). Combined before its shuffle."""
    hour = _ntz(F.date_trunc("hour", "ts"))
    without_run = (F.dayofmonth("ts") * 24 + F.hour("ts")) % 37 == 0
    run = F.when(without_run, hour + F.expr("INTERVAL 1 HOUR")).otherwise(hour)
    return (
        events.withColumn("ts_run", run)
        .groupBy("ts_run", F.col("user_id").alias("story_id"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
            F.max("event_id").alias("last_ev"),
            F.max(F.greatest(_ntz(F.col("ts")), F.col("ts_run"))).alias("ts_payload"),
            *[
                F.count_if(F.col("event_type") == kind).alias(name)
                for kind, name in (
                    ("click", "clicks"),
                    ("error", "errs"),
                    ("purchase", "purchases"),
                    ("signup", "signups"),
                )
            ],
        )
    )


def runs(base: DataFrame) -> DataFrame:
    """Run rows: three orders of each run's stories, each over all stories that qualify.

    A list is one value of a run's row, so it is gathered whole; it is as long as the run is busy.
    """

    def ids(name: str) -> Column:
        member, order = LISTED[name]
        key = [F.expr(o.removesuffix(" DESC")) * (-1 if "DESC" in o else 1) for o in order]
        fields = [k.alias(f"k{i}") for i, k in enumerate(key)]
        listed = F.when(F.expr(member), F.struct(*fields, F.col("story_id").alias("id")))
        found = F.transform(F.array_sort(F.collect_list(listed)), lambda e: e["id"])
        return F.when(F.size(found) > 0, found).alias(name)

    return (
        base.groupBy("ts_run")
        .agg(*[ids(name) for name in LISTED])
        .withColumn("ts_end", F.col("ts_run") + F.expr("INTERVAL 3 SECOND"))
        .withColumn("extversion", F.lit("sample"))
        .withColumn("ruleset_id", F.lit("bench"))
    )


class Samples:
    """The sample tables of one directory of parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, name)
        write_table(df, path)
        return read_table(self.spark, path)

    @cached_property
    def base(self) -> DataFrame:
        events = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        return self._stored(activity(events), "activity")

    @cached_property
    def run(self) -> DataFrame:
        return self._stored(runs(self.base), "run")

    @property
    def run_story(self) -> DataFrame:
        code = (F.col("story_id") * 7 + F.hour("ts_run") * 3 + F.col("n")) % len(STATUSES)
        names = F.array(*[F.lit(s) for s in STATUSES])
        return self.base.select(
            "ts_run",
            "story_id",
            F.element_at(names, (code + 1).cast("int")).alias("status"),
            F.expr("cents DIV 100").cast("int").alias("score"),
            F.col("clicks").alias("descendants"),
            "ts_payload",
            "run_date",
        )

    @property
    def error(self) -> DataFrame:
        of_story = self.base.filter("errs > 0").select(
            "ts_run",
            F.lit("run_story").alias("error_source"),
            F.col("story_id").cast("string").alias("source_id"),
            F.concat(
                F.lit('{"url":"item/'),
                F.col("story_id").cast("string"),
                F.lit('","retries":'),
                (F.col("errs") - 1).cast("string"),
                F.lit(',"duration":'),
                F.col("cents").cast("string"),
                F.lit(',"ts_end":"'),
                F.date_format("ts_payload", "yyyy-MM-dd HH:mm:ss"),
                F.lit('","batch_failrate":0.25,"payload":{"score":'),
                F.col("n").cast("string"),
                F.lit("}}"),
            ).alias("report"),
            "run_date",
        )
        of_run = self.run.filter(F.hour("ts_run") == 5).select(
            "ts_run",
            F.lit("run").alias("error_source"),
            F.lit("topstories").alias("source_id"),
            F.lit('{"url":"top","retries":1,"duration":5}').alias("report"),
            "run_date",
        )
        return of_story.unionByName(of_run)

    @property
    def rankings_raw(self) -> DataFrame:
        """Responses for the lists; at some hours one is missing, failed, empty or retried."""
        hour = F.hour("ts_run")
        lists = ", ".join(f"'{n}', {n}" for n in LISTED)
        rows = self.run.select(
            "ts_run", "run_date", F.expr(f"stack(3, {lists}) AS (id, ids)")
        ).filter(
            F.col("ids").isNotNull()
            & ~((hour == 11) & (F.col("id") == "newstories"))
            & (hour != 3)  # no response at all
        )
        text = F.concat(F.lit("["), F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("]"))
        failed = (hour == 5) & (F.col("id") == "topstories")
        # the first ID of some lists landed as text
        quoted = F.regexp_replace(text, r"^\[(\d+)", '["$1"')
        text = F.when((hour == 13) & (F.col("id") == "topstories"), quoted).otherwise(text)
        empty = (hour == 7) & (F.col("id") == "newstories")
        retried = (hour == 9) & (F.col("id") == "beststories")
        return rows.select(
            "ts_run",
            "id",
            F.concat(F.col("id"), F.lit(".json")).alias("url"),
            F.when(failed, F.lit(None)).when(empty, F.lit("[]")).otherwise(text).alias("payload"),
            (F.col("ts_run") + F.expr("make_dt_interval(0, 0, 0, length(id))")).alias("ts_end"),
            (F.length("id") / 8).alias("duration"),
            F.lit(1).cast("bigint").alias("batch"),
            F.when(~failed, F.when(retried, 1).otherwise(0)).alias("retries"),
            F.lit(0.0).alias("batch_failrate"),
            "run_date",
        )

    @cached_property
    def items_raw(self) -> DataFrame:
        """Responses for stories, from their activity in this and the preceding hours."""
        hours = F.sequence(F.lit(0), F.lit(ECHO_HOURS - 1))
        echoes = self.base.select(
            "ts_run", "story_id", "n", "cents", "clicks", F.explode(hours).alias("k")
        ).withColumn("ts_run", F.col("ts_run") + F.expr("make_dt_interval(0, k)"))
        rows = echoes.groupBy("ts_run", "story_id").agg(
            F.min("k").alias("k"),
            *[F.min_by(c, "k").alias(c) for c in ("n", "cents", "clicks")],
        )
        case = (F.col("story_id") * 5 + F.hour("ts_run") + F.col("n")) % 97
        id_text = F.col("story_id").cast("string")
        full = F.concat(
            F.lit('{"id":'), id_text,
            F.lit(',"type":"story","by":"u'), id_text,
            F.lit('","title":"story '), id_text,
            F.lit('","time":'), F.hour("ts_run").cast("string"),
            F.lit(',"kids":['), F.col("n").cast("string"), F.lit(","), id_text,
            F.lit('],"score":'), (F.expr("cents DIV 100") + F.col("k")).cast("string"),
            F.lit(',"descendants":'), F.col("clicks").cast("string"), F.lit("}"),
        )
        payload = (
            F.when(case % 31 == 3, F.lit("null"))
            .when(case % 31 == 5, F.lit(None))
            .when(case == 41, F.concat(F.lit('{"id":'), id_text, F.lit(',"deleted":true}')))
            .otherwise(full)
        )
        items = rows.select(
            "ts_run",
            F.col("story_id").alias("id"),
            F.concat(F.lit("item/"), id_text, F.lit(".json")).alias("url"),
            payload.alias("payload"),
            (F.col("ts_run") + F.expr("make_dt_interval(0, 0, 1, k)")).alias("ts_end"),
            ((F.col("cents") % 4096 + 1024) / 1024).alias("duration"),
            (F.col("story_id") % 3).alias("batch"),
            F.when(case % 31 != 5, F.when(case % 13 == 0, 2).otherwise(0)).alias("retries"),
            F.lit(0.25).alias("batch_failrate"),
        )
        return self._stored(items, "items_raw")

    @property
    def run_numbered(self) -> DataFrame:
        """Runs of the first layout: numbered by hour, so missing hours leave holes."""
        number = F.unix_micros(F.col("ts_run").cast("timestamp")) / 3_600_000_000
        return self.run.withColumn("id", number.cast("bigint") - 473_352)

    @property
    def run_story_numbered(self) -> DataFrame:
        """Records of the first layout, with stored ranks and a success flag."""
        number = F.unix_micros(F.col("ts_run").cast("timestamp")) / 3_600_000_000
        status = F.when(
            F.col("status").isin("new", "hot", "tepid", "cooling", "cold", "frozen", "missing"),
            F.col("status"),
        ).otherwise("cold")
        return (
            self.run_story.withColumn("success", F.col("descendants") != 1)
            .join(stories_ranks(self.run), ["ts_run", "story_id"], "left")
            .select(
                (number.cast("bigint") - 473_352).alias("run_id"),
                "story_id",
                *RANK_COLUMNS,
                status.alias("status"),
                F.when(F.col("success") | (F.col("score") % 2 == 0), F.col("score")).alias("score"),
                "descendants",
                "ts_payload",
                "success",
            )
        )


_known: dict[tuple[str, str], Samples] = {}


def samples(spark: SparkSession, sf_dir: str) -> Samples:
    """The samples of a directory, derived once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Samples(spark, sf_dir)
    return _known[key]
