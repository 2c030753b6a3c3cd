"""Ranks: from ordered lists to one row per (run, story) and back."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import id_list
from ..schema import RANKINGS
from ..sources.tables import at, run_time

RANK_COLUMNS = [f"{name}_rank" for name in RANKINGS]


def stories_ranks(run: DataFrame, runs: Iterable | DataFrame | None = None) -> DataFrame:
    """Rank of every story in each list, one row per (run, story).

    ``runs`` restricts to some runs: timestamps, a DataFrame with a ``ts_run``
    column, or None for all. One scan serves the three lists, and since a run's
    lists sit in one row, its stories are combined before the shuffle. A story
    twice in one list keeps its better position.
    """
    if isinstance(runs, DataFrame):
        run = run.join(runs.select("ts_run").distinct(), "ts_run", "left_semi")
    elif runs is not None:
        run = run.filter(F.col("ts_run").isin([run_time(run, r) for r in runs]))
    return _best_positions(run, ["ts_run", "story_id"])


def _best_positions(run: DataFrame, keys: list[str]) -> DataFrame:
    lists = ", ".join(f"{i}, {name}" for i, name in enumerate(RANKINGS))
    rows = run.select(
        "ts_run", F.expr(f"stack({len(RANKINGS)}, {lists}) AS (ranking, ids)")
    ).select("ts_run", "ranking", F.posexplode("ids").alias("position", "story_id"))
    best = [
        F.min(F.when(F.col("ranking") == i, F.col("position") + 1)).alias(column)
        for i, column in enumerate(RANK_COLUMNS)
    ]
    return rows.filter(F.col("story_id").isNotNull()).groupBy(*keys).agg(*best)


def landed_ranks(rankings: DataFrame) -> DataFrame:
    """:func:`stories_ranks` straight from parsed lists (one row per run and list), none assembled."""
    rows = rankings.select("ts_run", "id", F.posexplode("payload").alias("position", "story_id"))
    best = [
        F.min(F.when(F.col("id") == name, F.col("position") + 1)).alias(column)
        for name, column in zip(RANKINGS, RANK_COLUMNS)
    ]
    return rows.filter(F.col("story_id").isNotNull()).groupBy("ts_run", "story_id").agg(*best)


def rebuild_run_arrays(ranks: DataFrame) -> DataFrame:
    """Inverse of :func:`stories_ranks`: the ordered lists of each run.

    The lists are rows of the ``run`` table, so each is as long as what one run
    stored; nothing wider than one such row is gathered.
    """

    def ordered(rank: str) -> Column:
        entries = F.collect_list(F.when(F.col(rank).isNotNull(), F.struct(rank, "story_id")))
        ids = F.transform(F.array_sort(entries), lambda e: e["story_id"])
        return F.when(F.size(ids) > 0, ids)

    return ranks.groupBy("ts_run").agg(
        *[ordered(f"{name}_rank").alias(name) for name in RANKINGS]
    )


def with_ranks(rows: DataFrame, run: DataFrame) -> DataFrame:
    """Add the three ranks a story had in the run of each (ts_run, story_id) row.

    Rows whose run is not in ``run`` are dropped. Ranks are looked up by joining on
    (ts_run, story_id) instead of scanning the run's lists once per row: the key is
    unique, so no run and no story can make it skewed, and long lists do not matter.
    """
    return in_known_runs(rows, run).join(stories_ranks(run), ["ts_run", "story_id"], "left")


def with_few_ranks(rows: DataFrame, run: DataFrame) -> DataFrame:
    """The same for rows that are few per run, such as one per story over its lifetime.

    Taking apart every list would cost more than searching the lists of the runs that
    occur: measured, the break-even is at several hundred rows per run. A run that many
    rows share is split by adaptive execution.
    """
    lists = run.select("ts_run", *RANKINGS)
    ranks = {f"{n}_rank": position(n, F.col("story_id")) for n in RANKINGS}
    return rows.join(lists, "ts_run").withColumns(ranks).drop(*RANKINGS)


def in_known_runs(rows: DataFrame, run: DataFrame) -> DataFrame:
    """Rows whose run is recorded.

    Only the timestamp column of ``run`` takes part. It is broadcast when the planner
    measures it below its threshold; otherwise both sides are shuffled and an
    overfull run is split by adaptive execution.
    """
    return rows.join(run.select("ts_run"), "ts_run", "left_semi")


def story_timeline(run: DataFrame, run_story: DataFrame, story_id: int | None = None) -> DataFrame:
    """History of one story, or of all: time, ranks, status, score, comments."""
    if story_id is None:
        rows = with_ranks(run_story, run)
        ranks = [F.col(c) for c in RANK_COLUMNS]
    else:
        # one story has one row per run: reading positions off the arrays is cheapest
        rows = run_story.filter(F.col("story_id") == story_id).join(
            run.select("ts_run", *RANKINGS), "ts_run"
        )
        ranks = [position(n, F.lit(story_id)).alias(f"{n}_rank") for n in RANKINGS]
    return rows.select(
        F.date_format("ts_run", "yyyy-MM-dd HH:mm:ss").alias("ts_run"),
        "story_id",
        *ranks,
        "status",
        "score",
        "descendants",
    )


def position(ids: str, story_id: Column) -> Column:
    """1-based position in an array column; NULL when absent."""
    return F.nullif(F.array_position(F.col(ids), story_id), F.lit(0)).cast("int")


def data_cube(run: DataFrame, run_story: DataFrame) -> DataFrame:
    """Every rank and every record, on (run, story)."""
    ranks = stories_ranks(run).withColumn("ranks_ts_run", F.col("ts_run"))
    records = run_story.select(
        "ts_run", "story_id", "status", "score", "descendants", "ts_payload"
    )
    return ranks.join(records, ["ts_run", "story_id"], "full_outer").select(
        "ts_run",
        "story_id",
        *RANK_COLUMNS,
        "ranks_ts_run",
        "status",
        "score",
        "descendants",
        "ts_payload",
    )


def top_n_from_json(responses: DataFrame, below: int = 10) -> DataFrame:
    """Ranked rows of JSON lists, ranks below ``below``."""
    first = F.slice(id_list(F.col("payload")), 1, max(0, below - 1))
    return (
        responses.select("ts_run", "id", F.posexplode(first))
        .filter(F.col("col").isNotNull())
        .select("ts_run", "id", (F.col("pos") + 1).alias("rank"), F.col("col").alias("story_id"))
    )


def max_item_id(run: DataFrame, run_story: DataFrame) -> DataFrame:
    """Highest ID seen in any list or record."""
    in_lists = run.select(F.greatest(*[F.array_max(n) for n in RANKINGS]).alias("id"))
    return in_lists.unionAll(run_story.select("story_id")).agg(F.max("id").alias("max_id"))


def ranks_at(run: DataFrame, ts_run) -> DataFrame:
    """Ranks of one run, keyed by story_id alone: later joins on it need no new shuffle."""
    return _best_positions(at(run, ts_run), ["story_id"])
