"""Many cycles at once, in parallel by story.

What happens to a story depends only on its own ranks, responses and past, so the cycles
of a block of runs need not be run one after the other: all rows of a story go to one
task in time order, and a small state function walks through them. Between two rows
nothing about the story changes except its age, so the next run in which it falls due is
looked up in the timeline instead of visiting every run.

A story has at most four rows per run (a place in each list and a response), and rows stream
through a task in Arrow batches: nothing is gathered per story.
Blocks bound the timeline each task holds, and the state between blocks is written to the
shared folder, which also cuts the lineage.
"""

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import ranktrail

from ..functions.payload import json_fields, marked_payload
from ..operators.collect import (
    RECORDED_FIELDS,
    assemble_run,
    fetch_outcomes,
    outcome_code,
    run_errors,
    run_story_errors,
)
from ..operators.ranks import RANK_COLUMNS
from ..ruleset import Ruleset
from ..schema import CODE, COUNT_COLUMNS, RANKINGS, RUN, STATUSES, status_name
from ..session import shared_dir
from ..sources.responses import parse_rankings
from ..sources.tables import between, read_table, run_time, write_table

#: Runs handled per block. A task holds their timestamps: 8 bytes each.
BLOCK_RUNS = 100_000

_NEW, _HOT, _TEPID, _COOLING, _COLD = range(5)
_FROZEN, _FAILED = CODE["frozen"], CODE["failed"]
_SECOND = 1_000_000
_HOUR = 3_600 * _SECOND
_DAY = 24 * _HOUR
_EPOCH = datetime(1970, 1, 1)
_NONE_COUNT = len(STATUSES)

_RECORD, _STATE = 0, 1

#: Stand-ins for NULL in the columns the walk reads as plain ints.
_UNRANKED, _STORED_STATE = 2**31 - 1, -1
#: Response that leaves the status as classified.
_AS_CLASSIFIED = -1

# the state function travels with the query: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(ranktrail)

_INPUT = ("at", *RANK_COLUMNS, "answer", "score", "descendants", "payload_ts", "counts", "code")

_OUT_DDL = (
    "kind int, story_id bigint, ts bigint, code int, score int, descendants bigint, "
    "payload_ts bigint, counts array<bigint>"
)
_OUT_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("story_id", pa.int64()),
        ("ts", pa.int64()),
        ("code", pa.int32()),
        ("score", pa.int32()),
        ("descendants", pa.int64()),
        ("payload_ts", pa.int64()),
        ("counts", pa.list_(pa.int64())),
    ]
)


def _calendar_age(new: int, old: int) -> int:
    """Calendar age in microseconds, as ``functions.times.calendar_age_micros``."""
    late, early = (_EPOCH + timedelta(microseconds=t) for t in (new, old))
    time = new % _DAY - old % _DAY
    days = late.day - early.day
    if time < 0:
        time, days = time + _DAY, days - 1
    months = (late.year - early.year) * 12 + late.month - early.month
    if days < 0:
        next_month = (early.replace(day=1) + timedelta(days=32)).replace(day=1)
        days += (next_month - timedelta(days=1)).day
        months -= 1
    return (months * 30 + days) * _DAY + time


class _Story:
    """State of the story whose rows are passing through."""

    __slots__ = ("id", "last_ts", "code", "score", "counts", "at", "idle")

    def __init__(self, story_id: int):
        self.id = story_id
        self.last_ts = None  # None: never recorded
        self.code = None
        self.score = None
        self.counts = [0] * (_NONE_COUNT + 1)
        self.at = 0  # index of the first run not yet handled
        self.idle = None  # (run index, status) of the next fetch if it stays unranked


class _Rules:
    """Classification of a single story; mirrors ``operators.classify`` row by row."""

    def __init__(self, rules: Ruleset, timeline: list[int]):
        self.rules = rules
        self.timeline = timeline
        self.ages = {
            _TEPID: rules.tepid_age,
            _COOLING: rules.cooling_age,
            _COLD: rules.cold_age,
            CODE["unknown"]: rules.frozen_age,
            _FROZEN: rules.frozen_age,
        }

    def next_code(self, story: _Story, top, best, new) -> int:
        r, last = self.rules, story.code
        if last is None:
            return _NEW
        times = story.counts[last]
        if last == _NEW and times < r.new_repeat:
            return _NEW
        if (
            last < _HOT
            or top <= r.hot_rank
            or best <= r.hot_rank
            or (last == _HOT and times < r.hot_repeat)
        ):
            return _HOT
        if (
            top <= r.tepid_rank
            or best <= r.tepid_rank
            or new <= r.tepid_rank
            or (last in (CODE["missing"], _FAILED) and times < r.failed_repeat)
        ):
            return _TEPID
        if last < _COOLING or (last == _COOLING and times < r.cooling_repeat):
            return _COOLING
        if last < _COLD or (last == _COLD and times < r.cold_repeat):
            return _COLD
        return _FROZEN if last <= _FROZEN else CODE["unexpected"]

    def idle_due(self, story: _Story) -> tuple[int, int]:
        """When a known story falls due while unranked, and with which status."""
        if story.idle is None or story.idle[0] < story.at:
            code = self.next_code(story, _UNRANKED, _UNRANKED, _UNRANKED)
            story.idle = self.first_due(story, code, story.at), code
        return story.idle

    def first_due(self, story: _Story, code: int, start: int) -> int:
        """Index of the first run from ``start`` on in which the story is due, or the end."""
        end = len(self.timeline)
        if code <= _HOT or (story.code is not None and code < story.code):
            return start
        if code not in self.ages or story.last_ts is None:
            return end
        i = self._first_aged(story.last_ts, self.ages[code], start)
        window = self.rules.frozen_window * _SECOND
        if code < CODE["unknown"] or window == 0:
            return i
        while i < end:
            past = self.timeline[i] - story.last_ts
            if past % _DAY < window:
                return i
            i = bisect_left(self.timeline, story.last_ts + (past // _DAY + 1) * _DAY, i)
        return end

    def _first_aged(self, then: int, seconds: float, start: int) -> int:
        wanted = int(seconds * _SECOND)
        if seconds <= 28 * 86_400:
            return bisect_left(self.timeline, then + wanted, start)
        # a calendar age can run ahead of the plain difference by less than four days; between
        # a midnight and the old time of day it only grows
        i = bisect_left(self.timeline, then + wanted - 4 * _DAY, start)
        while i < len(self.timeline):
            t = self.timeline[i]
            turn = min((t // _DAY + 1) * _DAY, then + ((t - then) // _DAY + 1) * _DAY)
            end = bisect_left(self.timeline, turn, i)
            aged = bisect_left(
                self.timeline, wanted, i, end, key=lambda now: _calendar_age(now, then)
            )
            if aged < end:
                return aged
            i = end
        return i


def _ints(column: pa.Array, null: int) -> list[int]:
    return column.fill_null(null).to_numpy(zero_copy_only=False).tolist()


def _walk(batches: Iterable[pa.RecordBatch], rules: Ruleset, timeline: list[int]):
    """Fold the rows of a partition, sorted by story and time, into records and end states."""
    logic = _Rules(rules, timeline)
    index = {ts: i for i, ts in enumerate(timeline)}
    out: list[tuple] = []

    def record(story, i, code, score=None, descendants=None, payload_ts=None):
        ts = timeline[i]
        story.last_ts, story.code, story.score = ts, code, score
        story.counts[code] += 1
        story.idle = None
        out.append((_RECORD, story.id, ts, code, score, descendants, payload_ts, None))

    def skip_to(story, until):
        """Runs without ranks and without a response: what falls due there has failed."""
        while story.last_ts is not None and story.at < until:
            i, _ = logic.idle_due(story)
            if i >= until:
                break
            record(story, i, _FAILED)
            story.at = i + 1
        story.at = max(story.at, until)

    def finish(story):
        skip_to(story, len(timeline))
        if story.last_ts is not None:
            out.append(
                (_STATE, story.id, story.last_ts, story.code, story.score, None, None, story.counts)
            )

    def flush():
        columns = zip(*out) if out else [[] for _ in _OUT_ARROW]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _OUT_ARROW)], schema=_OUT_ARROW
        )
        out.clear()
        return batch

    def settle(story, at, top, best, new, answer):
        """One run of a story: its best places and its response, if any."""
        i = index.get(at)
        if i is None:
            return
        skip_to(story, i)
        if top == best == new == _UNRANKED:
            if story.last_ts is None:
                return  # neither ranked nor known
            due, code = logic.idle_due(story)
        else:
            code = logic.next_code(story, top, best, new)
            due = logic.first_due(story, code, i)
        story.at = i + 1
        if due == i:
            status, *result = answer or (_FAILED,)
            record(story, i, code if status == _AS_CLASSIFIED else status, *result)

    story, now, answer = None, None, None
    top = best = new = _UNRANKED
    for batch in batches:
        sids, ats, tops, bests, news, answers, scores, comments, ends, counts, codes = batch.columns
        rows = zip(
            _ints(sids, 0),
            _ints(ats, _STORED_STATE),
            _ints(tops, _UNRANKED),
            _ints(bests, _UNRANKED),
            _ints(news, _UNRANKED),
            _ints(answers, _UNRANKED),
        )
        for row, (sid, at, t, b, n, status) in enumerate(rows):
            if story is None or story.id != sid or at != now:
                if now is not None:
                    settle(story, now, top, best, new, answer)
                if story is None or story.id != sid:
                    if story is not None:
                        finish(story)
                    story = _Story(sid)
                now, answer = at, None
                top = best = new = _UNRANKED
            if at == _STORED_STATE:  # first of its story
                story.counts, story.last_ts = counts[row].as_py(), ends[row].as_py()
                story.code, story.score = codes[row].as_py(), scores[row].as_py()
                now = None
                continue
            top, best, new = min(top, t), min(best, b), min(new, n)
            if status != _UNRANKED:
                answer = status, scores[row].as_py(), comments[row].as_py(), ends[row].as_py()
        if len(out) >= 10_000:
            yield flush()
    if story is not None:
        if now is not None:
            settle(story, now, top, best, new, answer)
        finish(story)
    yield flush()


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _inputs(run: DataFrame, items_raw: DataFrame, state: DataFrame | None) -> DataFrame:
    """Rows for :func:`_walk`: a story's state, and its places in lists and responses by run.

    They are stacked, not joined: the walk meets what belongs to one run of a story in neighbouring
    rows, so the shuffle that brings a story's rows together is the only one.
    """
    null_int, null_long = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    empty = {"at": null_long, "answer": null_int, "score": null_int, "descendants": null_long,
             "payload_ts": null_long, "counts": F.lit(None).cast("array<bigint>"), "code": null_int}
    empty |= {c: null_int for c in RANK_COLUMNS}

    def rows(df: DataFrame, **columns) -> DataFrame:
        given = empty | columns
        return df.select("story_id", *[given[c].alias(c) for c in _INPUT])

    lists = ", ".join(f"{i}, {name}" for i, name in enumerate(RANKINGS))
    places = run.select("ts_run", F.expr(f"stack({len(RANKINGS)}, {lists}) AS (ranking, ids)")).select(
        "ts_run", "ranking", F.posexplode("ids").alias("position", "story_id")
    )
    place = F.col("position") + 1
    ranks = {c: F.when(F.col("ranking") == i, place) for i, c in enumerate(RANK_COLUMNS)}
    ranked = rows(places.filter(F.col("story_id").isNotNull()), at=_micros("ts_run"), **ranks)
    responses = json_fields(items_raw, "payload", **RECORDED_FIELDS).withColumn("story_id", F.col("id"))
    answer = outcome_code(marked_payload(F.col("payload")), F.col("deleted"), F.lit(_AS_CLASSIFIED))
    answered = rows(
        responses, at=_micros("ts_run"), answer=answer, score=F.col("score"),
        descendants=F.col("descendants"), payload_ts=_micros("ts_end"),
    )
    stacked = ranked.unionByName(answered)
    if state is None:
        return stacked
    states = rows(
        state, score=F.col("last_score"), payload_ts=_micros("last_ts"),
        counts=F.array(*COUNT_COLUMNS), code=F.col("last_code"),
    )
    return stacked.unionByName(states)


def replay_block(
    run: DataFrame, items_raw: DataFrame, rules: Ruleset, timeline: list[int],
    state: DataFrame | None = None, partitions: int | None = None,
) -> DataFrame:
    """Records and end states of one block of runs (``timeline``: its run times, micros).

    Nulls sort first, so a story's state precedes its rows. The number of partitions is
    given (None: the session's for shuffles): sized by bytes alone, adaptive execution would
    leave the walk too few tasks. A long history wants about one per million responses.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _walk(batches, rules, timeline)

    parallelism = partitions or run.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return (
        _inputs(run, items_raw, state)
        .repartition(int(parallelism), "story_id")
        .sortWithinPartitions("story_id", "at")
        .mapInArrow(walk, _OUT_DDL)
    )


def _timestamp(column: str):
    return F.timestamp_micros(column).cast("timestamp_ntz")


def block_records(block: DataFrame) -> DataFrame:
    """``run_story`` rows of a block."""
    return block.filter(F.col("kind") == _RECORD).select(
        _timestamp("ts").alias("ts_run"),
        "story_id",
        status_name("code").alias("status"),
        "score",
        "descendants",
        _timestamp("payload_ts").alias("ts_payload"),
    )


def block_state(block: DataFrame) -> DataFrame:
    """End states of a block, as ``story_state``."""
    return block.filter(F.col("kind") == _STATE).select(
        "story_id",
        _timestamp("ts").alias("last_ts"),
        F.col("code").alias("last_code"),
        F.col("score").alias("last_score"),
        *[F.col("counts")[i].alias(name) for i, name in enumerate(COUNT_COLUMNS)],
    )


def block_errors(block: DataFrame, items_raw: DataFrame) -> DataFrame:
    """Error rows of a block's fetches.

    Two narrow joins: the fetches that ended badly, whose responses alone are looked up, and the
    responses that took a retry. All other payloads stay where they are.
    """
    fetched = block.filter(F.col("kind") == _RECORD).select(
        _timestamp("ts").alias("ts_run"), "story_id", F.col("code").alias("new_code")
    )
    bad = fetched.filter(F.col("new_code") >= CODE["deleted"])
    keys = bad.select("ts_run", F.col("story_id").alias("id"))
    answers = items_raw.join(keys, ["ts_run", "id"], "left_semi")
    retried = items_raw.filter(F.col("retries") != 0)
    others = fetched.filter(F.col("new_code") < CODE["deleted"])
    return run_story_errors(fetch_outcomes(bad, answers)).unionByName(
        run_story_errors(fetch_outcomes(others, retried))
    )


def cycle_block(outcomes: DataFrame) -> DataFrame:
    """The records of one run, classified without a walk, as rows of a block."""
    return outcomes.select(
        F.lit(_RECORD).alias("kind"),
        "story_id",
        _micros("ts_run").alias("ts"),
        "code",
        "score",
        "descendants",
        _micros("ts_end").alias("payload_ts"),
        F.lit(None).cast("array<bigint>").alias("counts"),
    )


def visible_state(run: DataFrame, state: DataFrame) -> DataFrame:
    """A stored state as classification sees it.

    A story whose last run is not recorded counts as never recorded, but keeps its counts.
    """
    known = run.select(F.col("ts_run").alias("last_ts"), F.lit(True).alias("_known"))
    columns = state.columns
    return (
        state.join(known, "last_ts", "left")
        .withColumn("last_code", F.when(F.col("_known"), F.col("last_code")))
        .withColumn("last_ts", F.when(F.col("_known"), F.col("last_ts")))
        .select(*columns)
    )


@dataclass(frozen=True)
class Replay:
    """Tables a replay produced."""

    run: DataFrame
    run_story: DataFrame
    error: DataFrame
    state: DataFrame


def _windows(run: DataFrame, block_runs: int) -> list[tuple[int, int]]:
    """Stretches of whole hours, in order, with at most ``block_runs`` runs where possible.

    The driver sees one count per hour covered. A single hour with more runs is a stretch
    of its own.
    """
    hour = F.floor(_micros("ts_run") / _HOUR).alias("hour")
    counts = run.groupBy(hour).count().orderBy("hour").collect()
    windows, size = [], 0
    for row in counts:
        low, high = row["hour"] * _HOUR, (row["hour"] + 1) * _HOUR - 1
        if windows and size + row["count"] <= block_runs:
            windows[-1] = windows[-1][0], high
            size += row["count"]
        else:
            windows.append((low, high))
            size = row["count"]
    return windows


def _next_runs(run: DataFrame, after: datetime | None, count: int) -> list[int]:
    """Times (micros) of the next ``count`` runs of a stretch: that many longs, no more."""
    if after is not None:
        run = run.filter(F.col("ts_run") > run_time(run, after))
    times = run.select(_micros("ts_run").alias("t")).orderBy("t").limit(count)
    return [row.t for row in times.collect()]


def _timelines(run: DataFrame, block_runs: int) -> Iterator[list[int]]:
    """The run times of one block after the other."""
    for low, high in _windows(run, block_runs):
        stretch = between(run, _moment(low), _moment(high))
        timeline = _next_runs(stretch, None, block_runs)
        while timeline:
            yield timeline
            if len(timeline) < block_runs:
                break
            timeline = _next_runs(stretch, _moment(timeline[-1]), block_runs)


def _moment(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def replay_blocks(
    run: DataFrame,
    items_raw: DataFrame,
    rules: Ruleset,
    state: DataFrame | None,
    folder: str,
    block_runs: int = BLOCK_RUNS,
    partitions: int | None = None,
) -> DataFrame | None:
    """Fold ``run`` block by block into ``folder``; returns the state after the last one."""
    spark = run.sparkSession
    for number, timeline in enumerate(_timelines(run, block_runs)):
        low, high = _moment(timeline[0]), _moment(timeline[-1])
        block = replay_block(
            between(run, low, high),
            between(items_raw, low, high),
            rules,
            timeline,
            state,
            partitions,
        )
        path = f"{folder}/block={number}"
        # few tasks' worth of output in a live cycle, many in a long replay: let sizes decide
        block.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").parquet(path)
        state = block_state(spark.read.schema(_OUT_DDL).parquet(path))
    return state


def read_blocks(spark, folder: str, *partitions: str) -> DataFrame:
    """All blocks under a folder; ``partitions`` names directory levels above them."""
    levels = "".join(f"{p} bigint, " for p in (*partitions, "block"))
    return spark.read.schema(levels + _OUT_DDL).parquet(folder)


def replay_history(
    rankings_raw: DataFrame,
    items_raw: DataFrame,
    rules: Ruleset,
    run: DataFrame | None = None,
    state: DataFrame | None = None,
    block_runs: int = BLOCK_RUNS,
    runs: DataFrame | None = None,
    partitions: int | None = None,
) -> Replay:
    """Run every landed cycle in time order; same tables as ``run_cycle`` one by one.

    ``run`` and ``state`` hold what was recorded before, if anything; ``runs`` is the schedule,
    which also names runs whose lists all failed. ``partitions`` is the number of tasks per block.
    """
    spark = rankings_raw.sparkSession
    folder = shared_dir(spark, "replay")
    rankings = parse_rankings(rankings_raw, runs=runs)
    write_table(assemble_run(rankings, rules.name).select(*RUN.names), f"{folder}/run")
    landed = read_table(spark, f"{folder}/run", RUN)
    if state is not None:
        state = visible_state(run, state)
    state = replay_blocks(landed, items_raw, rules, state, f"{folder}/blocks", block_runs, partitions)
    if state is None:
        raise ValueError("no landed rankings to replay")
    blocks = read_blocks(spark, f"{folder}/blocks")
    return Replay(
        run=landed,
        run_story=block_records(blocks),
        error=run_errors(rankings).unionByName(block_errors(blocks, items_raw)),
        state=state,
    )
