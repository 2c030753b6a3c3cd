"""The live cycle with state per story: a batch costs what is ranked, answered or due in it.

Ranks, responses and run times stream into shards of stories. A shard keeps the state of every
story in a map of the state store, and the story's next due time in a second map: one entry per slot of
time, with the stories that fall due in it while they are unranked. A run takes from the maps the
stories that are ranked or answered in it and those whose slot has come; the others are not
looked at, however many there are. The state store writes changed entries only.

``streaming.live`` does the same with tables and joins: it writes the state of every story per batch,
but needs no state store.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.payload import id_list, json_fields, marked_payload
from ..operators.collect import RECORDED_FIELDS, assemble_run, outcome_code, run_errors
from ..operators.status import story_state
from ..plans.replay import (
    _AS_CLASSIFIED,
    _DAY,
    _FAILED,
    _HOT,
    _RECORD,
    _SECOND,
    _UNRANKED,
    Replay,
    _micros,
    _Rules,
    _Story,
    block_errors,
    block_records,
)
from ..ruleset import Ruleset
from ..schema import CODE, RANKINGS, RUN
from ..sources.responses import parse_rankings

SHARDS = 64  # groups of stories; a run sends each of them one row for each of its lists
SLOT = 300 * _SECOND  # stories that fall due within a slot are looked at together

_STORES = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TICK, _RANK, _ANSWER = range(3)
_TOUCHED, _LATE = 1, 2  # kinds of output rows: how many stories a batch looked at; a run that came too late
_NEXT = -1  # slot of stories that are due in every run

_EVENT = ("shard", "kind", "at", "story_id", "list", "place", "answer", "score", "descendants", "payload_ts")
_OUT = (
    "kind int, story_id bigint, ts bigint, code int, score int, descendants bigint, payload_ts bigint, "
    "touched bigint"
)
_STORY_VALUE = "last_ts bigint, code int, score int, counts array<bigint>, slot bigint"
_ANSWER_VALUE = (
    "story_id array<bigint>, code array<int>, score array<int>, descendants array<bigint>, payload_ts array<bigint>"
)


def story_events(
    lists: DataFrame, items: DataFrame, schedule: DataFrame | None = None, shards: int = SHARDS
) -> DataFrame:
    """Ticks of the runs for every shard, and the ranks and responses of its stories. No shuffle."""
    no_long, no_int = F.lit(None).cast("bigint"), F.lit(None).cast("int")
    shard = F.pmod(F.xxhash64("story_id"), F.lit(shards)).cast("int").alias("shard")

    def rows(df: DataFrame, **columns) -> DataFrame:
        given = {"story_id": no_long, "list": no_int, "place": no_int, "answer": no_int, "score": no_int,
                 "descendants": no_long, "payload_ts": no_long}
        given |= {"at": _micros("ts_run")} | columns
        return df.select(*[given[c].alias(c) for c in _EVENT])

    planned = lists.select("ts_run")
    if schedule is not None:
        planned = planned.unionAll(schedule.select("ts_run"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    ticks = rows(planned.select("ts_run", every), shard=F.col("shard"), kind=F.lit(_TICK))
    names = F.array_position(F.array(*[F.lit(n) for n in RANKINGS]), F.col("id")).cast("int")
    places = lists.select("ts_run", names.alias("list"), F.posexplode(id_list(F.col("payload"))).alias("p", "story_id"))
    ranks = rows(
        places.filter(F.col("story_id").isNotNull() & (F.col("list") > 0)),
        shard=shard, kind=F.lit(_RANK), story_id=F.col("story_id"), list=F.col("list") - 1, place=F.col("p") + 1,
    )
    answers = json_fields(items, "payload", **RECORDED_FIELDS).withColumn("story_id", F.col("id"))
    code = outcome_code(marked_payload(F.col("payload")), F.col("deleted"), F.lit(_AS_CLASSIFIED))
    answers = rows(
        answers, shard=shard, kind=F.lit(_ANSWER), story_id=F.col("story_id"), answer=code.cast("int"),
        score=F.col("score"), descendants=F.col("descendants"), payload_ts=_micros("ts_end"),
    )
    return ticks.unionByName(ranks).unionByName(answers)


class _Shelf:
    """Entries of a map state that a batch has read, written back if they changed."""

    def __init__(self, state, read, write):
        self.state, self.read, self.write = state, read, write
        self.known: dict = {}
        self.changed: set = set()

    def get(self, key):
        if key not in self.known:
            value = self.state.getValue((key,)) if self.state.containsKey((key,)) else None
            self.known[key] = self.read(key, value)
        return self.known[key]

    def flush(self):
        for key in self.changed:
            value = self.write(self.known[key])
            if value is None:
                self.state.removeKey((key,))
            else:
                self.state.updateValue((key,), value)
        self.known.clear()
        self.changed.clear()


def _read_story(key: int, value) -> _Story:
    story = _Story(key)
    if value is not None:
        story.last_ts, story.code, story.score = value[0], value[1], value[2]
        story.counts = list(value[3])
        story.at = value[4]  # here: the slot it waits in
    return story


class StoryShard(StatefulProcessor):
    """Runs the cycles of a shard's stories in time order."""

    def __init__(self, rules: Ruleset, slot: int = SLOT):
        self.rules, self.width = rules, slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stories = handle.getMapState("stories", "story_id bigint", _STORY_VALUE)
        self.due = handle.getMapState("due", "slot bigint", "stories array<bigint>")
        self.answers = handle.getMapState("answers", "at bigint", _ANSWER_VALUE)
        self.clock = handle.getValueState("clock", "last bigint, slots array<bigint>, runs array<bigint>")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, slots, waiting = self.clock.get() if self.clock.exists() else (None, [], [])
        self.slots, self.waiting = set(slots), set(waiting)
        ticks: set[int] = set()
        ranks: dict[int, dict[int, list[int]]] = {}
        answers: dict[int, list[tuple]] = {}
        for part in rows:
            for _, kind, at, sid, name, place, *answer in part[list(_EVENT)].itertuples(index=False, name=None):
                if kind == _TICK:
                    ticks.add(at)
                elif kind == _RANK:
                    best = ranks.setdefault(at, {}).setdefault(int(sid), [_UNRANKED] * len(RANKINGS))
                    best[int(name)] = min(best[int(name)], int(place))
                elif last is None or at > last:  # else its run has been recorded without it
                    known = [None if pd.isna(x) else int(x) for x in answer]
                    answers.setdefault(at, []).append((int(sid), *known))
        late = sorted(t for t in ticks if last is not None and t <= last)
        runs = sorted(ticks.difference(late))
        shelf = _Shelf(self.stories, _read_story, self._story_value)
        queue = _Shelf(self.due, lambda _, v: list(v[0]) if v else [], lambda v: (v,) if v else None)
        out: list[tuple] = []
        for t in runs:
            self._run(t, ranks.get(t, {}), self._answers_of(t, answers.pop(t, [])), shelf, queue, out)
            last = t
        for at, ahead in answers.items():  # responses whose run has not come yet
            self._keep(at, ahead)
        touched = len(shelf.known)
        shelf.flush()
        queue.flush()
        self.clock.update((last, sorted(self.slots), sorted(self.waiting)))
        if key[0] == 0:
            out += [(_LATE, None, t, None, None, None, None) for t in late]
        columns = [c.split()[0] for c in _OUT.split(", ")]
        out += [(_TOUCHED, None, None, None, None, None, None)] 
        frame = pd.DataFrame(out, columns=columns[:-1], dtype=object)
        frame["touched"] = [None] * (len(out) - 1) + [touched]
        yield frame

    @staticmethod
    def _story_value(story: _Story):
        return story.last_ts, story.code, story.score, story.counts, story.at

    def _keep(self, at: int, rows: list[tuple]) -> None:
        if at in self.waiting:
            rows = list(zip(*self.answers.getValue((at,)))) + rows
        self.answers.updateValue((at,), tuple(list(c) for c in zip(*rows)))
        self.waiting.add(at)

    def _answers_of(self, t: int, rows: list[tuple]) -> dict[int, tuple]:
        """Responses of a run, the kept ones too; what waits for an older run is of no use any more."""
        if t in self.waiting:
            rows = list(zip(*self.answers.getValue((t,)))) + rows
        for at in [at for at in self.waiting if at <= t]:
            self.answers.removeKey((at,))
            self.waiting.discard(at)
        return {row[0]: row[1:] for row in rows}

    def _run(self, t, ranks, answers, shelf, queue, out) -> None:
        logic = _Rules(self.rules, [t])
        come = sorted(s for s in self.slots if s == _NEXT or s * self.width <= t)
        waiting = {}
        for slot in come:
            for sid in queue.get(slot):
                if shelf.get(sid).at == slot:  # else it has moved to another slot since
                    waiting[sid] = slot
            queue.known[slot] = []
            queue.changed.add(slot)
            self.slots.discard(slot)
        for sid in ranks.keys() | answers.keys() | waiting.keys():
            story = shelf.get(sid)
            places = ranks.get(sid)
            if places is None and story.last_ts is None:
                continue  # neither ranked nor known
            code = logic.next_code(story, *(places or [_UNRANKED] * len(RANKINGS)))
            if logic.first_due(story, code, 0) == 0:
                status, score, comments, payload_ts = answers.get(sid, (_FAILED, None, None, None))
                story.code = code if status == _AS_CLASSIFIED else status
                story.last_ts, story.score = t, score
                story.counts[story.code] += 1
                story.at = None
                shelf.changed.add(sid)
                out.append((_RECORD, sid, t, story.code, score, comments, payload_ts))
                self._queue(logic, story, t, shelf, queue)
            elif sid in waiting:
                self._queue(logic, story, t, shelf, queue)

    def _queue(self, logic: _Rules, story: _Story, t: int, shelf: _Shelf, queue: _Shelf) -> None:
        """Put a story into the slot in which it may next be due, if it stays unranked after ``t``."""
        code = logic.next_code(story, _UNRANKED, _UNRANKED, _UNRANKED)
        slot = None
        if code <= _HOT or code < story.code:
            slot = _NEXT
        elif code in logic.ages:
            wanted = int(logic.ages[code] * _SECOND)
            if wanted > 28 * _DAY:
                wanted -= 4 * _DAY  # a calendar age can run ahead of the plain difference
            then = story.last_ts + wanted
            if then <= t and code >= CODE["unknown"] and self.rules.frozen_window:
                then = story.last_ts + ((t - story.last_ts) // _DAY + 1) * _DAY  # the window's next opening
            slot = max(then, t + 1) // self.width
        if slot != story.at:
            story.at = slot
            shelf.changed.add(story.id)
        if slot is not None:
            queue.get(slot).append(story.id)
            queue.changed.add(slot)
            self.slots.add(slot)


def stream_stories(
    lists: DataFrame,
    items: DataFrame,
    rules: Ruleset,
    out: str,
    schedule: DataFrame | None = None,
    shards: int = SHARDS,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the job on streams of landed lists and item responses.

    The lists of a run land together, and its responses no later than its lists; a response that comes
    earlier waits in the state. ``schedule`` is a stream of planned runs (ts_run), which land with
    their lists or instead of them. Without ``interval`` the query ends once everything
    landed has been handled. Records go to ``out``/records, the checkpoint to ``out``/_checkpoint.
    """
    spark = lists.sparkSession
    events = story_events(lists, items, schedule, shards)
    handled = events.groupBy("shard").transformWithStateInPandas(
        StoryShard(rules), _OUT, outputMode="Append", timeMode="None"
    )
    writer = (
        handled.writeStream.format("parquet")
        .option("path", f"{out}/records")
        .option("checkpointLocation", f"{out}/_checkpoint")
        .queryName("ranktrail_stories")
    )
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, _STORES)  # maps and values in one store need this one
    try:
        return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()
    finally:
        spark.conf.set(setting, before)


def _records(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_OUT).parquet(f"{out}/records")


def stories_touched(spark: SparkSession, out: str) -> int:
    """How many times a batch looked at a story, over all batches so far."""
    return _records(spark, out).agg(F.sum("touched")).first()[0] or 0


def late_run_times(spark: SparkSession, out: str) -> DataFrame:
    """Runs (ts_run) that landed after a later one, or again, and were left as they are."""
    late = _records(spark, out).filter(F.col("kind") == _LATE)
    return late.select(F.timestamp_micros("ts").cast("timestamp_ntz").alias("ts_run"))


def collected_stories(
    spark: SparkSession, lists: DataFrame, items: DataFrame, rules: Ruleset, out: str, runs: DataFrame | None = None
) -> Replay:
    """Tables behind a stream so far; ``lists``, ``items`` and ``runs`` are what landed, as plain tables."""
    records = _records(spark, out).filter(F.col("kind") == _RECORD)
    late = late_run_times(spark, out).distinct()
    rankings = parse_rankings(lists, runs=runs)
    run_story = block_records(records)
    errors = run_errors(rankings).unionByName(block_errors(records, items))
    run = assemble_run(rankings, rules.name).select(*RUN.names)
    once = run_story.select("ts_run").distinct()
    ignored = late.join(once, "ts_run", "left_anti")
    return Replay(
        run=run.join(ignored, "ts_run", "left_anti"),
        run_story=run_story,
        error=errors.join(ignored, "ts_run", "left_anti"),
        state=story_state(run_story),
    )
