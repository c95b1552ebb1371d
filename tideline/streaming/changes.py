"""Change detection on streams, with what is known of each key in the state store.

A key's state holds the time and value of its last settled poll, hence the cost of a micro-batch follows its
rows and not the keys ever seen. Rows wait until a poll of their group is ``delay`` ahead of them, so polls may
come out of order or in parts; a row older than what is settled comes out marked ``late``. Groups that can be
large are split into parts, which all learn of every poll.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType

from ..operators.envelope import TIMESTAMPS
from ..schemas import BOOL, LONG, STR, struct
from ..sources.landed import poll_trigger

#: Parts that the rows of one repository are dealt into.
PARTS = 8
#: Parts that the rows of one user pool are dealt into, as pools are few and rows of users wide.
POOL_PARTS = 32
#: Polls of pools that a task sums up before it tells of them.
POLLS_TOLD = 65_536


def micros(delay: str) -> int:
    """A time span of SQL in microseconds."""
    spark = SparkSession.getActiveSession()
    return spark.range(1).select(F.unix_micros(F.expr(f"timestamp_seconds(0) + interval {delay}"))).first()[0]


class Settling(StatefulProcessor):
    """Keeps rows (at, item, value) until they are ``delay`` behind the newest of the group, then hands them on in order.

    ``item`` may be null: the row then says only that there was a poll. Groups are many and mostly small, so they go
    by as plain tuples, and the state is asked as seldom as can be.
    """

    def __init__(self, delay: int):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "at bigint, item string, value string")
        self.newest = handle.getValueState("newest", "at bigint")
        self.begin(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ready = [(r.at, r.item, r.value) for r in rows]
        waited = self.waiting.exists()
        if waited:
            ready = [*map(tuple, self.waiting.get()), *ready]
        if self.delay > 0:  # without a delay no row is ahead of the newest: none is held, and the newest need not be known
            newest = max(at for at, _, _ in ready)
            known = self.newest.get()
            newest = max(newest, known[0]) if known else newest
            held = [r for r in ready if r[0] > newest - self.delay]
            ready = [r for r in ready if r[0] <= newest - self.delay]
            self.newest.update((newest,))
            if held:
                self.waiting.put(held)
        else:
            held = []
        if waited and not held:
            self.waiting.clear()
        if ready:
            ready.sort(key=itemgetter(0))
            for found in self.settle(ready):
                yield self.output(*key, *found)

    def close(self) -> None:
        pass


class ValueChanges(Settling):
    """Rows whose value differs from that of the poll before."""

    keys = ["repo", "branch"]
    output = Row(*keys, "at", "value", "previous", "late")

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at bigint, value string")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        known = self.last.get()
        if known is None or known[0] <= initialState.at:
            self.last.update((initialState.at, initialState.value))

    def settle(self, rows: list[tuple]) -> Iterator[tuple]:
        known = last = self.last.get()
        for at, _, value in rows:
            if known is not None and at < known[0]:
                yield at, value, None, True
                continue
            if last is not None and value != last[1]:
                yield at, value, last[1], False
            last = at, value
        if last is not known:
            self.last.update(last)


class ItemChanges(Settling):
    """Rows of items that are new or whose value differs from their poll before; the group's first poll is baseline."""

    keys = ["repo", "part"]
    output = Row(*keys, "item", "at", "value", "previous", "late")

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "at bigint")
        self.last = handle.getMapState("last", "item string", "at bigint, value string")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        at, item, value = initialState.at, initialState.item, initialState.value
        first = self.first.get()
        if first is None or at < first[0]:
            self.first.update((at,))
        if item is not None:
            known = self.last.getValue((item,))
            if known is None or known[0] <= at:
                self.last.updateValue((item,), (at, value))

    def settle(self, rows: list[tuple]) -> Iterator[tuple]:
        first = self.first.get()
        if first is None:
            first = rows[0][:1]
            self.first.update(first)
        known = {item: self.last.getValue((item,)) for item in {r[1] for r in rows} if item is not None}
        last = dict(known)
        for at, item, value in rows:
            if item is None:
                continue
            if known[item] is not None and at < known[item][0]:
                yield item, at, value, None, True
                continue
            if last[item] is None:
                if at > first[0]:
                    yield item, at, value, None, False
            elif value != last[item][1]:
                yield item, at, value, last[item][1], False
            last[item] = at, value
        for item, now in last.items():
            if now is not known[item]:
                self.last.updateValue((item,), now)


class AboveMark(Settling):
    """Rows whose ``item``, a time in microseconds, exceeds all of earlier polls; a row without value only tells of a time."""

    keys = ["pool", "part"]
    output = Row(*keys, "at", "value", "mark", "late")

    def begin(self, handle: StatefulProcessorHandle) -> None:
        # the last settled poll, the highest time before it (the mark of its rows), and the highest with it
        self.last = handle.getValueState("last", "at bigint, mark bigint, top bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        known = self.last.get()
        mark = initialState.mark if known is None else max(known[1], initialState.mark)
        self.last.update((None, mark, mark))

    def settle(self, rows: list[tuple]) -> Iterator[tuple]:
        settled_at, mark, top = self.last.get() or (None, None, None)
        last_at = settled_at
        for at, item, value in rows:
            if settled_at is not None and at < settled_at:
                if value is not None:
                    yield at, value, None, True
                continue
            if at != last_at:
                last_at, mark = at, top
            if item is not None:
                time = int(item)
                if value is not None and mark is not None and time > mark:
                    yield at, value, mark, False
                top = time if top is None else max(top, time)
        self.last.update((last_at, mark, top))


def _stateful(rows: DataFrame, processor: Settling, output: dict, prior: DataFrame | None) -> DataFrame:
    return rows.groupBy(*processor.keys).transformWithState(
        statefulProcessor=processor, outputStructType=struct(output), outputMode="Append", timeMode="None",
        initialState=None if prior is None else prior.groupBy(*processor.keys))


def _at(column: str = "poll_ts") -> Column:
    return F.unix_micros(column).alias("at")


def head_change_stream(heads: DataFrame, delay: str = "0 seconds", prior: DataFrame | None = None) -> DataFrame:
    """``head_changes`` on a stream: (repo, branch, poll_ts, commit_id, previous_commit, late).

    ``prior`` has the known (repo, branch, poll_ts, commit_id). ``late`` rows are older than the last settled poll
    of their branch and are not compared.
    """
    columns = ["repo", "branch", _at(), F.lit(None).cast("string").alias("item"), F.col("commit_id").alias("value")]
    known = None if prior is None else prior.select(*columns)
    found = _stateful(heads.select(*columns), ValueChanges(micros(delay)),
                      {"repo": STR, "branch": STR, "at": LONG, "value": STR, "previous": STR, "late": BOOL}, known)
    return found.select(
        "repo", "branch", F.timestamp_micros("at").alias("poll_ts"), F.col("value").alias("commit_id"),
        F.col("previous").alias("previous_commit"), "late")


def status_change_stream(
    prs: DataFrame, delay: str = "0 seconds", prior: DataFrame | None = None, parts: int = PARTS,
    marks_kept: str = "1 day",
) -> DataFrame:
    """``status_changes`` on a stream: (repo, pr_id, poll_ts, status, previous_status, late).

    A row without ``pr_id`` is a poll that found nothing; it can be a repository's first. ``prior`` has the known
    (repo, pr_id, poll_ts, status); a repository in it has had its first poll. The requests of a repository are dealt
    into ``parts``; each poll is told to all parts once, which is remembered for ``marks_kept``.
    """
    part = F.pmod(F.xxhash64("pr_id"), F.lit(parts)).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    none = F.lit(None).cast("string")
    row = ["repo", part, _at(), F.col("pr_id").alias("item"), F.col("status").alias("value")]
    mark = ["repo", every, _at(), none.alias("item"), none.alias("value")]
    # a watermark starts at the epoch and lets nothing of that very instant pass, hence the day
    polls = prs.select("repo", "poll_ts", (F.col("poll_ts") + F.expr("interval 1 day")).alias("_seen")).withWatermark(
        "_seen", marks_kept).dropDuplicatesWithinWatermark(["repo", "poll_ts"])
    rows = polls.select(*mark).unionByName(prs.where("pr_id IS NOT NULL").select(*row))
    known = None
    if prior is not None:
        firsts = prior.groupBy("repo").agg(F.min("poll_ts").alias("poll_ts"))
        known = firsts.select(*mark).unionByName(prior.where("pr_id IS NOT NULL").select(*row))
    found = _stateful(rows, ItemChanges(micros(delay)), {
        "repo": STR, "part": IntegerType(), "item": STR, "at": LONG, "value": STR, "previous": STR, "late": BOOL}, known)
    return found.select(
        "repo", F.col("item").alias("pr_id"), F.timestamp_micros("at").alias("poll_ts"), F.col("value").alias("status"),
        F.col("previous").alias("previous_status"), "late")


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The highest time per poll of (pool, at, top), summed up over the batches of a task."""
    held = []

    def summed() -> pa.Table:
        table = pa.Table.from_batches(held).group_by(["pool", "at"]).aggregate([("top", "max")])
        return table.rename_columns({"top_max": "top"}).select(["pool", "at", "top"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > POLLS_TOLD:
            table = summed()
            # what does not get smaller is told at once
            if table.num_rows > POLLS_TOLD // 2:
                yield from table.to_batches()
                held = []
            else:
                held = table.combine_chunks().to_batches()
    if held:
        yield from summed().to_batches()


def modified_stream(
    users: DataFrame, delay: str = "0 seconds", prior: DataFrame | None = None, parts: int = POOL_PARTS,
) -> DataFrame:
    """``modified_since`` on a stream: the columns of ``users``, ``mark`` and ``late``.

    A poll may come in parts; its mark is that of the polls before it. ``prior`` has the known (pool, mark).
    The rows of a pool are dealt into ``parts``, which all learn of every poll and of the highest time in it.
    """
    columns = [c for c in users.columns if c not in ("pool", "poll_ts")]
    form = {"timestampFormat": TIMESTAMPS}
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    modified = F.unix_micros("UserLastModifiedDate")
    tops = users.select("pool", _at(), modified.alias("top")).mapInArrow(_tops, "pool string, at bigint, top bigint")
    told = tops.select(
        "pool", every, "at", F.col("top").cast("string").alias("item"), F.lit(None).cast("string").alias("value"))
    value = F.to_json(F.struct(*columns), form)
    rows = users.select(
        "pool", F.pmod(F.xxhash64(value), F.lit(parts)).cast("int").alias("part"), _at(), modified.cast("string").alias("item"),
        value.alias("value"))
    known = None if prior is None else prior.groupBy("pool").agg(F.max(F.unix_micros("mark")).alias("mark")).select(
        "pool", every, "mark")
    found = _stateful(told.unionByName(rows), AboveMark(micros(delay)), {
        "pool": STR, "part": IntegerType(), "at": LONG, "value": STR, "mark": LONG, "late": BOOL}, known)
    return found.select(
        "pool", F.timestamp_micros("at").alias("poll_ts"), F.from_json("value", users.select(*columns).schema, form).alias("_user"),
        F.timestamp_micros("mark").alias("mark"), "late").select("pool", "poll_ts", "_user.*", "mark", "late")


def write_changes(
    changes: DataFrame, out: str, checkpoint: str, interval_seconds: float | None = None,
) -> StreamingQuery:
    """Append a change stream to Parquet files below ``out``, each micro-batch once."""
    return (
        changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**poll_trigger(interval_seconds)).start())


def stream_head_changes(heads: DataFrame, out: str, checkpoint: str, interval_seconds: float | None = None, **options) -> StreamingQuery:
    """``head_change_stream`` written to ``out``."""
    return write_changes(head_change_stream(heads, **options), out, checkpoint, interval_seconds)


def stream_status_changes(prs: DataFrame, out: str, checkpoint: str, interval_seconds: float | None = None, **options) -> StreamingQuery:
    """``status_change_stream`` written to ``out``."""
    return write_changes(status_change_stream(prs, **options), out, checkpoint, interval_seconds)


def stream_modified_since(users: DataFrame, out: str, checkpoint: str, interval_seconds: float | None = None, **options) -> StreamingQuery:
    """``modified_stream`` written to ``out``."""
    return write_changes(modified_stream(users, **options), out, checkpoint, interval_seconds)


def settled(spark: SparkSession, checkpoint: str, columns: Sequence[str], changes_from: int | None = None) -> DataFrame:
    """The last settled values that a change stream keeps below ``checkpoint``: its keys, and ``columns`` of its state.

    They can be the ``prior`` of a batch or of another stream. With ``changes_from`` the change feed of the state since that
    micro-batch instead, with ``batch_id`` and ``change_type``.
    """
    reader = spark.read.format("statestore").option("stateVarName", "last")
    extra = []
    if changes_from is not None:
        reader = reader.option("readChangeFeed", "true").option("changeStartBatchId", changes_from)
        extra = ["batch_id", "change_type"]
    return reader.load(checkpoint).select(*extra, "key.*", *[F.col(f"value.{c}").alias(c) for c in columns])
