"""Streams with keyed state over several micro-batches: out of order, split, empty and late input."""

import random
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from tideline.operators.capture import head_changes, log_capture, modified_since, status_changes
from tideline.operators.messages import queue_counters
from tideline.operators.metrics import as_metric_query, metric_stat
from tideline.session import configure, new_dir
from tideline.sources.landed import land, poll_trigger, read_landed, union_shards
from tideline.streaming.acks import AckBuffer
from tideline.streaming.changes import (
    ValueChanges, _tops, head_change_stream, modified_stream, settled, status_change_stream, stream_head_changes,
    stream_status_changes)
from tideline.streaming.counters import LiveCounters, latest_counters, observe_counters, stream_queue_counters
from tideline.streaming.windows import dedupe_redelivered, entry_buckets, stream_log_windows, stream_metric_stat, undated, window_buckets

HEADS = "repo string, branch string, s double, commit_id string"
PRS = "repo string, pr_id string, s double, status string"
USERS = "pool string, s double, Username string, m double"


@pytest.fixture(autouse=True)
def settings(spark):
    configure(spark)


class Steps:
    """A folder of micro-batches, and a stream that reads one of them at a time."""

    def __init__(self, spark, schema, at=True):
        self.spark, self.schema, self.path, self.at = spark, schema, new_dir(spark, "steps"), at
        self.out, self.checkpoint = new_dir(spark, "out"), new_dir(spark, "checkpoint")

    def frame(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        return df.withColumn("poll_ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint"))).drop("s") if self.at else df

    def add(self, rows):
        self.frame(rows).coalesce(1).write.mode("append").parquet(self.path)
        return self

    def stream(self):
        return self.spark.readStream.schema(self.frame([]).schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def run(self, operator):
        out = operator(self.stream())
        (out.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.checkpoint)
         .trigger(**poll_trigger()).start().awaitTermination())
        return self.spark.read.schema(out.schema).parquet(self.out)


def seconds(column="poll_ts"):
    return (F.unix_micros(column) / 1_000_000).alias("s")


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*[seconds() if c == "s" else c for c in columns]).collect()), key=str)


def shuffled_heads(seed, n=120):
    rng = random.Random(seed)
    return [(rng.choice("rst"), rng.choice(["main", "dev"]), float(i), rng.choice(["a", "b", "c", None])) for i in range(n)]


def test_heads_out_of_order(spark):
    """Polls that arrive up to ten seconds late give what the batch operator gives over all of them."""
    rows = shuffled_heads(1)
    arrived = sorted(rows, key=lambda r: r[2] + random.Random(r[2]).random() * 9)
    ends = [(r, b, 1e6, "end") for r in "rst" for b in ("main", "dev")]  # lets the last polls settle
    steps = Steps(spark, HEADS).add(arrived[:30]).add(arrived[30:35]).add(arrived[35:100]).add(arrived[100:]).add(ends)
    got = steps.run(lambda s: head_change_stream(s, delay="10 seconds")).where("commit_id <> 'end' OR commit_id IS NULL")
    want = head_changes(steps.frame(rows))
    columns = ("repo", "branch", "s", "commit_id", "previous_commit")
    assert rows_of(got, *columns) == rows_of(want, *columns) and not got.where("late").count() and want.count() > 40


def test_late_heads_are_marked(spark):
    steps = Steps(spark, HEADS).add([("r", "m", 5.0, "a"), ("r", "m", 9.0, "b")]).add([("r", "m", 7.0, "x"), ("r", "m", 11.0, "b")])
    got = steps.run(head_change_stream)
    assert rows_of(got, "s", "commit_id", "previous_commit", "late") == [(7.0, "x", None, True), (9.0, "b", "a", False)]


def test_state_goes_on_after_a_restart_and_from_a_prior(spark):
    steps = Steps(spark, HEADS).add([("r", "m", 1.0, "a")])
    steps.run(head_change_stream)
    steps.add([("r", "m", 2.0, "b"), ("q", "m", 2.0, "z")])
    assert rows_of(steps.run(head_change_stream), "repo", "s", "commit_id") == [("r", 2.0, "b")]
    known = settled(spark, steps.checkpoint, ["at", "value"])
    assert sorted(map(tuple, known.collect())) == [("q", "m", 2_000_000, "z"), ("r", "m", 2_000_000, "b")]
    feed = settled(spark, steps.checkpoint, ["value"], changes_from=1)
    assert sorted((r.repo, r.value) for r in feed.collect() if r.change_type == "update") == [("q", "z"), ("r", "b")]
    prior = known.select("repo", "branch", F.timestamp_micros("at").alias("poll_ts"), F.col("value").alias("commit_id"))
    more = Steps(spark, HEADS).add([("r", "m", 3.0, "c"), ("q", "m", 3.0, "z"), ("q", "m", 0.5, "y")])
    got = more.run(lambda s: head_change_stream(s, prior=prior))
    assert rows_of(got, "repo", "commit_id", "previous_commit", "late") == [("q", "y", None, True), ("r", "c", "b", False)]


def polls(seed, n=40, items=12):
    """Polls of two repositories, each a list of requests with their status; requests come up over time."""
    rng = random.Random(seed)
    return [(repo, f"{repo}{k}", 1000.0 + t, rng.choice(["OPEN", "CLOSED", "MERGED"])) for t in range(n) for repo in ("p", "q")
            for k in range(items) if rng.random() < 0.5 and k <= 2 + t // 3]


STATUS = ("repo", "pr_id", "s", "status", "previous_status")


def test_first_poll_in_parts(spark):
    rows = polls(3)
    first = [r for r in rows if r[2] == 1000.0]
    rest = [r for r in rows if r[2] > 1000.0]
    steps = Steps(spark, PRS).add(first[:1]).add(first[1:]).add(rest[:100]).add(rest[100:101]).add(rest[101:])
    got = steps.run(status_change_stream)
    want = status_changes(steps.frame(rows))
    assert rows_of(got, *STATUS) == rows_of(want, *STATUS) and want.count() > 100
    assert {r[2] for r in first} & {r[2] for r in rows_of(got, *STATUS)} == set()


def test_statuses_out_of_order(spark):
    rows = polls(4)
    arrived = sorted(rows, key=lambda r: r[2] + random.Random(str(r)).random() * 4)
    ends = [(repo, None, 1e6, None) for repo in "pq"]
    steps = Steps(spark, PRS)
    for i in range(0, len(arrived), 90):
        steps.add(arrived[i:i + 90])
    got = steps.add(ends).run(lambda s: status_change_stream(s, delay="5 seconds", parts=3))
    assert rows_of(got, *STATUS) == rows_of(status_changes(steps.frame(rows)), *STATUS)


def test_empty_first_poll_is_baseline(spark):
    rows = [("r", None, 1.0, None), ("r", "1", 2.0, "OPEN"), ("s", "1", 2.0, "OPEN"), ("s", "2", 3.0, "OPEN"), ("r", "1", 3.0, "OPEN")]
    steps = Steps(spark, PRS).add(rows[:1]).add(rows[1:4]).add(rows[4:])
    got = steps.run(status_change_stream)
    assert rows_of(got, "repo", "pr_id", "s") == [("r", "1", 2.0), ("s", "2", 3.0)]
    prior = steps.frame([("t", "1", 0.0, "OPEN")])
    more = Steps(spark, PRS).add([("t", "1", 1.0, "CLOSED"), ("t", "2", 1.0, "OPEN"), ("t", "3", 1.0, "OPEN"), ("u", "1", 1.0, "OPEN")])
    got = more.run(lambda s: status_change_stream(s, prior=prior))
    assert rows_of(got, "repo", "pr_id", "previous_status") == [("t", "1", "OPEN"), ("t", "2", None), ("t", "3", None)]


def user_steps(spark, rows):
    steps = Steps(spark, USERS)
    frame = steps.frame
    steps.frame = lambda r: frame(r).withColumn("UserLastModifiedDate", F.timestamp_micros((F.col("m") * 1_000_000).cast("bigint"))).drop("m")
    return steps


def test_modified_users_in_parts(spark):
    rng = random.Random(6)
    rows = [(pool, float(t), f"u{k}", t * 10 + rng.random() * 25 - 12) for t in range(20) for pool in ("a", "b") for k in range(5)]
    rows += [("a", 3.0, "none", None), ("c", 2.0, "x", 1.0)]
    steps = user_steps(spark, rows)
    order = sorted(rows, key=lambda r: r[1])
    for i in range(0, len(order), 33):  # polls are cut in the middle
        steps.add(order[i:i + 33])
    columns = ("pool", "s", "Username", "mark")
    want = modified_since(steps.frame(rows))
    got = steps.run(modified_stream)
    # a row of a poll's first part is judged by the mark of earlier polls, as all of it is
    assert rows_of(got, *columns) == rows_of(want, *columns) and want.count() > 30


def test_modified_users_late_and_from_a_prior(spark):
    steps = user_steps(spark, []).add([("a", 1.0, "u", 5.0)]).add([("a", 2.0, "u", 6.0), ("a", 0.5, "w", 99.0)])
    got = steps.run(modified_stream)
    assert rows_of(got, "Username", "late") == [("u", False), ("w", True)]
    prior = spark.createDataFrame([("a", 7.0)], "pool string, m double").select("pool", F.timestamp_seconds("m").alias("mark"))
    more = user_steps(spark, []).add([("a", 3.0, "x", 6.5), ("a", 3.0, "y", 7.5)])
    assert rows_of(more.run(lambda s: modified_stream(s, prior=prior)), "Username") == [("y",)]


def test_written_changes(spark):
    steps = Steps(spark, HEADS).add([("r", "m", 1.0, "a"), ("r", "m", 2.0, "b")])
    stream_head_changes(steps.stream(), steps.out, steps.checkpoint).awaitTermination()
    assert spark.read.parquet(steps.out).count() == 1
    steps = Steps(spark, PRS).add([("r", "1", 1.0, "a"), ("r", "1", 2.0, "b")])
    stream_status_changes(steps.stream(), steps.out, steps.checkpoint, parts=1).awaitTermination()
    assert spark.read.parquet(steps.out).count() == 1


def test_several_periods_in_one_stream(spark):
    rng = random.Random(8)
    rows = [("ns", "mn"[i % 2], float(i), rng.gauss(0, 9) if i % 50 else float("nan")) for i in range(1500)]
    schema = "namespace string, metric string, s double, value double"
    steps = Steps(spark, schema)
    frame = steps.frame
    steps.frame = lambda r: frame(r).select(
        "namespace", "metric", F.create_map(F.lit("d"), F.lit("1")).alias("dimensions"), F.lit("u").alias("unit"), F.col("poll_ts").alias("ts"), "value")
    for i in range(0, 1500, 400):
        steps.add(rows[i:i + 400])
    queries = union_shards(*[as_metric_query(spark, f"q{i}", "ns", m, p, s) for i, (m, p, s) in enumerate([
        ("m", 60, "Sum"), ("m", 90, "Average"), ("n", 300, "Minimum"), ("n", 60, "Maximum"), ("m", 300, "SampleCount"), ("x", 60, "Sum")])])
    closed = steps.run(lambda s: stream_metric_stat(s, queries))
    want = {(r.id, int(r.ts.timestamp())): r.value for r in metric_stat(steps.frame(rows), queries).collect()}
    period = {"q0": 60, "q1": 90, "q2": 300, "q3": 60, "q4": 300}
    want = {k: v for k, v in want.items() if k[1] + period[k[0]] <= 1498}  # the last point is at 1499
    got = {(r.id, int(r.ts.timestamp())): r.value for r in closed.collect()}
    assert got.keys() == want.keys() and len(got) > 60
    assert {k: (got[k], want[k]) for k in want if got[k] != pytest.approx(want[k], nan_ok=True)} == {}


def test_redelivery_without_time_and_with_delay(spark):
    rows = [("a", "s", 1.0), ("b", "s", None), ("a", "s", 2.0), ("b", "s", 3.0), ("c", "s", None), ("z", "s", 50.0), ("y", "s", 51.0), ("a", "s", 100.0)]
    steps = Steps(spark, "id string, source string, s double")
    frame = steps.frame
    steps.frame = lambda r: frame(r).withColumnRenamed("poll_ts", "time")
    for row in rows[:3], rows[3:5], rows[5:6], rows[6:7], rows[7:]:
        steps.add(row)
    got = steps.run(lambda s: dedupe_redelivered(s, "10 seconds"))
    listed = lambda df: sorted((r.id, int(r.time.timestamp())) for r in df.collect())
    everything = steps.frame(rows)
    assert listed(got) == listed(dedupe_redelivered(everything, "10 seconds")) == [("a", 1), ("a", 100), ("b", 3), ("y", 51), ("z", 50)]
    assert sorted((r.id, r.error) for r in undated(everything).collect()) == [("b", "event without time"), ("c", "event without time")]
    assert sorted(r.id for r in dedupe_redelivered(everything, "1 second").collect()) == ["a", "a", "b", "y", "z"]


def test_log_windows_on_two_streams(spark):
    rng = random.Random(9)
    logs = [(f"g{i % 2}", "s", int(t), int(t + rng.randrange(0, 9000)), str(i)) for i, t in enumerate(sorted(rng.randrange(0, 900_000) for _ in range(300)))]
    cuts = sorted(rng.sample(range(0, 900_000), 12))
    spans = [(f"g{g}", a, b) for g in (0, 1) for a, b in zip(cuts, cuts[1:])] + [("g0", 5, 5)]
    left = Steps(spark, "log_group string, log_stream string, Timestamp bigint, IngestionTime bigint, Message string", at=False)
    right = Steps(spark, "log_group string, start_ms bigint, end_ms bigint", at=False)
    for i in range(3):
        left.add(logs[i * 100:i * 100 + 100])
        right.add(spans[2 * i * 4:2 * i * 4 + 8] if i < 2 else spans[16:])
    got = left.run(lambda s: stream_log_windows(s, right.stream(), longest="1 hour", delay="1 hour", lateness_ms=10))
    want = log_capture(left.frame(logs), right.frame(spans), lateness_ms=10)
    columns = ("Message", "start_ms", "end_ms", "late")
    assert rows_of(got, *columns) == rows_of(want, *columns) and want.where("late").count() > 0


def test_log_windows_that_are_short_and_many(spark):
    t = 1_704_067_200_000
    logs = [("g", "s", t + 37 * i, t + 37 * i + 1, str(i)) for i in range(600)]
    spans = [("g", t + a, t + b) for a, b in [*((500 * i, 500 * i + 500) for i in range(46)), (0, 9_000), (3_000, 3_001), (18_700, 37_450), (18_700, 37_451)]]
    left = Steps(spark, "log_group string, log_stream string, Timestamp bigint, IngestionTime bigint, Message string", at=False)
    right = Steps(spark, "log_group string, start_ms bigint, end_ms bigint", at=False)
    for i in range(2):
        left.add(logs[i::2])
        right.add(spans[i::2])
    got = left.run(lambda s: stream_log_windows(s, right.stream(), longest="1 hour", delay="1 hour"))
    want = log_capture(left.frame(logs), right.frame(spans))
    assert rows_of(got, "Message", "start_ms", "end_ms", "late") == rows_of(want, "Message", "start_ms", "end_ms", "late")
    # an entry is compared with few of the windows of its 300 s bucket
    entries, windows = entry_buckets(left.frame(logs), 300), window_buckets(right.frame([("g", t + 500 * i, t + 500 * i + 500) for i in range(600)]), 300)
    on = (F.col("log_group") == F.col("_group")) & (F.col("_width") == F.col("_wide")) & (F.col("_bucket") == F.col("_span"))
    assert entries.join(windows, on).groupBy("Message").count().agg(F.max("count")).first()[0] <= 40


def counter_rows(spark):
    rng = random.Random(2)
    measures = ["message_enqueued_process_count", "message_dequeued_delete_count", "queue_capacity_process", "queue_capacity_delete"]
    return [("g", f"ns{i % 2}", "q", float(i), rng.choice(measures), rng.randrange(90)) for i in range(300)]


def test_live_counters(spark):
    schema = "resource_group string, namespace string, name string, s double, measure string, value bigint"
    steps = Steps(spark, schema)
    frame = steps.frame
    steps.frame = lambda r: frame(r).withColumnRenamed("poll_ts", "ts")
    rows = counter_rows(spark)
    for i in range(3):
        steps.add(rows[i * 100:i * 100 + 100])
    live = LiveCounters()
    spark.streams.addListener(live)
    try:
        query = (observe_counters(steps.stream()).writeStream.format("noop").option("checkpointLocation", steps.checkpoint)
                 .trigger(**poll_trigger()).start())
        query.awaitTermination()
        for _ in range(100):
            if live.batches.get(str(query.id), -1) >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(live)
    everything = steps.frame(rows).withColumns({"namespace": F.lit("all")})
    assert live.counters(query) == queue_counters(everything).drop("resource_group", "namespace", "name").first().asDict()
    out, checkpoint = new_dir(spark, "counters"), new_dir(spark, "counters-checkpoint")
    stream_queue_counters(steps.stream(), out, checkpoint).awaitTermination()
    got = latest_counters(spark.read.parquet(out))
    want = queue_counters(steps.frame(rows))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_landed_by_day_is_pruned(spark):
    rows = spark.range(96).select(
        F.lit("r").alias("repo"), F.lit("m").alias("branch"), F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("poll_ts"),
        F.col("id").cast("string").alias("commit_id"))
    rows = rows.unionByName(rows.limit(1).withColumn("poll_ts", F.lit(None).cast("timestamp")))
    path = new_dir(spark, "by_day")
    land(rows, "repo_snapshot", path, by_day=True)
    at = lambda h: F.timestamp_seconds(F.lit(1_700_000_000 + h * 3600))
    for bounds, n in (({"after": at(70)}, 25), ({"start": at(70)}, 26), ({"start": at(10), "end": at(30)}, 20), ({"end": at(3)}, 3), ({}, 97)):
        found = read_landed(spark, "repo_snapshot", path, by_day=True, **bounds)
        assert found.count() == n and found.columns == ["repo", "branch", "poll_ts", "commit_id"]
    late = read_landed(spark, "repo_snapshot", path, by_day=True, after=at(70))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "arrival_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    with pytest.raises(ValueError, match="no time of arrival"):
        read_landed(spark, "identity", path, after=at(1))
    logs = spark.range(10).select(
        F.lit("g").alias("log_group"), F.lit("s").alias("log_stream"), (F.col("id") * 43_200_000).alias("Timestamp"),
        (F.col("id") * 43_200_000 + 5).alias("IngestionTime"), F.lit("x").alias("Message"))
    path = new_dir(spark, "logs_by_day")
    land(logs, "log_event", path, by_day=True)
    assert read_landed(spark, "log_event", path, by_day=True, start=43_200_000 * 3, end=43_200_000 * 7).count() == 4
    stream = read_landed(spark, "log_event", path, by_day=True, streaming=True, after=43_200_000 * 6)
    out = new_dir(spark, "out")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_dir(spark, "c")).trigger(**poll_trigger()).start()
     .awaitTermination())
    assert spark.read.parquet(out).count() == 3


class Asked:
    """A state variable of one group in memory, that counts how often it is asked or told."""

    calls = 0

    def __init__(self):
        self.kept = None

    def exists(self):
        Asked.calls += 1
        return self.kept is not None

    def get(self):
        Asked.calls += 1
        return self.kept

    def update(self, value):
        Asked.calls += 1
        self.kept = value


class Handle:
    getValueState = getListState = lambda self, *a: Asked()


def test_a_group_asks_its_state_three_times():
    """Groups are many: what one of them costs is what a stream of heads costs."""
    processor, row = ValueChanges(0), Row("repo", "branch", "at", "item", "value")
    processor.init(Handle())
    feed = lambda *rows: [(r.at, r.value, r.previous, r.late) for r in processor.handleInputRows(("r", "m"), (row("r", "m", a, None, v) for a, v in rows), None)]
    assert feed((2, "b"), (1, "a"), (3, "b")) == [(2, "b", "a", False)]
    Asked.calls = 0
    assert feed((5, None), (4, "b"), (1, "z")) == [(1, "z", None, True), (5, None, "b", False)]
    assert Asked.calls == 3


def test_a_pool_is_shared_by_tasks(spark):
    """Rows of one pool are in many groups, and each group learns the highest time of every poll."""
    rows = [("a", float(t), f"u{k}", float(t * 10 + (90 if (t, k) == (3, 5) else k))) for t in range(6) for k in range(20)]
    steps = user_steps(spark, rows)
    for i in range(0, len(rows), 50):
        steps.add(rows[i:i + 50])
    columns = ("pool", "s", "Username", "mark")
    assert rows_of(steps.run(modified_stream), *columns) == rows_of(modified_since(steps.frame(rows)), *columns)
    groups = settled(spark, steps.checkpoint, ["at", "top"]).collect()
    assert len({g.part for g in groups}) > 8 and {(g.at, g.top) for g in groups} == {(5_000_000, 120_000_000)}


def test_tops_of_polls_stay_small(spark):
    """What a task tells of its polls does not grow with its rows."""
    batch = lambda i: pa.RecordBatch.from_pydict({"pool": ["a", None] * 40_000, "at": [1, 2] * 40_000, "top": [i, None] * 40_000})
    told = pa.Table.from_batches(_tops(iter([batch(i) for i in (3, 9, 4)]))).to_pylist()
    assert sorted(map(str, told)) == sorted(map(str, [{"pool": "a", "at": 1, "top": 9}, {"pool": None, "at": 2, "top": None}]))

def test_full_requests_of_a_batch_come_in_one_frame():
    buffer = AckBuffer(10, 3, True)
    buffer.buffer, buffer.batches, buffer.handle = Asked(), Asked(), None
    buffer.buffer.clear = lambda: None
    told = []
    buffer.buffer.updateValue = lambda k, v: told.append((k[0], v[0]))
    buffer._restart_timer = told.append
    frame = pd.DataFrame({"ts": pd.to_datetime(range(1005), unit="s"), "MessageId": [f"{i:04}" for i in range(1005)], "ReceiptHandle": [f"r{i}" for i in range(1005)]})
    frames = list(buffer.handleInputRows(("q", 1), iter([frame.iloc[::-1]]), None))
    assert len(frames) == 1 and len(frames[0]) == 1000 and frames[0]["batch"].value_counts().to_dict() == {i: 10 for i in range(100)}
    assert told == [(f"{i}", f"r{i}") for i in range(1000, 1005)] + [1_000_000] and buffer.batches.kept == (100,)
