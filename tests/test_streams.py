"""Streams over several micro-batches give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from tideline.operators.capture import head_changes, modified_since, status_changes
from tideline.operators.messages import objects_from_messages
from tideline.operators.metrics import as_metric_query, metric_stat
from tideline.session import configure, new_dir
from tideline.sinks.events import read_events, stream_events
from tideline.sources.landed import land, poll_trigger, read_landed
from tideline.streaming.acks import stream_ack_buffer
from tideline.streaming.changes import stream_head_changes, stream_modified_since, stream_status_changes
from tideline.streaming.windows import dedupe_redelivered, stream_log_capture, stream_metric_stat, stream_percentile


@pytest.fixture(autouse=True)
def settings(spark):
    configure(spark)


def drain(spark, stream, out, checkpoint):
    query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(**poll_trigger()).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def polled(spark, n=60):
    """Polls of three keys over time; the first key has most of the rows."""
    key = F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).otherwise("hot")
    return spark.range(n).select(
        F.lit("r").alias("repo"), F.lit("main").alias("branch"), key.alias("pr_id"),
        F.timestamp_seconds(F.col("id") * 400).alias("poll_ts"), "id",
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") * 7 % 11 % 3 + 1).cast("int")).alias("value"))


def land_in_steps(rows, kind, path, steps=3, size=20):
    for i in range(steps):
        land(rows.where((F.col("id") >= i * size) & (F.col("id") < (i + 1) * size)).coalesce(1), kind, path)


def same(left, right):
    columns = sorted(right.columns)
    assert sorted(map(tuple, left.select(columns).collect())) == sorted(map(tuple, right.collect() and right.select(columns).collect()))


def test_head_changes_across_batches(spark):
    rows = polled(spark).withColumn("commit_id", F.col("value")).withColumn("repo", F.col("pr_id"))
    path, out, checkpoint = (new_dir(spark, x) for x in ("heads", "out", "checkpoint"))
    for i in range(3):
        land_in_steps(rows.where((F.col("id") >= i * 20) & (F.col("id") < (i + 1) * 20)), "repo_snapshot", path, 3)
        stream = read_landed(spark, "repo_snapshot", path, streaming=True, max_files=1)
        stream_head_changes(stream, out, checkpoint).awaitTermination()
    same(spark.read.parquet(out).drop("batch"), head_changes(rows.select("repo", "branch", "poll_ts", "commit_id")))


def test_status_changes_across_batches(spark):
    rows = polled(spark).withColumn("status", F.col("value"))
    path, out, checkpoint = (new_dir(spark, x) for x in ("prs", "out", "checkpoint"))
    for i in range(3):
        land(rows.where((F.col("id") >= i * 20) & (F.col("id") < (i + 1) * 20)), "pr_snapshot", path)
        stream_status_changes(read_landed(spark, "pr_snapshot", path, streaming=True), out, checkpoint).awaitTermination()
    same(spark.read.parquet(out).drop("batch"), status_changes(rows.select("repo", "pr_id", "poll_ts", "status")))


def test_modified_since_across_batches(spark):
    rows = polled(spark).select(
        "id", F.lit("p").alias("pool"), F.date_trunc("hour", "poll_ts").alias("poll_ts"), F.col("value").alias("Username"),
        F.timestamp_seconds(F.col("id") * 400 - F.col("id") % 4 * 900 + 100_000).alias("UserLastModifiedDate"))
    path, out, checkpoint = (new_dir(spark, x) for x in ("users", "out", "checkpoint"))
    for i in range(3):
        # whole hours per step: nine polls of 400 s
        land(rows.where((F.col("id") >= i * 18) & (F.col("id") < (i + 1) * 18)), "user", path)
        stream_modified_since(read_landed(spark, "user", path, streaming=True), out, checkpoint).awaitTermination()
    landed = read_landed(spark, "user", path)
    want = modified_since(landed).select("Username", "poll_ts", "UserLastModifiedDate", "mark")
    assert want.count() > 0
    same(spark.read.parquet(out), want)


def test_metrics_on_a_stream(spark):
    rows = spark.range(600).select(
        "id", F.lit("ns").alias("namespace"), F.lit("m").alias("metric"), F.lit("u").alias("unit"), F.create_map(F.lit("d"), F.lit("1")).alias("dimensions"),
        F.timestamp_seconds("id").alias("ts"), (F.col("id") * 37 % 101).cast("double").alias("value"))
    path = new_dir(spark, "points")
    sums, p90 = (as_metric_query(spark, s, "ns", "m", 60, s) for s in ("Sum", "p90"))
    out = {n: (new_dir(spark, n), new_dir(spark, f"{n}-checkpoint")) for n in ("sums", "p90")}
    for i in range(3):
        land(rows.where((F.col("id") >= i * 200) & (F.col("id") < (i + 1) * 200)), "metric_point", path)
        stream = read_landed(spark, "metric_point", path, streaming=True)
        closed = drain(spark, stream_metric_stat(stream, sums, 60), *out["sums"])
        stream_percentile(stream, p90, 60, *out["p90"]).awaitTermination()
    # the last minute is still open
    end = F.col("ts") < F.timestamp_seconds(F.lit(540))
    same(closed, metric_stat(rows, sums).where(end))
    same(spark.read.parquet(out["p90"][0]), metric_stat(rows, p90).where(end))


def test_log_capture_on_a_stream(spark):
    rows = spark.createDataFrame([("g", "s", 299_999, 300_000, "a"), ("g", "s", 1, 300_001, "b")],
                                 "log_group string, log_stream string, Timestamp bigint, IngestionTime bigint, Message string")
    path = new_dir(spark, "logs")
    land(rows, "log_event", path)
    stream = stream_log_capture(read_landed(spark, "log_event", path, streaming=True), 300)
    got = drain(spark, stream, new_dir(spark, "out"), new_dir(spark, "checkpoint"))
    assert {(r.Message, r.start_ms, r.end_ms, r.late) for r in got.collect()} == {("a", 0, 300_000, False), ("b", 0, 300_000, True)}


def test_redelivered_events_across_batches(spark):
    rows = spark.range(40).select(
        (F.col("id") % 10).cast("string").alias("id"), F.lit("s").alias("source"), F.timestamp_seconds("id").alias("time"))
    path, out, checkpoint = (new_dir(spark, x) for x in ("events", "out", "checkpoint"))
    for _ in range(2):
        rows.repartition(4).write.mode("append").parquet(path)
        stream = dedupe_redelivered(spark.readStream.schema(rows.schema).parquet(path))
        got = drain(spark, stream, out, checkpoint)
    assert sorted(r.id for r in got.collect()) == [str(i) for i in range(10)]
    assert dedupe_redelivered(rows).count() == 10


def test_ack_buffer_flushes_by_size_and_time(spark):
    rows = spark.range(60).select(
        F.lit("q").alias("queue"), F.timestamp_seconds(F.col("id") + 1000).alias("ts"), F.col("id").cast("string").alias("MessageId"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("ReceiptHandle"), "id")
    path, out, checkpoint = (new_dir(spark, x) for x in ("acks", "out", "checkpoint"))
    for low, high in ((0, 25), (25, 60)):
        rows.where((F.col("id") >= low) & (F.col("id") < high)).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path).drop("id")
        got = drain(spark, stream_ack_buffer(stream, flush_seconds=3, workers=1, event_time=True), out, checkpoint)
    sizes = {r.batch: r.n for r in got.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    entries = [r.MessageId for r in got.collect()]
    assert len(entries) == len(set(entries)) and max(sizes.values()) == 10
    assert sum(sizes.values()) == 60 and any(n < 10 for n in sizes.values())


def test_events_stream_splits_dead_letters(spark):
    rows = spark.createDataFrame([("1", "plain"), ("2", '{"Records":[{}]}')], "MessageId string, Body string")
    path, out, dead, checkpoint = (new_dir(spark, x) for x in ("messages", "out", "dead", "checkpoint"))
    land(rows, "object_event", path)
    events = objects_from_messages(read_landed(spark, "object_event", path, streaming=True), "arn")
    stream_events(events, out, dead, checkpoint).awaitTermination()
    assert [r.id for r in read_events(spark, f"{out}/batch=0").collect()] == ["1"]
    assert spark.read.parquet(dead).first().error.startswith("missing eventName")


def test_start_position(spark):
    path = new_dir(spark, "heads")
    land(polled(spark), "repo_snapshot", path)
    after = F.timestamp_seconds(F.lit(400 * 50))
    assert read_landed(spark, "repo_snapshot", path, after=after).count() == 9
