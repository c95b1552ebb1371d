"""The sharded source and the acknowledging sink."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.session import configure, new_dir
from tideline.sinks.acknowledged import EventWriter, Taken, commits, refused_events, send_events, sent_events
from tideline.sources.landed import poll_trigger
from tideline.sources.shards import Shards, read_shards


@pytest.fixture(autouse=True)
def settings(spark):
    configure(spark)


class Table:
    """A sharded table that a test reshards."""

    def __init__(self, spark):
        self.spark, self.path = spark, new_dir(spark, "shards").removeprefix("file:")
        self.out, self.checkpoint = new_dir(spark, "out"), new_dir(spark, "checkpoint")
        self.made = 0

    def put(self, shard, *sequences):
        self.made += 1
        folder = f"{self.path}/shard_id={shard}"
        os.makedirs(folder, exist_ok=True)
        rows = self.spark.createDataFrame([(str(s),) for s in sequences], "SequenceNumber string").withColumn("Data", F.encode("SequenceNumber", "UTF-8"))
        rows.toPandas().to_parquet(f"{folder}/{self.made:06d}.parquet")

    def mark(self, shard, name, text=""):
        os.makedirs(f"{self.path}/shard_id={shard}", exist_ok=True)
        with open(f"{self.path}/shard_id={shard}/{name}", "w") as f:
            f.write(text)

    def drain(self):
        stream = read_shards(self.spark, "stream_record", self.path)
        (stream.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.checkpoint)
         .trigger(**poll_trigger()).start().awaitTermination())
        written = self.spark.read.parquet(self.out).select("*", "_metadata")
        order = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "row_index")]
        return [(r.shard_id, r.SequenceNumber) for r in written.orderBy(*order).collect()]


def test_reshard_without_loss_or_repeats(spark):
    table = Table(spark)
    table.put("a", 1, 2)
    table.put("b", 3)
    assert Counter(table.drain()) == Counter([("a", "1"), ("a", "2"), ("b", "3")])
    table.mark("c", "_parent", "a")
    table.put("c", 10)  # its parent is not sealed yet
    table.put("a", 4)
    assert Counter(table.drain()) == Counter([("a", "1"), ("a", "2"), ("b", "3"), ("a", "4")])
    table.mark("a", "_sealed")
    table.put("b", 5, 6)
    assert len(table.drain()) == 7
    table.mark("c", "_sealed")
    table.mark("b", "_sealed")
    table.mark("d", "_parent", "b c")
    table.put("d", 20, 21)
    assert Counter(s for _, s in table.drain()) == Counter("1 2 3 4 5 6 10 20 21".split())
    assert Counter(s for _, s in table.drain()) == Counter("1 2 3 4 5 6 10 20 21".split())  # nothing new


def test_children_come_after_their_parents(spark):
    table = Table(spark)
    for shard, parent, n in (("d", "b c", 9), ("b", "a", 5), ("c", "a", 6), ("a", "", 1)):
        table.put(shard, n)
        table.put(shard, n + 100)
        table.mark(shard, "_sealed")
        if parent:
            table.mark(shard, "_parent", parent)
    table.put("z", 50)
    order = [shard for shard, _ in table.drain() if shard != "z"]
    assert order[:2] == ["a", "a"] and order[-2:] == ["d", "d"] and Counter(order) == Counter("aabbccdd")
    assert Shards(table.path).open().index("d") > Shards(table.path).open().index("c")
    table.mark("e", "_parent", "gone")  # a parent whose folder was removed
    table.put("e", 70)
    assert ("e", "70") in table.drain()


def envelopes(spark, rows):
    df = spark.createDataFrame(rows, "id string, type string, data string")
    return df.select(
        "id", F.lit("s").alias("source"), F.lit("1.0").alias("specversion"), "type", F.lit(None).cast("string").alias("subject"),
        F.timestamp_seconds(F.lit(7)).alias("time"), F.lit("application/json").alias("datacontenttype"),
        F.create_map(F.lit("k"), F.col("id")).alias("extensions"), "data")


def test_refused_events_are_dead_letters(spark):
    path, table, checkpoint = (new_dir(spark, x) for x in ("events", "sink", "checkpoint"))
    steps = [[("1", "t", "{}"), (None, "t", "{}")], [("2", "", "{}"), ("3", "t", "x" * 50)], [("4", "t", None)]]
    for step in steps:
        envelopes(spark, step).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        send_events(stream, table, checkpoint, largest=40).awaitTermination()
    got = {r.id: r for r in sent_events(spark, table).collect()}
    assert set(got) == {"1", "4"} and got["1"].extensions == {"k": "1"} and got["4"].data is None and got["1"].time.timestamp() == 7
    assert {(r.id, r.error) for r in refused_events(spark, table).collect()} == {
        (None, "missing id"), ("2", "missing type"), ("3", "data of more than 40 bytes")}
    assert [(c["taken"], c["refused"]) for c in commits(table)] == [(1, 1), (0, 2), (1, 0)]


def test_a_replay_commits_once(spark):
    table = new_dir(spark, "sink")
    writer = EventWriter(table, 100)
    rows = envelopes(spark, [("1", "t", "{}"), (None, "t", "{}")]).withColumns(
        {"time": F.lit("0"), "extensions": F.lit("{}")}).toArrow().to_batches()
    first, again = writer.write(iter(rows)), writer.write(iter(rows))
    assert isinstance(first, Taken) and (first.taken, first.refused) == (1, 1)
    writer.commit([first, None], 3)
    writer.commit([again], 3)
    assert sent_events(spark, table).count() == 1 and refused_events(spark, table).count() == 1 and len(commits(table)) == 1
    failed = writer.write(iter(rows))
    writer.abort([failed, None], 4)
    assert sent_events(spark, table).count() == 1
    assert sent_events(spark, new_dir(spark, "nothing")).count() == 0
