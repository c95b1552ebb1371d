"""Demo queries: landed tables, sinks and streams, through the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from ..operators.capture import poll_windows
from ..operators.envelope import events_from_stream_records
from ..operators.identity import sync_datasets
from ..operators.metrics import as_metric_query
from ..session import new_dir
from ..sinks.acknowledged import refused_events, send_events, sent_events
from ..sinks.events import read_events, write_events
from ..sources.landed import land, poll_trigger, read_landed, union_shards
from ..sources.shards import read_shards
from ..streaming.acks import stream_ack_buffer
from ..streaming.changes import stream_head_changes, stream_modified_since, stream_status_changes
from ..streaming.counters import latest_counters, stream_queue_counters
from ..streaming.windows import (
    dedupe_redelivered, stream_log_capture, stream_log_windows, stream_metric_stat, stream_percentile)
from . import shapes
from .demo_capture import HEADS, LOG_CAPTURE, MODIFIED, OFF_TIES, STATUSES, modified_columns, rounded, status_columns
from .demo_events import COUNTERS_SQL, LOGS, SYNC, micros, record_list
from .registry import demo


def landed(spark, rows: DataFrame, kind: str, streaming: bool = False, fmt: str = "parquet") -> DataFrame:
    """``rows`` written as a landed table and read back."""
    path = new_dir(spark, kind)
    land(rows, kind, path, fmt)
    return read_landed(spark, kind, path, streaming=streaming, fmt=fmt)


@contextmanager
def state_partitions(spark) -> Iterator[None]:
    """No more state partitions than there are cores, for queries that run once."""
    key = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def drained(spark, stream: DataFrame, name: str) -> DataFrame:
    """All a stream gives from what is available, by way of a file sink."""
    out = new_dir(spark, name)
    with state_partitions(spark):
        query = (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", new_dir(spark, f"{name}-checkpoint")).trigger(**poll_trigger()).start())
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def batches(spark, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")


def in_steps(spark, rows: DataFrame, kind: str, at: str, steps: int = 3) -> DataFrame:
    """``rows`` landed in ``steps`` by time, one file each; a micro-batch of the stream that is returned reads one."""
    path = new_dir(spark, kind)
    cuts = rows.select(F.percentile_approx(at, [i / steps for i in range(1, steps)], 1000).alias("c")).first().c or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows if low is None else rows.where(F.col(at) > low)
        land((part if high is None else part.where(F.col(at) <= high)).coalesce(1), kind, path)
    return read_landed(spark, kind, path, streaming=True, max_files=1)


@demo("read_landed_queue_message", """
    SELECT event_id::VARCHAR AS id, props AS body, epoch_us(ts) AS time_us, event_type AS kind FROM events""")
def _(spark, sf):
    rows = landed(spark, shapes.queue_messages(spark, sf), "queue_message", fmt="json")
    return rows.select(
        F.col("MessageId").alias("id"), F.col("Body").alias("body"), micros("SentTimestamp"),
        F.col("MessageAttributes")["Event.Type"]["StringValue"].alias("kind"))


@demo("read_landed_object_event", """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS id, l_orderkey % 20 AS kind,
           CASE l_orderkey % 20 WHEN 0 THEN 'hello ' || l_partkey WHEN 1 THEN '{"Records":[]}'
                WHEN 2 THEN '{"Service":"Amazon S3","Event":"s3:TestEvent","Bucket":"bucket-' || (l_suppkey % 10) || '"}'
                WHEN 3 THEN '{"k":' || l_partkey || '}' WHEN 4 THEN '{"Records":"none"}' WHEN 5 THEN 'null' WHEN 6 THEN '[1,2]'
                ELSE '{"Records":[' || array_to_string(list_transform(generate_series(1, 1 + l_linenumber % 3), lambda i:
                    '{"awsRegion":"us-east-1",' || CASE WHEN l_orderkey % 20 = 7 THEN '' ELSE '"eventName":"' ||
                    CASE l_returnflag WHEN 'A' THEN 'ObjectCreated:Put' WHEN 'N' THEN 'ObjectRemoved:DeleteMarkerCreated'
                         ELSE 'ObjectRestore:Post' END || '",' END ||
                    '"s3":{"bucket":{"arn":"arn:aws:s3:::bucket-' || (l_suppkey % 10) || '","name":"bucket-' || (l_suppkey % 10) ||
                    '"},"object":{"key":"' || concat_ws('/', l_orderkey, l_linenumber, i) || '","size":' || l_quantity::BIGINT || '}}}'), ',') || ']}'
           END AS body
    FROM lineitem""")
def _(spark, sf):
    rows = landed(spark, shapes.object_messages(spark, sf).drop("MessageAttributes"), "object_event")
    order = F.substring_index("MessageId", "-", 1).cast("bigint")
    return rows.select(F.col("MessageId").alias("id"), (order % 20).alias("kind"), F.col("Body").alias("body"))


STREAM_RECORDS = """
    SELECT 'shard-' || (user_id % 4) AS shard_id, event_id::VARCHAR AS sequence, user_id::VARCHAR AS partition_key,
           epoch_us(ts) AS arrival_us, props AS payload FROM events"""


def record_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "shard_id", F.col("SequenceNumber").alias("sequence"), F.col("PartitionKey").alias("partition_key"),
        F.unix_micros("ApproximateArrivalTimestamp").alias("arrival_us"), F.decode("Data", "UTF-8").alias("payload"))


@demo("read_landed_stream_record", STREAM_RECORDS)
def _(spark, sf):
    return record_columns(landed(spark, shapes.stream_records(spark, sf), "stream_record"))


@demo("start_position", STREAM_RECORDS + " WHERE ts > TIMESTAMP '2024-01-10 06:00:00'")
def _(spark, sf):
    """Folders by day: only those from the start position on are opened."""
    path = new_dir(spark, "stream_record")
    land(shapes.stream_records(spark, sf), "stream_record", path, by_day=True)
    after = F.lit("2024-01-10 06:00:00").cast("timestamp")
    return record_columns(read_landed(spark, "stream_record", path, after=after, by_day=True))


@demo("sharded_source", STREAM_RECORDS)
def _(spark, sf):
    """A stream with an offset per shard, read as Arrow batches."""
    path = new_dir(spark, "shards")
    land(shapes.stream_records(spark, sf), "stream_record", path)
    return record_columns(drained(spark, read_shards(spark, "stream_record", path), "sharded"))


@demo("acknowledged_sink", f"""
    SELECT CASE WHEN event_id % 11 <> 0 THEN event_id::VARCHAR END AS id, '{shapes.STREAM_ARN}' AS source, epoch_us(ts) AS time_us,
           user_id::VARCHAR AS subject, props AS payload,
           CASE WHEN event_id % 11 = 0 THEN 'missing id' WHEN event_id % 13 = 0 THEN 'missing type' END AS error
    FROM events""")
def _(spark, sf):
    """Events that the sink took, and those it refused with their reason."""
    path, table = new_dir(spark, "to_send"), new_dir(spark, "sink")
    events = events_from_stream_records(shapes.stream_records(spark, sf), shapes.STREAM_ARN)
    number = F.col("id").cast("bigint")
    events = events.withColumns({"type": F.when(number % 13 != 0, F.col("type")), "id": F.when(number % 11 != 0, F.col("id"))})
    events.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    send_events(stream, table, new_dir(spark, "sink-checkpoint")).awaitTermination()
    refused = refused_events(spark, table).withColumn("time", F.timestamp_micros(F.col("time").cast("bigint")))
    payload = F.decode(F.unbase64(F.get_json_object("data", "$.Data")), "UTF-8").alias("payload")
    return sent_events(spark, table).withColumn("error", F.lit(None).cast("string")).drop("extensions").unionByName(
        refused.drop("extensions")).select("id", "source", micros(), "subject", payload, "error")


@demo("read_landed_change_record", """
    SELECT 'shard-' || (o_custkey % 4) AS shard_id, o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS customer FROM orders""")
def _(spark, sf):
    rows = landed(spark, shapes.change_records(spark, sf), "change_record")
    return rows.select(
        "shard_id", F.col("EventID").alias("id"),
        F.variant_get("Dynamodb.Keys", "$.o_custkey.N", "string").alias("customer"))


@demo("read_landed_log_event", f"WITH {LOGS} SELECT log_group, log_stream, stamp, ingested, props AS message FROM logs")
def _(spark, sf):
    return landed(spark, shapes.log_entries(spark, sf), "log_event").select(
        "log_group", "log_stream", F.col("Timestamp").alias("stamp"), F.col("IngestionTime").alias("ingested"),
        F.col("Message").alias("message"))


@demo("read_landed_metric_point", """
    SELECT 'Price' AS metric, l_returnflag AS flag, epoch_us(l_shipdate) AS time_us, l_extendedprice AS value
    FROM lineitem""")
def _(spark, sf):
    return landed(spark, shapes.price_points(spark, sf), "metric_point").select(
        "metric", F.col("dimensions")["ReturnFlag"].alias("flag"), micros("ts"), "value")


@demo("read_landed_perf_metric", """
    SELECT 'db.' || event_type AS metric, count(*) AS series, 2 * count(*) AS points FROM events GROUP BY 1""")
def _(spark, sf):
    rows = landed(spark, shapes.perf_series(spark, sf), "perf_metric")
    return rows.groupBy("metric").agg(
        F.count("*").alias("series"), F.sum(F.size("points").cast("bigint")).alias("points"))


@demo("read_landed_repo_snapshot", """
    SELECT 'head' AS kind, 'repo-' || user_id AS item, epoch_us(ts) AS poll_us, event_type AS state FROM events
    UNION ALL SELECT 'pr', user_id::VARCHAR, epoch_us(ts), event_type FROM events""")
def _(spark, sf):
    heads = landed(spark, shapes.branch_heads(spark, sf), "repo_snapshot")
    prs = landed(spark, shapes.pull_requests(spark, sf), "pr_snapshot")
    poll = F.unix_micros("poll_ts").alias("poll_us")
    return heads.select(F.lit("head").alias("kind"), F.col("repo").alias("item"), poll, F.col("commit_id").alias("state")).unionByName(
        prs.select(F.lit("pr").alias("kind"), F.col("pr_id").alias("item"), poll, F.col("status").alias("state")))


@demo("read_landed_sync_dataset", f"WITH {SYNC} SELECT identity, dataset, n, records FROM datasets")
def _(spark, sf):
    nested = sync_datasets(
        landed(spark, shapes.identities(spark, sf), "identity"),
        landed(spark, shapes.datasets(spark, sf), "dataset"),
        landed(spark, shapes.sync_records(spark, sf), "sync_record"))
    return nested.select(
        F.col("IdentityId").alias("identity"), F.col("DatasetName").alias("dataset"),
        F.size("DatasetRecords").cast("bigint").alias("n"), record_list(F.col("DatasetRecords")).alias("records"))


@demo("read_landed_user", """
    SELECT 'pool-' || (user_id % 3) AS pool, user_id::VARCHAR AS username, epoch_us(ts) AS time_us, event_type AS kind
    FROM events""")
def _(spark, sf):
    rows = landed(spark, shapes.users(spark, sf), "user", fmt="json")
    return rows.select(
        "pool", F.col("Username").alias("username"), micros("UserLastModifiedDate"),
        F.get("Attributes.Value", F.lit(0)).alias("kind"))


@demo("read_landed_notification", """
    SELECT epoch_us(ts) AS time_us, CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
           '/shop/nation_' || (user_id % 30) AS path, 3::BIGINT AS n_headers
    FROM events""")
def _(spark, sf):
    return landed(spark, shapes.http_requests(spark, sf), "notification").select(
        micros("received"), "method", "path", F.size("headers").cast("bigint").alias("n_headers"))


@demo("write_events", f"""
    SELECT event_id::VARCHAR AS id, '{shapes.STREAM_ARN}' AS source, 'com.amazon.kinesis.stream_record' AS type,
           user_id::VARCHAR AS subject, epoch_us(ts) AS time_us, props AS payload, 'NONE' AS encryption
    FROM events""")
def _(spark, sf):
    path = new_dir(spark, "events")
    write_events(events_from_stream_records(shapes.stream_records(spark, sf), shapes.STREAM_ARN), path)
    return read_events(spark, path).select(
        "id", "source", "type", "subject", micros(),
        F.decode(F.unbase64(F.get_json_object("data", "$.Data")), "UTF-8").alias("payload"),
        F.get_json_object("data", "$.EncryptionType").alias("encryption"))


@demo("stream_head_changes", HEADS)
def _(spark, sf):
    heads = in_steps(spark, shapes.branch_heads(spark, sf), "repo_snapshot", "poll_ts")
    out = new_dir(spark, "head_changes")
    with state_partitions(spark):
        stream_head_changes(heads, out, new_dir(spark, "head_changes-checkpoint")).awaitTermination()
    return batches(spark, out).where("NOT late").select(
        "repo", F.unix_micros("poll_ts").alias("poll_us"), "commit_id", F.col("previous_commit").alias("previous"))


@demo("stream_status_changes", STATUSES)
def _(spark, sf):
    prs = in_steps(spark, shapes.pull_requests(spark, sf), "pr_snapshot", "poll_ts")
    out = new_dir(spark, "status_changes")
    with state_partitions(spark):
        stream_status_changes(prs, out, new_dir(spark, "status_changes-checkpoint")).awaitTermination()
    return status_columns(batches(spark, out).where("NOT late"))


@demo("stream_modified_since", MODIFIED)
def _(spark, sf):
    users = in_steps(spark, shapes.users(spark, sf), "user", "poll_ts")
    out = new_dir(spark, "modified_since")
    with state_partitions(spark):
        stream_modified_since(users, out, new_dir(spark, "modified_since-checkpoint")).awaitTermination()
    return modified_columns(batches(spark, out).where("NOT late"))


@demo("stream_ack_buffer", """
    WITH buffers AS (
        SELECT 'q-' || (event_id % 5) AS queue, ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 4 AS worker,
               count(*) // 10 AS batches
        FROM events GROUP BY 1, 2)
    SELECT queue, worker, batches, 10 * batches AS entries FROM buffers WHERE batches > 0""")
def _(spark, sf):
    """Full batches only: what is left in a buffer stays in the query's state."""
    path = new_dir(spark, "acks")
    shapes.events(spark, sf).select(
        shapes.numbered("q-", F.col("event_id") % 5).alias("queue"), "ts",
        shapes.text("event_id").alias("MessageId"), shapes.numbered("r-", F.col("event_id")).alias("ReceiptHandle"),
    ).write.parquet(path)
    acks = spark.readStream.schema("queue string, ts timestamp, MessageId string, ReceiptHandle string").parquet(path)
    # no flush by time within the span of the table
    buffered = stream_ack_buffer(acks, flush_seconds=400 * 86_400, workers=4, event_time=True)
    flushed = drained(spark, buffered, "ack_buffer")
    sized = flushed.groupBy("queue", "worker", "batch").agg(F.count("*").alias("n"))
    return sized.groupBy("queue", "worker").agg(F.count("*").alias("batches"), F.sum("n").alias("entries"))


CLOSED = """
    WITH bound AS (SELECT max(epoch(ts)) AS top FROM events WHERE event_type = 'click'),
    closed AS (
        SELECT epoch_us(ts) // 1000000 // 3600 * 3600 AS start, value FROM events WHERE event_type = 'click')
"""


@demo("stream_metric_stat", CLOSED + """
    SELECT 'clicks' AS id, start, round(sum(value), 4) AS value FROM closed, bound
    WHERE start + 3600 <= top GROUP BY start""")
def _(spark, sf):
    points = landed(spark, shapes.event_points(spark, sf), "metric_point", streaming=True)
    query = as_metric_query(spark, "clicks", "Shop", "click", 3600, "Sum")
    closed = drained(spark, stream_metric_stat(points, query, 3600), "metric_stat")
    return closed.select("id", F.unix_seconds("ts").alias("start"), F.round("value", 4).alias("value"))


PERIODS = [("minutes", "click", 300, "Sum"), ("hours", "click", 3600, "Average"), ("days", "view", 86_400, "Maximum"),
           ("counts", "view", 3600, "SampleCount"), ("least", "click", 86_400, "Minimum")]


@demo("stream_metric_periods", """
    WITH points AS (SELECT event_type, value, epoch_us(ts) // 1000000 AS s FROM events WHERE event_type IN ('click', 'view')),
    bound AS (SELECT max(epoch_us(ts)) / 1000000.0 AS top FROM events WHERE event_type IN ('click', 'view'))
    """ + " UNION ALL ".join(f"""
    SELECT '{id}' AS id, s // {period} * {period} AS start, round({call} + {OFF_TIES}, 4) AS value FROM points, bound
    WHERE event_type = '{metric}' GROUP BY 2, top HAVING s // {period} * {period} + {period} <= top"""
                             for (id, metric, period, _), call in zip(PERIODS, (
                                 "sum(value)", "avg(value)", "max(value)", "count(value)::DOUBLE", "min(value)"))))
def _(spark, sf):
    """Three periods in one query table, over several micro-batches."""
    points = in_steps(spark, shapes.event_points(spark, sf), "metric_point", "ts")
    queries = union_shards(*[as_metric_query(spark, id, "Shop", metric, period, stat) for id, metric, period, stat in PERIODS])
    closed = drained(spark, stream_metric_stat(points, queries), "metric_periods")
    return closed.select("id", F.unix_seconds("ts").alias("start"), rounded())


@demo("stream_percentile", CLOSED + """
    SELECT 'p90' AS id, start, round(quantile_cont(value, 0.9), 4) AS value FROM closed, bound
    WHERE start + 3600 <= top GROUP BY start""")
def _(spark, sf):
    points = landed(spark, shapes.event_points(spark, sf), "metric_point", streaming=True)
    query = as_metric_query(spark, "p90", "Shop", "click", 3600, "p90")
    out = new_dir(spark, "percentile")
    with state_partitions(spark):
        stream_percentile(points, query, 3600, out, new_dir(spark, "percentile-checkpoint")).awaitTermination()
    return batches(spark, out).select("id", F.unix_seconds("ts").alias("start"), F.round("value", 4).alias("value"))


@demo("stream_log_capture", f"""
    WITH {LOGS}
    SELECT log_group, log_stream, stamp, stamp // 300000 * 300000 AS start_ms, stamp // 300000 * 300000 + 300000 AS end_ms,
           ingested > stamp // 300000 * 300000 + 300000 AS late
    FROM logs""")
def _(spark, sf):
    logs = landed(spark, shapes.log_entries(spark, sf), "log_event", streaming=True)
    return drained(spark, stream_log_capture(logs, 300), "log_capture").select(
        "log_group", "log_stream", F.col("Timestamp").alias("stamp"), "start_ms", "end_ms", "late")


@demo("stream_log_windows", LOG_CAPTURE)
def _(spark, sf):
    """Entries and poll windows of uneven length, both as streams of several micro-batches."""
    ticks = shapes.events(spark, sf).where("event_type = 'purchase'").select(
        shapes.numbered("shop-", F.col("user_id") % 4).alias("log_group"), F.col("ts").alias("tick"))
    path = new_dir(spark, "windows")
    windows = poll_windows(ticks, 300, source="log_group").select("log_group", "start_ms", "end_ms")
    windows.repartition(3).write.parquet(path)
    spans = spark.readStream.schema(windows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    logs = landed(spark, shapes.log_entries(spark, sf), "log_event", streaming=True)
    return drained(spark, stream_log_windows(logs, spans, longest="60 days", delay="400 days"), "log_windows").select(
        "log_group", "log_stream", F.col("Timestamp").alias("stamp"), "start_ms", "end_ms", "late")


@demo("stream_queue_counters", COUNTERS_SQL)
def _(spark, sf):
    """Counters per tag after every micro-batch; the newest row of each tag."""
    path, out = new_dir(spark, "queue_log"), new_dir(spark, "counters")
    log = shapes.queue_log(spark, sf)
    log.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)
    with state_partitions(spark):
        stream_queue_counters(stream, out, new_dir(spark, "counters-checkpoint")).awaitTermination()
    return latest_counters(spark.read.parquet(out))


@demo("dedupe_redelivered", f"""
    SELECT DISTINCT event_id::VARCHAR AS id, '{shapes.STREAM_ARN}' AS source FROM events""")
def _(spark, sf):
    """Every record is delivered twice."""
    path = new_dir(spark, "redelivered")
    records = shapes.stream_records(spark, sf)
    land(records, "stream_record", path)
    land(records, "stream_record", path)
    events = events_from_stream_records(
        read_landed(spark, "stream_record", path, streaming=True), shapes.STREAM_ARN)
    return drained(spark, dedupe_redelivered(events, "60 days"), "deduped").select("id", "source")
