"""Demo queries: the data of every kind of event read back as its payload type."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.envelope import (
    events_from_change_records, events_from_logs, events_from_messages, events_from_metrics, events_from_notifications,
    events_from_perf, events_from_repo, events_from_sync, events_from_users)
from ..operators.messages import objects_from_messages
from ..operators.metrics import metric_results, metric_stat, perf_points
from ..operators.payload import typed_payload
from ..operators.routing import route_notifications
from . import shapes
from .demo_events import LOGS, PERF, REQUESTS, SYNC, clicks_per_hour, micros, nested_datasets, record_list
from .registry import demo


def field(path: str, name: str):
    return F.col(f"payload.{path}").alias(name)


@demo("typed_payload_queue_message", """
    SELECT event_id::VARCHAR AS id, props AS body, md5(props) AS digest, 'r-' || event_id AS receipt, event_type AS kind,
           value::VARCHAR AS amount, epoch_us(ts) // 1000 AS sent_ms
    FROM events""")
def _(spark, sf):
    events = events_from_messages(shapes.queue_messages(spark, sf), shapes.QUEUE_ARN)
    text = lambda name: F.col("payload.MessageAttributes")[name]["StringValue"]
    return typed_payload(events, "queue_message").select(
        field("MessageId", "id"), field("Body", "body"), field("MD5OfBody", "digest"), field("ReceiptHandle", "receipt"),
        text("Event.Type").alias("kind"), text("Amount").alias("amount"),
        F.col("payload.Attributes")["SentTimestamp"].cast("bigint").alias("sent_ms"))


@demo("typed_payload_object_event", """
    WITH i AS (SELECT *, unnest(generate_series(1, 1 + l_linenumber % 3)) AS n FROM lineitem WHERE l_orderkey % 20 > 7)
    SELECT CASE l_returnflag WHEN 'A' THEN 'ObjectCreated:Put' WHEN 'N' THEN 'ObjectRemoved:DeleteMarkerCreated' ELSE 'ObjectRestore:Post' END AS name,
           'us-east-1' AS region, 'bucket-' || (l_suppkey % 10) AS bucket, concat_ws('/', l_orderkey, l_linenumber, n) AS key,
           l_quantity::BIGINT AS size
    FROM i""")
def _(spark, sf):
    events = objects_from_messages(shapes.object_messages(spark, sf), shapes.QUEUE_ARN)
    objects = events.where((F.size("errors") == 0) & F.col("subject").isNotNull())
    return typed_payload(objects, "object_event").select(
        field("eventName", "name"), field("awsRegion", "region"), field("s3.bucket.name", "bucket"), field("s3.object.key", "key"),
        field("s3.object.size", "size"))


@demo("typed_payload_change_record", """
    SELECT o_orderkey::VARCHAR AS id, CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'P' THEN 'MODIFY' ELSE 'REMOVE' END AS operation,
           o_custkey::VARCHAR AS customer, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
    FROM orders""")
def _(spark, sf):
    events = events_from_change_records(shapes.change_records(spark, sf), shapes.TABLE_ARN)
    inside = lambda column, path: F.try_variant_get(f"payload.Dynamodb.{column}", path, "string")
    return typed_payload(events, "change_record").select(
        field("EventID", "id"), field("EventName", "operation"), inside("Keys", "$.o_custkey.N").alias("customer"),
        inside("NewImage", "$.o_orderpriority.S").alias("priority"))


@demo("typed_payload_log_event", f"WITH {LOGS} SELECT stamp, ingested, props AS message FROM logs")
def _(spark, sf):
    events = events_from_logs(shapes.log_entries(spark, sf), shapes.LOGS_ARN)
    return typed_payload(events, "log_event").select(
        field("Timestamp", "stamp"), field("IngestionTime", "ingested"), field("Message", "message"))


def _metric_events(spark, sf, position: int):
    results = metric_results(metric_stat(shapes.event_points(spark, sf), clicks_per_hour(spark)))
    messages = shapes.table(spark, sf, "region").select(
        F.col("r_name").alias("Code"), F.concat(F.lit("checked "), shapes.text("r_regionkey")).alias("Value"))
    return events_from_metrics(results, messages, "urn:metrics").where(F.col("position") == position)


@demo("typed_payload_metric_result", """
    WITH hours AS (
        SELECT epoch_us(ts) // 1000000 // 3600 AS h, sum(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT 'clicks' AS id, 'Complete' AS status, min(h) * 3600 AS first, count(*) AS n, round(sum(v), 4) AS total, 0::BIGINT AS messages
    FROM hours GROUP BY h // 24""")
def _(spark, sf):
    return typed_payload(_metric_events(spark, sf, 1), "metric_result").select(
        field("Id", "id"), field("StatusCode", "status"), F.unix_seconds(F.get("payload.Timestamps", F.lit(0))).alias("first"),
        F.size("payload.Values").cast("bigint").alias("n"),
        F.round(F.aggregate("payload.Values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        F.size("payload.Messages").cast("bigint").alias("messages"))


@demo("typed_payload_metric_message", "SELECT r_name AS code, 'checked ' || r_regionkey AS value FROM region")
def _(spark, sf):
    return typed_payload(_metric_events(spark, sf, 0), "metric_message").select(field("Code", "code"), field("Value", "value"))


def _repository(spark, sf):
    user = F.struct(F.lit("1").alias("Date"), F.col("o_orderstatus").alias("Email"), F.col("o_orderpriority").alias("Name"))
    commits = shapes.table(spark, sf, "orders").select(
        shapes.numbered("c", F.col("o_orderkey")).alias("CommitId"), F.col("o_orderpriority").alias("Message"), user.alias("Author"),
        F.array(shapes.numbered("c", F.col("o_custkey"))).alias("Parents"))
    target = F.struct(
        shapes.numbered("repo-", F.col("user_id")).alias("RepositoryName"), F.col("event_type").alias("SourceReference"),
        F.struct((F.col("event_type") == "purchase").alias("IsMerged")).alias("MergeMetadata"))
    prs = shapes.events(spark, sf).select(
        shapes.text("event_id").alias("PullRequestId"), F.col("event_type").alias("PullRequestStatus"),
        F.col("ts").alias("LastActivityDate"), F.array(target).alias("PullRequestTargets"))
    return events_from_repo(commits, prs, shapes.REPO_ARN, "main")


@demo("typed_payload_commit", """
    SELECT 'c' || o_orderkey AS id, o_orderpriority AS message, o_orderpriority AS author, o_orderstatus AS mail, 'c' || o_custkey AS parent FROM orders""")
def _(spark, sf):
    events = _repository(spark, sf).where("type LIKE '%push'")
    return typed_payload(events, "commit").select(
        field("CommitId", "id"), field("Message", "message"), field("Author.Name", "author"), field("Author.Email", "mail"),
        F.get("payload.Parents", F.lit(0)).alias("parent"))


@demo("typed_payload_pull_request", """
    SELECT event_id::VARCHAR AS id, event_type AS status, epoch_us(ts) AS active_us, 'repo-' || user_id AS repo, event_type AS source,
           event_type = 'purchase' AS merged
    FROM events""")
def _(spark, sf):
    events = _repository(spark, sf).where("type LIKE '%pull_request'")
    first = F.get("payload.PullRequestTargets", F.lit(0))
    return typed_payload(events, "pull_request").select(
        field("PullRequestId", "id"), field("PullRequestStatus", "status"), F.unix_micros("payload.LastActivityDate").alias("active_us"),
        first["RepositoryName"].alias("repo"), first["SourceReference"].alias("source"), first["MergeMetadata"]["IsMerged"].alias("merged"))


@demo("typed_payload_sync_dataset", f"""
    WITH {SYNC} SELECT identity, dataset, 'SyncTrigger' AS trigger, 'us-east-1' AS region, n, records FROM datasets""")
def _(spark, sf):
    events = events_from_sync(nested_datasets(spark, sf), shapes.IDENTITY_ARN)
    return typed_payload(events, "sync_dataset").select(
        field("IdentityID", "identity"), field("DatasetName", "dataset"), field("EventType", "trigger"), field("Region", "region"),
        F.size("payload.DatasetRecords").cast("bigint").alias("n"), record_list(F.col("payload.DatasetRecords")).alias("records"))


@demo("typed_payload_user", """
    SELECT user_id::VARCHAR AS username, epoch_us(ts) AS modified_us, 'CONFIRMED' AS status, true AS enabled, 'kind' AS name, event_type AS value
    FROM events""")
def _(spark, sf):
    events = events_from_users(shapes.users(spark, sf), shapes.POOL_ARN)
    first = F.get("payload.Attributes", F.lit(0))
    return typed_payload(events, "user").select(
        field("Username", "username"), F.unix_micros("payload.UserLastModifiedDate").alias("modified_us"), field("UserStatus", "status"),
        field("Enabled", "enabled"), first["Name"].alias("name"), first["Value"].alias("value"))


@demo("typed_payload_notification", f"""
    WITH {REQUESTS}
    SELECT json_extract_string(body, '$.MessageId') AS id, json_extract_string(body, '$.Type') AS kind,
           json_extract_string(body, '$.TopicArn') AS topic, json_extract_string(body, '$.Message') AS message
    FROM requests WHERE method = 'POST' AND kind = 'Notification' AND NOT broken""")
def _(spark, sf):
    accepted = route_notifications(shapes.http_requests(spark, sf)).where("route = 'notification'")
    events = events_from_notifications(accepted, shapes.TOPIC_ARN)
    return typed_payload(events, "notification").select(
        field("MessageId", "id"), field("Type", "kind"), field("TopicArn", "topic"), field("Message", "message"))


@demo("typed_payload_perf_metric", f"WITH {PERF} SELECT metric, value FROM points")
def _(spark, sf):
    events = events_from_perf(perf_points(shapes.perf_series(spark, sf)), shapes.DB_ARN)
    return typed_payload(events, "perf_metric").select(field("metric", "metric"), field("value", "value"))
