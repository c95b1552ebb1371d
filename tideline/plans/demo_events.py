"""Demo queries: envelopes, payloads, messages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions.attributes import event_type
from ..operators.config import select_repo_events
from ..operators.envelope import (
    event_envelope, events_from_change_records, events_from_logs, events_from_messages, events_from_metrics,
    events_from_notifications, events_from_perf, events_from_repo, events_from_stream_records, events_from_sync,
    events_from_users)
from ..operators.identity import sync_datasets
from ..operators.messages import ack_batches, ack_failures, objects_from_messages, processor, queue_counters
from ..operators.metrics import as_metric_query, metric_results, metric_stat, perf_points
from ..operators.payload import typed_payload, validate_payload
from ..operators.routing import route_notifications
from ..operators.table_processors import register_table_processor
from ..sinks.events import dead_letters
from . import shapes
from .registry import demo


def micros(name: str = "time"):
    return F.unix_micros(name).alias("time_us")


def member(path: str, name: str, column: str = "data"):
    return F.get_json_object(column, path).alias(name)


@demo("event_envelope", """
    SELECT sha256('urn:shop|com.amazon.shop.' || event_type || '|' || user_id || '|' || props) AS id,
           'urn:shop' AS source, '1.0' AS specversion, 'com.amazon.shop.' || event_type AS type,
           user_id::VARCHAR AS subject, epoch_us(ts) AS time_us, 'application/json' AS datacontenttype,
           props AS data
    FROM events""")
def _(spark, sf):
    rows = event_envelope(
        shapes.events(spark, sf), event_type("shop", F.col("event_type")), "urn:shop", F.col("props"),
        subject=shapes.text("user_id"), time=F.col("ts"))
    return rows.select("id", "source", "specversion", "type", "subject", micros(), "datacontenttype", "data")


MESSAGES_SQL = f"""
    SELECT event_id::VARCHAR AS id, '{shapes.QUEUE_ARN}' AS source, 'com.amazon.sqs.message' AS type,
           event_type AS ext_type,
           CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE value::VARCHAR END AS ext_amount,
           2::BIGINT AS n_ext, props AS body, md5(props) AS digest
    FROM events"""


def _message_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "id", "source", "type", F.col("extensions")["sqsmsgeventtype"].alias("ext_type"),
        F.col("extensions")["sqsmsgamount"].alias("ext_amount"), F.size("extensions").cast("bigint").alias("n_ext"),
        member("$.Body", "body"), member("$.MD5OfBody", "digest"))


@demo("events_from_messages", MESSAGES_SQL)
def _(spark, sf):
    return _message_columns(events_from_messages(shapes.queue_messages(spark, sf), shapes.QUEUE_ARN))


@demo("processor", MESSAGES_SQL)
def _(spark, sf):
    return _message_columns(processor("default")(shapes.queue_messages(spark, sf), shapes.QUEUE_ARN))


def carts(batch: pa.RecordBatch) -> pa.Table:
    """A conversion as a user writes it: two events for a message of an even id, none for one that ends in 5; ids ending in 9 fail."""
    ids = batch.column("MessageId")
    if pc.any(pc.ends_with(ids, "9")).as_py():
        raise ValueError("a cart without number")
    even = pc.is_in(pc.utf8_slice_codeunits(ids, -1), pa.array(list("02468")))
    times = pc.if_else(even, 2, pc.if_else(pc.ends_with(ids, "5"), 0, 1)).to_numpy(zero_copy_only=False)
    rows = pa.array(np.repeat(np.arange(len(ids)), times))
    copy = pa.array(np.concatenate([np.arange(t) for t in times] or [np.empty(0, np.int64)]).astype(np.int64))
    return pa.table({
        "id": pc.binary_join_element_wise(ids.take(rows), copy.cast(pa.string()), "/"), "type": pa.repeat("shop.cart", len(rows)),
        "subject": ids.take(rows), "time": batch.column("SentTimestamp").take(rows), "data": batch.column("Body").take(rows)})


@demo("table_processor", f"""
    WITH m AS (SELECT event_id, epoch_us(ts) AS time_us, props, event_id % 10 AS d FROM events),
    copies AS (
        SELECT *, unnest(generate_series(0, CASE WHEN d % 2 = 0 THEN 1 ELSE 0 END)) AS copy FROM m WHERE d <> 5 AND d <> 9)
    SELECT event_id || '/' || copy AS id, 'shop.cart' AS type, event_id::VARCHAR AS subject, time_us, '{shapes.QUEUE_ARN}' AS source,
           props AS data, NULL AS error
    FROM copies
    UNION ALL SELECT event_id::VARCHAR, NULL, NULL, NULL, '{shapes.QUEUE_ARN}', NULL, 'ValueError: a cart without number' FROM m WHERE d = 9""")
def _(spark, sf):
    """A user's processor on Arrow batches; messages it fails on are dead letters."""
    register_table_processor("carts", carts)
    events = processor("carts")(shapes.queue_messages(spark, sf), shapes.QUEUE_ARN)
    good = events.where(F.size("errors") == 0).withColumn("error", F.lit(None).cast("string"))
    return good.unionByName(dead_letters(events), allowMissingColumns=True).select(
        "id", "type", "subject", micros(), "source", "data", "error")


OBJECTS = f"""
    WITH m AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS id, l_orderkey % 20 AS kind,
               l_orderkey, l_linenumber, l_quantity::BIGINT AS size,
               'arn:aws:s3:::bucket-' || (l_suppkey % 10) AS bucket,
               CASE l_returnflag WHEN 'A' THEN 'ObjectCreated:Put' WHEN 'N' THEN 'ObjectRemoved:DeleteMarkerCreated'
                                 ELSE 'ObjectRestore:Post' END AS name
        FROM lineitem),
    i AS (SELECT *, unnest(generate_series(1, 1 + l_linenumber % 3)) AS n FROM m WHERE kind > 6),
    r AS (
        SELECT CASE WHEN kind = 7 THEN NULL ELSE 'com.amazon.s3.' || lower(split_part(name, ':', 1)) END AS type,
               bucket AS source, concat_ws('/', l_orderkey, l_linenumber, n) AS subject, size,
               '{{"awsRegion":"us-east-1",' || CASE WHEN kind = 7 THEN '' ELSE '"eventName":"' || name || '",' END
               || '"s3":{{"bucket":{{"arn":"' || bucket || '","name":"' || substr(bucket, 14) || '"}},"object":{{"key":"'
               || concat_ws('/', l_orderkey, l_linenumber, n) || '","size":' || size || '}}}}}}' AS data,
               CASE WHEN kind = 7 THEN 'missing eventName' ELSE '' END AS error
        FROM i),
    o AS (
        SELECT sha256(concat_ws('|', source, type, subject, data)) AS id, source, type, subject, size, error FROM r
        UNION ALL
        SELECT id, bucket, 'com.amazon.s3.testevent', NULL, NULL, '' FROM m WHERE kind = 2
        UNION ALL
        SELECT id, '{shapes.QUEUE_ARN}', 'com.amazon.sqs.message', NULL, NULL, '' FROM m WHERE kind IN (0, 3, 4, 5, 6))
"""


@demo("objects_from_messages", OBJECTS + "SELECT id, source, type, subject, size, error FROM o")
def _(spark, sf):
    events = objects_from_messages(shapes.object_messages(spark, sf), shapes.QUEUE_ARN)
    return events.select(
        "id", "source", "type", "subject", F.get_json_object("data", "$.s3.object.size").cast("bigint").alias("size"),
        F.array_join("errors", "; ").alias("error"))


@demo("dead_letters", OBJECTS + "SELECT id, source, subject, error FROM o WHERE error <> ''")
def _(spark, sf):
    events = objects_from_messages(shapes.object_messages(spark, sf), shapes.QUEUE_ARN)
    return dead_letters(events).select("id", "source", "subject", "error")


@demo("events_from_stream_records", f"""
    SELECT event_id::VARCHAR AS id, '{shapes.STREAM_ARN}' AS source, 'com.amazon.kinesis.stream_record' AS type,
           user_id::VARCHAR AS subject, epoch_us(ts) AS time_us, props AS payload
    FROM events""")
def _(spark, sf):
    events = events_from_stream_records(shapes.stream_records(spark, sf), shapes.STREAM_ARN)
    return events.select(
        "id", "source", "type", "subject", micros(),
        F.decode(F.unbase64(F.get_json_object("data", "$.Data")), "UTF-8").alias("payload"))


@demo("events_from_change_records", f"""
    SELECT o_orderkey::VARCHAR AS id, '{shapes.TABLE_ARN}' AS source, 'com.amazon.dynamodb.stream_record' AS type,
           'o_custkey,o_orderkey' AS subject,
           CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'P' THEN 'MODIFY' ELSE 'REMOVE' END AS operation,
           o_custkey::VARCHAR AS customer,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
    FROM orders""")
def _(spark, sf):
    events = events_from_change_records(shapes.change_records(spark, sf), shapes.TABLE_ARN)
    return events.select(
        "id", "source", "type", "subject", F.col("extensions")["dynamodboperation"].alias("operation"),
        member("$.Dynamodb.Keys.o_custkey.N", "customer"), member("$.Dynamodb.NewImage.o_orderpriority.S", "priority"))


LOGS = """
    logs AS (
        SELECT 'shop-' || (user_id % 4) AS log_group, user_id::VARCHAR AS log_stream, epoch_us(ts) // 1000 AS stamp,
               epoch_us(ts) // 1000 + CASE WHEN event_id % 7 = 0 THEN 7200000 ELSE 0 END AS ingested, props
        FROM events)
"""


@demo("events_from_logs", f"""
    WITH {LOGS}
    SELECT sha256('{shapes.LOGS_ARN}|com.amazon.logs.log|' || json_array(log_group, log_stream)::VARCHAR || '|' ||
                  json_object('IngestionTime', ingested, 'Message', props, 'Timestamp', stamp)::VARCHAR) AS id,
           '{shapes.LOGS_ARN}' AS source, 'com.amazon.logs.log' AS type, stamp, props AS message
    FROM logs""")
def _(spark, sf):
    events = events_from_logs(shapes.log_entries(spark, sf), shapes.LOGS_ARN)
    return events.select(
        "id", "source", "type", F.unix_millis("time").alias("stamp"), member("$.Message", "message"))


def clicks_per_hour(spark) -> DataFrame:
    return as_metric_query(spark, "clicks", "Shop", "click", 3600, "Sum")


@demo("events_from_metrics", """
    WITH hours AS (
        SELECT epoch_us(ts) // 1000000 // 3600 AS h, sum(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT 0::BIGINT AS position, 'com.amazon.cloudwatch.metrics.message' AS type, 'urn:metrics' AS source,
           r_name AS name, 0::BIGINT AS n, NULL::DOUBLE AS total
    FROM region
    UNION ALL
    SELECT 1, 'com.amazon.cloudwatch.metrics.metric', 'urn:metrics', 'clicks', count(*), round(sum(v), 4)
    FROM hours GROUP BY h // 24""")
def _(spark, sf):
    points = shapes.event_points(spark, sf)
    results = metric_results(metric_stat(points, clicks_per_hour(spark)))
    messages = shapes.table(spark, sf, "region").select(
        F.col("r_name").alias("Code"), F.concat(F.lit("checked "), shapes.text("r_regionkey")).alias("Value"))
    values = F.from_json(F.get_json_object("data", "$.Values"), "array<double>")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return events_from_metrics(results, messages, "urn:metrics").select(
        F.col("position").cast("bigint").alias("position"), "type", "source",
        F.coalesce(F.get_json_object("data", "$.Id"), F.get_json_object("data", "$.Code")).alias("name"),
        F.when(values.isNull(), 0).otherwise(F.size(values)).cast("bigint").alias("n"),
        F.round(total, 4).alias("total"))


PERF = f"""
    points AS (
        SELECT 'arn:aws:rds:us-east-1:{shapes.ACCOUNT}:db:' || user_id AS instance_arn, 'db.' || event_type AS metric,
               epoch_us(ts) AS time_us, value FROM events WHERE event_id % 10 <> 0
        UNION ALL
        SELECT 'arn:aws:rds:us-east-1:{shapes.ACCOUNT}:db:' || user_id, 'db.' || event_type,
               epoch_us(ts) + 1000000, value FROM events WHERE event_id % 4 <> 0)
"""


@demo("perf_points", f"WITH {PERF} SELECT instance_arn, metric, time_us, value FROM points")
def _(spark, sf):
    return perf_points(shapes.perf_series(spark, sf)).select("instance_arn", "metric", micros("ts"), "value")


@demo("events_from_perf", f"""
    WITH {PERF}
    SELECT sha256('{shapes.DB_ARN}|com.amazon.rds.pi.metric|' || time_us || '|' ||
                  '{{"metric":"' || metric || '","value":' || value || '}}') AS id,
           '{shapes.DB_ARN}' AS source, 'com.amazon.rds.pi.metric' AS type, time_us, metric AS pimetric, value
    FROM points""")
def _(spark, sf):
    events = events_from_perf(perf_points(shapes.perf_series(spark, sf)), shapes.DB_ARN)
    return events.select(
        "id", "source", "type", micros(), F.col("extensions")["pimetric"].alias("pimetric"),
        F.get_json_object("data", "$.value").cast("double").alias("value"))


REPO = f"""
    repo AS (
        SELECT sha256('{shapes.REPO_ARN}|com.amazon.codecommit.push|main|' ||
                      '{{"AdditionalData":null,"Author":null,"CommitId":"c' || o_orderkey ||
                      '","Committer":null,"Message":"' || o_orderpriority || '","Parents":null,"TreeId":null}}') AS id,
               'com.amazon.codecommit.push' AS type, 'c' || o_orderkey AS item
        FROM orders
        UNION ALL
        SELECT NULL, 'com.amazon.codecommit.pull_request', user_id || ' ' || event_type FROM events)
"""


def _repo_events(spark, sf) -> DataFrame:
    commits = shapes.table(spark, sf, "orders").select(
        F.concat(F.lit("c"), shapes.text("o_orderkey")).alias("CommitId"), F.col("o_orderpriority").alias("Message"))
    prs = shapes.events(spark, sf).select(
        shapes.text("user_id").alias("PullRequestId"), F.col("event_type").alias("PullRequestStatus"))
    return events_from_repo(commits, prs, shapes.REPO_ARN, "main")


def _repo_columns(events: DataFrame) -> DataFrame:
    pushed = F.col("type").endswith("push")
    request = F.concat_ws(
        " ", F.get_json_object("data", "$.PullRequestId"), F.get_json_object("data", "$.PullRequestStatus"))
    return events.select(
        F.when(pushed, F.col("id")).alias("id"), "source", "type", "subject",
        F.when(pushed, F.get_json_object("data", "$.CommitId")).otherwise(request).alias("item"))


@demo("events_from_repo", f"""
    WITH {REPO} SELECT id, '{shapes.REPO_ARN}' AS source, type, 'main' AS subject, item FROM repo""")
def _(spark, sf):
    return _repo_columns(_repo_events(spark, sf))


@demo("select_repo_events", f"""
    WITH {REPO} SELECT id, '{shapes.REPO_ARN}' AS source, type, 'main' AS subject, item FROM repo
    WHERE type = 'com.amazon.codecommit.push'""")
def _(spark, sf):
    return _repo_columns(select_repo_events(_repo_events(spark, sf), "push"))


SYNC = """
    records AS (
        SELECT l_orderkey, concat_ws('/', l_linenumber, l_partkey, l_suppkey) AS k, l_quantity::BIGINT::VARCHAR AS v
        FROM lineitem),
    nested AS (
        SELECT l_orderkey, count(*) AS n, string_agg(k || '=' || v, ',' ORDER BY k, v) AS records
        FROM records GROUP BY 1),
    datasets AS (
        SELECT 'us-east-1:' || o_custkey AS identity, 'order-' || o_orderkey AS dataset,
               coalesce(n, 0)::BIGINT AS n, coalesce(records, '') AS records, epoch_us(o_orderdate) AS time_us
        FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nested ON l_orderkey = o_orderkey)
"""


def record_list(records):
    """Records as text, in the order of key and value."""
    pairs = F.transform(records, lambda r: F.struct(r["Key"].alias("k"), r["Value"].alias("v")))
    return F.array_join(F.transform(F.sort_array(pairs), lambda p: F.concat(p["k"], F.lit("="), p["v"])), ",")


def nested_datasets(spark, sf) -> DataFrame:
    return sync_datasets(
        shapes.identities(spark, sf), shapes.datasets(spark, sf), shapes.sync_records(spark, sf))


@demo("sync_datasets", f"WITH {SYNC} SELECT identity, dataset, 0::BIGINT AS part, n, records FROM datasets")
def _(spark, sf):
    return nested_datasets(spark, sf).select(
        F.col("IdentityId").alias("identity"), F.col("DatasetName").alias("dataset"), "part",
        F.size("DatasetRecords").cast("bigint").alias("n"), record_list(F.col("DatasetRecords")).alias("records"))


@demo("events_from_sync", f"""
    WITH {SYNC}
    SELECT identity AS id, '{shapes.IDENTITY_ARN}' AS source, 'com.amazon.cognito-identity.sync_trigger' AS type,
           dataset AS subject, time_us, 'SyncTrigger' AS trigger, 'us-east-1' AS region, 'us-east-1:pool' AS pool, n
    FROM datasets""")
def _(spark, sf):
    events = events_from_sync(nested_datasets(spark, sf), shapes.IDENTITY_ARN)
    # the data is parsed once for all members that are looked at
    looked = F.from_json("data", "EventType string, Region string, IdentityPoolID string, DatasetRecords array<struct<Key:string>>")
    return events.withColumn("_d", looked).select(
        "id", "source", "type", "subject", micros(), F.col("_d.EventType").alias("trigger"), F.col("_d.Region").alias("region"),
        F.col("_d.IdentityPoolID").alias("pool"), F.size("_d.DatasetRecords").cast("bigint").alias("n"))


BY_IDENTITY = """
    numbered AS (
        SELECT 'us-east-1:' || o_custkey AS identity, concat_ws('/', o_orderkey, l_linenumber, l_partkey, l_suppkey) AS k
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
    sizes AS (SELECT identity, count(*) AS n FROM numbered GROUP BY 1)
"""


def datasets_by_identity(spark, sf) -> DataFrame:
    """One dataset per identity with the records of all its orders, in parts of eight."""
    records = shapes.sync_records(spark, sf)
    order = F.substring_index("DatasetName", "-", -1)
    records = records.withColumns({"Key": F.concat_ws("/", order, "Key"), "DatasetName": F.lit("orders")})
    datasets = shapes.datasets(spark, sf).groupBy("IdentityId", F.lit("orders").alias("DatasetName")).agg(
        F.max("LastModifiedDate").alias("LastModifiedDate"))
    return sync_datasets(shapes.identities(spark, sf), datasets, records, part_records=8)


@demo("sync_dataset_parts", f"""
    WITH {BY_IDENTITY},
    spread AS (SELECT identity, n, unnest(range(CAST(ceil(n / 8) AS BIGINT))) AS part FROM sizes)
    SELECT s.identity, s.part, CAST(ceil(s.n / 8) AS BIGINT) AS parts, least(8, s.n - s.part * 8)::BIGINT AS n,
           s.identity || CASE WHEN s.part > 0 THEN '#' || s.part ELSE '' END AS id
    FROM spread s
    UNION ALL
    SELECT DISTINCT 'us-east-1:' || o_custkey, 0, 1, 0, 'us-east-1:' || o_custkey
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE 'us-east-1:' || o_custkey NOT IN (SELECT identity FROM sizes)""")
def _(spark, sf):
    events = events_from_sync(datasets_by_identity(spark, sf), shapes.IDENTITY_ARN)
    listed = F.from_json(F.get_json_object("data", "$.DatasetRecords"), "array<struct<Key:string>>")
    return events.select(
        F.get_json_object("data", "$.IdentityID").alias("identity"),
        F.col("extensions.part").cast("bigint").alias("part"), F.col("extensions.parts").cast("bigint").alias("parts"),
        F.size(listed).cast("bigint").alias("n"), "id")


@demo("sync_dataset_part_records", f"""
    WITH {BY_IDENTITY}
    SELECT identity, count(*) AS n, string_agg(k, ',' ORDER BY k) AS records FROM numbered GROUP BY 1""")
def _(spark, sf):
    records = datasets_by_identity(spark, sf).select(
        F.col("IdentityId").alias("identity"), F.explode("DatasetRecords.Key").alias("k"))
    return records.groupBy("identity").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("k")), ",").alias("records"))


@demo("events_from_users", f"""
    SELECT '{shapes.POOL_ARN}' AS source, 'com.amazon.cognito-idp.sync_trigger' AS type, 'us-east-1_pool' AS subject,
           epoch_us(ts) AS time_us, user_id::VARCHAR AS username, event_type AS kind, 64::BIGINT AS id_length
    FROM events""")
def _(spark, sf):
    events = events_from_users(shapes.users(spark, sf), shapes.POOL_ARN)
    return events.select(
        "source", "type", "subject", micros(), member("$.Username", "username"),
        member("$.Attributes[0].Value", "kind"), F.length("id").cast("bigint").alias("id_length"))


REQUESTS = f"""
    requests AS (
        SELECT event_id, user_id, epoch_us(ts) AS time_us,
               CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
               '/shop/nation_' || (user_id % 30) AS path,
               CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'Notification'
                    WHEN event_type = 'signup' THEN 'SubscriptionConfirmation' ELSE 'Unknown' END AS kind,
               event_id % 11 = 0 AS broken,
               CASE WHEN event_id % 3 = 0 THEN '' ELSE 'user ' || user_id END AS subject,
               CASE WHEN event_id % 11 = 0 THEN 'not json'
                    WHEN event_type = 'signup' THEN '{{"Type":"SubscriptionConfirmation","Token":"t-' || event_id || '"}}'
                    ELSE '{{"Type":"Notification","MessageId":"' || event_id ||
                         CASE WHEN event_id % 3 = 0 THEN '' ELSE '","Subject":"user ' || user_id END ||
                         '","Message":"' || value || '"}}' END AS body
        FROM events)
"""


@demo("route_notifications", f"""
    WITH {REQUESTS},
    routed AS (
        SELECT *, CASE WHEN method <> 'POST' OR broken THEN NULL WHEN kind = 'Notification' THEN 'notification'
                       WHEN kind = 'SubscriptionConfirmation' THEN 'confirmation' END AS route
        FROM requests)
    SELECT event_id, route,
           CASE WHEN method <> 'POST' THEN 405 WHEN route IS NOT NULL THEN 200 ELSE 400 END::BIGINT AS status,
           CASE WHEN route = 'notification' THEN event_id::VARCHAR END AS message_id,
           CASE WHEN route = 'notification' THEN subject END AS subject,
           CASE WHEN route = 'confirmation' THEN '{shapes.TOPIC_ARN}' END AS topic,
           CASE WHEN route = 'confirmation' THEN 't-' || event_id END AS token
    FROM routed""")
def _(spark, sf):
    routed = route_notifications(shapes.http_requests(spark, sf))
    event_id = F.map_filter("headers", lambda k, _: F.lower(k) == "x-amz-sns-message-id")
    return routed.select(
        F.get(F.map_values(event_id), F.lit(0)).cast("bigint").alias("event_id"), "route", "status", "message_id",
        "subject", "topic", "token")


@demo("events_from_notifications", f"""
    WITH {REQUESTS}
    SELECT event_id::VARCHAR AS id, '{shapes.TOPIC_ARN}' AS source, 'com.amazon.sns.notification' AS type,
           subject, time_us, body AS data
    FROM requests WHERE method = 'POST' AND kind = 'Notification' AND NOT broken""")
def _(spark, sf):
    accepted = route_notifications(shapes.http_requests(spark, sf)).where("route = 'notification'")
    events = events_from_notifications(accepted, shapes.TOPIC_ARN)
    return events.select("id", "source", "type", "subject", micros(), "data")


@demo("typed_payload", """
    SELECT event_id::VARCHAR AS sequence, user_id::VARCHAR AS partition_key, epoch_us(ts) AS time_us, props AS payload,
           'NONE' AS encryption
    FROM events""")
def _(spark, sf):
    events = events_from_stream_records(shapes.stream_records(spark, sf), shapes.STREAM_ARN)
    return typed_payload(events, "stream_record").select(
        F.col("payload.SequenceNumber").alias("sequence"), F.col("payload.PartitionKey").alias("partition_key"),
        micros("payload.ApproximateArrivalTimestamp"), F.decode("payload.Data", "UTF-8").alias("payload"),
        F.col("payload.EncryptionType").alias("encryption"))


@demo("validate_payload", f"""
    WITH {REQUESTS}
    SELECT event_id, CASE
        WHEN broken THEN 'not an object'
        WHEN kind = 'SubscriptionConfirmation' THEN
            'missing Message,missing MessageId,missing Signature,missing SignatureVersion,missing SigningCertURL,'
            || 'missing Timestamp,missing TopicArn,missing UnsubscribeURL,unknown Token,value Type'
        ELSE 'missing Signature,missing SignatureVersion,missing SigningCertURL,missing Timestamp,missing TopicArn,'
            || 'missing UnsubscribeURL' END AS errors
    FROM requests""")
def _(spark, sf):
    requests = shapes.http_requests(spark, sf)
    event_id = F.map_filter("headers", lambda k, _: F.lower(k) == "x-amz-sns-message-id")
    return validate_payload(requests, "notification", "body").select(
        F.get(F.map_values(event_id), F.lit(0)).cast("bigint").alias("event_id"),
        F.array_join("errors", ",").alias("errors"))


COUNTERS_SQL = """
    SELECT 'sqssources' AS resource_group, 'ns-' || (user_id % 3) AS namespace, 'q-' || (user_id % 5) AS name,
           count(*) FILTER (event_type = 'click') AS message_enqueued_process_count,
           count(*) FILTER (event_type = 'view') AS message_dequeued_process_count,
           count(*) FILTER (event_type = 'purchase') AS message_enqueued_delete_count,
           count(*) FILTER (event_type = 'signup') AS message_dequeued_delete_count,
           arg_max(floor(value)::BIGINT, ts) FILTER (event_type = 'error' AND event_id % 2 = 0) AS queue_capacity_process,
           arg_max(floor(value)::BIGINT, ts) FILTER (event_type = 'error' AND event_id % 2 = 1) AS queue_capacity_delete
    FROM events GROUP BY 1, 2, 3"""


@demo("queue_counters", COUNTERS_SQL)
def _(spark, sf):
    return queue_counters(shapes.queue_log(spark, sf))


BATCHES = """
    acks AS (
        SELECT event_id - CASE WHEN event_id % 10 = 9 THEN 5 ELSE 0 END AS m, event_id, ts FROM events),
    latest AS (
        SELECT 'q-' || (m % 5) AS queue, epoch_us(ts) // 1000000 // 86400 AS period,
               ('0x' || substr(md5(m::VARCHAR), 1, 8))::BIGINT % 4 AS worker, m::VARCHAR AS message,
               arg_max('r-' || event_id, ts) AS receipt, max(ts) AS ts
        FROM acks GROUP BY 1, 2, 3, 4),
    numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY queue, period, worker ORDER BY ts, message) - 1) // 10 AS batch
        FROM latest),
    batches AS (
        SELECT queue, period, worker, batch::BIGINT AS batch, count(*) AS n,
               string_agg(message || ':' || receipt, ',' ORDER BY message) AS entries
        FROM numbered GROUP BY 1, 2, 3, 4)
"""


def _batches(spark, sf) -> DataFrame:
    return ack_batches(shapes.acks(spark, sf), flush_seconds=86_400, workers=4)


@demo("ack_batches", f"WITH {BATCHES} SELECT queue, period, worker, batch, n, entries FROM batches")
def _(spark, sf):
    entries = F.transform("entries", lambda e: F.concat_ws(":", e["MessageId"], e["ReceiptHandle"]))
    return _batches(spark, sf).select("queue", "period", "worker", "batch", "n", F.array_join(entries, ",").alias("entries"))


@demo("ack_failures", f"""
    WITH {BATCHES}
    SELECT queue, period, worker, batch::BIGINT AS batch, count(*) AS n,
           '[' || string_agg('{{' || chr(10) || '  Code: "ReceiptHandleIsInvalid",' || chr(10) || '  Id: "' || message ||
               '",' || chr(10) || '  Message: "receipt \\"' || receipt || '\\" expired",' || chr(10) ||
               '  SenderFault: true' || chr(10) || '}}', ',' ORDER BY message) || ']' AS error
    FROM numbered WHERE message::BIGINT % 3 = 0 GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    results = _batches(spark, sf).select("queue", "period", "worker", "batch", F.explode("entries").alias("e")).select(
        "queue", "period", "worker", "batch", F.col("e.MessageId").alias("Id"),
        F.lit("ReceiptHandleIsInvalid").alias("Code"),
        F.concat(F.lit('receipt "'), F.col("e.ReceiptHandle"), F.lit('" expired')).alias("Message"),
        F.lit(True).alias("SenderFault"), (F.col("e.MessageId").cast("bigint") % 3 == 0).alias("failed"))
    return ack_failures(results, "queue", "period", "worker", "batch")
