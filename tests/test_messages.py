"""Messages, envelopes and payloads on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.operators.config import select_repo_events
from tideline.operators.envelope import (
    events_from_change_records, events_from_messages, events_from_stream_records, events_from_sync)
from tideline.operators.identity import sync_datasets
from tideline.operators.messages import (
    ack_batches, ack_failures, objects_from_messages, processor, queue_counters, register_processor)
from tideline.operators.payload import typed_payload, validate_payload
from tideline.operators.routing import route_notifications
from tideline.schemas import LANDED, PAYLOADS
from tideline.sinks.events import dead_letters, read_events, valid_events, write_events

ARN = "arn:aws:sqs:eu-north-1:123456789012:orders"


def messages(spark, bodies, attributes=None):
    rows = [(f"m{i}", body, attributes) for i, body in enumerate(bodies)]
    kind = LANDED["queue_message"]["MessageAttributes"].dataType.simpleString()
    return spark.createDataFrame(rows, f"MessageId string, Body string, MessageAttributes {kind}")


def attribute(kind, value=None, binary=None):
    return (None, binary, kind, None, value)


def test_message_event(spark):
    attributes = {
        "Parcel.Weight.Class": attribute("String.Class", "heavy"), "Label_Scan": attribute("Binary.scan", None, "eA=="),
        "a-b": attribute("String", "first"), "ab": attribute("String", "last"), "none": attribute("String")}
    event = events_from_messages(messages(spark, ["body"], attributes), ARN).first()
    assert (event.type, event.source, event.id) == ("com.amazon.sqs.message", ARN, "m0")
    assert event.extensions == {"sqsmsgparcelweightclass": "heavy", "sqsmsgab": "last"}
    data = json.loads(event.data)
    assert data["Body"] == "body" and data["MD5OfMessageAttributes"] is None
    assert data["MessageAttributes"]["Label_Scan"]["BinaryValue"] == "eA=="


def test_no_extensions(spark):
    assert events_from_messages(messages(spark, ["x"], {"b": attribute("Binary", None, "eA==")}), ARN).first().extensions is None
    assert events_from_messages(messages(spark, ["x"]), ARN).first().extensions is None


def record(name="ObjectCreated:Put", bucket="arn:aws:s3:::b", key="k"):
    return {"eventName": name, "s3": {"bucket": {"arn": bucket}, "object": {"key": key}}}


OBJECT_CASES = [
    (json.dumps({"Records": [record(), record("ObjectRemoved:Delete", key="k 2")]}),
     [("com.amazon.s3.objectcreated", "arn:aws:s3:::b", "k", []), ("com.amazon.s3.objectremoved", "arn:aws:s3:::b", "k 2", [])]),
    ('{"Records": []}', []),
    ('{"Records": "text"}', [("com.amazon.sqs.message", ARN, None, [])]),
    ('{"Records": null}', [("com.amazon.sqs.message", ARN, None, [])]),
    ('{"Service": "Amazon S3", "Event": "s3:TestEvent", "Bucket": "b"}', [("com.amazon.s3.testevent", "arn:aws:s3:::b", None, [])]),
    ('{"Service": "Amazon S3", "Event": "s3:TestEvent", "Bucket": "b", "Records": {}}',
     [("com.amazon.s3.testevent", "arn:aws:s3:::b", None, [])]),
    ('{"Service": "Amazon S3", "Event": "s3:TestEvent"}', [("com.amazon.s3.testevent", None, None, ["missing Bucket"])]),
    ('{"Service": "Amazon S3", "Event": "s3:TestEvent", "Bucket": 5}', [("com.amazon.s3.testevent", None, None, ["missing Bucket"])]),
    ('{"Service": "Other", "Event": "s3:TestEvent"}', [("com.amazon.sqs.message", ARN, None, [])]),
    ("plain", [("com.amazon.sqs.message", ARN, None, [])]),
    ("", [("com.amazon.sqs.message", ARN, None, [])]),
    ("null", [("com.amazon.sqs.message", ARN, None, [])]),
    ("[1]", [("com.amazon.sqs.message", ARN, None, [])]),
    ('{"Records": []} x', [("com.amazon.sqs.message", ARN, None, [])]),
    ('{"Records": []}, {}', [("com.amazon.sqs.message", ARN, None, [])]),
    ('{"Records": [1], "Records": []}', []),
    ('{"Records": [null, 5]}', [(None, None, None, ["missing eventName", "missing s3.bucket.arn", "missing s3.object.key"])] * 2),
    (json.dumps({"Records": [record(name=7)]}), [(None, "arn:aws:s3:::b", "k", ["missing eventName"])]),
    (json.dumps({"Records": [record(key=7)]}), [("com.amazon.s3.objectcreated", "arn:aws:s3:::b", None, ["missing s3.object.key"])]),
    (json.dumps({"Records": [record(key="7")]}), [("com.amazon.s3.objectcreated", "arn:aws:s3:::b", "7", [])]),
    (json.dumps({"Records": [record(key="{x")]}), [("com.amazon.s3.objectcreated", "arn:aws:s3:::b", "{x", [])]),
]


def test_object_branches(spark):
    events = objects_from_messages(messages(spark, [c[0] for c in OBJECT_CASES]), ARN)
    got = [(e.type, e.source, e.subject, e.errors) for e in events.collect()]
    want = [row for _, rows in OBJECT_CASES for row in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_object_data_and_ids(spark):
    body = json.dumps({"Records": [record()]})
    first, again = [objects_from_messages(messages(spark, [body]), ARN).first() for _ in range(2)]
    assert json.loads(first.data) == record() and first.id == again.id and len(first.id) == 64
    test = '{"Service":"Amazon S3", "Event":"s3:TestEvent", "Bucket":"b"}'
    event = objects_from_messages(messages(spark, [test]), ARN).first()
    assert event.data == test and event.id == "m0"


def test_dead_letters_split(spark):
    events = objects_from_messages(messages(spark, ["x", '{"Records": [{}]}']), ARN)
    assert valid_events(events).count() == 1
    assert dead_letters(events).first().error == "missing eventName; missing s3.bucket.arn; missing s3.object.key"


def test_processors(spark):
    register_processor("mine", lambda df, source: events_from_messages(df, source).withColumn("subject", F.lit("s")))
    assert processor("mine")(messages(spark, ["x"]), ARN).first().subject == "s"
    with pytest.raises(ValueError, match="unsupported"):
        processor("unknown")


def test_round_trip(spark):
    rows = spark.createDataFrame(
        [("1", "key", b"cart", "2024-01-01 00:00:00.123456")],
        "SequenceNumber string, PartitionKey string, Data binary, t string",
    ).withColumn("ApproximateArrivalTimestamp", F.col("t").cast("timestamp"))
    arn = "arn:aws:kinesis:us-east-1:123456789012:stream/s"
    events = events_from_stream_records(rows, arn)
    back = typed_payload(events, "stream_record").first()
    assert (back.type, back.subject, back.id) == ("com.amazon.kinesis.stream_record", "key", "1")
    assert bytes(back.payload.Data) == b"cart" and back.payload.EncryptionType is None
    assert back.payload.ApproximateArrivalTimestamp == rows.first().ApproximateArrivalTimestamp


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_written_events_read_back(spark, tmp_path, fmt):
    events = events_from_messages(
        messages(spark, ['say "hi"', "é\n"], {"a.b": attribute("String", 'x"y')}), ARN)
    write_events(events, str(tmp_path / "out"), fmt)
    back = read_events(spark, str(tmp_path / "out"), fmt)
    assert back.columns == events.columns

    def plain(df):
        return sorted((e.id, e.source, e.type, e.subject, e.extensions, json.loads(e.data)["Body"]) for e in df.collect())
    assert plain(back) == plain(events)


def test_change_record_keys(spark):
    rows = spark.sql("""SELECT 'e1' AS EventID, 'INSERT' AS EventName, named_struct(
        'Keys', parse_json('{"name":{"S":"x"},"id":{"M":{"a":{"L":[{"N":"1"}]}}}}')) AS Dynamodb""")
    rows = rows.withColumn("Dynamodb", F.col("Dynamodb").withField("ApproximateCreationDateTime", F.lit(None).cast("timestamp")))
    empty = rows.withColumn("Dynamodb", F.col("Dynamodb").withField("Keys", F.lit(None).cast("variant")))
    arn = "arn:aws:dynamodb:us-east-1:123456789012:table/t"
    event = events_from_change_records(rows, arn).first()
    assert (event.subject, event.extensions) == ("id,name", {"dynamodboperation": "INSERT"})
    assert json.loads(event.data)["Dynamodb"]["Keys"]["id"]["M"]["a"]["L"][0]["N"] == "1"
    assert events_from_change_records(empty, arn).first().subject == ""


def dataset_tables(spark, n):
    identities = spark.createDataFrame([("id-7",), ("empty",)], "IdentityId string")
    datasets = spark.createDataFrame(
        [("cart", "id-7", None), ("big", "id-7", None), ("lost", "unknown", None)],
        "DatasetName string, IdentityId string, LastModifiedDate timestamp")
    records = spark.range(n).select(
        F.lit("id-7").alias("IdentityId"), F.lit("big").alias("DatasetName"),
        F.format_string("%05d", "id").alias("Key"), F.col("id").cast("string").alias("Value"),
        F.col("id").alias("SyncCount"), F.lit(None).cast("string").alias("LastModifiedBy"),
        F.lit(None).cast("timestamp").alias("LastModifiedDate"),
        F.lit(None).cast("timestamp").alias("DeviceLastModifiedDate"))
    return identities, datasets, records


def test_sync_event_text(spark):
    nested = sync_datasets(*dataset_tables(spark, 3))
    arn = "arn:aws:cognito-identity:eu-north-1:123456789012:identitypool/pool"
    events = {e.subject: e for e in events_from_sync(nested, arn).collect()}
    assert set(events) == {"cart", "big"}
    assert json.loads(events["cart"].data) == {
        "CreationDate": None, "DataStorage": None, "DatasetName": "cart", "IdentityID": "id-7",
        "LastModifiedBy": None, "LastModifiedDate": None, "NumRecords": None, "EventType": "SyncTrigger",
        "Region": "eu-north-1", "IdentityPoolID": "pool", "DatasetRecords": []}
    assert [r["Key"] for r in json.loads(events["big"].data)["DatasetRecords"]] == ["00000", "00001", "00002"]
    assert events["cart"].id == "id-7"


def test_large_dataset_comes_in_parts(spark):
    nested = sync_datasets(*dataset_tables(spark, 1000), part_records=50).where("DatasetName = 'big'").collect()
    keys = sorted(r.Key for row in nested for r in row.DatasetRecords)
    assert keys == [f"{i:05d}" for i in range(1000)]
    assert len(nested) == 20 and max(len(row.DatasetRecords) for row in nested) < 150


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 1000])
def test_parts_follow_one_rule(spark, n):
    nested = sync_datasets(*dataset_tables(spark, n), part_records=50)
    rows = nested.where("DatasetName = 'big'").orderBy("part").collect()
    parts = max(1, -(-n // 50))
    assert [(r.part, r.parts) for r in rows] == [(i, parts) for i in range(parts)]
    assert [len(r.DatasetRecords) for r in rows] == [min(50, n - 50 * i) for i in range(parts)]
    keys = [[r.Key for r in row.DatasetRecords] for row in rows]
    assert all(k == sorted(k) for k in keys)
    assert sorted(sum(keys, [])) == [f"{i:05d}" for i in range(n)]
    events = events_from_sync(nested, "arn:aws:cognito-identity:eu-north-1:123456789012:identitypool/pool")
    ids = [(e.id, e.subject) for e in events.collect()]
    assert len(set(ids)) == len(ids) == parts + 1


def test_validate_payload(spark):
    good = {n: "x" for n in ["MessageId", "TopicArn", "Message", "Timestamp", "SignatureVersion", "Signature",
                             "SigningCertURL", "UnsubscribeURL"]} | {"Type": "Notification"}
    cases = [
        (good, []),
        (good | {"Subject": "s", "MessageAttributes": {"a": {"Type": "String", "Value": "v", "more": 1}}}, []),
        (good | {"MessageAttributes": {"a": {"Type": "Other"}}},
         ["missing MessageAttributes.Value", "value MessageAttributes.Type"]),
        (good | {"Message": 5, "extra": 1}, ["type Message", "unknown extra"]),
        ({k: v for k, v in good.items() if k != "TopicArn"} | {"Type": "X"}, ["missing TopicArn", "value Type"]),
    ]
    rows = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, data string")
    assert [r.errors for r in validate_payload(rows, "notification").orderBy("i").collect()] == [e for _, e in cases]
    nested = {"Id": "i", "Label": "l", "Messages": [{"Code": "c"}, 5], "StatusCode": "s", "Timestamps": ["t", 1], "Values": [1, 2.5]}
    rows = spark.createDataFrame([(json.dumps(nested),)], "data string")
    assert validate_payload(rows, "metric_result").first().errors == [
        "missing Messages.Value", "type Messages[]", "type Timestamps[]"]


@pytest.mark.parametrize("kind", list(PAYLOADS))
def test_contract_of_every_kind(spark, kind):
    rows = spark.createDataFrame([("{}",), ("[]",), (None,)], "data string")
    errors = [r.errors for r in validate_payload(rows, kind).collect()]
    assert errors[0] and all(e.startswith("missing ") for e in errors[0])
    assert errors[1] == errors[2] == ["not an object"]


def test_route_notifications(spark):
    def request(method, kind, body):
        return method, {"x-amz-sns-message-type": kind, "X-Amz-Sns-Message-Id": "1", "X-Amz-Sns-Topic-Arn": "t"}, body
    cases = [
        (request("GET", "Notification", "{}"), (None, 405, None, None, None, None)),
        (request("POST", "Notification", '{"Subject":"s"}'), ("notification", 200, "1", "s", None, None)),
        (request("POST", "Notification", "{}"), ("notification", 200, "1", "", None, None)),
        (request("POST", "Notification", "null"), ("notification", 200, "1", "", None, None)),
        (request("POST", "Notification", "bad"), (None, 400, None, None, None, None)),
        (request("POST", "Notification", '{"Subject":5}'), (None, 400, None, None, None, None)),
        (request("POST", "SubscriptionConfirmation", '{"Token":"k"}'), ("confirmation", 200, None, None, "t", "k")),
        (request("POST", "Other", "{}"), (None, 400, None, None, None, None)),
        (("POST", {}, "{}"), (None, 400, None, None, None, None)),
    ]
    rows = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, method string, headers map<string,string>, body string")
    got = route_notifications(rows).orderBy("i").select("route", "status", "message_id", "subject", "topic", "token")
    assert [tuple(r) for r in got.collect()] == [w for _, w in cases]


def test_ack_batches(spark):
    acks = spark.range(95).select(
        F.lit("q").alias("queue"), F.timestamp_seconds(F.lit(1_704_067_200)).alias("ts"),
        (F.col("id") % 90).cast("string").alias("MessageId"), F.format_string("r%03d", "id").alias("ReceiptHandle"))
    rows = ack_batches(acks, workers=3).collect()
    entries = {e.MessageId: e.ReceiptHandle for r in rows for e in r.entries}
    assert len(entries) == sum(len(r.entries) for r in rows) == 90
    assert entries["0"] == "r090" and max(r.n for r in rows) == 10


def test_ack_failures(spark):
    rows = spark.createDataFrame(
        [(1, "b", "C", None, None, True), (1, "a", "C", 'm "x"', True, True), (1, "c", "C", "m", True, False)],
        "batch int, Id string, Code string, Message string, SenderFault boolean, failed boolean")
    assert ack_failures(rows, "batch").first().error == (
        '[{\n  Code: "C",\n  Id: "a",\n  Message: "m \\"x\\"",\n  SenderFault: true\n},{\n  Code: "C",\n  Id: "b"\n}]')


def test_queue_counters(spark):
    rows = spark.createDataFrame(
        [("message_enqueued_process_count", 1, 1), ("message_enqueued_process_count", 2, 1),
         ("queue_capacity_process", 1, 90), ("queue_capacity_process", 3, 180)],
        "measure string, t int, value bigint")
    log = rows.select(F.lit("g").alias("resource_group"), F.lit("n").alias("namespace"), F.lit("x").alias("name"),
                      F.timestamp_seconds("t").alias("ts"), "measure", "value")
    row = queue_counters(log).first()
    assert (row.message_enqueued_process_count, row.message_dequeued_delete_count) == (2, 0)
    assert (row.queue_capacity_process, row.queue_capacity_delete) == (180, None)


def test_select_repo_events_needs_a_kind(spark):
    with pytest.raises(ValueError):
        select_repo_events(spark.createDataFrame([("x",)], "type string"), "pushes")


def test_a_filter_parses_no_record_anew(spark):
    """Bodies are parsed once and records once, also where events are chosen by what was found in them."""
    bodies = [("1", '{"Records":[{"eventName":"A:B"},null,{"s3":{"object":{"key":"k"}}}]}'), ("2", "plain")]
    messages = spark.createDataFrame(bodies, "MessageId string, Body string").withColumn(
        "MessageAttributes", F.lit(None).cast("map<string,struct<DataType:string,StringValue:string>>"))
    failed = dead_letters(objects_from_messages(messages, "arn:aws:sqs:us-east-1:1:q")).select("id", "error")
    assert sorted(r.error for r in failed.collect()) == [
        "missing eventName; missing s3.bucket.arn", "missing eventName; missing s3.bucket.arn; missing s3.object.key",
        "missing s3.bucket.arn; missing s3.object.key"]
    assert failed._jdf.queryExecution().executedPlan().toString().count("from_json(") == 2
