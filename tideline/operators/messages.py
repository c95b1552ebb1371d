"""Queue messages: object notifications, named processors, acknowledgements, counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import as_column
from ..functions.attributes import event_type, ext_attrs, object_event_type
from .envelope import content_id, event_envelope, events_from_messages, payload_json, payload_struct

BATCH_SIZE = 10
FLUSH_SECONDS = 3


# a body is read between brackets, which rejects text after its end
BODY = "array<struct<Records:array<string>,Service:variant,Event:variant,Bucket:variant>>"
RECORD = "eventName string, s3 struct<bucket:struct<arn:string>,object:struct<key:string>>"
# text that a JSON value other than text would also be read as
NOT_TEXT = r"^(-?[0-9.eE+-]+|true|false|[{\[].*)$"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _text(value: Column) -> Column:
    """A member that is JSON text; null when absent or of another type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _member_text(record: Column, path: str, value: Column) -> Column:
    """As ``_text`` for a member read as ``value``; only what could be another type is looked at twice.

    Separate branches, as the sides of an ``or`` count as evaluated for every row: all records would be parsed once more.
    """
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(record), path, "variant"))
    return F.when(value.isNull(), None).when(~value.rlike(NOT_TEXT), value).when(kind == "STRING", value)


def is_test_event(body: Column) -> Column:
    """Whether a parsed body announces a change of a bucket's notification settings."""
    return F.coalesce(
        (_text(body["Service"]) == "Amazon S3") & (_text(body["Event"]) == "s3:TestEvent"), F.lit(False))


def objects_from_messages(df: DataFrame, fallback_source: str | Column) -> DataFrame:
    """Events of messages that carry bucket notifications, plus an ``errors`` array.

    A list of records gives one event per record, so an empty list gives none. A
    test event gives one. Any other body is passed on as an ordinary message.
    A record without event name, bucket or key, and a test event without bucket,
    keeps its row with ``errors`` set (see ``dead_letters``). Each body is parsed
    once, and each record once as it is listed, below the generator: a filter on
    the events does not pass that, so it never parses records anew. No shuffle.
    """
    parsed = F.from_json(F.concat(F.lit("["), F.col("Body"), F.lit("]")), BODY, STRICT)
    rows = df.select(
        parsed.alias("_parsed"), F.col("Body").alias("_text"), F.col("MessageId").alias("_id"),
        payload_struct("queue_message", df).alias("_message"))
    rows = rows.withColumn("_body", F.when(F.size("_parsed") == 1, F.get("_parsed", F.lit(0))))
    rows = rows.withColumn(
        "_branch",
        F.when(F.col("_body.Records").isNotNull(), "record")
        .when(is_test_event(F.col("_body")), "test")
        .otherwise("message"))

    # a record's row carries nothing of its message; the others have one row, of a null record
    def only(branch: str, value: Column) -> Column:
        return F.when(F.col("_branch") == branch, value)

    read = F.transform("_body.Records", lambda text: F.struct(text.alias("text"), F.from_json(text, RECORD).alias("read")))
    none = F.lit(None).cast(f"struct<text:string,read:struct<{RECORD}>>")
    rows = rows.select(
        "_id", "_branch", only("message", F.col("_message")).alias("_message"),
        only("test", F.col("_text")).alias("_text"), only("test", _text(F.col("_body.Bucket"))).alias("_test_bucket"),
        F.explode(only("record", read).otherwise(F.array(none))).alias("_item"))
    rows = rows.select("*", F.col("_item.text").alias("_record"), F.col("_item.read").alias("_r")).drop("_item")
    rows = rows.withColumns({
        "_name": _member_text(F.col("_record"), "$.eventName", F.col("_r.eventName")),
        "_key": _member_text(F.col("_record"), "$.s3.object.key", F.col("_r.s3.object.key")),
        "_bucket": F.coalesce(
            "_test_bucket", _member_text(F.col("_record"), "$.s3.bucket.arn", F.col("_r.s3.bucket.arn")))})
    is_record, is_test = F.col("_branch") == "record", F.col("_branch") == "test"
    kind = (
        F.when(is_record, event_type("s3", object_event_type(F.col("_name"))))
        .when(is_test, event_type("s3", "testevent"))
        .otherwise(event_type("sqs", "message")))
    source = (
        F.when(is_record, F.col("_bucket"))
        .when(is_test, F.concat(F.lit("arn:aws:s3:::"), F.col("_bucket")))
        .otherwise(as_column(fallback_source)))
    data = (
        F.when(is_record, F.col("_record"))
        .when(is_test, F.col("_text"))
        .otherwise(payload_json(F.col("_message"))))
    errors = F.array_compact(F.array(
        F.when(is_record & F.col("_name").isNull(), "missing eventName"),
        F.when(is_record & F.col("_bucket").isNull(), "missing s3.bucket.arn"),
        F.when(is_record & F.col("_key").isNull(), "missing s3.object.key"),
        F.when(is_test & F.col("_bucket").isNull(), "missing Bucket")))
    rows = rows.withColumns({"_kind": kind, "_source": source, "_data": data, "_errors": errors})
    events = event_envelope(
        rows, F.col("_kind"), F.col("_source"), F.col("_data"),
        id=F.when(is_record, content_id(*map(F.col, ("_source", "_kind", "_key", "_data"))))
        .otherwise(F.col("_id")),
        subject=F.col("_key"),
        extensions=F.when(~is_record & ~is_test, ext_attrs(F.col("_message.MessageAttributes"))),
        keep=["_errors"])
    return events.withColumnRenamed("_errors", "errors")


Processor = Callable[[DataFrame, "str | Column"], DataFrame]

_PROCESSORS: dict[str, Processor] = {
    "default": events_from_messages,
    "s3": objects_from_messages,
}


def register_processor(name: str, fn: Processor) -> None:
    """Make ``fn(messages, source)`` available under ``name``."""
    _PROCESSORS[name] = fn


def processor(name: str) -> Processor:
    if name not in _PROCESSORS:
        raise ValueError(f'unsupported message processor "{name}"')
    return _PROCESSORS[name]


def ack_batches(
    acks: DataFrame, size: int = BATCH_SIZE, flush_seconds: int = FLUSH_SECONDS, workers: int = 24
) -> DataFrame:
    """Delete requests of at most ``size`` entries from ``(queue, ts, MessageId, ReceiptHandle)``.

    A batch never outlives one flush period and belongs to one of the ``workers``
    that drain a queue. Numbering therefore runs inside (queue, period, worker),
    and a queue that holds most of the rows still spreads over many tasks. Within
    such a buffer the last receipt of a message wins.
    """
    buffer = ["queue", "period", "worker"]
    digest = F.conv(F.substring(F.md5("MessageId"), 1, 8), 16, 10).cast("bigint")
    latest = (
        acks.withColumn("period", F.floor(F.unix_seconds("ts") / flush_seconds).cast("bigint"))
        .withColumn("worker", digest % workers)
        .groupBy(*buffer, "MessageId")
        .agg(F.max_by("ReceiptHandle", F.struct("ts", "ReceiptHandle")).alias("ReceiptHandle"),
             F.max("ts").alias("ts")))
    position = F.row_number().over(Window.partitionBy(*buffer).orderBy("ts", "MessageId"))
    entries = F.sort_array(F.collect_list(F.struct("MessageId", "ReceiptHandle")))
    return (
        latest.withColumn("batch", F.floor((position - 1) / size).cast("bigint"))
        .groupBy(*buffer, "batch")
        .agg(entries.alias("entries"))
        .withColumn("n", F.size("entries").cast("bigint")))


def _field(name: str, text: Column) -> Column:
    return F.when(text.isNotNull(), F.concat(F.lit(f"  {name}: "), text))


def _quoted(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def ack_failures(results: DataFrame, *batch: str) -> DataFrame:
    """Failed entries of each delete request as one bracketed text.

    ``results`` has ``Id, Code, Message, SenderFault, failed`` per entry; ``batch``
    names the columns of a request, which holds at most ten entries.
    """
    if not batch:
        raise ValueError("name the columns that make up a request")
    fields = F.array_compact(F.array(
        _field("Code", _quoted(F.col("Code"))), _field("Id", _quoted(F.col("Id"))),
        _field("Message", _quoted(F.col("Message"))),
        _field("SenderFault", F.col("SenderFault").cast("string"))))
    entry = F.concat(F.lit("{\n"), F.array_join(fields, ",\n"), F.lit("\n}"))
    listed = F.sort_array(F.collect_list(F.struct("Id", entry.alias("text"))))
    return (
        results.where("failed").groupBy(*batch)
        .agg(listed.alias("listed"))
        .select(*batch, F.size("listed").cast("bigint").alias("n"),
                F.concat(F.lit("["), F.array_join(F.col("listed.text"), ","), F.lit("]")).alias("error")))


# counter per step of a message's way, and the two capacities
COUNTERS = [
    "message_enqueued_process_count", "message_dequeued_process_count",
    "message_enqueued_delete_count", "message_dequeued_delete_count",
]
GAUGES = ["queue_capacity_process", "queue_capacity_delete"]


def counter_expressions() -> list[Column]:
    """Aggregates over ``(ts, measure, value)`` rows; also usable with ``DataFrame.observe``."""
    counts = [F.count_if(F.col("measure") == name).alias(name) for name in COUNTERS]
    last = [
        F.max_by(F.when(F.col("measure") == name, F.col("value")),
                 F.when(F.col("measure") == name, F.struct("ts", "value"))).alias(name)
        for name in GAUGES]
    return counts + last


def queue_counters(log: DataFrame) -> DataFrame:
    """Counters and last capacities per (resource group, namespace, name)."""
    return log.groupBy("resource_group", "namespace", "name").agg(*counter_expressions())
