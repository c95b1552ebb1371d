"""Projections of landed payloads into the event envelope.

All of them are narrow: one output row per input row, no shuffle, and only the
columns an envelope uses are read from the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import as_column
from ..functions.arn import arn_service
from ..functions.attributes import event_type, ext_attrs, key_subject
from ..schemas import PAYLOADS, STR_MAP

JSON = "application/json"
TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
SPEC_VERSION = "1.0"


def payload_json(fields: Column) -> Column:
    """JSON text of a struct; unset fields are written as null."""
    return F.to_json(fields, {"ignoreNullFields": "false", "timestampFormat": TIMESTAMPS})


def payload_struct(kind: str, df: DataFrame) -> Column:
    """The payload columns of ``kind`` from ``df``; columns it lacks become null."""
    return F.struct(*[
        (F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None).cast(field.dataType))
        .alias(field.name)
        for field in PAYLOADS[kind]])


def content_id(source: Column, kind: Column, subject: Column, data: Column) -> Column:
    """Id of an event whose origin gives none; equal on every replay."""
    return F.sha2(F.concat_ws("|", source, kind, F.coalesce(subject, F.lit("")), data), 256)


def event_envelope(
    df: DataFrame,
    type: str | Column,
    source: str | Column,
    data: Column,
    id: Column | None = None,
    subject: str | Column | None = None,
    time: Column | None = None,
    extensions: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One event per row of ``df``; ``data`` is JSON text. ``keep`` names extra columns."""
    type, source = as_column(type), as_column(source)
    subject = as_column(subject) if subject is not None else F.lit(None).cast("string")
    time = time if time is not None else F.lit(None).cast("timestamp")
    extensions = extensions if extensions is not None else F.lit(None).cast(STR_MAP)
    rows = df.select(
        (id if id is not None else F.lit(None)).cast("string").alias("id"),
        source.alias("source"), F.lit(SPEC_VERSION).alias("specversion"), type.alias("type"),
        subject.alias("subject"), time.alias("time"), F.lit(JSON).alias("datacontenttype"),
        extensions.alias("extensions"), data.alias("data"), *keep)
    if id is None:
        rows = rows.withColumn("id", content_id(*map(F.col, ("source", "type", "subject", "data"))))
    return rows


def sent_time(df: DataFrame) -> Column:
    """When a queue message was sent; null where the queue did not say."""
    if "Attributes" not in df.columns:
        return F.lit(None).cast("timestamp")
    return F.timestamp_millis(F.col("Attributes").getItem("SentTimestamp").try_cast("bigint"))


def events_from_messages(df: DataFrame, source: str | Column) -> DataFrame:
    """Queue messages; the whole message is the data, the time is when it was sent."""
    return event_envelope(
        df, event_type("sqs", "message"), source, payload_json(payload_struct("queue_message", df)),
        id=F.col("MessageId"), time=sent_time(df), extensions=ext_attrs(F.col("MessageAttributes")))


def events_from_stream_records(df: DataFrame, arn: str | Column) -> DataFrame:
    arn = as_column(arn)
    return event_envelope(
        df, event_type(arn_service(arn), "stream_record"), arn,
        payload_json(payload_struct("stream_record", df)),
        id=F.col("SequenceNumber"), subject=F.col("PartitionKey"),
        time=F.col("ApproximateArrivalTimestamp"))


def key_names(attribute_values: Column) -> Column:
    """Key names of an attribute map kept as a variant."""
    return F.map_keys(F.try_variant_get(attribute_values, "$", "map<string,variant>"))


def events_from_change_records(df: DataFrame, arn: str | Column) -> DataFrame:
    """Table changes; the subject lists the key names, an extension names the operation."""
    arn = as_column(arn)
    return event_envelope(
        df, event_type(arn_service(arn), "stream_record"), arn,
        payload_json(payload_struct("change_record", df)),
        id=F.col("EventID"), subject=key_subject(key_names(F.col("Dynamodb.Keys"))),
        time=F.col("Dynamodb.ApproximateCreationDateTime"),
        extensions=F.create_map(F.lit("dynamodboperation"), F.col("EventName")))


def events_from_logs(df: DataFrame, arn: str | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Log entries. Group and stream take part in the id: two streams may write the same line at one time."""
    arn = as_column(arn)
    kind, data = event_type(arn_service(arn), "log"), payload_json(payload_struct("log_event", df))
    return event_envelope(
        df, kind, arn, data, id=content_id(arn, kind, F.to_json(F.array("log_group", "log_stream")), data),
        time=F.timestamp_millis(F.col("Timestamp")), keep=keep)


def events_from_metrics(results: DataFrame, messages: DataFrame, source: str | Column) -> DataFrame:
    """Service messages, then metric results; ``position`` keeps that order."""
    first = event_envelope(
        messages, event_type("cloudwatch", "metrics.message"), source,
        payload_json(payload_struct("metric_message", messages)))
    second = event_envelope(
        results, event_type("cloudwatch", "metrics.metric"), source,
        payload_json(payload_struct("metric_result", results)),
        time=F.array_max("Timestamps"))
    return first.withColumn("position", F.lit(0)).unionByName(second.withColumn("position", F.lit(1)))


def events_from_perf(df: DataFrame, arn: str | Column) -> DataFrame:
    """Rows of ``perf_points``; the point's time is kept as the event time.

    The time takes part in the id, as the data alone repeats whenever a value does.
    """
    arn, kind = as_column(arn), event_type("rds", "pi.metric")
    data = payload_json(payload_struct("perf_metric", df))
    stamp = F.unix_micros("ts").cast("string")
    return event_envelope(
        df, kind, arn, data, id=content_id(arn, kind, stamp, data), time=F.col("ts"),
        extensions=F.create_map(F.lit("pimetric"), F.col("metric")))


def events_from_repo(
    commits: DataFrame, prs: DataFrame, arn: str | Column, branch: str | Column
) -> DataFrame:
    arn = as_column(arn)
    pushed = event_envelope(
        commits, event_type(arn_service(arn), "push"), arn,
        payload_json(payload_struct("commit", commits)), subject=branch)
    requested = event_envelope(
        prs, event_type(arn_service(arn), "pull_request"), arn,
        payload_json(payload_struct("pull_request", prs)), subject=branch)
    return pushed.unionByName(requested)


def events_from_sync(df: DataFrame, arn: str | Column) -> DataFrame:
    """Rows of ``sync_datasets``. Datasets of one identity share its id: dedupe on the subject too.

    Further parts of a dataset have ``#part`` after the id; the extensions hold ``part`` and ``parts``.
    """
    arn = as_column(arn)
    part, count = (F.col(c) if c in df.columns else F.lit(None).cast("bigint") for c in ("part", "parts"))
    further = F.when(part > 0, F.concat(F.lit("#"), part.cast("string")))
    numbers = F.create_map(
        F.lit("part"), F.coalesce(part, F.lit(0)).cast("string"),
        F.lit("parts"), F.coalesce(count, F.lit(1)).cast("string"))
    parts = F.split(arn, ":", 6)
    named = df.withColumns({
        "IdentityID": F.col("IdentityId"), "EventType": F.lit("SyncTrigger"),
        "Region": F.get(parts, F.lit(3)),
        "IdentityPoolID": F.split_part(F.get(parts, F.lit(5)), F.lit("/"), F.lit(2))})
    return event_envelope(
        named, event_type(arn_service(arn), "sync_trigger"), arn,
        payload_json(payload_struct("sync_dataset", named)),
        id=F.concat("IdentityID", F.coalesce(further, F.lit(""))), subject=F.col("DatasetName"),
        time=F.col("LastModifiedDate"), extensions=numbers)


def events_from_users(df: DataFrame, arn: str | Column) -> DataFrame:
    arn = as_column(arn)
    pool = F.split_part(F.get(F.split(arn, ":", 6), F.lit(5)), F.lit("/"), F.lit(2))
    return event_envelope(
        df, event_type(arn_service(arn), "sync_trigger"), arn,
        payload_json(payload_struct("user", df)), subject=pool, time=F.col("UserLastModifiedDate"))


def events_from_notifications(df: DataFrame, source: str | Column) -> DataFrame:
    """Accepted notifications of ``route_notifications``; the body is kept as it came."""
    return event_envelope(
        df, event_type("sns", "notification"), source, F.col("body"),
        id=F.col("message_id"), subject=F.col("subject"), time=F.col("received"))
