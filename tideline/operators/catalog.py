"""Whole tables of source configuration, and reports over status messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arn import arn_error, arn_parse, arn_resource, log_resource
from ..functions.attributes import event_source, queue_name, split_list, url_path
from ..functions.duration import duration_error, duration_format, duration_parse
from ..functions.predicates import (
    OBJECT_EVENTS, REPO_EVENTS, polling_interval, valid_region, valid_source_arn,
    valid_visibility_timeout)
from ..functions.reasons import failure_reason
from .config import event_types

# resource format of the kinds whose ARN carries a key/value path
RESOURCE_KINDS = {
    "cognitouserpool": "userpool",
    "cognitoidentity": "identitypool",
    "dynamodb": "table",
    "kinesis": "stream",
}


def _resource_value(kind: Column, resource: Column) -> Column:
    value = None
    for name, form in RESOURCE_KINDS.items():
        read = F.get(arn_resource(resource, form), F.lit(0))
        value = F.when(kind == name, read) if value is None else value.when(kind == name, read)
    return value


def source_catalog(configs: DataFrame, prefix: str | Column) -> DataFrame:
    """Normalised source configurations, with everything wrong with a row in ``errors``.

    Reads ``(kind, ns, name, arn, region, event_types, polling_interval,
    visibility_timeout)``, all text, ``event_types`` as a comma list. One narrow
    pass of column expressions; a row is never dropped.
    """
    kind = F.col("kind")
    rows = configs.withColumns({
        "arn_parts": arn_parse(F.col("arn")),
        "configured": F.when(F.col("event_types") != "", split_list(F.col("event_types"))),
        "interval_ns": duration_parse(F.col("polling_interval")),
        "timeout_ns": duration_parse(F.col("visibility_timeout"))})
    has_arn = kind != "cloudwatch"
    resource = F.col("arn_parts.resource")
    known_events = (
        F.when(kind == "s3", F.forall("configured", lambda t: t.isin(OBJECT_EVENTS)))
        .when(kind == "codecommit", F.forall("configured", lambda t: t.isin(REPO_EVENTS))))
    interval_error = duration_error(F.col("polling_interval"), F.col("interval_ns"))
    timeout_error = duration_error(F.col("visibility_timeout"), F.col("timeout_ns"))
    errors = F.array_compact(F.array(
        F.when(has_arn & arn_error(F.col("arn")).isNotNull(), F.concat(F.lit("arn: "), arn_error(F.col("arn")))),
        F.when(has_arn & ~valid_source_arn(kind, F.col("arn")), F.lit("arn: not accepted by this kind")),
        F.when(kind.isin(*RESOURCE_KINDS) & F.col("arn_parts").isNotNull()
               & _resource_value(kind, resource).isNull(), F.lit("arn: unexpected resource")),
        F.when(~has_arn & ~F.coalesce(valid_region(F.col("region")), F.lit(False)), F.lit("region: invalid")),
        F.when(~known_events, F.lit("event types: unknown")),
        F.when(F.col("polling_interval").isNotNull(), F.concat(F.lit("polling interval: "), interval_error)),
        F.when(F.col("visibility_timeout").isNotNull(), F.concat(F.lit("visibility timeout: "), timeout_error)),
        F.when(F.col("timeout_ns").isNotNull() & valid_visibility_timeout(F.col("timeout_ns")).isNull(),
               F.lit("visibility timeout: out of bounds"))))
    logs = log_resource(resource)
    interval = polling_interval(F.col("interval_ns"))
    return rows.select(
        "kind", "ns", "name", "arn", "arn_parts",
        event_source(kind, F.col("arn"), F.col("arn_parts"), F.col("ns"), F.col("name"), prefix).alias("source"),
        url_path(F.col("ns"), F.col("name")).alias("path"),
        _resource_value(kind, resource).alias("resource_value"),
        F.when(kind == "cloudwatchlogs", logs["log_group"]).alias("log_group"),
        F.when(kind == "cloudwatchlogs", logs["log_stream"]).alias("log_stream"),
        F.when(kind == "s3", queue_name(resource)).alias("queue_name"),
        interval.alias("polling_interval_ns"),
        duration_format(interval).alias("polling_interval"),
        valid_visibility_timeout(F.col("timeout_ns")).alias("visibility_timeout_seconds"),
        event_types(kind, F.col("arn_parts.service"), F.col("configured")).alias("event_types"),
        errors.alias("errors"))


def failure_report(statuses: DataFrame, period_seconds: int = 3600) -> DataFrame:
    """Messages per exact reason and period of ``(ts, reason, message)`` rows."""
    start = F.floor(F.unix_seconds("ts") / period_seconds).cast("bigint") * period_seconds
    return statuses.groupBy(
        failure_reason(F.col("reason"), F.col("message")).alias("reason"), start.alias("bucket"),
    ).agg(F.count("*").alias("n"))
