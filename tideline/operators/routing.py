"""Routing of pushed requests and lookups of registered resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.attributes import url_path

TYPE_HEADER = "X-Amz-Sns-Message-Type"
ID_HEADER = "X-Amz-Sns-Message-Id"
TOPIC_HEADER = "X-Amz-Sns-Topic-Arn"


def registry(sources: DataFrame) -> DataFrame:
    """Paths of registered sources; the last registration of a path wins by ``pos``."""
    paths = sources.withColumn("path", url_path(F.col("ns"), F.col("name")))
    return paths.groupBy("path").agg(F.max_by("source", "pos").alias("source"))


def route_requests(requests: DataFrame, registered: DataFrame) -> DataFrame:
    """Adds the ``source`` registered for a request's path and ``status``: 200, or 404 without one."""
    known = registered.select("path", "source")
    return requests.join(known, "path", "left").withColumn(
        "status", F.when(F.col("source").isNull(), 404).otherwise(200).cast("bigint"))


def route_notifications(requests: DataFrame) -> DataFrame:
    """Classifies captured requests by method, message type and body.

    ``route`` is ``notification``, ``confirmation`` or null with ``status`` 405
    (method), 400 (type or body). Notifications get ``message_id`` and
    ``subject``; confirmations get ``topic`` and ``token``.
    """
    # header names are case-insensitive
    headers = F.transform_keys("headers", lambda k, _: F.lower(k))
    body = F.try_parse_json("body")
    rows = requests.withColumns({"_h": headers, "_v": body})

    def header(name: str):
        return F.col("_h")[name.lower()]

    # null and objects can be read as a message, provided the member wanted is text
    kind = F.schema_of_variant("_v")

    def readable(member: str):
        inner = F.schema_of_variant(F.try_variant_get("_v", f"$.{member}", "variant"))
        return (kind == "VOID") | (kind.startswith("OBJECT") & F.coalesce(inner.isin("STRING", "VOID"), F.lit(True)))

    is_notification = header(TYPE_HEADER) == "Notification"
    is_confirmation = header(TYPE_HEADER) == "SubscriptionConfirmation"
    route = (
        F.when(F.col("method") != "POST", F.lit(None))
        .when(is_notification & readable("Subject"), "notification")
        .when(is_confirmation & readable("Token"), "confirmation"))
    rows = rows.withColumn("route", route)
    status = (
        F.when(F.col("method") != "POST", 405).when(F.col("route").isNotNull(), 200).otherwise(400))
    noted, confirmed = F.col("route") == "notification", F.col("route") == "confirmation"

    def member(name: str):
        return F.coalesce(F.try_variant_get("_v", f"$.{name}", "string"), F.lit(""))

    return rows.withColumns({
        "status": status.cast("bigint"),
        "message_id": F.when(noted, header(ID_HEADER)),
        "subject": F.when(noted, member("Subject")),
        "topic": F.when(confirmed, header(TOPIC_HEADER)),
        "token": F.when(confirmed, member("Token")),
    }).drop("_h", "_v")


def resolve_resource(wanted: DataFrame, instances: DataFrame) -> DataFrame:
    """Adds ``resource_id`` of the last instance with the row's ``arn``; '' without one."""
    last = instances.groupBy("arn").agg(F.max_by("resource_id", "pos").alias("resource_id"))
    return wanted.join(last, "arn", "left").withColumn("resource_id", F.coalesce("resource_id", F.lit("")))


def find_subscription(wanted: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Adds the first ``subscription_arn`` of the row's topic and endpoint; null and ``found`` false without one."""
    first = subscriptions.groupBy("topic_arn", "endpoint").agg(
        F.min_by("subscription_arn", "pos").alias("subscription_arn"))
    return wanted.join(first, ["topic_arn", "endpoint"], "left").withColumn(
        "found", F.col("subscription_arn").isNotNull())
