"""Set operations on configuration rows, and the registry of event types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import as_column
from ..functions.attributes import event_type, spec_event_type


def upsert_by_id(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], events: str = "events"
) -> DataFrame:
    """``current`` with the rows of ``updates`` put in by key; ``changed`` tells what an update altered.

    An update alters a row when the row is new or its event list differs; the
    order in which the update lists its events does not matter.
    """
    names = [c for c in current.columns if c not in keys]
    old = current.select(*keys, F.struct(*names).alias("_old"))
    new = updates.select(*keys, F.struct(*names).alias("_new"))
    row = F.coalesce("_new", "_old")
    same = F.sort_array(F.col(f"_new.{events}")).eqNullSafe(F.col(f"_old.{events}"))
    changed = F.col("_new").isNotNull() & (F.col("_old").isNull() | ~same)
    return (
        old.join(new, list(keys), "full")
        .select(*keys, *[row[name].alias(name) for name in names], changed.alias("changed")))


def remove_by_id(current: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` without the rows whose key is in ``removed``."""
    return current.join(removed.select(*keys), list(keys), "left_anti")


def _fits(desired: Column, current: Column, data_type: T.DataType) -> Column:
    """Whether a current value satisfies a desired one; an unset desired value accepts all."""
    equal = desired.eqNullSafe(current)
    if isinstance(data_type, T.StringType):
        return desired.isNull() | (desired == "") | equal
    if isinstance(data_type, T.LongType):
        return desired.isNull() | (desired == 0) | equal
    if isinstance(data_type, T.ArrayType):
        # the wanted elements must lead the current list
        head = F.slice(current, F.lit(1), F.size(desired))
        return desired.isNull() | (F.size(desired) == 0) | head.eqNullSafe(desired)
    if isinstance(data_type, T.MapType):
        held = F.forall(F.map_entries(desired), lambda e: F.coalesce(current[e["key"]] == e["value"], F.lit(False)))
        return desired.isNull() | (F.size(desired) == 0) | F.coalesce(held, F.lit(False))
    return desired.isNull() | equal


def desired_state_diff(desired: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``action`` per desired row: ``create``, ``update`` or ``noop``, with the columns that differ.

    Unset desired values (null, empty text, list or map, whole number 0) accept
    any current value. Rows that are only in ``current`` call for no action.
    """
    types = {f.name: f.dataType for f in desired.schema if f.name not in keys}
    have = current.select(*keys, F.struct(*types).alias("_have"))
    have_column = F.col("_have")
    differs = F.array_compact(F.array(*[
        F.when(~_fits(F.col(name), have_column[name], kind), F.lit(name)) for name, kind in types.items()]))
    action = (
        F.when(have_column.isNull(), "create").when(F.size("differs") > 0, "update").otherwise("noop"))
    return (
        desired.join(have, list(keys), "left")
        .withColumn("differs", F.when(have_column.isNotNull(), differs).otherwise(F.array().cast("array<string>")))
        .withColumn("action", action).drop("_have"))


# fixed values: event types of kinds with a constant list, without prefix
CONSTANT_TYPES = {
    "sqs": ["message"],
    "kinesis": ["stream_record"],
    "dynamodb": ["stream_record"],
    "cognitouserpool": ["sync_trigger"],
    "cognitoidentity": ["sync_trigger"],
    "cloudwatchlogs": ["log"],
    "sns": ["notification"],
}


def event_types(kind: Column, service: Column, configured: Column) -> Column:
    """Array of the event types a source emits.

    Null where the service is needed and not known. Buckets: the distinct configured types and the test event, sorted.
    Repositories: the configured types in their order. Others: a constant list.
    """
    configured = F.coalesce(configured, F.array().cast("array<string>"))
    objects = F.sort_array(F.array_distinct(F.concat(
        F.transform(configured, lambda t: event_type("s3", spec_event_type(t))),
        F.array(event_type("s3", "testevent")))))
    result = (
        F.when(kind == "s3", objects)
        .when((kind == "codecommit") & service.isNotNull(), F.transform(configured, lambda t: event_type(service, t)))
        .when(kind == "cloudwatch", F.array(
            event_type("cloudwatch", "metrics.metric"), event_type("cloudwatch", "metrics.message")))
        .when(kind == "performanceinsights", F.array(event_type("rds", "pi.metric"))))
    for name, types in CONSTANT_TYPES.items():
        result = result.when(
            (kind == name) & service.isNotNull(), F.array(*[event_type(service, t) for t in types]))
    return result


def event_type_registry(catalog: DataFrame) -> DataFrame:
    """One ``(source, type)`` row per event type of each source; ``pos`` is its place in the list."""
    return catalog.select("source", F.posexplode("event_types").alias("pos", "type")).select(
        "source", "type", F.col("pos").cast("bigint").alias("pos"))


def select_repo_events(events: DataFrame, wanted: str, service: str | Column = "codecommit") -> DataFrame:
    """Events of the kinds in a comma list; a list without a known kind is an error."""
    from ..functions.predicates import REPO_EVENTS

    kinds = [k.strip() for k in wanted.split(",") if k.strip() in REPO_EVENTS]
    if not kinds:
        raise ValueError(f'no event type in "{wanted}"; valid: {",".join(REPO_EVENTS)}')
    return events.where(F.col("type").isin(*[event_type(as_column(service), k) for k in kinds]))
