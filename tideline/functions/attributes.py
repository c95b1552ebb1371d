"""Names and small texts that end up in event attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import as_column, let

# fixed values
TYPE_PREFIX = "com.amazon."
EXTENSION_PREFIX = "sqsmsg"
QUEUE_PREFIX = "s3-events_"


def event_type(service: str | Column, kind: str | Column) -> Column:
    return F.concat(F.lit(TYPE_PREFIX), as_column(service), F.lit("."), as_column(kind))


def event_source(
    kind: Column, arn: Column, arn_parts: Column, ns: Column, name: Column, prefix: str | Column
) -> Column:
    """Source attribute of a configured source.

    Metric sources have no resource of their own and are named after their
    configuration; buckets use their global name; the rest use their ARN.
    """
    from .arn import bucket_arn

    return (
        F.when(kind == "cloudwatch",
               F.concat_ws(".", as_column(prefix), F.lit("awscloudwatchsource"), ns, name))
        .when(kind == "s3", bucket_arn(arn_parts))
        .otherwise(arn))


def ext_attr_name(name: Column) -> Column:
    """Extension name of a message attribute: prefix plus lower-case ASCII alphanumerics."""
    return F.concat(F.lit(EXTENSION_PREFIX), F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", "")))


def ext_attrs(attributes: Column) -> Column:
    """Extensions of a message: its non-binary attributes, renamed; null when there are none.

    Names that collide after renaming keep the value of the last original name.
    """
    def is_text(value: Column) -> Column:
        return value["StringValue"].isNotNull() & ~F.coalesce(value["DataType"].startswith("Binary"), F.lit(False))

    def renamed(kept: Column) -> Column:
        return F.struct(
            F.transform(F.map_keys(kept), ext_attr_name).alias("keys"),
            F.transform(F.map_values(kept), lambda v: v["StringValue"]).alias("values"),
            F.map_keys(kept).alias("names"))

    def as_map(text: Column) -> Column:
        unique = F.size(F.array_distinct(text["keys"])) == F.size(text["keys"])
        return F.when(unique, F.map_from_arrays(text["keys"], text["values"])).otherwise(_last_wins(text))

    kept = F.map_filter(attributes, lambda _, value: is_text(value))
    extensions = let(kept, lambda k: let(renamed(k), as_map))
    return F.when(F.size(kept) > 0, extensions)


def _last_wins(text: Column) -> Column:
    """Map of colliding keys: ordered by original name, the last value of a key stays."""
    ordered = F.sort_array(F.arrays_zip(text["names"], text["keys"], text["values"]))

    def unique(entries: Column) -> Column:
        later = F.filter(entries, lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda other: other["keys"] == e["keys"]))
        return F.map_from_entries(F.transform(later, lambda e: F.struct(e["keys"], e["values"])))

    return let(ordered, unique)


def object_event_type(event_name: Column) -> Column:
    """``ObjectRemoved:Delete`` becomes ``objectremoved``."""
    return F.lower(F.split_part(event_name, F.lit(":"), F.lit(1)))


def spec_event_type(configured: Column) -> Column:
    """As ``object_event_type`` for configured names, which start with ``s3:``."""
    return object_event_type(F.regexp_replace(configured, "^s3:", ""))


def key_subject(names: Column) -> Column:
    """Comma-joined key names in sorted order; '' when there are none."""
    return F.coalesce(F.array_join(F.sort_array(names), ","), F.lit(""))


def url_path(ns: Column, name: Column) -> Column:
    return F.concat(F.lit("/"), ns, F.lit("/"), name)


def queue_name(bucket: Column) -> Column:
    return F.concat(F.lit(QUEUE_PREFIX), bucket)


def split_list(text: Column) -> Column:
    return F.split(text, ",")


def seconds_ms(ts: Column) -> Column:
    """Epoch milliseconds of ``ts`` cut to whole seconds."""
    return F.unix_seconds(ts) * 1000
