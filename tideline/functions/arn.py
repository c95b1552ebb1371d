"""Resource names: parse, format, and read the resource part."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PARTS = ["partition", "service", "region", "account_id", "resource"]

# fixed values: resource formats, as key/value paths
RESOURCE_KEYS = {
    "userpool": ["userpool"],
    "identitypool": ["identitypool"],
    "table": ["table"],
    "stream": ["stream"],
}


def arn_error(arn: Column) -> Column:
    """Why ``arn`` cannot be parsed, or null."""
    return (
        F.when(arn.isNull() | ~arn.startswith("arn:"), "invalid prefix")
        .when(F.size(F.split(arn, ":", 6)) < 6, "not enough sections")
    )


def arn_parse(arn: Column) -> Column:
    """Struct of the five named parts; null where ``arn_error`` is set."""
    sections = F.split(arn, ":", 6)
    named = [F.get(sections, F.lit(i + 1)).alias(name) for i, name in enumerate(PARTS)]
    return F.when(arn_error(arn).isNull(), F.struct(*named))


def arn_format(parts: Column) -> Column:
    """Text of a parsed name; a missing part becomes an empty section."""
    sections = [F.coalesce(parts[name], F.lit("")) for name in PARTS]
    return F.when(parts.isNotNull(), F.concat_ws(":", F.lit("arn"), *sections))


def bucket_arn(parts: Column) -> Column:
    """A bucket's global name, which carries no region and no account."""
    return arn_format(
        parts.withField("region", F.lit("")).withField("account_id", F.lit("")))


def arn_service(arn: Column) -> Column:
    return F.split_part(arn, F.lit(":"), F.lit(3))


def arn_resource(resource: Column, kind: str) -> Column:
    """Values of a ``key/value/...`` resource; null unless length and keys match ``kind``."""
    keys = RESOURCE_KEYS[kind]
    sections = F.split(resource, "/")
    matches = F.size(sections) == 2 * len(keys)
    for i, key in enumerate(keys):
        matches = matches & (F.get(sections, F.lit(2 * i)) == key)
    return F.when(matches, F.array(*[F.get(sections, F.lit(2 * i + 1)) for i in range(len(keys))]))


def _after(atoms: Column, word: str) -> Column:
    """The atom after the last ``word``, or empty text."""
    backwards = F.reverse(atoms)
    at = F.array_position(backwards, F.lit(word)).cast("int")
    return F.when(atoms.isNotNull(), F.coalesce(F.get(backwards, at - 2), F.lit("")))


def log_resource(resource: Column) -> Column:
    """Struct ``(log_group, log_stream)`` of a log resource; '' where absent."""
    atoms = F.split(resource, ":")
    return F.struct(
        _after(atoms, "log-group").alias("log_group"),
        _after(atoms, "log-stream").alias("log_stream"))
