"""Typed access to event data and checks against the payload contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import ENUMS, NULLABLE, OPEN, OPTIONAL, PAYLOADS


def typed_payload(events: DataFrame, kind: str) -> DataFrame:
    """Adds ``payload``: the event data as its payload type."""
    return events.withColumn("payload", F.from_json("data", PAYLOADS[kind]))


def _kinds(data_type: T.DataType) -> str:
    """Pattern of the JSON types a field accepts."""
    if isinstance(data_type, T.LongType):
        return "BIGINT"
    if isinstance(data_type, T.DoubleType):
        return "BIGINT|DECIMAL.*|DOUBLE|FLOAT"
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, T.ArrayType):
        return "ARRAY.*"
    if isinstance(data_type, (T.StructType, T.MapType, T.VariantType)):
        return "OBJECT.*"
    return "STRING"


class _Contract:
    """Builds one array-of-errors expression for a payload kind."""

    def __init__(self, kind: str):
        self.optional = OPTIONAL.get(kind, set())
        self.nullable = NULLABLE.get(kind, set())
        self.enums = ENUMS.get(kind, {})
        self.open = OPEN.get(kind, set())

    def members(self, value: Column, schema: T.StructType, path: str) -> list[Column]:
        """Errors of an object, given as a map of its members."""
        prefix = f"{path}." if path else ""
        names = [field.name for field in schema]
        required = [n for n in names if prefix + n not in self.optional]
        keys = F.map_keys(value)
        checks = [F.transform(F.array_except(F.array(*map(F.lit, required)), keys),
                              lambda n: F.concat(F.lit(f"missing {prefix}"), n))]
        if path not in self.open:
            checks.append(F.transform(F.array_except(keys, F.array(*map(F.lit, names))),
                                      lambda n: F.concat(F.lit(f"unknown {prefix}"), n)))
        for field in schema:
            checks.extend(self.value(value[field.name], field.dataType, prefix + field.name))
        return checks

    def value(self, variant: Column, data_type: T.DataType, path: str) -> list[Column]:
        """Errors of one field; null means the field is absent, JSON's null is a value of its own."""
        accepted = _kinds(data_type) + ("|VOID" if path in self.nullable else "")
        fits = F.schema_of_variant(variant).rlike(rf"^({accepted})\z")
        checks = [F.when(variant.isNotNull() & ~F.coalesce(fits, F.lit(False)),
                         F.array(F.lit(f"type {path}")))]
        if path in self.enums:
            plain = F.try_variant_get(variant, "$", "string")
            checks.append(F.when(~plain.isin(self.enums[path]), F.array(F.lit(f"value {path}"))))
        if isinstance(data_type, T.StructType):
            checks.append(self._object(variant, data_type, path))
        elif isinstance(data_type, T.MapType) and isinstance(data_type.valueType, T.StructType):
            entries = F.map_values(_members(variant))
            checks.append(self._each(entries, data_type.valueType, path))
        elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
            checks.append(self._each(_elements(variant), data_type.elementType, path))
        elif isinstance(data_type, T.ArrayType):
            pattern = rf"^({_kinds(data_type.elementType)})\z"
            wrong = F.exists(_elements(variant), lambda e: ~F.coalesce(F.schema_of_variant(e).rlike(pattern), F.lit(False)))
            checks.append(F.when(wrong, F.array(F.lit(f"type {path}[]"))))
        return checks

    def _object(self, variant: Column, schema: T.StructType, path: str) -> Column:
        members = _members(variant)
        return F.when(members.isNotNull(), _joined(self.members(members, schema, path)))

    def _each(self, variants: Column, schema: T.StructType, path: str) -> Column:
        return F.flatten(F.transform(
            variants, lambda e: F.coalesce(self._object(e, schema, path), F.array(F.lit(f"type {path}[]")))))


def _none() -> Column:
    return F.array().cast("array<string>")


def _joined(checks: list[Column]) -> Column:
    return F.concat(*[F.coalesce(c, _none()) for c in checks])


def _members(variant: Column) -> Column:
    """An object's members; null when it is no object."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def _elements(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<variant>")


def validate_payload(df: DataFrame, kind: str, column: str = "data") -> DataFrame:
    """Adds ``errors``: sorted texts such as ``missing Message``; empty when the data conforms.

    Checked at every level: required fields, fields that are not declared,
    JSON types and enumerated values. The text is parsed once.
    """
    members = _members(F.try_parse_json(F.col(column)))
    found = F.sort_array(F.array_distinct(_joined(_Contract(kind).members(F.col("_m"), PAYLOADS[kind], ""))))
    return (
        df.withColumn("_m", members)
        .withColumn("errors", F.when(F.col("_m").isNull(), F.array(F.lit("not an object"))).otherwise(found))
        .drop("_m"))
