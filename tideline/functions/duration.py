"""Duration text such as ``1h5m10s`` and whole nanoseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: nanoseconds per unit
UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}
SECOND = UNITS["s"]
MINUTE = UNITS["m"]
HOUR = UNITS["h"]

_NUMBER = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
_UNIT = "(?:" + "|".join(UNITS) + ")"
_TERM = _NUMBER + _UNIT


def _nanos(text: Column) -> Column:
    """Signed total, or null when it does not fit 64 bits."""
    numbers = F.regexp_extract_all(text, F.lit(f"({_NUMBER}){_UNIT}"), 1)
    units = F.regexp_extract_all(text, F.lit(f"{_NUMBER}({_UNIT})"), 1)
    scale = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    terms = F.zip_with(
        numbers, units,
        lambda n, u: F.floor(n.try_cast("decimal(30,15)") * scale[u].cast("decimal(13,0)")))
    total = F.aggregate(
        terms, F.lit(0).cast("decimal(38,0)"),
        lambda acc, x: (acc + x).cast("decimal(38,0)"))
    sign = F.when(text.startswith("-"), -1).otherwise(1).cast("decimal(1,0)")
    return (sign * total).try_cast("bigint")


def _well_formed(text: Column) -> Column:
    return text.rlike(rf"^[+-]?(0|({_TERM})+)\z")


def duration_parse(text: Column) -> Column:
    """Nanoseconds, or null where ``duration_error`` is set."""
    return F.when(_well_formed(text), _nanos(text))


def duration_error(text: Column, parsed: Column | None = None) -> Column:
    """Why ``text`` is not a duration, or null. ``parsed`` is its value if already at hand."""
    parsed = _nanos(text) if parsed is None else parsed
    return (
        F.when(text.isNull(), "invalid duration")
        .when(_well_formed(text), F.when(parsed.isNull(), "invalid duration"))
        .when(text.rlike(rf"^[+-]?({_TERM})*{_NUMBER}\z"), "missing unit")
        .when(text.rlike(rf"^[+-]?({_TERM})*{_NUMBER}[^0-9.]"), "unknown unit")
        .otherwise("invalid duration")
    )


def _scaled(nanos: Column, unit: int) -> Column:
    """``nanos / unit`` as decimal text without trailing zeros."""
    digits = len(str(unit)) - 1
    whole = F.floor(nanos / F.lit(unit).cast("decimal(19,0)")).cast("bigint")
    rest = F.rtrim(F.lpad((nanos % unit).cast("string"), digits, "0"), F.lit("0"))
    return F.concat(whole.cast("string"), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)))


def duration_format(nanos: Column) -> Column:
    """Shortest text of a nanosecond count: ``5m10s``, ``1.5s``, ``100ms``, ``0s``."""
    size = F.abs(nanos.cast("decimal(20,0)"))
    hours = F.floor(size / HOUR).cast("bigint")
    minutes = F.floor((size % HOUR) / MINUTE).cast("bigint")
    clock = F.concat(
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))).otherwise(""),
        F.when(size >= MINUTE, F.concat(minutes.cast("string"), F.lit("m"))).otherwise(""),
        _scaled(size % MINUTE, SECOND), F.lit("s"))
    text = (
        F.when(size == 0, "0s")
        .when(size < UNITS["us"], F.concat(size.cast("string"), F.lit("ns")))
        .when(size < UNITS["ms"], F.concat(_scaled(size, UNITS["us"]), F.lit("µs")))
        .when(size < SECOND, F.concat(_scaled(size, UNITS["ms"]), F.lit("ms")))
        .otherwise(clock))
    return F.concat(F.when(nanos < 0, "-").otherwise(""), text)
