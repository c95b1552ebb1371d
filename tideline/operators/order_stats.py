"""Statistics by rank, exact at any group size: percentiles, trimmed and winsorised means, trimmed sums.

A first pass keeps one mergeable quantile sketch per group. The sketch says between which two values a
wanted rank lies, give or take its error; a second pass counts and sums what is below that interval as one
group and what is inside it by value. The interval is split into even steps, running sums over the steps
find the one that holds the rank, and only the values of that step are put in order. A rank that turned out
to lie outside its interval, which the width of the interval makes as good as impossible, is an error and
never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Size of a sketch, and how far from a wanted rank its interval reaches: five times the sketch's own error.
SKETCH_K = 2048
REACH = 5 * 2.296 / SKETCH_K ** 0.9723
#: Ranks at which a sketch is read, from 0 to 1.
GRID = 512
#: Even steps that an interval is split into.
STEPS = 1024
#: Ways the rows of a group are split before they meet its intervals.
SPREAD = 8

NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"
# fixed values: names of statistics
STATS = ["Sum", "Average", "Minimum", "Maximum", "SampleCount"]
PERCENTILE = r"^p[0-9]{1,2}(\.[0-9]+)?\z|^p100\z"
SHORT = r"^(tm|wm|tc|ts)(100|[0-9]{1,2}(?:\.[0-9]+)?)\z"
LONG = rf"^(TM|WM|TC|TS|PR)\(({NUMBER})?(%?):({NUMBER})?(%?)\)\z"
BY_RANK = ["p", "tm", "wm", "ts"]


def stat_spec(stat: Column) -> Column:
    """What a statistic's name asks for: struct of kind, share, low and high; null for an unknown one.

    ``kind`` is the name of a simple statistic, ``p``, or the two letters of a trimmed one. With ``share``
    the bounds are percentages of the points in order, otherwise values; a missing bound is null.
    """
    def spec(kind: Column, share: Column, low: Column, high: Column) -> Column:
        return F.struct(kind.alias("kind"), share.alias("share"), low.try_cast("double").alias("low"), high.try_cast("double").alias("high"))

    none, yes = F.lit(None).cast("string"), F.lit(True)
    part = lambda pattern, i: F.regexp_extract(stat, pattern, i)
    number = F.substring(stat, 2, 32)
    share = (part(LONG, 3) == "%") | (part(LONG, 5) == "%")
    long = spec(F.lower(part(LONG, 1)), share, part(LONG, 2), part(LONG, 4))
    known = F.when(stat.isin(STATS), spec(stat, F.lit(False), none, none)).when(
        stat.rlike(PERCENTILE), spec(F.lit("p"), yes, number, number)).when(
        stat == "IQM", spec(F.lit("tm"), yes, F.lit("25"), F.lit("75"))).when(
        stat.rlike(SHORT), spec(part(SHORT, 1), yes, none, part(SHORT, 2))).when(stat.rlike(LONG), long)
    low, high = long["low"], long["high"]
    signs = (part(LONG, 2) == "") | ((part(LONG, 3) == "%") == share), (part(LONG, 4) == "") | ((part(LONG, 5) == "%") == share)
    sound = (low.isNotNull() | high.isNotNull()) & signs[0] & signs[1] & F.coalesce(low < high, F.lit(True))
    sound &= ~share | ((long["kind"] != "pr") & F.coalesce(low >= 0, F.lit(True)) & F.coalesce(high <= 100, F.lit(True)))
    return F.when(~stat.rlike(LONG) | sound, known)


def in_range(value: Column, low: Column, high: Column) -> Column:
    """Above ``low`` and at most ``high``; a null bound is none."""
    return F.coalesce(value > low, F.lit(True)) & F.coalesce(value <= high, F.lit(True))


def sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), SKETCH_K)


def summary(value: str = "value") -> list[Column]:
    """Aggregates of a group of points that later steps need; every one combines before the shuffle."""
    v = F.col(value)
    return [
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("most"),
        F.count(F.when(~F.isnan(v), 1)).alias("numbers"), F.max(F.when(~F.isnan(v), v)).alias("most_number")]


def wanted_ranks(groups: DataFrame) -> DataFrame:
    """Adds ``cells``, the ranks (from zero) that a statistic needs, to (n, spec, ...): array of (cell, first, last).

    A percentile needs the two ranks around it; a trimmed statistic the first and the last rank that stay.
    Whole points are trimmed: of n points, floor(n low / 100) at the lower and floor(n (100 - high) / 100) at the
    upper end. A group without points that stay has no cells.
    """
    spec, n = F.col("spec"), F.col("n")
    exact = lambda x: x.cast("decimal(20,10)")
    at = spec["low"] / 100 * (n - 1)
    share = lambda name, none: exact(F.coalesce(F.when(spec["share"], spec[name]), F.lit(none)))
    cut = F.floor(n * share("low", 0.0) / 100).cast("long")
    end = n - F.floor(n * (100 - share("high", 100.0)) / 100).cast("long")

    def cell(number: int, first: Column, last: Column) -> Column:
        return F.struct(F.lit(number).alias("cell"), first.cast("long").alias("first"), last.cast("long").alias("last"))

    groups = groups.withColumns({"at": F.when(spec["kind"] == "p", at), "cut": cut, "end": end})
    return groups.withColumn("cells", F.when(spec["kind"] == "p", F.array(cell(0, F.floor("at"), F.ceil("at")))).otherwise(
        F.when(F.col("cut") < F.col("end"), F.array(cell(0, F.col("cut"), F.col("cut")), cell(1, F.col("end") - 1, F.col("end") - 1)))
        .otherwise(F.array().cast("array<struct<cell:int,first:bigint,last:bigint>>"))))


def intervals(groups: DataFrame, keys: list[str], by_sketch: bool = True) -> DataFrame:
    """One row per cell of (keys, spec, n, at, cells, numbers, least, most_number[, sketch]): keys, kind, n_all, at, cell, first,
    last, lo, hi.

    ``lo`` and ``hi`` are values between which the ranks lie; NaN ranks above all numbers.
    """
    nan, numbers = F.lit(float("nan")), F.col("numbers")
    if by_sketch:  # the ranks that a sketch is asked for have to be constants
        grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
        groups = groups.withColumn("_grid", F.when(numbers > 0, grid))
    rows = groups.withColumn("_c", F.explode("cells")).select("*", "_c.*")
    lo, hi = F.col("least"), F.col("most_number")
    if by_sketch:
        below = F.col("first") / numbers - REACH
        above = (F.col("last") + 1) / numbers + REACH
        lo = F.when(below > 0, F.get("_grid", F.floor(below * GRID).cast("int"))).otherwise(lo)
        hi = F.when(above < 1, F.get("_grid", F.ceil(above * GRID).cast("int"))).otherwise(hi)
    return rows.select(
        *keys, F.col("spec.kind").alias("kind"), F.col("n").alias("n_all"), "at", "cell", "first", "last", F.when(F.col("first") >= numbers, nan).otherwise(lo).alias("lo"),
        F.when(F.col("last") >= numbers, nan).otherwise(hi).alias("hi"))


def rank_values(rows: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per cell: keys, kind, n_all, at, cell, first, last, the values ``a`` and ``b`` at its first and last rank, ``below`` (the sum of all before the
    first) and ``through`` (the sum up to and with the last).

    ``rows`` has keys, value, n (rows of that value) and spread, any small whole number that splits a group.
    """
    value, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    spread = F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))
    met = rows.withColumn("spread", F.pmod("spread", F.lit(SPREAD)).cast("long")).join(
        cells.withColumn("spread", F.explode(spread)), [*keys, "spread"]).where(value <= hi)
    cell = [*keys, "cell"]
    # all that is below the interval is one group, without a value
    known = ["kind", "n_all", "at", "first", "last"]
    counted = met.groupBy(*cell, *known, "lo", "hi", F.when(value >= lo, value).alias("value")).agg(
        F.sum("n").alias("n"), F.sum(value * F.col("n")).alias("s"))
    even = (hi - lo > 0) & (hi - lo < float("inf"))  # not so for equal, infinite and NaN bounds: one step
    # bounded, as the optimizer may ask for the step of a value above the interval
    part = F.least((value - lo) / (hi - lo) * STEPS, F.lit(float(STEPS)))
    step = F.when(value.isNull(), -1).when(even, F.floor(part)).otherwise(0)
    counted = counted.withColumn("step", step.cast("int"))

    steps = counted.groupBy(*cell, "step").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.first("first").alias("first"), F.first("last").alias("last"))
    whole = Window.partitionBy(*cell)
    met_all, met_low = F.sum("n").over(whole), F.coalesce(F.sum(F.when(F.col("step") < 0, F.col("n"))).over(whole), F.lit(0))
    missed = F.raise_error(F.lit("a rank lies outside the interval of its sketch; raise SKETCH_K")).cast("boolean")
    steps = steps.withColumn("sound", F.when((met_all > F.col("last")) & (met_low <= F.col("first")), True).otherwise(missed))
    before = Window.partitionBy(*cell).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    zero, nothing = F.lit(0).cast("long"), F.lit(0.0)
    steps = steps.withColumns({"n_before": F.coalesce(F.sum("n").over(before), zero), "s_before": F.coalesce(F.sum("s").over(before), nothing)})

    def holds(rank: str) -> Column:
        return (F.col("n_before") <= F.col(rank)) & (F.col(rank) < F.col("n_before") + F.col("n"))

    found = steps.where(F.col("sound") & (F.col("step") >= 0) & (holds("first") | holds("last"))).select(*cell, "step", "n_before", "s_before")
    inside = counted.join(found, [*cell, "step"])
    along = Window.partitionBy(*cell, "step").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumns({
        "n_before": F.col("n_before") + F.coalesce(F.sum("n").over(along), zero),
        "s_before": F.col("s_before") + F.coalesce(F.sum("s").over(along), nothing)})

    def upto(rank: Column) -> Column:
        count = rank - F.col("n_before")
        return F.col("s_before") + F.when(count == 0, 0.0).otherwise(value * count)

    return inside.groupBy(*cell).agg(
        *[F.first(c).alias(c) for c in known], F.max(F.when(holds("first"), value)).alias("a"), F.max(F.when(holds("last"), value)).alias("b"),
        F.max(F.when(holds("first"), upto(F.col("first")))).alias("below"),
        F.max(F.when(holds("last"), upto(F.col("last") + 1))).alias("through"))


def rank_stat(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, value): the statistics that the ``found`` values of their cells give."""
    of = lambda cell, column: F.max(F.when(F.col("cell") == cell, F.col(column))).alias(f"_{column}{cell}")
    rows = found.groupBy(*keys).agg(
        F.first("kind").alias("kind"), F.first("n_all").alias("n"), F.first("at").alias("at"), of(0, "a"), of(0, "b"), of(0, "below"),
        of(0, "first"), of(1, "b"), of(1, "through"), of(1, "last"))
    kind, n, a, b = F.col("kind"), F.col("n"), F.col("_a0"), F.col("_b0")
    between = F.when(a == b, a).otherwise(a + (b - a) * (F.col("at") - F.floor("at")))
    kept, cut, end = F.col("_through1") - F.col("_below0"), F.col("_first0"), F.col("_last1") + 1
    ends = F.when(cut == 0, 0.0).otherwise(a * cut) + F.when(end == n, 0.0).otherwise(F.col("_b1") * (n - end))
    value = F.when(kind == "p", between).when(kind == "ts", kept).when(kind == "tm", kept / (end - cut)).otherwise((kept + ends) / n)
    return rows.select(*keys, value.alias("value"))


def exact_percentile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Linear-interpolated percentile ``fraction`` of ``value`` per key, exact at any group size.

    ``df`` has ``keys, value, n, fraction, spread``: ``n`` rows of that value, and any small whole number
    that splits a group. The interval of a rank goes from the least to the greatest number of its group.
    """
    number = F.when(~F.isnan("value"), F.col("value"))
    groups = df.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum(F.when(number.isNotNull(), F.col("n"))).alias("numbers"), F.min("value").alias("least"),
        F.max(number).alias("most_number"), F.first("fraction").alias("fraction"))
    spec, at = F.struct(F.lit("p").alias("kind")), F.col("fraction") * (F.col("n") - 1)
    cell = F.struct(F.lit(0).alias("cell"), F.floor(at).cast("long").alias("first"), F.ceil(at).cast("long").alias("last"))
    groups = groups.withColumns({
        "spec": spec, "numbers": F.coalesce("numbers", F.lit(0)), "at": at, "cells": F.array(cell), "cut": F.lit(0), "end": F.col("n")})
    return rank_stat(rank_values(df.drop("fraction"), intervals(groups, keys, by_sketch=False), keys), keys)
