"""Metric queries: parse, evaluate over raw points, combine, and shape as results."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.predicates import valid_query_name
from .order_stats import (
    BY_RANK, SPREAD, STATS, exact_percentile, in_range, intervals, rank_stat, rank_values, sketch, stat_spec, summary,  # noqa: F401
    wanted_ranks)

QUERY_JSON = (
    "array<struct<name:string,expression:string,metric:struct<"
    "metric:struct<dimensions:array<struct<name:string,value:string>>,metricName:string,namespace:string>,"
    "period:bigint,stat:string,unit:string>>>")

#: Seconds of a roll-up.
ROLLUP_SECONDS = 3600


def parse_metric_queries(df: DataFrame, column: str = "queries") -> DataFrame:
    """One row per query of a JSON list; an expression wins over a metric, neither drops the item.

    Text that is not a JSON list gives no rows here; ``invalid_queries`` finds it.
    """
    query = F.col("_q")
    metric = F.when(query["expression"].isNull(), query["metric"])
    dimensions = F.map_from_arrays(
        F.transform(metric["metric"]["dimensions"], lambda d: d["name"]),
        F.transform(metric["metric"]["dimensions"], lambda d: d["value"]))
    parsed = df.withColumn("_q", F.explode(F.from_json(column, QUERY_JSON)))
    return (
        parsed.where(query["expression"].isNotNull() | query["metric"].isNotNull())
        .withColumns({
            "id": query["name"], "expression": query["expression"],
            "namespace": metric["metric"]["namespace"], "metric": metric["metric"]["metricName"],
            "dimensions": dimensions, "period": metric["period"], "stat": metric["stat"],
            "unit": F.when(metric["unit"] != "", metric["unit"])})
        .drop("_q", column))


def invalid_queries(df: DataFrame, column: str = "queries") -> DataFrame:
    """Rows whose text is not a JSON list."""
    kind = F.schema_of_variant(F.try_parse_json(column))
    return df.where(~F.coalesce(kind.startswith("ARRAY"), F.lit(False)))


def evaluable(queries: DataFrame) -> DataFrame:
    """The metric queries that ``metric_stat`` answers; a name that is none is reported by ``metric_failures`` only."""
    return _metric_queries(queries).where(known_stat(F.col("stat")) & (F.col("period") > 0))


def _metric_queries(queries: DataFrame) -> DataFrame:
    return queries.where("expression IS NULL") if "expression" in queries.columns else queries


def _answering(rows: DataFrame, queries: DataFrame, start: Column) -> DataFrame:
    """``rows`` of series joined to the queries they answer, with id, stat and ``ts``, the start of the period of ``start``."""
    wanted = queries.select(
        F.col("id").alias("id"), F.col("namespace").alias("_ns"), F.col("metric").alias("_metric"),
        F.map_entries("dimensions").alias("_dims"), F.col("unit").alias("_unit"), "period", "stat",
        stat_spec(F.col("stat")).alias("spec"))  # once per query: its patterns cost more than the rest of a row
    has_all = F.size(F.array_except("_dims", F.map_entries("dimensions"))) == 0
    in_dims = F.col("_dims").isNull() | (F.size("_dims") == 0) | has_all
    in_unit = F.col("_unit").isNull() | (F.col("unit") == F.col("_unit"))
    begin = F.floor(F.unix_seconds(start) / F.col("period")).cast("bigint") * F.col("period")
    joined = rows.join(wanted, (F.col("namespace") == F.col("_ns")) & (F.col("metric") == F.col("_metric")))
    return joined.where(in_dims & in_unit).withColumn("ts", F.timestamp_seconds(begin))


def match_points(points: DataFrame, queries: DataFrame) -> DataFrame:
    """Points joined to the queries they answer: ``(id, stat, spec, period, ts, value, point_ts, spread)``.

    ``ts`` is the start of the point's period, ``point_ts`` its own time, ``spec`` what the statistic asks for.
    """
    rows = points.select("namespace", "metric", "dimensions", "unit", F.col("ts").alias("point_ts"), "value")
    return (
        _answering(rows.where("value IS NOT NULL"), _metric_queries(queries), F.col("point_ts"))
        .select("id", "stat", "spec", "period", "ts", "value", "point_ts", F.pmod(F.xxhash64("point_ts"), F.lit(SPREAD)).alias("spread")))


def simple_stat(stat: Column, value: str = "value") -> Column:
    """The statistic named by the grouping column ``stat``; every part combines before the shuffle."""
    return (
        F.when(stat == "Sum", F.sum(value))
        .when(stat == "Average", F.avg(value))
        .when(stat == "Minimum", F.min(value))
        .when(stat == "Maximum", F.max(value))
        .when(stat == "SampleCount", F.count(value).cast("double")))


def metric_rollups(points: DataFrame, seconds: int = ROLLUP_SECONDS) -> DataFrame:
    """One row per series and ``seconds``: namespace, metric, dimensions, unit, ts, n, total, least, most, numbers,
    most_number, and a quantile sketch that merges with others.

    Written once, these rows answer the first pass of any query whose period is a multiple of ``seconds``.
    """
    start = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / seconds).cast("bigint") * seconds)
    rows = points.where("value IS NOT NULL").withColumns({"_dims": F.array_sort(F.map_entries("dimensions")), "ts": start})
    grouped = rows.groupBy("namespace", "metric", "_dims", "unit", "ts").agg(*summary(), sketch(F.col("value")).alias("sketch"))
    return grouped.withColumn("dimensions", F.map_from_entries("_dims")).drop("_dims")


def _groups_of_points(points: DataFrame, queries: DataFrame) -> DataFrame:
    """(id, ts, stat, spec) with the aggregates of the points: one scan for all kinds of statistics."""
    matched = match_points(points, queries)
    low, high, value = F.col("spec")["low"], F.col("spec")["high"], F.col("value")
    held = in_range(value, low, high)
    by_value = ~F.col("spec")["share"]
    clamped = F.greatest(F.least(value, F.coalesce(high, value)), F.coalesce(low, value))
    ranked = F.col("spec")["kind"].isin(BY_RANK) & F.col("spec")["share"]
    return matched.groupBy("id", "ts", "stat", "spec").agg(
        *summary(), F.count(F.when(by_value & held, 1)).alias("n_in"), F.sum(F.when(by_value & held, value)).alias("total_in"),
        F.sum(F.when(by_value, clamped)).alias("total_clamped"), sketch(F.when(ranked, value)).alias("sketch"))


def _groups_of_rollups(rollups: DataFrame, queries: DataFrame) -> DataFrame:
    """The same from roll-ups, for statistics that don't ask for single values."""
    rows = rollups.withColumnRenamed("ts", "_hour")
    matched = _answering(rows, queries, F.col("_hour"))
    none = F.lit(None).cast("double")
    return matched.groupBy("id", "ts", "stat", "spec").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.sum("numbers").alias("numbers"), F.max("most_number").alias("most_number"), F.lit(0).cast("bigint").alias("n_in"),
        none.alias("total_in"), none.alias("total_clamped"), F.kll_merge_agg_double("sketch").alias("sketch"))


def metric_stat(
    points: DataFrame, queries: DataFrame, rollups: DataFrame | None = None, rollup_seconds: int = ROLLUP_SECONDS,
) -> DataFrame:
    """Evaluates metric queries: ``(id, ts, value)``, one row per query and period with data.

    ``points`` has ``(namespace, metric, dimensions, unit, ts, value)``; ``queries``
    has the columns ``parse_metric_queries`` gives. Periods start at the epoch.
    Queries of an unknown statistic or period give no rows here; ``metric_failures`` lists them.

    Statistics are the simple ones, percentiles (``p95``), trimmed means (``tm90``, ``TM(5%:95%)``, ``IQM``), counts
    (``tc``), sums (``ts``) and winsorised means (``wm``), each by share of the points or by value (``TM(10:200)``, above
    the lower and at most the upper bound), and the percentage of points in a range (``PR(:300)``). Points are scanned
    once, statistics by rank go over them a second time (see ``order_stats``). A trimmed statistic that no point is left
    for has no row. With ``rollups`` (``metric_rollups`` of the same points), the first pass of queries whose period is a
    multiple of ``rollup_seconds`` reads those.
    """
    queries = evaluable(queries)
    if rollups is None:
        groups = _groups_of_points(points, queries)
    else:
        spec = stat_spec(F.col("stat"))
        whole = (F.col("period") % rollup_seconds == 0) & (spec["share"] | spec["kind"].isin(STATS))
        groups = _groups_of_points(points, queries.where(~whole)).unionByName(_groups_of_rollups(rollups, queries.where(whole)))
    kind, n, n_in = F.col("spec")["kind"], F.col("n"), F.col("n_in")
    ranked = kind.isin(BY_RANK) & F.col("spec")["share"]
    trimmed_count = F.col("spec")["share"] & (kind == "tc")
    groups = wanted_ranks(groups)
    value = (
        F.when(kind == "Sum", F.col("total")).when(kind == "Average", F.col("total") / n)
        .when(kind == "Minimum", F.col("least")).when(kind == "Maximum", F.col("most"))
        .when(kind == "SampleCount", n.cast("double")).when(kind == "pr", n_in * 100.0 / n)
        .when(trimmed_count, F.greatest(F.col("end") - F.col("cut"), F.lit(0)).cast("double"))
        .when(kind == "tc", n_in.cast("double")).when(kind == "wm", F.col("total_clamped") / n)
        .when(kind == "ts", F.col("total_in")).when((kind == "tm") & (n_in > 0), F.col("total_in") / n_in))
    simple = groups.where(~ranked).select("id", "ts", value.alias("value")).where("value IS NOT NULL")

    keys = ["id", "ts"]
    by_rank = groups.where(ranked).drop("n_in", "total_in", "total_clamped")
    spec = stat_spec(F.col("stat"))
    rows = match_points(points, queries.where(spec["share"] & spec["kind"].isin(BY_RANK))).select(*keys, "value", "spread")
    found = rank_values(rows.withColumn("n", F.lit(1).cast("bigint")), intervals(by_rank, keys), keys)
    return simple.unionByName(rank_stat(found, keys))


def known_stat(stat: Column) -> Column:
    """Whether ``metric_stat`` evaluates the statistic."""
    return stat_spec(stat).isNotNull()


def _reason(expression: Column) -> Column:
    """Why a query can't be evaluated, null if it can."""
    stat, period = F.coalesce("stat", F.lit("null")), F.col("period")
    reason = lambda code, value: F.struct(F.lit(code).alias("Code"), F.coalesce(value, F.lit("null")).alias("Value"))
    return (
        F.when(~F.coalesce(valid_query_name(F.col("id")), F.lit(False)), reason("InvalidName", F.col("id")))
        .when(expression, None)
        .when(~known_stat(stat), reason("UnknownStatistic", stat))
        .when(~F.coalesce(period > 0, F.lit(False)), reason("InvalidPeriod", period.cast("string"))))


def metric_failures(queries: DataFrame) -> DataFrame:
    """Result rows, as ``metric_results`` gives them, of the queries that are not as they should be.

    These are queries whose name is no name (expressions too), of an unknown statistic (null too), or of a period that is
    null or below one.
    """
    expression = F.col("expression").isNotNull() if "expression" in queries.columns else F.lit(False)
    return queries.withColumn("_reason", _reason(expression)).where("_reason IS NOT NULL").select(
        F.col("id").alias("Id"), F.col("id").alias("Label"), F.array("_reason").alias("Messages"),
        F.lit("InternalError").alias("StatusCode"), F.array().cast("array<timestamp>").alias("Timestamps"),
        F.array().cast("array<double>").alias("Values"), F.lit(None).cast("bigint").alias("span"))


def metric_expression(values: DataFrame, id: str, expression: str, inputs: list[str]) -> DataFrame:
    """A series computed from other series by a Spark SQL expression over their ids.

    Only periods where every one of ``inputs`` has a value give a result.
    """
    wide = (
        values.where(F.col("id").isin(inputs)).groupBy("ts")
        .agg(*[F.max(F.when(F.col("id") == name, F.col("value"))).alias(name) for name in inputs]))
    whole = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in inputs])
    return wide.where(whole).select(
        F.lit(id).alias("id"), "ts", F.expr(expression).cast("double").alias("value"))


def metric_results(values: DataFrame, poll_seconds: int = 86_400) -> DataFrame:
    """Result rows with parallel arrays in time order: one per query and polled span.

    ``values`` has one row per query and period, so a row holds at most
    ``poll_seconds / period`` points however long the series is.
    """
    span = F.floor(F.unix_seconds("ts") / poll_seconds).cast("bigint")
    pairs = F.sort_array(F.collect_list(F.struct("ts", "value")))
    return (
        values.groupBy(F.col("id").alias("Id"), span.alias("span"))
        .agg(pairs.alias("_pairs"))
        .select(
            "Id", F.col("Id").alias("Label"),
            F.array().cast("array<struct<Code:string,Value:string>>").alias("Messages"),
            F.lit("Complete").alias("StatusCode"),
            F.col("_pairs.ts").alias("Timestamps"), F.col("_pairs.value").alias("Values"), "span"))


def perf_points(series: DataFrame) -> DataFrame:
    """One row per measured point; points without a value are left out."""
    return (
        series.withColumn("_p", F.explode("points"))
        .withColumns({"ts": F.col("_p.ts"), "value": F.col("_p.value")})
        .where("value IS NOT NULL").drop("_p", "points"))


def as_metric_query(
    spark: SparkSession, id: str, namespace: str, metric: str, period: int, stat: str,
    dimensions: dict[str, str] | None = None, unit: str | None = None,
) -> DataFrame:
    """A one-row query table, as ``metric_stat`` takes it.

    Made of literals, so that its size is known when the join with the points is planned.
    """
    return spark.range(1).select(
        F.lit(id).alias("id"), F.lit(namespace).alias("namespace"), F.lit(metric).alias("metric"),
        F.from_json(F.lit(json.dumps(dimensions or {})), "map<string,string>").alias("dimensions"),
        F.lit(period).cast("bigint").alias("period"), F.lit(stat).alias("stat"),
        F.lit(unit).cast("string").alias("unit"))
