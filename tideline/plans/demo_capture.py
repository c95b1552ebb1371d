"""Demo queries: capture, metrics, routing, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.capture import (
    backoff_schedule, diff_snapshots, head_changes, latest_stream, log_capture, merge_seen, modified_since,
    poll_delay, poll_history, poll_windows, select_log_streams, status_changes, trim_to_window)
from ..operators.catalog import failure_report, source_catalog
from ..operators.config import desired_state_diff, event_type_registry, remove_by_id, upsert_by_id
from ..operators.envelope import events_from_change_records, events_from_logs, events_from_stream_records
from ..operators.metric_math import graph_failures, metric_graph
from ..operators.metrics import (
    as_metric_query, metric_expression, metric_failures, metric_results, metric_rollups, metric_stat, parse_metric_queries)
from ..operators.routing import find_subscription, registry, resolve_resource, route_requests
from ..session import new_dir
from ..sources.landed import union_event_streams, union_shards
from . import shapes
from .demo_events import LOGS, micros
from .registry import demo

START_MS, END_MS = 1_705_276_800_000, 1_706_140_800_000


@demo("select_log_streams", f"""
    WITH {LOGS}, streams AS (SELECT log_group, log_stream, max(ingested) AS last FROM logs GROUP BY 1, 2)
    SELECT log_group, log_stream, last AS last_ingestion FROM streams WHERE last > {END_MS}""")
def _(spark, sf):
    streams = shapes.log_entries(spark, sf).groupBy("log_group", "log_stream").agg(
        F.max("IngestionTime").alias("LastIngestionTime"))
    return select_log_streams(streams, END_MS).select(
        "log_group", "log_stream", F.col("LastIngestionTime").alias("last_ingestion"))


@demo("trim_to_window", f"""
    WITH {LOGS} SELECT log_group, log_stream, stamp, props AS message FROM logs
    WHERE stamp >= {START_MS} AND stamp < {END_MS}""")
def _(spark, sf):
    return trim_to_window(shapes.log_entries(spark, sf), START_MS, END_MS).select(
        "log_group", "log_stream", F.col("Timestamp").alias("stamp"), F.col("Message").alias("message"))


LOG_CAPTURE = f"""
    WITH {LOGS},
    ticks AS (SELECT 'shop-' || (user_id % 4) AS log_group, ts FROM events WHERE event_type = 'purchase'),
    windows AS (
        SELECT log_group,
               coalesce(epoch_us(lag(ts) OVER w) // 1000000, epoch_us(ts) // 1000000 - 300) * 1000 AS start_ms,
               epoch_us(ts) // 1000000 * 1000 AS end_ms
        FROM ticks WINDOW w AS (PARTITION BY log_group ORDER BY ts))
    SELECT logs.log_group, log_stream, stamp, start_ms, end_ms, ingested > end_ms AS late
    FROM logs JOIN windows ON logs.log_group = windows.log_group AND stamp >= start_ms AND stamp < end_ms"""


@demo("log_capture", LOG_CAPTURE)
def _(spark, sf):
    ticks = shapes.events(spark, sf).where("event_type = 'purchase'").select(
        shapes.numbered("shop-", F.col("user_id") % 4).alias("log_group"), F.col("ts").alias("tick"))
    windows = poll_windows(ticks, 300, source="log_group")
    return log_capture(shapes.log_entries(spark, sf), windows).select(
        "log_group", "log_stream", F.col("Timestamp").alias("stamp"), "start_ms", "end_ms", "late")


POLLS = """
    polls AS (
        SELECT 'src-' || user_id AS source, ts AS tick, epoch_us(ts) AS tick_us,
               CASE WHEN event_type = 'purchase' THEN 3 ELSE 0 END::BIGINT AS n_rows, event_type = 'error' AS failed
        FROM events),
    linked AS (
        SELECT *, lag(tick) OVER w AS prev, row_number() OVER w AS n,
               max(CASE WHEN n_rows > 0 THEN tick END) OVER w AS reset_at
        FROM polls WINDOW w AS (PARTITION BY source ORDER BY tick)),
    stepped AS (
        SELECT *, CASE WHEN reset_at IS NULL THEN n - 1
                       ELSE row_number() OVER (PARTITION BY source, reset_at ORDER BY tick) - 1 END AS step
        FROM linked),
    history AS (
        SELECT source, tick_us, coalesce(epoch_us(prev), tick_us - 300000000) AS start_us,
               coalesce(epoch_us(prev) // 1000000, tick_us // 1000000 - 300) * 1000 AS start_ms,
               tick_us // 1000000 * 1000 AS end_ms, step::BIGINT AS step,
               CASE WHEN step >= 6 THEN 32.0 ELSE greatest(1, power(2, step) - 1) END::DOUBLE AS delay_seconds,
               CASE WHEN failed THEN 1.0 WHEN n_rows > 0 THEN 0.0 ELSE 3.0 END::DOUBLE AS burst_seconds
        FROM stepped)
"""


@demo("poll_windows", f"WITH {POLLS} SELECT source, tick_us, start_us, start_ms, end_ms FROM history")
def _(spark, sf):
    return poll_windows(shapes.poll_log(spark, sf), 300).select(
        "source", F.unix_micros("tick").alias("tick_us"), F.unix_micros("window_start").alias("start_us"),
        "start_ms", "end_ms")


@demo("backoff_schedule", f"WITH {POLLS} SELECT source, tick_us, step, delay_seconds FROM history")
def _(spark, sf):
    log = shapes.poll_log(spark, sf).withColumn("had_data", F.col("n_rows") > 0)
    return backoff_schedule(log).select("source", F.unix_micros("tick").alias("tick_us"), "step", "delay_seconds")


@demo("poll_delay", f"WITH {POLLS} SELECT source, tick_us, burst_seconds FROM history")
def _(spark, sf):
    return poll_delay(shapes.poll_log(spark, sf)).select(
        "source", F.unix_micros("tick").alias("tick_us"), "burst_seconds")


@demo("poll_history", f"""
    WITH {POLLS} SELECT source, tick_us, start_us, start_ms, end_ms, step, delay_seconds, burst_seconds FROM history""")
def _(spark, sf):
    return poll_history(shapes.poll_log(spark, sf)).select(
        "source", F.unix_micros("tick").alias("tick_us"), F.unix_micros("window_start").alias("start_us"),
        "start_ms", "end_ms", "step", "delay_seconds", "burst_seconds")


HEADS = """
    WITH linked AS (
        SELECT 'repo-' || user_id AS repo, epoch_us(ts) AS poll_us, event_type AS commit_id,
               lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS previous
        FROM events)
    SELECT repo, poll_us, commit_id, previous FROM linked WHERE previous <> commit_id"""


@demo("head_changes", HEADS)
def _(spark, sf):
    return head_changes(shapes.branch_heads(spark, sf)).select(
        "repo", F.unix_micros("poll_ts").alias("poll_us"), "commit_id", F.col("previous_commit").alias("previous"))


STATUSES = """
    WITH linked AS (
        SELECT 'repo-' || (user_id % 4) AS repo, user_id::VARCHAR AS pr_id, epoch_us(ts) AS poll_us,
               event_type AS status, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS previous,
               ts = min(ts) OVER (PARTITION BY user_id % 4) AS baseline
        FROM events)
    SELECT repo, pr_id, poll_us, status, previous FROM linked
    WHERE previous <> status OR (previous IS NULL AND NOT baseline)"""


def status_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "repo", "pr_id", F.unix_micros("poll_ts").alias("poll_us"), "status", F.col("previous_status").alias("previous"))


@demo("status_changes", STATUSES)
def _(spark, sf):
    return status_columns(status_changes(shapes.pull_requests(spark, sf)))


MODIFIED = """
    WITH users AS (
        SELECT 'pool-' || (user_id % 3) AS pool, date_trunc('hour', ts) AS poll, user_id::VARCHAR AS username, ts
        FROM events),
    polls AS (SELECT pool, poll, max(ts) AS top FROM users GROUP BY 1, 2),
    marks AS (
        SELECT pool, poll, max(top) OVER (
            PARTITION BY pool ORDER BY poll ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
        FROM polls)
    SELECT pool, username, epoch_us(ts) AS modified_us, epoch_us(mark) AS mark_us
    FROM users JOIN marks USING (pool, poll) WHERE ts > mark"""


def modified_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "pool", F.col("Username").alias("username"), F.unix_micros("UserLastModifiedDate").alias("modified_us"),
        F.unix_micros("mark").alias("mark_us"))


@demo("modified_since", MODIFIED)
def _(spark, sf):
    return modified_columns(modified_since(shapes.users(spark, sf)))


@demo("diff_snapshots", """
    WITH old AS (
        SELECT l_orderkey, arg_max(l_linestatus, (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_linestatus)) AS status
        FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS order_key, o_orderstatus AS status FROM orders LEFT JOIN old ON o_orderkey = l_orderkey
    WHERE old.status IS NULL OR old.status <> o_orderstatus""")
def _(spark, sf):
    old = shapes.table(spark, sf, "lineitem").withColumnsRenamed({"l_orderkey": "order_key", "l_linestatus": "status"})
    new = shapes.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "status"]
    return diff_snapshots(old, new, "order_key", "status", order)


@demo("merge_seen", """
    SELECT user_id, arg_max(event_type, (CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END, ts)) AS status,
           arg_max(epoch_us(ts), (CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END, ts)) AS poll_us
    FROM events GROUP BY 1""")
def _(spark, sf):
    rows = shapes.events(spark, sf).select("user_id", F.col("event_type").alias("status"), "ts")
    earlier = F.col("status").isin("click", "view")
    merged = merge_seen(rows.where(earlier), rows.where(~earlier), ["user_id"], ["ts"])
    return merged.select("user_id", "status", micros("ts").alias("poll_us"))


@demo("latest_stream", """
    WITH streams AS (
        SELECT 'table-' || o_custkey AS table_arn, o_orderdate AS created,
               CASE WHEN o_orderstatus <> 'P' THEN 'stream-' || o_orderkey END AS stream_arn
        FROM orders),
    latest AS (
        SELECT table_arn, arg_max(stream_arn, (created, stream_arn)) FILTER (stream_arn IS NOT NULL) AS stream_arn
        FROM streams GROUP BY 1)
    SELECT table_arn, stream_arn,
           CASE WHEN stream_arn IS NULL THEN 'no stream is associated with table ' || table_arn END AS error
    FROM latest""")
def _(spark, sf):
    streams = shapes.table(spark, sf, "orders").select(
        shapes.numbered("table-", F.col("o_custkey")).alias("table_arn"), F.col("o_orderdate").alias("created"),
        F.when(F.col("o_orderstatus") != "P", shapes.numbered("stream-", F.col("o_orderkey"))).alias("stream_arn"))
    return latest_stream(streams)


# --- metrics

QUERIES = [
    ("sum", "Shop", "click", 3600, "Sum", {}),
    ("avg", "Shop", "view", 7 * 3600, "Average", {}),
    ("min", "Shop", "signup", 86_400, "Minimum", {"UserId": "1"}),
    ("max", "Sales", "Price", 30 * 86_400, "Maximum", {"ReturnFlag": "A", "LineStatus": "F"}),
    ("count", "Sales", "Price", 7 * 86_400, "SampleCount", {"ReturnFlag": "R"}),
    ("p90", "Shop", "purchase", 86_400, "p90", {}),
    ("p50", "Sales", "Price", 90 * 86_400, "p50", {"LineStatus": "O"}),
    ("p99.9", "Sales", "Price", 365 * 86_400, "p99.9", {}),
]


def metric_queries(spark) -> DataFrame:
    return union_shards(*[
        as_metric_query(spark, id, ns, metric, period, stat, dims)
        for id, ns, metric, period, stat, dims in QUERIES])


def _stat_sql(id: str, ns: str, metric: str, period: int, stat: str, dims: dict[str, str]) -> str:
    value, ts, source = ("value", "ts", "events") if ns == "Shop" else ("l_extendedprice", "l_shipdate", "lineitem")
    columns = {"UserId": "user_id::VARCHAR", "ReturnFlag": "l_returnflag", "LineStatus": "l_linestatus"}
    tests = [f"event_type = '{metric}'"] if ns == "Shop" else []
    tests += [f"{columns[name]} = '{wanted}'" for name, wanted in dims.items()]
    result = {
        "Sum": f"sum({value})", "Average": f"avg({value})", "Minimum": f"min({value})", "Maximum": f"max({value})",
        "SampleCount": f"count({value})::DOUBLE",
    }.get(stat) or f"quantile_cont({value}, {float(stat[1:])} / 100)"
    return (
        f"SELECT '{id}' AS id, epoch_us({ts}) // 1000000 // {period} * {period} AS start, round({result}, 4) AS value"
        f" FROM {source} {'WHERE ' + ' AND '.join(tests) if tests else ''} GROUP BY 2")


STATS_SQL = " UNION ALL ".join(_stat_sql(*q) for q in QUERIES)


@demo("metric_stat", STATS_SQL)
def _(spark, sf):
    points = shapes.event_points(spark, sf).unionByName(shapes.price_points(spark, sf))
    return metric_stat(points, metric_queries(spark)).select(
        "id", F.unix_seconds("ts").alias("start"), F.round("value", 4).alias("value"))


#: id, namespace, metric, period, statistic; kind, whether its bounds are shares of the points, bounds (whole numbers)
ORDER_QUERIES = [
    ("tm_short", "Shop", "click", 86_400, "tm90", "tm", True, 0, 90),
    ("tm_share", "Sales", "Price", 90 * 86_400, "TM(5%:95%)", "tm", True, 5, 95),
    ("iqm", "Shop", "view", 7 * 86_400, "IQM", "tm", True, 25, 75),
    ("tm_value", "Shop", "click", 86_400, "TM(10:60)", "tm", False, 10, 60),
    ("wm_short", "Sales", "Price", 30 * 86_400, "wm98", "wm", True, 0, 98),
    ("wm_share", "Shop", "purchase", 7 * 86_400, "WM(10%:90%)", "wm", True, 10, 90),
    ("wm_value", "Shop", "view", 86_400, "WM(10:60)", "wm", False, 10, 60),
    ("tc_short", "Shop", "click", 86_400, "tc75", "tc", True, 0, 75),
    ("tc_value", "Sales", "Price", 365 * 86_400, "TC(20000:40000)", "tc", False, 20_000, 40_000),
    ("ts_share", "Sales", "Price", 60 * 86_400, "TS(80%:)", "ts", True, 80, 100),
    ("ts_value", "Shop", "signup", 86_400, "TS(:50)", "ts", False, None, 50),
    ("pr_upto", "Shop", "click", 86_400, "PR(:30)", "pr", False, None, 30),
    ("pr_range", "Sales", "Price", 90 * 86_400, "PR(10000:50000)", "pr", False, 10_000, 50_000),
]


#: Added before results are rounded: means of prices end in a five at the next digit more often than not by chance.
OFF_TIES = 0.00001234567


def _order_sql(id, ns, metric, period, _stat, kind, share, low, high, value=None, digits=None) -> str:
    digits = digits or 4
    column, ts, source = ("value", "ts", "events") if ns == "Shop" else ("l_extendedprice", "l_shipdate", "lineitem")
    where = f"WHERE event_type = '{metric}'" if ns == "Shop" else ""
    if share:
        cut, end = f"(n * {low} // 100)", f"(n - n * {100 - high} // 100)"
        kept = f"r >= {cut} AND r < {end}"
        clamped = f"(sum(value) FILTER ({kept}) + {cut} * min(value) FILTER ({kept}) + (n - {end}) * max(value) FILTER ({kept})) / n"
    else:
        kept = " AND ".join([f"value > {low}"] * (low is not None) + [f"value <= {high}"] * (high is not None))
        clamped = f"avg(least(greatest(value, {low}), {high}))"
    result = {
        "tm": f"avg(value) FILTER ({kept})", "ts": f"sum(value) FILTER ({kept})", "tc": f"count(*) FILTER ({kept})::DOUBLE",
        "wm": clamped, "pr": f"count(*) FILTER ({kept}) * 100.0 / n", "p": f"quantile_cont(value, {high} / 100.0)"}[kind]
    return f"""
        SELECT * FROM (
            SELECT '{id}' AS id, start, round({result} + {OFF_TIES}, {digits}) AS value FROM (
                SELECT start, value, row_number() OVER (PARTITION BY start ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY start) AS n
                FROM (SELECT epoch_us({ts}) // 1000000 // {period} * {period} AS start, {value or column} AS value FROM {source} {where}))
            GROUP BY start, n) WHERE value IS NOT NULL"""


def _order_queries(spark, rows) -> DataFrame:
    return union_shards(*[as_metric_query(spark, id, ns, metric, period, stat) for id, ns, metric, period, stat, *_ in rows])


def rounded(digits: int = 4):
    return F.round(F.col("value") + OFF_TIES, digits).alias("value")


@demo("metric_order_stats", " UNION ALL ".join(_order_sql(*q) for q in ORDER_QUERIES))
def _(spark, sf):
    """Trimmed and winsorised means, trimmed sums and counts, percentile ranks."""
    points = shapes.event_points(spark, sf).unionByName(shapes.price_points(spark, sf))
    return metric_stat(points, _order_queries(spark, ORDER_QUERIES)).select("id", F.unix_seconds("ts").alias("start"), rounded())


ROLLED = [q for q in QUERIES if q[4] != "Sum" or q[3] % 3600 == 0]
ROLLED_ORDER = [q for q in ORDER_QUERIES if q[6]]


@demo("metric_rollups", " UNION ALL ".join([*(_stat_sql(*q) for q in ROLLED), *(_order_sql(*q) for q in ROLLED_ORDER)]))
def _(spark, sf):
    """Hourly roll-ups, written once, answer the first pass; only statistics by rank go back to the points."""
    points = shapes.event_points(spark, sf).unionByName(shapes.price_points(spark, sf))
    path = new_dir(spark, "rollups")
    metric_rollups(points).write.parquet(path)
    queries = union_shards(
        *[as_metric_query(spark, id, ns, metric, period, stat, dims) for id, ns, metric, period, stat, dims in ROLLED],
        _order_queries(spark, ROLLED_ORDER))
    plain = F.col("id").isin([q[0] for q in ROLLED])
    return metric_stat(points, queries, spark.read.parquet(path)).select(
        "id", F.unix_seconds("ts").alias("start"), F.when(plain, F.round("value", 4)).otherwise(rounded()).alias("value"))


EPOCH_QUERIES = [
    ("late", "Shop", "click", 30 * 86_400, "p99", "p", True, 0, 99), ("middle", "Shop", "view", 7 * 86_400, "p50", "p", True, 0, 50),
    ("mean", "Shop", "click", 30 * 86_400, "TM(10%:90%)", "tm", True, 10, 90)]


@demo("metric_large_offset", " UNION ALL ".join(_order_sql(*q, value="epoch_us(ts) / 1000000.0", digits=2) for q in EPOCH_QUERIES))
def _(spark, sf):
    """Values of a large offset and a small spread: the times of the events in seconds."""
    points = shapes.event_points(spark, sf).withColumn("value", F.unix_micros("ts") / 1_000_000.0)
    return metric_stat(points, _order_queries(spark, EPOCH_QUERIES)).select(
        "id", F.unix_seconds("ts").alias("start"), rounded(2))


@demo("metric_failures", """
    WITH queries AS (
        SELECT CASE WHEN c_custkey % 7 = 0 THEN 'Q' ELSE 'q' END || c_custkey AS id,
               CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'Sum' WHEN 2 THEN 'p99.9'
               WHEN 3 THEN CASE WHEN c_custkey % 2 = 0 THEN 'tm90' ELSE 'TM(90%:10%)' END END AS stat, c_nationkey * 60 AS period
        FROM customer),
    checked AS (SELECT *, substr(id, 1, 1) = 'q' AS named, coalesce(stat IN ('Sum', 'p99.9', 'tm90'), false) AS known FROM queries)
    SELECT id, 'InternalError' AS status,
           CASE WHEN NOT named THEN 'InvalidName' WHEN known THEN 'InvalidPeriod' ELSE 'UnknownStatistic' END AS code,
           CASE WHEN NOT named THEN id WHEN known THEN period::VARCHAR ELSE coalesce(stat, 'null') END AS value, 0::BIGINT AS n
    FROM checked WHERE NOT named OR NOT known OR period < 1""")
def _(spark, sf):
    k = F.col("c_custkey")
    trimmed = F.when(k % 2 == 0, "tm90").otherwise("TM(90%:10%)")
    stat = F.when(k % 5 == 0, F.col("c_mktsegment")).when(k % 5 == 1, "Sum").when(k % 5 == 2, "p99.9").when(k % 5 == 3, trimmed)
    name = F.when(k % 7 == 0, shapes.numbered("Q", k)).otherwise(shapes.numbered("q", k))
    queries = shapes.table(spark, sf, "customer").select(
        name.alias("id"), stat.alias("stat"), (F.col("c_nationkey") * 60).cast("bigint").alias("period"))
    return metric_failures(queries).select(
        F.col("Id").alias("id"), F.col("StatusCode").alias("status"), F.col("Messages")[0]["Code"].alias("code"),
        F.col("Messages")[0]["Value"].alias("value"), F.size("Values").cast("bigint").alias("n"))


def _two_series(spark, sf) -> DataFrame:
    queries = as_metric_query(spark, "c", "Shop", "click", 3600, "Sum").unionByName(
        as_metric_query(spark, "v", "Shop", "view", 3600, "Sum"))
    return metric_stat(shapes.event_points(spark, sf), queries)


SERIES = """
    series AS (
        SELECT CASE event_type WHEN 'click' THEN 'c' ELSE 'v' END AS id,
               epoch_us(ts) // 1000000 // 3600 * 3600 AS start, sum(value) AS value
        FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2)
"""


@demo("metric_expression", f"""
    WITH {SERIES}
    SELECT 'share' AS id, c.start, round(c.value / (c.value + v.value) * 100, 4) AS value
    FROM series c JOIN series v ON c.start = v.start AND c.id = 'c' AND v.id = 'v'""")
def _(spark, sf):
    share = metric_expression(_two_series(spark, sf), "share", "c / (c + v) * 100", ["c", "v"])
    return share.select("id", F.unix_seconds("ts").alias("start"), F.round("value", 4).alias("value"))


GRAPH = [
    ("total", "SUM([c, v])"), ("share", "IF(total > 0, c / total * 100, 0)"), ("steady", "FILL(share, 0)"),
    ("jump", "DIFF(steady)"), ("score", "(steady - AVG(steady)) / STDDEV(steady)"), ("rate", "RATE(c) * 3600"),
    ("busy", "IF(c > AVG(c) AND v > 0 || total >= 500, 1)"), ("repeat", "FILL(c, REPEAT)"), ("line", "FILL(v, LINEAR)"),
    ("running", "RUNNING_SUM(total) / 1000"), ("power", "-ABS(steady - 50) ^ 2 / 100"), ("hours", "PERIOD(c) / 3600"),
    ("self", "self + 1"), ("left", "right * 2"), ("right", "left - c"), ("after", "right + 1"), ("wrong", "c +"), ("gone", "nothing * 2")]


def _graph_queries(spark) -> DataFrame:
    rows = [(id, text, None) for id, text in GRAPH] + [("c", None, 3600), ("v", None, 3600)]
    return spark.createDataFrame(rows, "id string, expression string, period bigint")


@demo("metric_graph", f"""
    WITH {SERIES},
    hours AS (SELECT unnest(generate_series(min(start), max(start), 3600)) AS start FROM series),
    wide AS (
        SELECT hours.start, max(value) FILTER (id = 'c') AS c, max(value) FILTER (id = 'v') AS v
        FROM hours LEFT JOIN series ON hours.start = series.start GROUP BY 1),
    one AS (
        SELECT *, CASE WHEN c IS NOT NULL OR v IS NOT NULL THEN coalesce(c, 0) + coalesce(v, 0) END AS total,
               avg(c) OVER () AS mean_c, last_value(CASE WHEN c IS NOT NULL THEN start END IGNORE NULLS) OVER w AS c_at,
               last_value(c IGNORE NULLS) OVER w AS c_before, last_value(v IGNORE NULLS) OVER w AS v_before,
               last_value(CASE WHEN v IS NOT NULL THEN start END IGNORE NULLS) OVER w AS v_at,
               first_value(v IGNORE NULLS) OVER x AS v_after,
               first_value(CASE WHEN v IS NOT NULL THEN start END IGNORE NULLS) OVER x AS v_next
        FROM wide WINDOW w AS (ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         x AS (ORDER BY start ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    two AS (SELECT *, CASE WHEN total > 0 THEN c / total * 100 WHEN total <= 0 THEN 0 END AS share FROM one),
    three AS (SELECT *, coalesce(share, 0) AS steady FROM two),
    results AS (
        SELECT 'total' AS id, start, total AS value FROM three UNION ALL SELECT 'share', start, share FROM three
        UNION ALL SELECT 'steady', start, steady FROM three
        UNION ALL SELECT 'jump', start, steady - lag(steady) OVER (ORDER BY start) FROM three
        UNION ALL SELECT 'score', start, (steady - avg(steady) OVER ()) / stddev_pop(steady) OVER () FROM three
        UNION ALL SELECT 'rate', start, (c - c_before) / (start - c_at) * 3600 FROM three
        UNION ALL SELECT 'busy', start, CASE WHEN (c > mean_c AND v > 0) OR total >= 500 THEN 1 END FROM three
        UNION ALL SELECT 'repeat', start, coalesce(c, c_before) FROM three
        UNION ALL SELECT 'line', start, coalesce(v, v_before + (v_after - v_before) * (start - v_at) / (v_next - v_at)) FROM three
        UNION ALL SELECT 'running', start, CASE WHEN total IS NOT NULL THEN sum(total) OVER (ORDER BY start) / 1000 END FROM three
        UNION ALL SELECT 'power', start, 0 - power(abs(steady - 50), 2) / 100 FROM three
        UNION ALL SELECT 'hours', start, 1 FROM three)
    SELECT id, start, round(value + {OFF_TIES}, 4) + 0.0 AS value, NULL AS code FROM results WHERE value IS NOT NULL
    UNION ALL VALUES ('self', NULL, NULL, 'CyclicExpression'), ('left', NULL, NULL, 'CyclicExpression'), ('right', NULL, NULL, 'CyclicExpression'),
                     ('after', NULL, NULL, 'UnknownSeries'), ('wrong', NULL, NULL, 'InvalidExpression'), ('gone', NULL, NULL, 'UnknownSeries')""")
def _(spark, sf):
    """Expressions over expressions, and a row for each that can't be evaluated."""
    queries = _graph_queries(spark)
    series = metric_graph(_two_series(spark, sf), queries, 3600).select(
        "id", F.unix_seconds("ts").alias("start"), (rounded() + 0.0).alias("value"), F.lit(None).cast("string").alias("code"))
    return series.unionByName(graph_failures(queries).select(
        F.col("Id").alias("id"), F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("double").alias("value"),
        F.col("Messages")[0]["Code"].alias("code")))


@demo("metric_results", f"""
    WITH {SERIES}
    SELECT id, start // 86400 AS span, 'Complete' AS status, count(*) AS n,
           string_agg(start::VARCHAR, ',' ORDER BY start) AS starts, round(sum(value), 4) AS total
    FROM series GROUP BY 1, 2""")
def _(spark, sf):
    starts = F.transform("Timestamps", lambda t: F.unix_seconds(t).cast("string"))
    return metric_results(_two_series(spark, sf)).select(
        F.col("Id").alias("id"), "span", F.col("StatusCode").alias("status"),
        F.size("Values").cast("bigint").alias("n"), F.array_join(starts, ",").alias("starts"),
        F.round(F.aggregate("Values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@demo("parse_metric_queries", """
    WITH q AS (
        SELECT n_nationkey::BIGINT AS nation, lower(n_name) AS name, n_nationkey AS k FROM nation)
    SELECT nation, 'a_' || name AS id, NULL AS expression, 'Shop' AS namespace, 'click' AS metric, k::VARCHAR AS user_id,
           60::BIGINT AS period, 'Sum' AS stat FROM q
    UNION ALL SELECT nation, 'b_' || name, 'a * ' || k, NULL, NULL, NULL, NULL, NULL FROM q
    UNION ALL SELECT nation, 'c_' || name, 'a + 1', NULL, NULL, NULL, NULL, NULL FROM q""")
def _(spark, sf):
    parsed = parse_metric_queries(shapes.metric_query_texts(spark, sf))
    return parsed.select(
        F.col("n_nationkey").cast("bigint").alias("nation"), "id", "expression", "namespace", "metric",
        F.col("dimensions")["UserId"].alias("user_id"), "period", "stat")


# --- routing and lookups

@demo("route_requests", f"""
    SELECT event_id, '/shop/nation_' || (user_id % 30) AS path,
           CASE WHEN r_name IS NULL THEN NULL
                ELSE '{shapes.TOPIC_ARN}-' || lower(r_name) || '-' || n_nationkey END AS source,
           CASE WHEN r_name IS NULL THEN 404 ELSE 200 END::BIGINT AS status
    FROM events LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
         ON '/shop/nation_' || (user_id % 30) = '/shop/' || lower(n_name)""")
def _(spark, sf):
    requests = shapes.events(spark, sf).select(
        "event_id", shapes.numbered("/shop/nation_", F.col("user_id") % 30).alias("path"))
    routed = route_requests(requests, registry(shapes.registered_sources(spark, sf)))
    return routed.select("event_id", "path", "source", "status")


@demo("resolve_resource", f"""
    WITH last AS (SELECT s_suppkey % 50 AS k, 'db-' || max(s_suppkey) AS resource_id FROM supplier GROUP BY 1)
    SELECT c_custkey, 'arn:aws:rds:us-east-1:{shapes.ACCOUNT}:db:' || (c_custkey % 60) AS arn,
           coalesce(resource_id, '') AS resource_id
    FROM customer LEFT JOIN last ON k = c_custkey % 60""")
def _(spark, sf):
    wanted = shapes.table(spark, sf, "customer").select(
        "c_custkey", shapes.numbered(f"arn:aws:rds:us-east-1:{shapes.ACCOUNT}:db:", F.col("c_custkey") % 60).alias("arn"))
    return resolve_resource(wanted, shapes.db_instances(spark, sf)).select("c_custkey", "arn", "resource_id")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NONE"]


@demo("find_subscription", f"""
    WITH wanted AS (
        SELECT s_suppkey, s_nationkey,
               list_extract({SEGMENTS}, (s_suppkey % 6 + 1)) AS segment FROM supplier),
    first AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS c FROM customer GROUP BY 1, 2)
    SELECT s_suppkey, '{shapes.TOPIC_ARN}-' || s_nationkey || ':' || c AS subscription_arn, c IS NOT NULL AS found
    FROM wanted LEFT JOIN first ON s_nationkey = c_nationkey AND segment = c_mktsegment""")
def _(spark, sf):
    segment = F.get(F.array(*map(F.lit, SEGMENTS)), (F.col("s_suppkey") % 6).cast("int"))
    wanted = shapes.table(spark, sf, "supplier").select(
        "s_suppkey", shapes.numbered(f"{shapes.TOPIC_ARN}-", F.col("s_nationkey")).alias("topic_arn"),
        shapes.numbered("https://hooks.example/", segment).alias("endpoint"))
    return find_subscription(wanted, shapes.subscriptions(spark, sf)).select("s_suppkey", "subscription_arn", "found")


# --- set operations

@demo("union_shards", """
    SELECT 'shard-' || (user_id % 4) AS shard_id, event_id::VARCHAR AS sequence, user_id::VARCHAR AS partition_key
    FROM events
    UNION ALL SELECT 'shard-' || (o_custkey % 4), o_orderkey::VARCHAR, NULL FROM orders""")
def _(spark, sf):
    second = shapes.change_records(spark, sf).select("shard_id", F.col("EventID").alias("SequenceNumber"))
    return union_shards(shapes.stream_records(spark, sf), second).select(
        "shard_id", F.col("SequenceNumber").alias("sequence"), F.col("PartitionKey").alias("partition_key"))


@demo("union_event_streams", f"""
    SELECT event_id::VARCHAR AS id, '{shapes.STREAM_ARN}' AS source, 'com.amazon.kinesis.stream_record' AS type,
           user_id::VARCHAR AS subject FROM events
    UNION ALL SELECT o_orderkey::VARCHAR, '{shapes.TABLE_ARN}', 'com.amazon.dynamodb.stream_record',
           'o_custkey,o_orderkey' FROM orders
    UNION ALL SELECT NULL, '{shapes.LOGS_ARN}', 'com.amazon.logs.log', NULL FROM events""")
def _(spark, sf):
    merged = union_event_streams(
        events_from_stream_records(shapes.stream_records(spark, sf), shapes.STREAM_ARN),
        events_from_change_records(shapes.change_records(spark, sf), shapes.TABLE_ARN),
        events_from_logs(shapes.log_entries(spark, sf), shapes.LOGS_ARN))
    own_id = F.when(~F.col("type").endswith("log"), F.col("id"))
    return merged.select(own_id.alias("id"), "source", "type", "subject")


CURRENT_EVENTS = (
    "CASE WHEN o_orderstatus = 'F' THEN 's3:ObjectRemoved:*' ELSE 's3:ObjectCreated:Post,s3:ObjectCreated:Put' END")


@demo("upsert_by_id", f"""
    WITH cur AS (
        SELECT 'b-' || o_custkey AS bucket, 'cfg-' || o_orderkey AS id, {CURRENT_EVENTS} AS events FROM orders),
    upd AS (
        SELECT 'b-' || o_custkey AS bucket,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'cfg-' ELSE 'new-' END || o_orderkey AS id FROM orders)
    SELECT coalesce(upd.bucket, cur.bucket) AS bucket, coalesce(upd.id, cur.id) AS id,
           CASE WHEN upd.id IS NOT NULL THEN 's3:ObjectCreated:Put,s3:ObjectCreated:Post' ELSE events END AS events,
           upd.id IS NOT NULL AND (cur.id IS NULL OR events <> 's3:ObjectCreated:Post,s3:ObjectCreated:Put') AS changed
    FROM cur FULL JOIN upd ON cur.bucket = upd.bucket AND cur.id = upd.id""")
def _(spark, sf):
    merged = upsert_by_id(shapes.bucket_settings(spark, sf), shapes.bucket_updates(spark, sf), ["bucket", "id"])
    return merged.select("bucket", "id", F.array_join("events", ",").alias("events"), "changed")


@demo("remove_by_id", f"""
    SELECT 'b-' || o_custkey AS bucket, 'cfg-' || o_orderkey AS id, {CURRENT_EVENTS} AS events
    FROM orders WHERE o_orderpriority <> '1-URGENT'""")
def _(spark, sf):
    kept = remove_by_id(shapes.bucket_settings(spark, sf), shapes.bucket_updates(spark, sf), ["bucket", "id"])
    return kept.select("bucket", "id", F.array_join("events", ",").alias("events"))


@demo("desired_state_diff", """
    WITH w AS (
        SELECT 'w-' || p_partkey AS name, p_brand = 'Brand#1' AS missing,
               concat_ws(',',
                   CASE WHEN p_partkey % 6 <> 0 AND p_partkey % 9 = 0 THEN 'image' END,
                   CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 10 = 0 THEN 'replicas' END,
                   CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 7 = 0 AND p_type <> 'other' THEN 'labels' END,
                   CASE WHEN p_partkey % 11 = 0 THEN 'args' END) AS differs
        FROM part)
    SELECT name, CASE WHEN missing THEN 'create' WHEN differs <> '' THEN 'update' ELSE 'noop' END AS action,
           CASE WHEN missing THEN '' ELSE differs END AS differs
    FROM w""")
def _(spark, sf):
    diff = desired_state_diff(shapes.desired_workloads(spark, sf), shapes.current_workloads(spark, sf), ["name"])
    return diff.select("name", "action", F.array_join("differs", ",").alias("differs"))


# --- source configuration

def _array(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CATALOG = f"""
    cfg AS (
        SELECT c_custkey AS k, list_extract({_array(shapes.CONFIG_KINDS)}, c_custkey % 11 + 1) AS kind,
               list_extract({_array(shapes.CONFIG_RESOURCES)}, c_custkey % 11 + 1) AS res,
               lower(c_mktsegment) AS ns, lower(replace(c_name, '#', '-')) AS name,
               CASE WHEN c_custkey % 9 <> 0 THEN list_extract({_array(shapes.CONFIG_INTERVALS)}, c_custkey % 8 + 1) END AS iv,
               CASE WHEN c_custkey % 11 = 0 THEN list_extract({_array(shapes.CONFIG_TIMEOUTS)}, c_custkey % 4 + 1) END AS vt
        FROM customer),
    arns AS (
        SELECT *, CASE WHEN kind = 'cloudwatch' THEN NULL WHEN k % 7 = 5 THEN 'not-arn:' || res
                       WHEN k % 7 = 6 THEN 'arn:aws:sqs'
                       ELSE 'arn:aws:' || res || CASE WHEN k % 5 = 4 THEN '/extra' ELSE '' END END AS arn,
               kind <> 'cloudwatch' AND k % 7 < 5 AS parsed, k % 5 = 4 AS extra,
               CASE WHEN kind = 's3' AND k % 4 = 0 THEN ['s3.objectcreated', 's3.objectremoved', 's3.testevent']
                    WHEN kind = 's3' THEN ['s3.replication', 's3.testevent', 's3.unknown']
                    WHEN kind = 'codecommit' AND NOT parsed THEN NULL
                    WHEN kind = 'codecommit' AND k % 3 = 0 THEN ['codecommit.push', 'codecommit.pull_request']
                    WHEN kind = 'codecommit' THEN ['codecommit.pull_request', 'codecommit.push']
                    WHEN kind = 'cloudwatch' THEN ['cloudwatch.metrics.metric', 'cloudwatch.metrics.message']
                    WHEN kind = 'performanceinsights' THEN ['rds.pi.metric']
                    WHEN NOT parsed THEN NULL
                    ELSE [split_part(res, ':', 1) || '.' || CASE kind
                        WHEN 'sqs' THEN 'message' WHEN 'kinesis' THEN 'stream_record' WHEN 'dynamodb' THEN 'stream_record'
                        WHEN 'cloudwatchlogs' THEN 'log' WHEN 'sns' THEN 'notification' ELSE 'sync_trigger' END] END AS kinds
        FROM cfg),
    catalog AS (
        SELECT *,
               CASE WHEN kind = 'cloudwatch' THEN 'io.example.awscloudwatchsource.' || ns || '.' || name
                    WHEN kind = 's3' AND parsed THEN 'arn:aws:s3:::bucket-name' || CASE WHEN extra THEN '/extra' ELSE '' END
                    WHEN kind = 's3' THEN NULL ELSE arn END AS source,
               CASE iv WHEN '5m' THEN 300000000000 WHEN '1h30m' THEN 5400000000000 WHEN '1.5h' THEN 5400000000000
                       WHEN '250ms' THEN 250000000 ELSE 300000000000 END AS interval_ns,
               concat_ws('; ',
                   CASE WHEN kind <> 'cloudwatch' AND k % 7 = 5 THEN 'arn: invalid prefix'
                        WHEN kind <> 'cloudwatch' AND k % 7 = 6 THEN 'arn: not enough sections' END,
                   CASE WHEN kind <> 'cloudwatch' AND (NOT parsed OR kind = 's3' AND extra)
                        THEN 'arn: not accepted by this kind' END,
                   CASE WHEN parsed AND extra AND kind IN ('kinesis', 'dynamodb', 'cognitouserpool', 'cognitoidentity')
                        THEN 'arn: unexpected resource' END,
                   CASE WHEN kind = 'cloudwatch' AND k % 2 = 1 THEN 'region: invalid' END,
                   CASE WHEN kind = 's3' AND k % 4 <> 0 THEN 'event types: unknown' END,
                   CASE iv WHEN '5' THEN 'polling interval: missing unit' WHEN '42kg' THEN 'polling interval: unknown unit'
                           WHEN '' THEN 'polling interval: invalid duration' END,
                   CASE vt WHEN 'bad' THEN 'visibility timeout: invalid duration'
                           WHEN '13h' THEN 'visibility timeout: out of bounds' END) AS errors
        FROM arns)
"""


@demo("source_catalog", f"""
    WITH {CATALOG}
    SELECT kind, name, arn, source, '/' || ns || '/' || name AS path,
           CASE WHEN parsed AND NOT extra AND kind IN ('kinesis', 'dynamodb', 'cognitouserpool', 'cognitoidentity')
                THEN split_part(res, '/', 2) END AS resource_value,
           CASE WHEN kind = 'cloudwatchlogs' AND parsed THEN '/app/x' END AS log_group,
           CASE WHEN kind = 'cloudwatchlogs' AND parsed THEN 's1' || CASE WHEN extra THEN '/extra' ELSE '' END END AS log_stream,
           CASE WHEN kind = 's3' AND parsed THEN 's3-events_bucket-name' || CASE WHEN extra THEN '/extra' ELSE '' END END AS queue_name,
           interval_ns AS polling_interval_ns,
           CASE interval_ns WHEN 300000000000 THEN '5m0s' WHEN 250000000 THEN '250ms' ELSE '1h30m0s' END AS polling_interval,
           CASE vt WHEN '30s' THEN 30 WHEN '1m1.5s' THEN 61 END::BIGINT AS visibility_timeout_seconds,
           array_to_string(list_transform(kinds, lambda x: 'com.amazon.' || x), ',') AS event_types, errors
    FROM catalog""")
def _(spark, sf):
    catalog = source_catalog(shapes.source_configs(spark, sf), "io.example")
    return catalog.select(
        "kind", "name", "arn", "source", "path", "resource_value", "log_group", "log_stream", "queue_name",
        "polling_interval_ns", "polling_interval", "visibility_timeout_seconds",
        F.array_join("event_types", ",").alias("event_types"), F.array_join("errors", "; ").alias("errors"))


@demo("event_type_registry", f"""
    WITH {CATALOG}
    SELECT source, 'com.amazon.' || unnest(kinds) AS type, unnest(generate_series(0, len(kinds) - 1)) AS pos FROM catalog""")
def _(spark, sf):
    return event_type_registry(source_catalog(shapes.source_configs(spark, sf), "io.example"))


@demo("failure_report", """
    WITH s AS (
        SELECT 1704067200 + p_partkey * 60 AS t, p_size % 8 AS pick, p_partkey AS k, p_name FROM part),
    m AS (
        SELECT *, pick IN (2, 3, 4, 6) AND k % 3 <> 2 AND NOT (pick = 4 AND k % 2 = 0) AND pick <> 3 AS missing FROM s),
    c AS (
        SELECT t // 3600 * 3600 AS bucket,
               CASE WHEN pick IN (0, 3) THEN 'AppRuntimeFailure' WHEN pick = 1 OR (pick = 4 AND k % 2 = 0) THEN 'BadContainerImage'
                    WHEN missing AND k % 3 = 0 THEN 'MissingSecret' WHEN missing THEN 'MissingConfigMap'
                    ELSE list_extract(['CrashLoopBackOff', 'ErrImagePull', 'CreateContainerConfigError', 'RevisionFailed',
                        'RevisionFailed', 'ContainerCreating', 'CreateContainerError', 'Unknown'], pick + 1) END AS reason
        FROM m)
    SELECT reason, bucket, count(*) AS n FROM c GROUP BY 1, 2""")
def _(spark, sf):
    return failure_report(shapes.status_messages(spark, sf))
