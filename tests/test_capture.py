"""Capture, metrics and configuration operators against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.operators.capture import (
    backoff_delay, backoff_schedule, diff_snapshots, head_changes, log_capture, merge_seen, modified_since, poll_windows,
    select_log_streams, status_changes, with_previous)
from tideline.operators.config import desired_state_diff, remove_by_id, upsert_by_id
from tideline.operators.metrics import (
    as_metric_query, exact_percentile, invalid_queries, metric_expression, metric_stat, parse_metric_queries)
from tideline.operators.routing import find_subscription, resolve_resource, route_requests


def rows_by_time(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def polls(spark):
    """One source holds most of the rows; others are sparse."""
    rng = random.Random(7)
    rows = []
    for source, n, span in [("hot", 3000, 20_000), ("cold", 40, 500_000), ("one", 1, 10)]:
        rows += [(source, t, rng.random() < 0.2) for t in sorted(rng.sample(range(span), min(n, span)))]
    return pd.DataFrame(rows, columns=["source", "t", "had_data"])


def as_polls(spark, polls):
    return spark.createDataFrame(polls).withColumn("tick", F.timestamp_seconds("t"))


@pytest.mark.parametrize("chunk", [60, 900, 10**9])
def test_previous_row_of_a_hot_key(spark, polls, chunk):
    got = with_previous(as_polls(spark, polls), ["source"], "tick", ["t"], chunk_seconds=chunk)
    got = got.select("source", "t", F.col("previous.t").alias("p")).toPandas().sort_values(["source", "t"])
    want = polls.sort_values(["source", "t"]).groupby("source").t.shift()
    assert [None if math.isnan(x) else int(x) for x in got.p] == [None if math.isnan(x) else int(x) for x in want]


@pytest.mark.parametrize("chunk", [60, 900, 10**9])
def test_backoff_of_a_hot_source(spark, polls, chunk):
    got = backoff_schedule(as_polls(spark, polls), chunk_seconds=chunk).toPandas().sort_values(["source", "t"])
    steps = []
    for _, group in polls.sort_values(["source", "t"]).groupby("source"):
        step = -1
        for had_data in group.had_data:
            step = 0 if had_data else step + 1
            steps.append(step)
    assert list(got.step) == steps
    assert list(got.delay_seconds) == [max(1.0, min(32.0, 2.0**s - 1)) for s in steps]


def test_backoff_bounds(spark):
    delays = spark.range(8).select(backoff_delay(F.col("id"))).collect()
    assert [r[0] for r in delays] == [1, 1, 3, 7, 15, 31, 32, 32]
    assert spark.range(9, 10).select(backoff_delay(F.col("id"), 1, 60)).first()[0] == 60
    assert spark.range(5000, 5001).select(backoff_delay(F.col("id"))).first()[0] == 32


def test_poll_windows(spark):
    ticks = spark.createDataFrame([("s", 1000.9), ("s", 1300.2)], "source string, t double").withColumn("tick", F.timestamp_seconds("t"))
    rows = poll_windows(ticks, 300).orderBy("tick").select("start_ms", "end_ms").collect()
    assert [tuple(r) for r in rows] == [(700_000, 1_000_000), (1_000_000, 1_300_000)]


def heads(spark, commits):
    rows = [("r", "main", i, c) for i, c in enumerate(commits)]
    return spark.createDataFrame(rows, "repo string, branch string, t int, commit_id string").withColumn("poll_ts", F.timestamp_seconds("t"))


def test_head_changes(spark):
    assert head_changes(heads(spark, ["foo"])).count() == 0
    assert head_changes(heads(spark, ["foo", "foo"])).count() == 0
    assert [r.commit_id for r in head_changes(heads(spark, ["foo", "bar", "bar", "foo"])).orderBy("t").collect()] == ["bar", "foo"]
    prior = spark.createDataFrame([("r", "main", "foo")], "repo string, branch string, commit_id string")
    assert head_changes(heads(spark, ["foo"]), prior).count() == 0
    assert head_changes(heads(spark, ["bar"]), prior).first().previous_commit == "foo"


def prs(spark, rows):
    return spark.createDataFrame(rows, "repo string, pr_id string, t int, status string").withColumn("poll_ts", F.timestamp_seconds("t"))


def test_status_changes(spark):
    rows = [("r", "1", 0, "OPEN"), ("r", "2", 0, "OPEN"), ("r", "1", 1, "OPEN"), ("r", "2", 1, "CLOSED"), ("r", "3", 1, "OPEN"),
            ("other", "9", 5, "OPEN")]
    got = {(r.repo, r.pr_id, r.status) for r in status_changes(prs(spark, rows)).collect()}
    assert got == {("r", "2", "CLOSED"), ("r", "3", "OPEN")}
    prior = spark.createDataFrame([("r", "1", "OPEN")], "repo string, pr_id string, status string")
    got = {(r.pr_id, r.status) for r in status_changes(prs(spark, [("r", "1", 9, "OPEN"), ("r", "4", 9, "OPEN")]), prior).collect()}
    assert got == {("4", "OPEN")}


def users(spark, rows):
    frame = spark.createDataFrame(rows, "pool string, poll int, Username string, us bigint")
    return frame.withColumn("poll_ts", F.timestamp_seconds("poll")).withColumn("UserLastModifiedDate", F.timestamp_micros("us"))


def test_modified_since(spark):
    rows = [("p", 1, "user1", 0), ("p", 1, "user2", 1), ("p", 2, "user1", 0), ("p", 2, "user2", 2), ("p", 3, "user2", 2), ("p", 3, "user3", 2)]
    got = [(r.poll, r.Username) for r in modified_since(users(spark, rows)).collect()]
    assert got == [(2, "user2")]
    prior = spark.createDataFrame([("p", 0)], "pool string, us bigint").select("pool", F.timestamp_micros("us").alias("mark"))
    assert {(r.poll, r.Username) for r in modified_since(users(spark, rows), prior).collect()} == {(1, "user2"), (2, "user2")}


def test_diff_snapshots(spark):
    old = spark.createDataFrame([("1", "CREATED", 0), ("2", "X", 0), ("2", "CREATED", 1), ("9", "CREATED", 0)], "id string, status string, pos int")
    new = spark.createDataFrame([("1", "CREATED"), ("2", "CLOSED"), ("3", "CREATED")], "id string, status string")
    got = {tuple(r) for r in diff_snapshots(old, new, "id", "status", ["pos"]).collect()}
    assert got == {("2", "CLOSED"), ("3", "CREATED")}


def test_diff_snapshots_sorts_known_rows_once(spark):
    old = spark.createDataFrame([("1", "A", 0), ("1", "B", 2), ("1", "C", 1), (None, "A", 0), ("2", None, 1)], "id string, status string, pos int")
    new = spark.createDataFrame([("1", "B"), ("1", "C"), (None, "A"), ("2", None)], "id string, status string")
    rows = diff_snapshots(old, new, "id", "status", ["pos"])
    assert {tuple(r) for r in rows.collect()} == {("1", "C"), (None, "A")}
    plan = diff_snapshots(old, new, "id", "status", ["pos"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_max_by"):]
    assert below.count("Sort [") == 1 and below.index("Sort [") < below.index("Exchange hashpartitioning")


def test_merge_seen(spark):
    seen = spark.createDataFrame([("1", "A", 5), ("2", "A", 5)], "id string, status string, t int")
    emitted = spark.createDataFrame([("2", "B", 1), ("3", "C", 1), ("3", "D", 2)], "id string, status string, t int")
    assert {(r.id, r.status) for r in merge_seen(seen, emitted, ["id"], ["t"]).collect()} == {("1", "A"), ("2", "B"), ("3", "D")}


def test_log_capture_against_all_pairs(spark):
    rng = random.Random(3)
    logs = [(rng.choice("ab"), rng.randrange(0, 2_000_000), rng.randrange(0, 300_000)) for _ in range(400)]
    logs = [(g, str(i), t, t + d, "m") for i, (g, t, d) in enumerate(logs)]
    windows = [("a", 0, 700_001), ("a", 700_001, 700_050), ("a", 700_050, 1_900_000), ("b", 100, 1_000_000), ("b", 5, 5)]
    left = spark.createDataFrame(logs, "log_group string, log_stream string, Timestamp bigint, IngestionTime bigint, Message string")
    right = spark.createDataFrame(windows, "log_group string, start_ms bigint, end_ms bigint")
    got = {(r.log_stream, r.start_ms, r.late) for r in log_capture(left, right).collect()}
    want = {(s, a, i > b) for g, s, t, i, _ in logs for w, a, b in windows if w == g and a <= t < b}
    assert got == want


def test_select_log_streams(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 9), ("c", None)], "log_stream string, LastIngestionTime bigint")
    for stream, want in [("*", {"b"}), ("", {"b"}), ("b", {"b"}), ("a", set())]:
        assert {r.log_stream for r in select_log_streams(rows, 5, stream).collect()} == want


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.9, 0.99, 0.999, 1.0])
def test_exact_percentile(spark, fraction):
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(0, 1e3, 3001), "one": np.array([4.25]), "same": np.full(2000, 7.0),
        "narrow": 100 + rng.random(2000) * 1e-9, "mixed": np.concatenate([np.zeros(500), -np.exp(rng.normal(0, 30, 500)), [1e300, -1e300]])}
    rows = [(k, float(v), i) for k, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, value double, i bigint").select(
        "k", "value", F.lit(fraction).alias("fraction"), F.lit(1).cast("bigint").alias("n"), F.col("i").alias("spread"))
    got = {r.k: r.value for r in exact_percentile(df, ["k"]).collect()}
    for name, values in groups.items():
        assert got[name] == pytest.approx(np.percentile(values, fraction * 100), rel=1e-9, abs=1e-300), name


def points(spark, rows):
    frame = spark.createDataFrame(rows, "metric string, dimensions map<string,string>, unit string, t bigint, value double")
    return frame.select(F.lit("ns").alias("namespace"), "metric", "dimensions", "unit", F.timestamp_seconds("t").alias("ts"), "value")


def test_metric_stat_filters(spark):
    data = points(spark, [
        ("m", {"a": "1", "b": "2"}, "Count", 0, 1.0), ("m", {"a": "1", "b": "3"}, "Count", 1, 2.0), ("m", {"a": "1"}, "Count", 2, 4.0),
        ("m", {"a": "1", "b": "2"}, "Bytes", 3, 8.0), ("x", {"a": "1", "b": "2"}, "Count", 4, 16.0), ("m", {"a": "1", "b": "2"}, "Count", 7, None),
        ("m", None, "Count", 8, 32.0)])
    def total(**kw):
        return [r.value for r in metric_stat(data, as_metric_query(spark, "q", "ns", "m", 60, "Sum", **kw)).collect()]
    assert total(dimensions={"a": "1", "b": "2"}) == [9.0]
    assert total(dimensions={"a": "1", "b": "2"}, unit="Count") == [1.0]
    assert total(dimensions={"a": "1"}) == [15.0]
    assert total() == [47.0]
    assert total(dimensions={"z": "1"}) == []


def test_metric_period_starts_at_the_epoch(spark):
    data = points(spark, [("m", {}, None, t, 1.0) for t in (6, 7, 13, 14)])
    got = metric_stat(data, as_metric_query(spark, "q", "ns", "m", 7, "SampleCount"))
    assert {(r.ts.timestamp(), r.value) for r in got.collect()} == {(0, 1.0), (7, 2.0), (14, 1.0)}


def test_metric_expression_needs_all_inputs(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 4.0), ("a", 2, 3.0)], "id string, t int, value double")
    series = rows.select("id", F.timestamp_seconds("t").alias("ts"), "value")
    assert [(r.id, r.value) for r in metric_expression(series, "r", "b / a", ["a", "b"]).collect()] == [("r", 2.0)]


def test_parse_metric_queries(spark):
    text = ('[{"name":"q","metric":{"period":60,"stat":"Sum","metric":{"dimensions":[{"name":"FunctionName","value":"f"},'
            '{"name":"Resource","value":"r"}],"metricName":"Duration","namespace":"AWS/Lambda"}}},{"name":"none"},'
            '{"name":"e","expression":"q * 2","metric":{"period":1}}]')
    rows = spark.createDataFrame([(1, text), (2, "not json"), (3, "{}")], "source int, queries string")
    got = parse_metric_queries(rows).orderBy("id").collect()
    assert [(r.source, r.id, r.expression, r.period, r.stat, r.unit, r.dimensions) for r in got] == [
        (1, "e", "q * 2", None, None, None, None),
        (1, "q", None, 60, "Sum", None, {"FunctionName": "f", "Resource": "r"})]
    assert {r.source for r in invalid_queries(rows).collect()} == {2, 3}


def test_upsert_and_remove(spark):
    current = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"])], "id string, events array<string>")
    update = spark.createDataFrame([("1", ["b", "a"]), ("3", ["c"])], "id string, events array<string>")
    got = {r.id: (r.events, r.changed) for r in upsert_by_id(current, update, ["id"]).collect()}
    assert got == {"1": (["b", "a"], False), "2": (["a"], False), "3": (["c"], True)}
    other = spark.createDataFrame([("2", ["b"])], "id string, events array<string>")
    assert {r.id: r.changed for r in upsert_by_id(current, other, ["id"]).collect()} == {"1": False, "2": True}
    assert [r.id for r in remove_by_id(current, update, ["id"]).collect()] == ["2"]


def test_desired_state(spark):
    schema = "name string, image string, replicas bigint, labels map<string,string>, args array<string>"
    current = spark.createDataFrame([("a", "i", 3, {"x": "1", "y": "2"}, ["p", "q"]), ("extra", "i", 1, None, None)], schema)
    cases = [
        (("a", None, None, None, None), "noop"), (("a", "", 0, {}, []), "noop"), (("a", "i", 3, {"x": "1"}, ["p"]), "noop"),
        (("a", "j", 3, None, None), "update"), (("a", None, 4, None, None), "update"), (("a", None, None, {"z": "1"}, None), "update"),
        (("a", None, None, None, ["q"]), "update"), (("a", None, None, None, ["p", "q", "r"]), "update"), (("b", "i", 1, None, None), "create")]
    for desired, action in cases:
        got = desired_state_diff(spark.createDataFrame([desired], schema), current, ["name"]).collect()
        assert [r.action for r in got] == [action], desired


def test_lookups(spark):
    requests = spark.createDataFrame([("/foo",), ("/bar",), ("/",)], "path string")
    known = spark.createDataFrame([("/foo", "s1"), ("/bar", "s2")], "path string, source string")
    assert {(r.path, r.status) for r in route_requests(requests, known).collect()} == {("/foo", 200), ("/bar", 200), ("/", 404)}
    instances = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "arn string, resource_id string, pos int")
    wanted = spark.createDataFrame([("a",), ("b",)], "arn string")
    assert {tuple(r) for r in resolve_resource(wanted, instances).collect()} == {("a", "2"), ("b", "")}
    subs = spark.createDataFrame([("t", "u", "s1", 1), ("t", "u", "s2", 2)], "topic_arn string, endpoint string, subscription_arn string, pos int")
    asked = spark.createDataFrame([("t", "u"), ("t", "v")], "topic_arn string, endpoint string")
    assert {(r.endpoint, r.subscription_arn, r.found) for r in find_subscription(asked, subs).collect()} == {("u", "s1", True), ("v", None, False)}
