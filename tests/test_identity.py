"""Event identity, redelivery, odd numbers and JSON text."""

import math

import pytest
from pyspark.sql import functions as F

from tideline.operators.envelope import events_from_logs, events_from_messages
from tideline.operators.identity import sync_datasets
from tideline.operators.metrics import exact_percentile
from tideline.plans import demo_events  # noqa: F401
from tideline.plans.registry import QUERIES
from tideline.schemas import LANDED, SYNC_RECORD
from tideline.session import new_dir
from tideline.sinks.events import read_events, write_events
from tideline.sources.landed import poll_trigger
from tideline.streaming.windows import dedupe_redelivered


def test_equal_lines_of_two_streams_have_two_ids(spark):
    rows = [("g", "a", "line", 5), ("g", "b", "line", 5), ("g", "a", "line", 5), ("g|a", "", "line", 5), ("g", "|a", "line", 5)]
    logs = spark.createDataFrame(rows, "log_group string, log_stream string, Message string, Timestamp long")
    ids = [r.id for r in events_from_logs(logs, "arn:aws:logs:eu-north-1:1:log-group:g").collect()]
    assert len(set(ids)) == 4 and ids[0] == ids[2]


def test_queue_events_carry_the_time_they_were_sent(spark):
    schema = LANDED["queue_message"]
    rows = spark.createDataFrame(
        [("1", {"SentTimestamp": "1700000000123"}), ("2", {"SentTimestamp": "soon"}), ("3", None)], "MessageId string, Attributes map<string,string>")
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in rows.columns})
    events = events_from_messages(rows, "arn:aws:sqs:eu-north-1:1:orders").select("id", F.unix_millis("time").alias("t"))
    assert dict(map(tuple, events.collect())) == {"1": 1700000000123, "2": None, "3": None}


def events(spark, rows):
    return spark.createDataFrame(rows, "id string, source string, subject string, s long").select(
        "id", "source", "subject", F.timestamp_seconds("s").alias("time"))


def test_redelivery_over_micro_batches(spark):
    path, out, checkpoint = (new_dir(spark, x) for x in ("in", "out", "checkpoint"))
    steps = [[("a", "q", "x", 1), ("a", "q", "y", 1), ("b", "q", None, 2)], [("a", "q", "x", 3), ("b", "q", None, 4)], [("b", "r", None, 5)]]
    for step in steps:
        df = events(spark, step)
        df.coalesce(1).write.mode("append").parquet(path)
        stream = dedupe_redelivered(spark.readStream.schema(df.schema).parquet(path))
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(**poll_trigger()).start().awaitTermination())
    want = [("a", "q", "x"), ("a", "q", "y"), ("b", "q", None), ("b", "r", None)]
    key = lambda r: tuple(x or "" for x in r)
    got = [tuple(r)[:3] for r in spark.read.schema(df.schema).parquet(out).collect()]
    assert sorted(got, key=key) == want
    everything = events(spark, [r for s in steps for r in s])
    assert sorted((tuple(r)[:3] for r in dedupe_redelivered(everything).collect()), key=key) == want


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 100.0, 1000.0, math.nan], [math.inf, 1.0, -math.inf, 0.0, 5.0], [1.7976931348623157e308, 1e308, 1.0, math.inf, 2.0],
    [math.inf, math.inf, math.inf, 1.0, 2.0], [-math.nan, -1.0, -2.0, 3.0, 4.0]])
def test_percentiles_of_odd_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value double")
    for fraction in (0.0, 0.5, 0.75, 1.0):
        rows = df.select(F.lit("k").alias("k"), "value", F.lit(1).cast("long").alias("n"), F.lit(fraction).alias("fraction"),
                         F.lit(0).cast("long").alias("spread"))
        got = exact_percentile(rows, ["k"]).first().value
        want = df.agg(F.percentile("value", fraction).alias("p")).first().p
        assert got == want or (math.isnan(got) and math.isnan(want))


def test_text_data_stays_json(spark):
    rows = [("1", '"plain"'), ("2", '{"a":"b"}'), ("3", "[1]"), ("4", "7"), ("5", '"with \\"quotes\\""'), ("6", None)]
    df = spark.createDataFrame(rows, "id string, data string").selectExpr(
        "id", "'s' AS source", "'1.0' AS specversion", "'t' AS type", "string(null) AS subject", "timestamp(null) AS time",
        "'application/json' AS datacontenttype", "cast(null AS map<string,string>) AS extensions", "data")
    path = new_dir(spark, "events")
    write_events(df, path)
    assert {r.id: r.data for r in read_events(spark, path).collect()} == dict(rows)


def test_large_and_small_datasets_have_the_same_parts(spark):
    """Datasets that are ordered as one list come in the parts that shared ones come in."""
    rows = [(f"i{i % 3}", f"d{i % 7}" if i % 50 else None, f"k{i % 90}", str(i)) for i in range(900)] + [(None, "d1", "k", "v")]
    records = spark.createDataFrame(rows, "IdentityId string, DatasetName string, Key string, Value string")
    records = records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SYNC_RECORD if f.name not in records.columns})
    datasets = spark.createDataFrame([(f"i{i}", f"d{k}") for i in range(4) for k in range(8)] + [("i0", None), ("i1", "d1")], "IdentityId string, DatasetName string")
    identities = spark.createDataFrame([("i0",), ("i1",), ("i3",), ("i1",)], "IdentityId string")
    found = [sorted(map(str, sync_datasets(identities, datasets, records, part_records=8, spread=4, together=n).collect())) for n in (8, 45, 1000)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 80


def test_sync_query_parses_an_event_once(spark, tmp_path):
    tables = {
        "customer": spark.range(1, 3).selectExpr("id AS c_custkey"),
        "orders": spark.range(1, 5).selectExpr(
            "id AS o_orderkey", "id % 3 AS o_custkey", "DATE'2024-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority", "1.5D AS o_totalprice"),
        "lineitem": spark.range(6).selectExpr(
            "id % 2 + 1 AS l_orderkey", "CAST(id AS INT) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey", "2D AS l_quantity",
            "'A' AS l_returnflag", "DATE'2024-01-03' AS l_shipdate")}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    df = QUERIES["events_from_sync"](spark, str(tmp_path))
    got = {(r.subject, r.trigger, r.region, r.pool, r.n) for r in df.collect()}
    assert got == {(f"order-{k}", "SyncTrigger", "us-east-1", "us-east-1:pool", n) for k, n in ((1, 3), (2, 3), (4, 0))}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") + plan.count("from_json(") == 1


def test_small_datasets_are_not_sorted_to_meet_large_ones(spark):
    """Where no dataset is large, records go into their lists and nowhere else."""
    rows = [(f"i{i % 9}", f"d{i % 7}", f"k{i}", str(i)) for i in range(500)]
    records = spark.createDataFrame(rows, "IdentityId string, DatasetName string, Key string, Value string")
    records = records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SYNC_RECORD if f.name not in records.columns})
    datasets, identities = records.select("IdentityId", "DatasetName").distinct(), records.select("IdentityId").distinct()
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were too large for it
    try:
        df = sync_datasets(identities, datasets, records)
        found = {(r.IdentityId, r.DatasetName): [x.Key for x in r.DatasetRecords] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    want = {(i, d): sorted(r[2] for r in rows if r[:2] == (i, d)) for i, d in {r[:2] for r in rows}}
    assert found == want
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # datasets meet identities and lists; records are not sorted to meet the few large datasets
    assert "== Final Plan ==" in final and final.count("SortMergeJoin") == 2 and "Window" not in final
