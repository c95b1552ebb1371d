"""Statistics by rank against sorted lists, from points and from roll-ups."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tideline.operators import metrics
from tideline.operators.metrics import as_metric_query, metric_failures, metric_rollups, metric_stat
from tideline.operators.order_stats import stat_spec
from tideline.sources.landed import union_shards


def by_hand(stat, values):
    v, n = sorted(values, key=lambda x: (math.isnan(x), x)), len(values)
    if stat[0] == "p":
        at = float(stat[1:]) / 100 * (n - 1)
        a, b = v[math.floor(at)], v[math.ceil(at)]
        return a if a == b else a + (b - a) * (at - math.floor(at))
    if stat == "IQM":
        stat = "TM(25%:75%)"
    if stat[0].islower():
        stat = f"{stat[:2].upper()}(:{stat[2:]}%)"
    kind, share = stat[:2], "%" in stat
    low, high = (x.rstrip("%") for x in stat[3:-1].split(":"))
    if share:
        cut, up = math.floor(Fraction(low or 0) * n / 100), math.floor((100 - Fraction(high or 100)) * n / 100)
        kept = v[cut:n - up]
        ends = [kept[0]] * cut + [kept[-1]] * up if kept else []
    else:
        inside = lambda x: (not low or x > float(low)) and (not high or x <= float(high))
        kept = [x for x in v if inside(x)]
        ends = [float(low) if low and x <= float(low) else float(high) for x in v if not inside(x)]
    if kind == "TC":
        return float(len(kept))
    if kind == "PR":
        return 100 * len(kept) / n
    if kind == "WM":
        return math.fsum(kept + ends) / n if kept or not share else None
    return None if not kept else math.fsum(kept) / (len(kept) if kind == "TM" else 1)


STATS = ["tm90", "tm99.9", "TM(5%:95%)", "TM(30%:)", "TM(:12.5%)", "IQM", "TM(-20:30)", "TM(10:)", "wm98", "WM(10%:90%)", "WM(-20:30)",
         "tc75", "TC(0:50)", "TC(20%:80%)", "ts60", "TS(80%:)", "TS(:-10)", "PR(:0)", "PR(-5.5:40)", "p0", "p50", "p99.9", "p100"]


def groups():
    rng = random.Random(4)
    return {
        "normal": [rng.gauss(0, 40) for _ in range(4001)], "ties": [float(rng.randrange(-3, 4)) for _ in range(3000)], "one": [7.5],
        "two": [1.0, -1.0], "same": [3.25] * 500, "epoch": [1.7e9 + rng.random() * 100 for _ in range(3000)],
        "heavy": [rng.paretovariate(0.6) for _ in range(3000)], "four": [4.0, 3.0, 2.0, 1.0]}


def points_of(spark, values):
    rows = [(name, i, float(v)) for name, vs in values.items() for i, v in enumerate(vs)]
    frame = spark.createDataFrame(rows, "metric string, t bigint, value double").repartition(6)
    return frame.select(F.lit("ns").alias("namespace"), "metric", F.create_map(F.lit("d"), F.lit("1")).alias("dimensions"),
                        F.lit("u").alias("unit"), F.timestamp_seconds("t").alias("ts"), "value")


def asked(spark, values, stats, period=86_400):
    names = {f"q{i}": (m, s) for i, (m, s) in enumerate((m, s) for m in values for s in stats)}
    rows = [(q, "ns", m, {}, period, s, None) for q, (m, s) in names.items()]
    return names, spark.createDataFrame(rows, "id string, namespace string, metric string, dimensions map<string,string>, period bigint, stat string, unit string")


@pytest.mark.parametrize("rolled", [False, True])
def test_every_statistic(spark, rolled):
    values = groups()
    points = points_of(spark, values)
    names, queries = asked(spark, values, STATS)
    got = {r.id: r.value for r in metric_stat(points, queries, metric_rollups(points, 600) if rolled else None, 600).collect()}
    for q, (metric, stat) in names.items():
        want = by_hand(stat, values[metric])
        assert (q in got) == (want is not None), (metric, stat)
        if want is not None:
            assert got[q] == pytest.approx(want, rel=1e-9, abs=1e-9), (metric, stat)


def test_not_a_number_is_larger_than_any(spark):
    values = {"some": [1.0, math.nan, 2.0, 3.0, math.nan, 4.0], "all": [math.nan] * 3}
    names, queries = asked(spark, values, ["p50", "p100", "tm60", "wm60", "ts50", "tm90", "PR(:3)"])
    got = {names[r.id]: r.value for r in metric_stat(points_of(spark, values), queries).collect()}
    for key, value in got.items():
        want = by_hand(key[1], values[key[0]])
        assert (math.isnan(value) and math.isnan(want)) or value == pytest.approx(want), key
    assert got["some", "tm60"] == pytest.approx(2.5) and math.isnan(got["all", "p50"])


def test_groups_by_period_and_two_scans(spark):
    values = groups()
    points = points_of(spark, {"normal": values["normal"]})
    _, queries = asked(spark, ["normal"], ["tm90", "p90"], 600)
    out = metric_stat(points, queries)
    want = defaultdict(list)
    for t, v in enumerate(values["normal"]):
        want[t // 600 * 600].append(v)
    assert {(r.id, int(r.ts.timestamp())): round(r.value, 6) for r in out.collect()} == {
        (q, start): round(by_hand(s, vs), 6) for start, vs in want.items() for q, s in (("q0", "tm90"), ("q1", "p90"))}


def test_names(spark):
    good = ["Sum", "p9", "p100", "p99.99", "tm5", "wm100", "tc0.5", "IQM", "TM(1:2)", "TM(:2)", "TM(-1.5:)", "TS(1%:99%)", "PR(:3)", "WM(:90%)"]
    bad = ["sum", "p", "p101", "px", "tm", "tm101", "pr50", "TM()", "TM(:)", "TM(5%:90)", "TM(90%:10%)", "TM(5:5)", "TM(1%:101%)", "PR(1%:2%)",
           "tm90 ", "IQM(1:2)", "XX(1:2)", "", "p5\n", "TM(1:2", None]
    rows = spark.createDataFrame([(s,) for s in good + bad], "s string").select("s", stat_spec(F.col("s")).alias("spec")).collect()
    assert [r.s for r in rows if r.spec is not None] == good
    queries = union_shards(*[as_metric_query(spark, n, "ns", "m", p, s) for n, s, p in (
        ("ok", "tm90", 60), ("Bad name", "Sum", 60), ("x", "TM(5:5)", 60), ("y", "IQM", 0))]).withColumn("expression", F.lit(None).cast("string"))
    more = queries.limit(1).withColumns({"expression": F.lit("ok + 1"), "id": F.lit("1st"), "stat": F.lit(None).cast("string")})
    got = {(r.Id, r.Messages[0].Code, r.Messages[0].Value) for r in metric_failures(queries.unionByName(more)).collect()}
    assert got == {("Bad name", "InvalidName", "Bad name"), ("x", "UnknownStatistic", "TM(5:5)"), ("y", "InvalidPeriod", "0"),
                   ("1st", "InvalidName", "1st")}


def test_statistics_are_read_once_per_query(spark):
    points = spark.createDataFrame(
        [("N", "m", {}, None, float(i)) for i in range(50)], "namespace string, metric string, dimensions map<string,string>, unit string, value double")
    points = points.withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("value").cast("long")))
    queries = union_shards(*[as_metric_query(spark, id, "N", "m", 60, id) for id in ("tm50", "PR(10:30)", "p50", "Sum")])
    got = {r.id: r.value for r in metric_stat(points, queries).collect()}
    assert got == {"tm50": 12.0, "PR(10:30)": 40.0, "p50": 24.5, "Sum": 1225.0}
    # above the join with the points, no pattern is looked for in the name of a statistic
    plan = metrics._groups_of_points(points, queries)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not any(word in plan[:plan.index("Join")].lower() for word in ("rlike", "regexp"))
