"""Metric expressions: parsing, order of evaluation, missing values, and what can't be evaluated."""

import math

import pytest
from pyspark.sql import functions as F

from tideline.operators.metric_math import graph_failures, metric_graph, parse


def text_of(n):
    return n.value if n.kind in ("number", "series", "word") else f"{n.value}({' '.join(map(text_of, n.args))})"


@pytest.mark.parametrize("text, tree", [
    ("a + b * c", "+(a *(b c))"), ("a - b - c", "-(-(a b) c)"), ("2 ^ 3 ^ a", "^(2 ^(3 a))"), ("-a ^ 2", "-(0 ^(a 2))"), ("a * -b", "*(a -(0 b))"),
    ("(a + b) * 1.5e3", "*(+(a b) 1.5e3)"), ("a > 1 AND b < 2 || c", "||(&&(>(a 1) <(b 2)) c)"), ("SUM([a, b + 1])", "SUM((a +(b 1)))"),
    ("FILL(a, LINEAR)", "FILL(a LINEAR)"), ("IF(a == b, 1, IF(a != b, 2))", "IF(==(a b) 1 IF(!=(a b) 2))"), (" a ", "a"), (".5", ".5")])
def test_parse(text, tree):
    assert text_of(parse(text)) == tree


@pytest.mark.parametrize("text", ["", "a +", "(a", "a b", "a $ b", "NOPE(a)", "IF(a)", "ABS(a, b)", "[a, b]", "a + [b]", "FILL(a, [b])", "LINEAR",
                                  "FILL(LINEAR, a)", "a AND", "1..2", "SUM([])", "SUM([a b])", "AND"])
def test_not_an_expression(text):
    with pytest.raises(ValueError):
        parse(text)


def run(spark, series, expressions, period=10, groups=False):
    rows = [(g, s, t * 1.0, v) for (g, s), points in series.items() for t, v in points.items()]
    values = spark.createDataFrame(rows, "g string, id string, t double, value double").select("g", "id", F.timestamp_seconds("t").alias("ts"), "value")
    names = sorted({s for _, s in series})
    queries = spark.createDataFrame([(n, None, period) for n in names] + [(n, e, None) for n, e in expressions.items()],
                                    "id string, expression string, period bigint")
    got = metric_graph(values if groups else values.drop("g"), queries, period, ["g"] if groups else [])
    out = {}
    for r in got.collect():
        out.setdefault((r.g, r.id) if groups else r.id, {})[int(r.ts.timestamp())] = round(r.value, 9)
    return out, {(r.Id, r.Messages[0].Code, r.Messages[0].Value) for r in graph_failures(queries).collect()}


A = {("x", "a"): {0: 1.0, 10: 2.0, 40: 8.0}, ("x", "b"): {10: 4.0, 20: 5.0, 40: 0.0}}


def test_missing_values(spark):
    got, failures = run(spark, A, {
        "add": "a + b", "sum": "SUM([a, b])", "least": "MIN([a, b])", "mean": "AVG([a, b])", "apart": "STDDEV([a, b])", "all": "SUM(a)", "div": "a / b",
        "zero": "FILL(a, 0)", "last": "FILL(a, REPEAT)", "line": "FILL(a, LINEAR)", "rate": "RATE(a)", "diff": "DIFF(a)", "gap": "DIFF_TIME(a)",
        "run": "RUNNING_SUM(a)", "if": "IF(a > 1, a)", "both": "IF(a >= 1 && b != 0, 1, 0)", "p": "PERIOD(a) * FILL(a, 1) / FILL(a, 1)",
        "round": "CEIL(a / 3) + FLOOR(a / 3)", "logs": "LOG(a) + LOG10(a)"})
    assert not failures
    assert got["add"] == {10: 6.0, 40: 8.0} and got["sum"] == {0: 1.0, 10: 6.0, 20: 5.0, 40: 8.0} and got["least"] == {0: 1.0, 10: 2.0, 20: 5.0, 40: 0.0}
    assert got["mean"] == {0: 1.0, 10: 3.0, 20: 5.0, 40: 4.0} and got["apart"] == {0: 0.0, 10: 1.0, 20: 0.0, 40: 4.0}
    assert set(got["all"].values()) == {11.0} and len(got["all"]) == 5 and got["div"] == {10: 0.5}
    assert got["zero"] == {0: 1.0, 10: 2.0, 20: 0.0, 30: 0.0, 40: 8.0} and got["last"] == {0: 1.0, 10: 2.0, 20: 2.0, 30: 2.0, 40: 8.0}
    assert got["line"] == {0: 1.0, 10: 2.0, 20: 4.0, 30: 6.0, 40: 8.0} and got["rate"] == {10: 0.1, 40: 0.2} and got["diff"] == {10: 1.0, 40: 6.0}
    assert got["gap"] == {10: 10.0, 40: 30.0} and got["run"] == {0: 1.0, 10: 3.0, 40: 11.0} and got["if"] == {10: 2.0, 40: 8.0}
    assert got["both"] == {10: 1.0, 40: 0.0} and set(got["p"].values()) == {10.0} and got["round"] == {0: 1.0, 10: 1.0, 40: 5.0}
    assert got["logs"][40] == pytest.approx(math.log(8) + math.log10(8))


def test_levels_and_groups(spark):
    series = {**A, ("y", "a"): {0: 10.0, 20: 30.0}}
    got, _ = run(spark, series, {"z": "y * 2", "y": "x + 1", "x": "FILL(a, 0)"}, groups=True)
    assert got["x", "z"] == {0: 4.0, 10: 6.0, 20: 2.0, 30: 2.0, 40: 18.0} and got["y", "z"] == {0: 22.0, 10: 2.0, 20: 62.0}


def test_failures(spark):
    got, failures = run(spark, A, {"ok": "a", "one": "two + 1", "two": "three", "three": "one", "me": "me", "gone": "nowhere", "next": "gone + a", "bad": "a +",
                                   "over": "bad * 2"})
    assert set(got) == {"ok"}
    cycle = "one -> three -> two"
    assert failures == {("one", "CyclicExpression", cycle), ("two", "CyclicExpression", cycle), ("three", "CyclicExpression", cycle), ("me", "CyclicExpression", "me"),
                        ("gone", "UnknownSeries", "nowhere"), ("next", "UnknownSeries", "gone"), ("bad", "InvalidExpression", "unexpected 'end'"),
                        ("over", "UnknownSeries", "bad")}
    nothing = spark.createDataFrame([], "id string, ts timestamp, value double")
    queries = spark.createDataFrame([("e", "x + 1", None)], "id string, expression string, period bigint")
    assert metric_graph(nothing, queries, 60).columns == ["id", "ts", "value"] and metric_graph(nothing, queries, 60).count() == 0
