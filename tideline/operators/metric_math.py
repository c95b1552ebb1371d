"""Expressions over metric series and over one another, evaluated in the order of their references.

An expression's text becomes a Spark column over a table with one row per period and one column per series.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, Window, functions as F

TOKEN = re.compile(r"\s*(?:([0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+)|([A-Za-z_][A-Za-z0-9_]*)|(==|!=|<=|>=|&&|\|\||[-+*/^()<>,\[\]]))")
#: Binary operators, loosest first.
LEVELS = [("||", "OR"), ("&&", "AND"), ("==", "!=", "<", ">", "<=", ">="), ("+", "-"), ("*", "/")]
#: Number of arguments of each function, least and most.
FUNCTIONS = {
    "ABS": (1, 1), "CEIL": (1, 1), "FLOOR": (1, 1), "LOG": (1, 1), "LOG10": (1, 1), "SUM": (1, 1), "AVG": (1, 1), "MIN": (1, 1),
    "MAX": (1, 1), "STDDEV": (1, 1), "IF": (2, 3), "FILL": (2, 2), "RATE": (1, 1), "DIFF": (1, 1), "DIFF_TIME": (1, 1),
    "RUNNING_SUM": (1, 1), "PERIOD": (1, 1)}
WORDS = ("REPEAT", "LINEAR")
COMBINING = ("SUM", "AVG", "MIN", "MAX", "STDDEV")


@dataclass
class Node:
    """A number, a series, a list, a call or an operator."""

    kind: str
    value: str
    args: list[Node] = field(default_factory=list)

    def names(self) -> set[str]:
        own = {self.value} if self.kind == "series" else set()
        return own.union(*(a.names() for a in self.args))

    def calls(self, name: str) -> bool:
        return (self.kind == "call" and self.value == name) or any(a.calls(name) for a in self.args)


def parse(text: str) -> Node:
    """The expression that ``text`` is; a ValueError says what is wrong with it."""
    tokens, at = [], 0
    while at < len(text.rstrip()):
        m = TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"unexpected {text[at:].strip()[:1]!r}")
        tokens.append(next((kind, m.group(i)) for i, kind in ((1, "number"), (2, "name"), (3, "sign")) if m.group(i)))
        at = m.end()
    tokens.append(("end", "end"))
    place = 0

    def take(*wanted: str) -> str | None:
        nonlocal place
        kind, value = tokens[place]
        if kind != "end" and value in wanted:
            place += 1
            return value
        return None

    def need(sign: str) -> None:
        if take(sign) is None:
            raise ValueError(f"expected {sign!r} before {tokens[place][1]!r}")

    def listed(closing: str) -> list[Node]:
        items = [binary(0)]
        while take(","):
            items.append(binary(0))
        need(closing)
        return items

    def binary(level: int) -> Node:
        if level == len(LEVELS):
            return power()
        left = binary(level + 1)
        while sign := take(*LEVELS[level]):
            left = Node("operator", {"OR": "||", "AND": "&&"}.get(sign, sign), [left, binary(level + 1)])
        return left

    def power() -> Node:
        if take("-"):
            return Node("operator", "-", [Node("number", "0"), power()])
        base = single()
        return Node("operator", "^", [base, power()]) if take("^") else base

    def single() -> Node:
        nonlocal place
        kind, value = tokens[place]
        if take("("):
            inner = binary(0)
            need(")")
            return inner
        if take("["):
            return Node("list", "", listed("]"))
        if kind == "number":
            place += 1
            return Node("number", value)
        if kind != "name" or value in ("AND", "OR"):
            raise ValueError(f"unexpected {value!r}")
        place += 1
        if not take("("):
            return Node("word" if value in WORDS else "series", value)
        if value not in FUNCTIONS:
            raise ValueError(f"unknown function {value!r}")
        call = Node("call", value, listed(")"))
        if not FUNCTIONS[value][0] <= len(call.args) <= FUNCTIONS[value][1]:
            raise ValueError(f"{value} takes {FUNCTIONS[value][0]} to {FUNCTIONS[value][1]} arguments")
        return call

    tree = binary(0)
    if tokens[place][0] != "end":
        raise ValueError(f"unexpected {tokens[place][1]!r}")
    return checked(tree)


def checked(node: Node) -> Node:
    """``node`` with words only as the second argument of FILL, and lists only in functions that combine them."""
    if node.kind in ("word", "list"):
        raise ValueError(f"unexpected {node.value or 'list'!r}")
    for i, a in enumerate(node.args):
        if a.kind == "list" and node.kind == "call" and node.value in COMBINING:
            for item in a.args:
                checked(item)
        elif not (a.kind == "word" and (node.value, i) == ("FILL", 1)):
            checked(a)
    return node


class Compiler:
    """Expressions as columns of a table with a row per group and period."""

    def __init__(self, groups: Sequence[str], periods: dict[str, int]):
        self.whole = Window.partitionBy(*groups)
        self.upto = self.whole.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
        self.before = self.whole.orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
        self.after = self.whole.orderBy("ts").rowsBetween(1, Window.unboundedFollowing)
        self.periods = periods

    def column(self, node: Node) -> Column:
        if node.kind == "number":
            return F.lit(float(node.value))
        if node.kind == "series":
            return F.col(f"`{node.value}`")
        if node.kind == "operator":
            return self.operator(node.value, *map(self.column, node.args))
        return self.call(node.value, node.args)

    def operator(self, sign: str, a: Column, b: Column) -> Column:
        number: dict[str, Callable[[], Column]] = {
            "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b), "^": lambda: F.pow(a, b)}
        if sign in number:
            return number[sign]()
        test = {"==": a == b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "&&": (a != 0) & (b != 0), "||": (a != 0) | (b != 0)}
        return test[sign].cast("double")

    def call(self, name: str, args: list[Node]) -> Column:
        if name in COMBINING:
            return self.combined(name, args[0])
        if name == "PERIOD":
            return F.lit(float(self.periods[args[0].value])) if args[0].value in self.periods else F.lit(None).cast("double")
        value = self.column(args[0])
        plain = {"ABS": F.abs, "CEIL": F.ceil, "FLOOR": F.floor, "LOG": F.ln, "LOG10": F.log10}
        if name in plain:
            return plain[name](value).cast("double")
        if name == "IF":
            other = self.column(args[2]) if len(args) == 3 else F.lit(None).cast("double")
            return F.when(value.isNull(), None).when(value != 0, self.column(args[1])).otherwise(other)
        if name == "RUNNING_SUM":
            return F.when(value.isNotNull(), F.sum(value).over(self.upto))
        if name == "FILL":
            return self.filled(value, args[1])
        past, at = F.last(value, ignorenulls=True).over(self.before), self.seconds(F.when(value.isNotNull(), F.col("ts")))
        gap = at - F.max(at).over(self.before)
        return {"DIFF": value - past, "DIFF_TIME": gap, "RATE": (value - past) / gap}[name]

    @staticmethod
    def seconds(ts: Column) -> Column:
        return F.unix_micros(ts) / 1_000_000.0

    def combined(self, name: str, of: Node) -> Column:
        if of.kind != "list":  # one number for all periods of a series
            return {"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "STDDEV": F.stddev_pop}[name](self.column(of)).over(self.whole)
        found = F.array_compact(F.array(*map(self.column, of.args)))  # periods of several series, those without a value left out
        n, total = F.size(found), F.aggregate(found, F.lit(0.0), lambda s, x: s + x)
        mean = total / n
        spread = F.sqrt(F.aggregate(found, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n)
        value = {"SUM": total, "AVG": mean, "MIN": F.array_min(found), "MAX": F.array_max(found), "STDDEV": spread}[name]
        return F.when(n > 0, value)

    def filled(self, value: Column, how: Node) -> Column:
        if how.kind != "word":
            return F.coalesce(value, self.column(how))
        known = F.when(value.isNotNull(), F.struct(self.seconds(F.col("ts")).alias("at"), value.alias("v")))
        last = F.last(known, ignorenulls=True).over(self.before)
        if how.value == "REPEAT":
            return F.coalesce(value, last["v"])
        following = F.first(known, ignorenulls=True).over(self.after)
        share = (self.seconds(F.col("ts")) - last["at"]) / (following["at"] - last["at"])
        return F.coalesce(value, last["v"] + (following["v"] - last["v"]) * share)


def _read(expressions: DataFrame) -> tuple[dict[str, Node], dict[str, tuple[str, str]]]:
    """Parsed expressions, and (code, text) of those that are none. Query tables are small."""
    trees, wrong = {}, {}
    for id, text in sorted((r.id, r.expression) for r in expressions.where("expression IS NOT NULL").select("id", "expression").collect()):
        try:
            trees[id] = parse(text)
        except ValueError as error:
            wrong[id] = ("InvalidExpression", str(error))
    return trees, wrong


def _order(trees: dict[str, Node], known: Sequence[str]) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """Expressions in the order of their references, and what is wrong with those that can't be evaluated."""
    wrong: dict[str, tuple[str, str]] = {}
    left = dict(trees)
    while True:
        unknown = {id: min(missing) for id, t in left.items() if (missing := t.names() - set(known) - set(left))}
        if not unknown:
            try:
                return [id for id in TopologicalSorter({id: t.names() & set(left) for id, t in left.items()}).static_order()], wrong
            except CycleError as error:
                members = error.args[1][:-1]
                unknown, code = {id: " -> ".join(sorted(members)) for id in members}, "CyclicExpression"
        else:
            code = "UnknownSeries"
        wrong |= {id: (code, text) for id, text in unknown.items()}
        left = {id: t for id, t in left.items() if id not in unknown}


def metric_graph(
    values: DataFrame, queries: DataFrame, period_seconds: int, groups: Sequence[str] = (),
) -> DataFrame:
    """Series of all expressions of ``queries`` (id, expression, period): (groups, id, ts, value), periods with a value only.

    ``values`` (groups, id, ts, value) has the series of the metric queries. An expression may refer to these and to other
    expressions, in any order. Periods are those of any series, with FILL all between the first and the last one of a
    group. A value that an operator lacks gives none; SUM, AVG, MIN, MAX and STDDEV of a list leave it out, of one series
    they give one number for all periods. Comparisons give 1 or 0; a division by zero gives none. Expressions that can't
    be evaluated have no rows here, ``graph_failures`` lists them. Windows order one row per period of a group.
    """
    trees, _ = _read(queries)
    series = [r.id for r in queries.where("expression IS NULL").select("id").distinct().collect()]
    periods = {r.id: r.period for r in queries.where("expression IS NULL").select("id", "period").collect()}
    order, _ = _order(trees, series)
    used = sorted(set(series) & set().union(*(trees[id].names() for id in order)))
    if not order:
        return values.select(*groups, "id", "ts", "value").limit(0)
    wide = values.where(F.col("id").isin(used)).groupBy(*groups, "ts").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(F.when(F.col("id") == s, F.col("value"))).alias(s) for s in used])
    if any(trees[id].calls("FILL") for id in order):
        ends = wide.groupBy(*groups).agg(F.min("ts").alias("_a"), F.max("ts").alias("_b")).where("_a IS NOT NULL")
        every = F.sequence(F.col("_a"), F.col("_b"), F.expr(f"interval {period_seconds} seconds"))
        wide = ends.select(*groups, F.explode(every).alias("ts")).join(wide, [*groups, "ts"], "left")
    compiler = Compiler(groups, periods)
    for id in order:
        wide = wide.withColumn(id, compiler.column(trees[id]).cast("double"))
    long = wide.select(*groups, "ts", F.explode(F.array(*[
        F.struct(F.lit(id).alias("id"), F.col(f"`{id}`").alias("value")) for id in order])).alias("_s"))
    return long.select(*groups, "_s.id", "ts", "_s.value").where("value IS NOT NULL")


def graph_failures(queries: DataFrame) -> DataFrame:
    """Result rows, as ``metric_results`` gives them, of the expressions that ``metric_graph`` can't evaluate.

    These are texts that are no expression, references to series that there are not (also by way of such an expression), and
    expressions that refer to themselves by way of one another.
    """
    trees, wrong = _read(queries)
    series = [r.id for r in queries.where("expression IS NULL").select("id").distinct().collect()]
    _, unordered = _order(trees, series)
    rows = [(id, code, text) for id, (code, text) in sorted({**wrong, **unordered}.items())]
    found = queries.sparkSession.createDataFrame(rows, "Id string, Code string, Value string")
    return found.select(
        "Id", F.col("Id").alias("Label"), F.array(F.struct("Code", "Value")).alias("Messages"), F.lit("InternalError").alias("StatusCode"),
        F.array().cast("array<timestamp>").alias("Timestamps"), F.array().cast("array<double>").alias("Values"),
        F.lit(None).cast("bigint").alias("span"))
