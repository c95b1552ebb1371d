"""URL filter: host and path rules, then exact membership in a host list by a Bloom filter cascade.

Level 1 encodes the listed keys, level 2 those unlisted keys of the corpus's whole key universe that
pass level 1, level 3 the listed keys that pass level 2, and so on until a level lets nothing false
through. The first level that lacks a key decides, which is exact for every key of the universe.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import stored

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: A level that would need more bytes is not shipped; membership then comes from a join on the key.
MAX_LEVEL_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The (rule, verdict) struct of the longest rule that fits, or null."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        hit = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        fits = F.when(hit, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


class Level:
    """One Bloom filter: built by a Spark aggregation of bits per byte, probed as a binary literal."""

    def __init__(self, keys: DataFrame, n: int, fpp: float, number: int) -> None:
        self.number = number
        self.hashes = max(1, round(-math.log2(fpp)))
        self.bits = max(64, math.ceil(n * -math.log(fpp) / math.log(2) ** 2))
        if self.bits > 8 * MAX_LEVEL_BYTES:
            raise OverflowError(f"{self.bits} bits at level {number}")
        spots = keys.select(F.explode(F.array(*positions(F.col("key"), number, self.hashes, self.bits))).alias("p"))
        rows = spots.groupBy(F.floor(F.col("p") / 8).alias("byte")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1), F.pmod("p", F.lit(8)).cast("int"))).alias("v")).toLocalIterator()
        filter_ = bytearray(self.bits // 8 + 1)
        for row in rows:
            filter_[row["byte"]] = row["v"]
        self.filter = bytes(filter_)

    def has(self, key: Column) -> Column:
        found = F.lit(True)
        for p in positions(key, self.number, self.hashes, self.bits):
            byte = F.conv(F.hex(F.substring(F.lit(self.filter), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            found = found & (F.call_function("shiftright", byte, F.pmod(p, F.lit(8)).cast("int")).bitwiseAND(1) == 1)
        return found


def bloom_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that separate ``listed`` from the rest of ``universe`` (both: distinct, column key)."""
    inside = stored(listed.join(universe, "key", "left_semi"), "listed")
    outside = stored(universe.join(listed, "key", "left_anti"), "unlisted")
    levels: list[Level] = []
    n_in, n_out = inside.count(), outside.count()
    while n_in:
        # the first level leaves about as many false keys as there are listed ones; later ones halve
        fpp = 0.5 if levels else min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(n_out, 1)))
        levels.append(Level(inside, n_in, fpp, len(levels) + 1))
        inside, outside = stored(outside.where(levels[-1].has(F.col("key"))), f"level{len(levels)}"), inside
        n_in = inside.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether ``key`` is listed: the first level that lacks it decides, odd ones against and even ones for."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(level.has(key), answer).otherwise(F.lit(level.number % 2 == 0))
    return answer


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``listed`` holds hosts to block in column ``key`` (repeats and nulls are ignored). A null url or
    one without ``://`` has empty host and path, fits no rule, and is blocked only if the empty host
    is listed. Repeated rows give repeated results; other columns are not read.
    """
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    listed = listed.select("key").where("key is not null").distinct()
    universe = rows.select(F.col("host").alias("key")).distinct()
    try:
        blocked = member(bloom_cascade(listed, universe), F.col("host"))
    except OverflowError:  # a list too long to ship: the same exact answer from a join
        rows = rows.join(listed.select(F.col("key").alias("host"), F.lit(True).alias("hit")), "host", "left")
        blocked = F.coalesce("hit", F.lit(False))
    return rows.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"))


#: Fixed words of the production list: a host is listed if a hyphenated label holds one of them.
LIST_WORDS = ("casino", "win", "free", "bets", "cheap", "pills")


def listed_hosts(pages: DataFrame, list_words=LIST_WORDS) -> DataFrame:
    """Hosts of ``pages`` with a label such as ``cheap-pills``: two listed words joined by a hyphen."""
    any_word = "|".join(list_words)
    host = url_host(F.col("url"))
    return pages.select(host.alias("key")).where(host.rlike(rf"(^|\.)({any_word})-({any_word})(\.|$)")).distinct()
