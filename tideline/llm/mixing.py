"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is permuted by a hash and cut into blocks of ``block_words``; its target gives it a
quota of blocks. The tree halves the output shards level by level: a node's quotas are split
between its children by an exact multivariate-hypergeometric draw, so every shard gets its size
and every source exactly its quota. A shard then owns a run of each source's permuted blocks.
Runs end at hash cuts, so a document finds its shards from its own hash and its source's cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import free_names, located, share, stored, text_of, words

#: First level of the prefix sums over a source's permuted documents.
BUCKET_BITS = 10


def source_key(column: Column) -> Column:
    """A key without nulls that sorts like the source by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit("~"))


def permuted(seed: int) -> Column:
    """A document's place in its source's permutation, 63 bits.

    Rows that share a doc_id move together; a row without one moves by its text and its number in its file.
    """
    nameless = F.xxhash64(F.lit(seed), text_of(), F.col("_metadata.row_index"))
    return F.shiftrightunsigned(F.when(F.col("doc_id").isNull(), nameless).otherwise(F.xxhash64(F.lit(seed), "doc_id")), 1)


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share_of_all: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """(key, rank, source_size, target), one row per source; targets are capped and the excess reshared by weight."""
    per_source = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    level = Window.orderBy("ratio", "rank")
    ranked = per_source.withColumn("rank", F.row_number().over(Window.orderBy("key")) - 1).select(
        "*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))) + 1).alias("w"),
        (F.col("source_size") * float(max_repeat)).alias("cap"))
    # sources fill up in the order of cap / weight; the first that does not fill sets the water level
    steps = ranked.withColumn("ratio", F.col("cap") / F.col("w")).select(
        "*", (F.sum("source_size").over(Window.partitionBy()) * share_of_all).alias("total"),
        F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)).alias("filled"),
        F.sum("w").over(level.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("left_w"),
    ).withColumn("water", (F.col("total") - F.coalesce("filled", F.lit(0.0))) / F.col("left_w"))
    water = F.min(F.when(F.col("water") <= F.col("ratio"), F.struct("ratio", "rank", "water"))).over(Window.partitionBy())
    return steps.withColumn("at", water["water"]).select(
        "key", "rank", "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("at") * F.col("w"), F.col("cap"))).alias("target"))


def log_factorial(n: Column) -> Column:
    """Exact up to 20, Stirling's series beyond (error below 1e-12)."""
    x = n.cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(series)


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among ``good``, by inversion of the distribution at ``u``.

    Terms beyond 12 standard deviations are below the resolution of a double and are not summed.
    """
    rest = total - good
    n = F.greatest(total, F.lit(1)).cast("double")
    mean = draws * good / n
    spread = 12 * F.sqrt(mean * F.greatest(rest / n, F.lit(0.0)) * (total - draws) / n) + 4
    low = F.greatest(F.lit(0), draws - rest, F.floor(mean - spread)).cast("long")
    high = F.least(good, draws, F.ceil(mean + spread)).cast("long")
    fixed = (log_factorial(good) + log_factorial(rest) + log_factorial(draws) + log_factorial(total - draws)
             - log_factorial(total))

    def step(state: Column, k: Column) -> Column:
        term = F.exp(fixed - log_factorial(k) - log_factorial(good - k) - log_factorial(draws - k)
                     - log_factorial(rest - draws + k))
        sum_ = state["sum"] + term
        return F.when(state["x"].isNotNull(), state).otherwise(
            F.struct(sum_.alias("sum"), F.when(sum_ >= u, k).alias("x")))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("x"))
    return F.coalesce(F.aggregate(F.sequence(low, F.greatest(low, high)), start, step, lambda s: s["x"]), high)


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(node, quotas) per shard from one row of root quotas: ``levels`` halvings, each an exact draw."""
    nodes = quotas.select(F.lit(0).cast("long").alias("node"), "quotas")
    for level in range(levels):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        draw = F.lit(level)

        def take(state: Column, i: Column) -> Column:
            q = F.element_at("quotas", i + 1)
            u = share(F.lit(seed), draw, F.col("node"), i)  # noqa: B023  used before the next level
            x = hypergeometric(q, state["total"], state["draws"], u)
            return F.struct(
                F.concat(state["left"], F.array(x)).alias("left"),
                (state["total"] - q).alias("total"), (state["draws"] - x).alias("draws"))

        start = F.struct(
            F.array().cast("array<long>").alias("left"), total.alias("total"),
            F.floor((total + F.pmod(F.col("node"), F.lit(2))) / 2).cast("long").alias("draws"))
        left = F.aggregate(F.sequence(F.lit(0), F.size("quotas") - 1), start, take, lambda s: s["left"])
        nodes = nodes.select("node", "quotas", left.alias("left")).select("node", F.posexplode(F.array(
            F.col("left"), F.zip_with("quotas", "left", lambda q, x: q - x))).alias("side", "quotas")).select(
            (F.col("node") * 2 + F.col("side")).alias("node"), "quotas")
    return nodes


def mix_plan(
    sizes: DataFrame, weights=(5, 2, 1), share_of_all: float = 1.0, max_repeat: int = 3,
    shard_levels: int = 6, block_words: int = 1 << 16, seed: int = 7,
) -> DataFrame:
    """(key, source_size, target, cuts) per source from (key, h, size) rows.

    ``cuts`` is sorted: array of (epoch, cut, shard). In epoch e a document with hash h goes to the
    shard of the first cut of e that is at least h, or is not drawn if there is none.
    """
    sources = stored(source_targets(sizes, weights, share_of_all, max_repeat), "sources", 1)
    quota = F.ceil(F.col("target") / block_words).cast("long")
    root = sources.select("rank", quota.alias("q")).groupBy().agg(
        F.sort_array(F.collect_list(F.struct("rank", "q"))).alias("ranked")).where(F.size("ranked") > 0).select(
        F.transform("ranked", lambda r: r["q"]).alias("quotas"))
    shards = stored(split_quotas(root, shard_levels, seed), "shards", 1).select(
        F.col("node").alias("shard"), F.posexplode("quotas").alias("rank", "blocks"))

    # ends of the shards' runs and of the epochs, as positions in words along a source's repeated permutation
    runs = shards.withColumn("upto", F.sum("blocks").over(Window.partitionBy("rank").orderBy("shard"))).where("blocks > 0")
    ends = runs.join(sources, "rank").select(
        "key", "source_size", F.least(F.col("upto") * float(block_words), F.col("target")).alias("x"), "shard")
    epochs = sources.where("source_size > 0").select(
        "key", "source_size", F.explode(F.sequence(F.lit(1), F.lit(max_repeat))).alias("e"), "target").select(
        "key", "source_size", (F.col("e") * F.col("source_size")).cast("double").alias("x"), F.lit(None).cast("long").alias("shard"),
        "target").where("x < target").drop("target")
    along = Window.partitionBy("key").orderBy("x")
    size = F.col("source_size")
    segments = ends.unionByName(epochs).groupBy("key", "source_size", "x").agg(F.min("shard").alias("shard")).select(
        "key", "source_size", "x", F.coalesce(F.lag("x").over(along), F.lit(0.0)).alias("prev"),
        F.first("shard", ignorenulls=True).over(along.rowsBetween(0, Window.unboundedFollowing)).alias("shard"),
    ).withColumn("epoch", F.floor(F.col("prev") / size).cast("int")).select(
        "key", "epoch", "shard", (F.col("x") - F.col("epoch") * size).alias("x"), (F.col("x") >= (F.col("epoch") + 1) * size).alias("all"))

    # a position becomes a hash: by bucket sums first, then inside the one bucket that holds it
    shift = 63 - BUCKET_BITS
    bucketed = sizes.withColumn("bucket", F.shiftright("h", shift))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("key", "bucket").agg(F.sum("size").alias("in_bucket")).withColumn(
        "before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
    found = segments.where("not all").join(sums, "key").where("before <= x and x < before + in_bucket")
    found = stored(found.select("key", "epoch", "shard", "x", "bucket", "before"), "found", 1)
    inside = Window.partitionBy("key", "bucket").orderBy("h")
    units = bucketed.join(found.select("key", "bucket").distinct(), ["key", "bucket"], "left_semi").groupBy(
        "key", "bucket", "h").agg(F.sum("size").alias("unit")).withColumn(
        "mid", F.sum("unit").over(inside) - F.col("unit") / 2)
    cuts = found.join(units, ["key", "bucket"], "left").groupBy("key", "epoch", "shard", "x", "bucket").agg(
        F.max(F.when(F.col("before") + F.col("mid") <= F.col("x"), F.col("h"))).alias("cut")).select(
        "key", "epoch", "shard", F.coalesce("cut", F.shiftleft(F.col("bucket"), shift) - 1).alias("cut"))
    whole = segments.where("all").select("key", "epoch", "shard", F.lit((1 << 63) - 1).alias("cut"))
    lists = cuts.unionByName(whole).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "cut", "shard"))).alias("cuts"))
    return stored(sources.join(lists, "key", "left").select("key", "source_size", "target", "cuts"), "mix", 1)


def draws_of(h: Column, cuts: Column, max_repeat: int = 3) -> Column:
    """The shards that draw a document, one entry per epoch that takes it."""
    def in_epoch(e: Column) -> Column:
        return F.get(F.filter(cuts, lambda c: (c["epoch"] == e) & (h <= c["cut"])), F.lit(0))["shard"]
    drawn = F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)), in_epoch)
    return F.coalesce(F.filter(drawn, lambda s: s.isNotNull()), F.array().cast("array<long>"))


def mix_sources(docs: DataFrame, seed: int = 7, max_repeat: int = 3, **plan) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, shards.

    ``shards`` lists the output shard of each copy that the mix takes, ``taken`` the words of all
    copies. A null text has size 0; a null source is a source of its own, last in order; a source
    without words has target 0. Rows with one doc_id share their fate, rows without one are drawn each by itself. Other columns are
    not read; an empty table gives an empty result. Reruns agree: all draws come from hashes.
    """
    sizes = stored(located(docs).select("doc_id", source_key(F.col("source")).alias("key"), words(text_of()).alias("size"),
                                        permuted(seed).alias("h")), "sizes")
    plan_ = mix_plan(sizes, seed=seed, max_repeat=max_repeat, **plan)
    return sizes.join(plan_, "key").withColumn("shards", draws_of(F.col("h"), F.col("cuts"), max_repeat)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mixed_rows(docs: DataFrame, seed: int = 7, max_repeat: int = 3, shard_levels: int = 6, **plan) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as drawn, gathered by shard and shuffled inside each."""
    docs = located(docs)
    sizes = stored(docs.select(source_key(F.col("source")).alias("key"), words(text_of()).alias("size"), permuted(seed).alias("h")), "sizes")
    key, cuts, shard, h = free_names(docs, "key", "cuts", "shard", "h")
    plan_ = mix_plan(sizes, seed=seed, max_repeat=max_repeat, shard_levels=shard_levels, **plan).select(
        F.col("key").alias(key), F.col("cuts").alias(cuts))
    placed = docs.select("*", permuted(seed).alias(h), source_key(F.col("source")).alias(key))
    drawn = placed.join(plan_, key).withColumn(shard, F.explode(draws_of(F.col(h), F.col(cuts), max_repeat)))
    order = F.xxhash64(F.lit(seed), F.col(shard), F.col(h))
    return drawn.repartition(shard).sortWithinPartitions(shard, order).select(*[F.col(f"`{c}`") for c in docs.columns])
