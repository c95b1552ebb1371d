"""Hard negatives by best-first search in STR-packed R-trees.

Rows of a label are dealt into slabs by their first coordinate; a slab is tiled along its two widest coordinates
into leaves (sort-tile-recursive packing) and kept as one tree with the bounding box of every leaf. A box gives, by
coordinate, an interval for the inner product of a query with whatever lies in it. Blocks of queries walk a tree from
a queue ordered by the upper end, and pass over boxes that are outside a query's score window or strictly below its
k-th score, which they carry from tree to tree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pivot_search import lists_of, quantised
from .util import stored

#: Rows of a tree and of a leaf, and queries that walk together.
SLAB, LEAF, QUERIES_PER_BLOCK = 8192, 256, 512
#: Trees that a block of queries meets in one task at most.
TREES_PER_STRIPE = 64
#: Beyond every score that fits a long.
FAR = float("inf")

TREE = ("tree long, dim int, label int, lo array<long>, hi array<long>, leaf_sizes array<int>, leaf_lo binary, leaf_hi binary, "
        "ids binary, kind string, v binary")


def narrow(v: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest signed type that holds them."""
    for kind in ("<i2", "<i4"):
        info = np.iinfo(kind)
        if v.size == 0 or info.min <= v.min() and v.max() <= info.max:
            return v.astype(kind)
    return v


def tiles(v: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of every leaf: sorted along the widest coordinate and sliced, each slice along the next widest."""
    n = len(v)
    if n <= leaf or not v.shape[1]:
        return np.array_split(np.arange(n), max(1, -(-n // leaf)))
    wide = np.argsort(-np.ptp(v, axis=0), kind="stable")
    leaves = -(-n // leaf)
    slices = int(np.ceil(np.sqrt(leaves)))
    out = []
    for part in np.array_split(np.argsort(v[:, wide[0]], kind="stable"), slices):
        inner = part[np.argsort(v[part, wide[min(1, len(wide) - 1)]], kind="stable")]
        out += np.array_split(inner, max(1, -(-len(inner) // leaf)))
    return out


def pack_trees(slab: int, leaf: int):
    """A mapInArrow function: rows (dim, label, vec_id, v) sorted by dim and label to trees of at most ``slab`` rows."""
    made, held = 0, []

    def tree(dim: int, label: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        nonlocal made
        leaves = tiles(v, leaf)
        order = np.concatenate(leaves)
        lo, hi = (np.stack([f(v[x], axis=0) for x in leaves]).astype("<i8") for f in (np.min, np.max))
        small = narrow(v[order])
        number = TaskContext.get().partitionId() << 32 | made
        made += 1
        columns = [[number], [dim], [label], [lo.min(axis=0)], [hi.max(axis=0)], [[len(x) for x in leaves]], [lo.tobytes()],
                   [hi.tobytes()], [ids[order].astype("<i8").tobytes()], [small.dtype.str], [small.tobytes()]]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
                 pa.binary(), pa.binary(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in TREE.split(", ")])

    def flush() -> Iterator[pa.RecordBatch]:
        dim, label = held[0][:2]
        ids, v = (np.concatenate([h[i] for h in held]) for i in (2, 3))
        held.clear()
        for s in range(0, len(ids), slab):
            yield tree(dim, label, ids[s:s + slab], v[s:s + slab])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, labels, ids = (batch.column(c).to_numpy() for c in ("dim", "label", "vec_id"))
            flat, at = lists_of(batch.column("v"))
            cuts = np.flatnonzero((dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if e > s:
                    dim, label = int(dims[s]), int(labels[s])
                    if held and (held[0][:2] != (dim, label) or sum(len(h[2]) for h in held) >= slab):
                        yield from flush()
                    held.append((dim, label, ids[s:e], flat[at[s]:at[e]].astype(np.int64).reshape(e - s, dim)))
        if held:
            yield from flush()
    return run


class Block:
    """Queries that walk together. Each has asks: a window of scores, and the best k ids in it so far."""

    def __init__(self, queries: pa.StructArray, dim: int, k: int, same: bool) -> None:
        self.k, self.same = k, same
        self.key, self.id, self.label = (queries.field(c).to_numpy() for c in ("key", "vec_id", "label"))
        self.q = lists_of(queries.field("v"))[0].astype(np.int64).reshape(len(self.key), dim)
        asks, at = queries.field("asks"), lists_of(queries.field("asks"))[1]
        self.owner = np.repeat(np.arange(len(self.key)), np.diff(at))
        flat = asks.flatten()
        self.ask = flat.field("ask").to_numpy()
        self.low, self.high = (np.array([bound(x) for x in flat.field(c).to_pylist()]) for c in ("low", "high"))
        self.best = np.full(len(self.owner), -FAR)
        self.pool = [np.empty(0, np.int64) for _ in range(3)]

    def wanted(self, upper: np.ndarray, lower: np.ndarray, label: int) -> np.ndarray:
        """Asks to which a box with these intervals may add something."""
        up, down = upper[self.owner], lower[self.owner]
        return ((self.label[self.owner] == label) == self.same) & (up >= np.maximum(self.low, self.best)) & (down <= self.high)

    def add(self, asks: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.pool = [np.concatenate(x) for x in zip(self.pool, (asks, scores, ids))]
        if len(self.pool[0]) > 2 * self.k * len(self.owner):
            self.settle()

    def settle(self) -> None:
        """The first k of every ask stay, higher scores first, then smaller ids."""
        asks, scores, ids = self.pool
        order = np.lexsort((ids, -scores, asks))
        asks, scores, ids = asks[order], scores[order], ids[order]
        rank = np.arange(len(asks)) - np.searchsorted(asks, asks)
        best = scores[rank == self.k - 1]
        exact = np.abs(best) < 1 << 53  # a rounded bound must not be above the score
        self.best[asks[rank == self.k - 1]] = np.where(exact, best, np.nextafter(best.astype(np.float64), -FAR))
        self.pool = [x[rank < self.k] for x in (asks, scores, ids)]

    def found(self) -> pa.RecordBatch:
        self.settle()
        asks, scores, ids = self.pool
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.key[self.owner[asks]], self.ask[asks], scores.astype(np.int64), ids)],
            ["key", "ask", "score", "vec_id"])


def bound(x: int | None) -> float | int:
    return FAR if x is None else x


def interval(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every query with points of every box: (queries, boxes) each."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    return plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T


def walk(block: Block, row: dict) -> None:
    """Take from one tree what the block's asks can use, the most promising box first."""
    dim, sizes = row["dim"], row["leaf_sizes"]
    v = np.frombuffer(row["v"], row["kind"]).reshape(-1, dim) if dim else np.empty((sum(sizes), 0), np.int64)
    ids = np.frombuffer(row["ids"], "<i8")
    largest = max((int(np.abs(x).max(initial=0)) for x in (v.astype(np.int64), block.q)))
    kind = np.float64 if largest ** 2 * max(1, dim) < 1 << 53 else np.int64  # sums that a double holds exactly
    q = block.q.astype(kind)
    lo, hi = (np.frombuffer(row[c], "<i8").reshape(len(sizes), dim).astype(kind) for c in ("leaf_lo", "leaf_hi"))
    lower, upper = interval(q, lo, hi)
    ends = np.cumsum(sizes)
    root = interval(q, np.array([row["lo"]]).reshape(1, dim).astype(kind), np.array([row["hi"]]).reshape(1, dim).astype(kind))
    queue: list[tuple[float, int]] = [(-float(root[1].max()), -1)]
    while queue:
        _, box = heapq.heappop(queue)
        down, up = (root[0][:, 0], root[1][:, 0]) if box < 0 else (lower[:, box], upper[:, box])
        asks = np.flatnonzero(block.wanted(up, down, row["label"]))
        if not len(asks):
            continue
        if box < 0:
            for leaf, best in enumerate(upper[block.owner[asks]].max(axis=0).tolist()):
                heapq.heappush(queue, (-best, leaf))
            continue
        s, e = int(ends[box]) - sizes[box], int(ends[box])
        owners, at = np.unique(block.owner[asks], return_inverse=True)
        scores = (q[owners] @ v[s:e].astype(kind).T)[at]
        good = (scores >= np.maximum(block.low, block.best)[asks, None]) & (scores <= block.high[asks, None])
        good &= block.id[block.owner[asks], None] != ids[None, s:e]
        i, j = np.nonzero(good)
        block.add(asks[i], scores[i, j].astype(np.int64), ids[s + j])


def search(trees: DataFrame, blocks: DataFrame, on: list[str], k: int, same: bool) -> DataFrame:
    """(key, ask, score, vec_id): the first k rows of every ask, rows of the query's label (``same``) or of the others.

    ``blocks`` has a row of queries for each block; it meets the trees that agree in ``on``, some in every stripe.
    """
    spark = trees.sparkSession
    n = trees.groupBy(*on).count().agg(F.max("count")).first()[0] or 0
    parallel = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, blocks.count()))
    stripes = max(1, -(-n // TREES_PER_STRIPE), min(n, parallel))
    # an equal join on block and stripe: no key gathers more than a stripe of trees and one block
    count = blocks.groupBy(*on).agg((F.max("block") + 1).alias("blocks"))
    dealt = trees.join(count, on).withColumn("stripe", F.pmod(F.xxhash64("tree"), F.lit(stripes)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    numbered = blocks.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).select(
        *on, "block", "stripe", "queries")
    pairs = dealt.join(numbered, [*on, "block", "stripe"]).sortWithinPartitions(*on, "block", "stripe", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names if c != "queries"}
                if (place := tuple(row[c] for c in (*on, "block", "stripe"))) != at:
                    if block is not None:
                        yield block.found()
                    at, block = place, Block(batch.column("queries")[r].values, row["dim"], k, same)
                walk(block, row)
        if block is not None:
            yield block.found()

    found = pairs.mapInArrow(run, "key long, ask long, score long, vec_id long")
    first = Window.partitionBy("key", "ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def query_blocks(queries: DataFrame, on: list[str], size: int) -> DataFrame:
    """Rows (key, dim, label, vec_id, v, asks) in blocks of about ``size``."""
    count = queries.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    return stored(queries.join(count, on).groupBy(*on, F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block")).agg(
        F.collect_list(F.struct("key", "vec_id", "label", "v", "asks")).alias("queries")), "blocks")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    slab: int = SLAB, leaf: int = LEAF, block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The hard negatives of every anchor: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label, ``is_anchor`` is a condition on vec_id. Scores are inner products of
    the components times 256, floored, and must fit a long; higher ones come first, then smaller ids. An anchor's
    positives are its first ``positives`` other rows of its label; its negatives for each are the first ``negatives``
    rows of other labels whose score is ``low`` to ``high`` hundredths of the positive's (none, if that is below zero).
    Rows with a null id, label or vector or with null or non-finite components take no part, exact repeats of a row count
    once, and vectors of another length are never candidates; rows that differ but share a vec_id are no candidates of
    each other. An anchor without positives or negatives has no rows; an empty table gives an empty result.
    """
    rows = vectors.select(
        "vec_id", F.col("label").cast("int").alias("label"), quantised(F.col("embedding")).alias("v"), is_anchor.alias("asks"))
    rows = stored(rows.where("vec_id is not null and label is not null and v is not null").distinct().withColumn(
        "dim", F.size("v")).withColumn("key", F.xxhash64("vec_id", "label", "v")), "vectors")
    along = ["dim", "label", F.get("v", F.lit(0)), "vec_id"]
    trees = stored(rows.repartitionByRange(*along).sortWithinPartitions(*along).select("dim", "label", "vec_id", "v").mapInArrow(
        pack_trees(slab, leaf), TREE), "trees")
    anchors = rows.where("asks").select("key", "dim", "label", "vec_id", "v")

    def asks(ask: Column, least: Column, most: Column) -> Column:
        return F.struct(ask.alias("ask"), least.alias("low"), most.alias("high"))

    anything = F.array(asks(F.lit(0).cast("long"), F.lit(-(1 << 63)).cast("long"), F.lit(None).cast("long")))
    blocks = query_blocks(anchors.withColumn("asks", anything), ["dim", "label"], block)
    near = stored(search(trees, blocks, ["dim", "label"], positives, same=True).select(
        "key", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    p = F.col("positive_score").cast("decimal(20,0)")
    least, most = F.ceil(p * low / 100).cast("long"), F.floor(p * high / 100).cast("long")
    windows = near.groupBy("key").agg(F.collect_list(asks(F.col("rank").cast("long"), least, most)).alias("asks"))
    blocks = query_blocks(anchors.join(windows, "key"), ["dim"], block)
    hard = search(trees, blocks, ["dim"], negatives, same=False).select(
        "key", F.col("ask").cast("int").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return hard.join(near.withColumnRenamed("rank", "positive_rank"), ["key", "positive_rank"]).join(
        anchors.select("key", F.col("vec_id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
